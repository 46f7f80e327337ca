"""Rendering, parsing and the last delivery without needless copies, comparisons and shuffles."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaywork.operators import interchange as I
from quaywork.streaming import jobs

TEXT = "ISA*00*SENDER~st*940* 1 ~W05*N*A1**20260801~W01*5*EA*VN**  *Q~SE*4*1~ST*940*2~W05*N*A2~W01*1*EA~SE*4*2~ST*940*3~"


def received(spark, *texts):
    rows = [(i + 1, f"f{i + 1}", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "RawId bigint, FileName string, RawEDIText string")


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_parse_copies_no_blocks(spark):
    parsed = I.parse_files(received(spark, TEXT))
    assert "AS blocks" not in plan(parsed)
    row = parsed.first()
    first, second = row["transactions"]
    assert (first["STControlNumber"], first["WarehouseOrderNumber"], first["ShipDate"]) == ("1", "A1", "20260801")
    assert (second["STControlNumber"], second["WarehouseOrderNumber"], second["ShipDate"]) == ("2", "A2", None)
    line = first["details"][0]
    assert (line["ProductId"], line["ProductQualifier2"], line["ProductId2"]) == (None, None, "Q")
    assert row["unterminated"] == [10]


def test_rendering_compares_flat_keys(spark):
    orders = spark.createDataFrame(
        [(1, 1, "S", "R", "000000001", "20260801", "A", "20260801", "N", "I")],
        "RawId bigint, OrderId bigint, Sender string, Receiver string, ControlNumber string, DateText string, "
        "OrderNumber string, ShipDate string, ShipToName string, ShipToId string",
    )
    keys = [(2, "c"), ((1), "b"), (None, "n")]
    lines = spark.createDataFrame(
        [(1, k, s) for k, s in keys], "OrderId bigint, k int, Sku string"
    ).select(
        "OrderId",
        F.when(F.col("k").isNotNull(), F.struct("k")).alias("SortKey"),
        F.lit("1").alias("Quantity"),
        F.lit("EA").alias("UOM"),
        F.lit("VN").alias("Qualifier"),
        "Sku",
    )
    text = I.render_940(orders, lines)
    assert "named_struct(SortKey" not in plan(text) and "struct(SortKey" not in plan(text)
    found = [s.split("*")[-1] for s in text.first()["RawEDIText"].split("~") if s.startswith("W01")]
    assert found == ["n", "b", "c"]


def test_the_last_delivery_is_found_without_moving_the_rest(spark, tmp_path):
    for batch, ids in enumerate([[1, 2, 3], [2]]):
        rows = [(i, f"{i}-{batch}") for i in ids]
        spark.createDataFrame(rows, "RawId bigint, FileName string").write.parquet(f"{tmp_path}/batch={batch}")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        last = jobs.read_parsed(spark, str(tmp_path))
        assert sorted(map(tuple, last.collect())) == [(1, "1-0"), (2, "2-1"), (3, "3-0")]
        assert "SortMergeJoin" not in last._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
