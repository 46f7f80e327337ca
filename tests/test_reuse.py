"""What is used several times is computed once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    orders = spark.range(40).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 5).alias("o_custkey"), F.expr("timestamp_ntz'2001-01-01 00:00:00' AS o_orderdate")
    )
    orders.write.parquet(f"{path}/orders.parquet")
    customer = spark.range(5).select(
        F.col("id").alias("c_custkey"), F.lit("FURNITURE").alias("c_mktsegment"), F.expr("concat('Name ', id) AS c_name")
    )
    customer.write.parquet(f"{path}/customer.parquet")
    lines = spark.range(80).select(
        (F.col("id") % 40).alias("l_orderkey"),
        (F.floor(F.col("id") / 40) + 1).cast("int").alias("l_linenumber"),
        (F.col("id") + 1).alias("l_partkey"),
        F.col("id").alias("l_suppkey"),
        F.lit(3.0).alias("l_quantity"),
        *[F.lit(1.0).alias(c) for c in ("l_extendedprice", "l_discount", "l_tax")],
        F.expr("timestamp_ntz'2001-01-02 00:00:00' AS l_shipdate"),
    )
    lines.write.parquet(f"{path}/lineitem.parquet")
    return path


@pytest.mark.parametrize(
    "name, rows",
    [("key_check", 7), ("b12_parse_status", 10), ("b13_reparse", 36), ("b15_envelope_check", 10), ("b16_render_roundtrip", 72)],
)
def test_files_are_rendered_and_parsed_once(spark, folder, name, rows):
    result = entry_module.queries()[name](spark, folder)
    assert not any("lineitem.parquet" in f for f in result.inputFiles())
    got = result.collect()
    assert len(got) == rows
    if name == "key_check":
        assert {r["violations"] for r in got} == {0}
