"""Sources and sinks: derived data is written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaywork.operators import interchange as I
from quaywork.plans.registry import query
from quaywork.session import scratch_path
from quaywork.sources import files as A
from quaywork.sources import sinks

BUNDLE = 500


@query(
    "a1_ingest_files",
    "txn",
    f"""SELECT lpad(CAST(min(RawId) AS VARCHAR), 9, '0') AS first_isa, count(DISTINCT RawId) AS interchanges, count(*) AS transactions,
       'RAW_LOADED' AS ProcessStatus FROM txn GROUP BY CAST(floor(RawId / {BUNDLE}) AS BIGINT)""",
)
def ingest_files(d):
    # Interchanges in bundles of 500, each bundle one text file in the inbound folder.
    path = scratch_path(d.spark, "inbound")
    bundle = F.floor(F.col("RawId") / BUNDLE).alias("bundle")
    lines = d.raw_files.select(bundle, F.col("RawEDIText").alias("value"))
    lines.repartition("bundle").write.partitionBy("bundle").text(path)
    received = A.ingest_files(d.spark, path)
    segments = I.tokenize(received)
    isa = F.when(F.col("SegmentId") == "ISA", F.substring_index(F.substring_index("SegmentText", "*", 14), "*", -1))
    counted = segments.groupBy("RawId").agg(
        F.min(isa).alias("first_isa"),
        F.count(isa).alias("interchanges"),
        F.count(F.when(F.col("SegmentId") == "ST", 1)).alias("transactions"),
    )
    return counted.join(received.select("RawId", "ProcessStatus"), "RawId").drop("RawId")


@query(
    "a4_export_lake",
    "",
    """SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, count(*) AS n, round(sum(value), 2) AS total
       FROM events GROUP BY ALL""",
)
def export_lake(d):
    path = scratch_path(d.spark, "lake")
    events = d.table("events")
    sinks.export_lake(events, path, "ts")
    # A second export of some days replaces these days only.
    again = events.where("ts >= timestamp_ntz'2024-01-20 00:00:00'")
    sinks.export_lake(again, path, "ts")
    return d.spark.read.parquet(path).groupBy(
        F.format_string("%04d", "year").alias("year"),
        F.format_string("%02d", "month").alias("month"),
        F.format_string("%02d", "day").alias("day"),
    ).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query(
    "a8_load_order_staging",
    "",
    """SELECT o_orderkey AS OrderID, o_custkey AS CustomerID, strftime(o_orderdate, '%Y-%m-%d') AS OrderDate,
       CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE round(o_totalprice, 2) END AS OrderAmount, 7 AS LoadBatchID, o_orderkey % 50 = 0 AS corrupt FROM orders""",
)
def load_order_staging(d):
    path = scratch_path(d.spark, "staging")
    orders = d.table("orders")
    orders.select(
        F.col("o_orderkey").alias("OrderID"),
        F.col("o_custkey").alias("CustomerID"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("OrderDate"),
        # Every fiftieth amount is not a number.
        F.when(F.col("o_orderkey") % 50 == 0, F.lit("n/a"))
        .otherwise(F.col("o_totalprice").cast("decimal(10,2)").cast("string"))
        .alias("OrderAmount"),
        F.col("o_orderstatus").alias("Status"),
        F.lit("9.5").alias("UnitPrice"),
        F.lit("TX").alias("ShipToState"),
        F.lit("someone").alias("CustomerName"),
        F.lit("SKU1").alias("sku"),
        F.lit("1").alias("quantity"),
    ).write.option("header", "true").csv(path)
    loaded = A.read_order_staging(d.spark, path, 7)
    return loaded.select(
        "OrderID",
        "CustomerID",
        "OrderDate",
        "OrderAmount",
        "LoadBatchID",
        F.col("_corrupt").isNotNull().alias("corrupt"),
    )


@query(
    "a11_intake_scores",
    "",
    """SELECT l.doc_id % 4 AS rounds, count(*) AS n, CAST(sum(l.quality) AS BIGINT) AS matches, round(sum(l.doc_id / 8.0), 3) AS latency FROM labels l GROUP BY 1""",
)
def intake_scores(d):
    path = scratch_path(d.spark, "scores")
    labels = d.table("labels")
    columns = {
        "run_date": F.lit("2026-08-12 17:59:19"),
        "context_length": F.lit(2048),
        "model": F.lit("m"),
        "prompt_variant": F.lit("baseline"),
        "case_set": F.lit("synthetic"),
        "name": F.concat(F.lit("case "), F.col("doc_id").cast("string")),
        "request": F.lit('add a "chart", please'),
        "expected_tier": F.lit("A"),
        "actual_tier": F.lit("A"),
        "tier_match": F.when(F.col("quality") == 1, "True").otherwise("False"),
        "forced_escalation": F.lit(None).cast("string"),
        "outcome": F.lit("ok"),
        "schema_valid": F.lit("True"),
        "detail": F.lit(None).cast("string"),
        "rounds": F.col("doc_id") % 4,
        "latency_sec": F.col("doc_id") / 8,
        "estimated_tokens": F.lit(30),
    }
    rows = labels.select(*[c.alias(n) for n, c in columns.items()])
    # Results accumulate over runs: two appends, one read.
    for part in (rows.where("rounds < 2"), rows.where("rounds >= 2")):
        part.write.mode("append").option("header", "true").option("escape", '"').csv(path)
    scores = A.read_intake_scores(d.spark, path)
    return scores.groupBy("rounds").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("tier_match").cast("int")).alias("matches"),
        F.round(F.sum("latency_sec"), 3).alias("latency"),
    )
