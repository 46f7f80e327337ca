"""The nightly flow: inbound folder to staged orders, as one restartable run.

A warehouse folder holds one sub-folder per table and, inside it, one per run.
Row tables (texts, parsed rows, order lines, logs) only grow: a run adds its
own folder.  Status tables (``files``, ``orders``) are written whole, without
file texts; the run before supplies the previous state.  Runs are numbered from
1, and a run that is repeated replaces exactly what it wrote before.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywork import schemas as S
from quaywork.functions.columns import clock
from quaywork.operators import interchange, staging
from quaywork.sources import files as sources
from quaywork.sources import sinks

PARSED = ("headers", "addresses", "details", "controls", "rejects")
FILE_COLUMNS = [c for c in S.columns("files") if c != "RawEDIText"]


class Warehouse:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, table: str, run: int) -> str:
        return f"{self.folder}/{table}/run={run}"

    def write(self, df: DataFrame, table: str, run: int) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(table, run))
        return self.spark.read.parquet(self.path(table, run))

    def run_rows(self, table: str, run: int) -> DataFrame:
        return self.spark.read.parquet(self.path(table, run))

    def all_rows(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}")


def run_batch(
    spark: SparkSession,
    inbound: str,
    warehouse: str,
    run: int,
    as_of: datetime | None = None,
    strict: bool = False,
) -> Warehouse:
    """Ingest, parse, stage and log what lies in ``inbound`` and was not received before."""
    house = Warehouse(spark, warehouse)
    first = run == 1
    old_files = spark.createDataFrame([], S.schema("files")).select(*FILE_COLUMNS)
    old_orders = spark.createDataFrame([], S.schema("wms_orders"))
    after = 0
    if not first:
        old_files = house.run_rows("files", run - 1)
        old_orders = house.run_rows("orders", run - 1)
        after = old_files.agg(F.coalesce(F.max("RawId"), F.lit(0))).first()[0]

    received = interchange.enrich_isa(sources.ingest_files(spark, inbound, after))
    fresh_files = _unseen(house, received, run)
    texts = house.write(received.join(fresh_files.select("RawId"), "RawId", "left_semi"), "texts", run)

    pending = interchange.newest_unparsed(texts)
    # Texts are read and tokenised once; every table comes from the nested result.
    parsed = house.write(interchange.parse_files(pending, strict), "parsed", run)
    tables = {
        name: house.write(getattr(interchange, name)(parsed), name, run) for name in PARSED
    }

    fresh = staging.stage_headers(
        tables["headers"], tables["addresses"], None if first else old_orders, as_of=as_of
    )
    orders = house.write(old_orders.unionByName(fresh), "orders", run)
    house.write(staging.header_rejects(tables["headers"]), "staging_rejects", run)
    this_run = tables["headers"].select(F.col("HeaderId").alias("SourceHeaderId"))
    staged_now = orders.join(this_run, "SourceHeaderId", "left_semi")
    house.write(staging.stage_lines(tables["details"], staged_now, as_of=as_of), "lines", run)
    house.write(staging.line_rejects(tables["details"], staged_now), "line_rejects", run)

    outcome = parsed.select("RawId", "Problem")
    # Only this run's files change state, so the earlier ones need no join.
    statuses = interchange.apply_parse_status(texts.select(*FILE_COLUMNS), outcome, as_of)
    statuses = staging.mark_staged(statuses, tables["headers"], staged_now)
    house.write(old_files.unionByName(statuses.select(*FILE_COLUMNS)), "files", run)

    house.write(staging.staging_log(staged_now, as_of), "events", run)
    activity = parsed.select(
        "FileName",
        F.when(F.col("Problem").isNull(), "SUCCESS").otherwise("ERROR").alias("ProcessStatus"),
        clock(as_of).alias("ProcessDateTime"),
        F.col("Problem").alias("ErrorMessage"),
        F.size("transactions").alias("RecordsProcessed"),
    )
    house.write(sinks.processing_entries(activity), "processing_log", run)
    house.write(sinks.audit_entries(activity), "audit_log", run)
    return house


def _unseen(house: Warehouse, received: DataFrame, run: int) -> DataFrame:
    """(RawId, FileName, Digest) of the files whose content no earlier run received, each content once.

    The list is kept as ``seen`` and the files left out as ``skipped``, so that a
    file delivered again, under whatever name, is not processed again.  A blank
    file is known by its name.
    """
    content = F.coalesce(F.nullif(F.col("RawEDIText"), F.lit("")), F.concat(F.lit("blank: "), "FileName"))
    digests = received.select("RawId", "FileName", F.sha2(content, 256).alias("Digest"))
    first = digests.groupBy("Digest").agg(F.min(F.struct("RawId", "FileName")).alias("f"))
    kept = first.select("f.RawId", "f.FileName", "Digest")
    if run > 1:
        earlier = house.all_rows("seen").where(F.col("run") < run).select("Digest")
        kept = kept.join(earlier, "Digest", "left_anti")
    kept = house.write(kept, "seen", run)
    house.write(digests.join(kept.select("RawId"), "RawId", "left_anti"), "skipped", run)
    return kept


def apply_responses(
    spark: SparkSession, warehouse: str, run: int, events: DataFrame
) -> DataFrame:
    """Fold warehouse responses into the orders of ``run`` as the next run's state."""
    house = Warehouse(spark, warehouse)
    orders = house.run_rows("orders", run)
    house.write(staging.integration_log(orders, events), "events", run + 1)
    house.write(house.run_rows("files", run), "files", run + 1)
    return house.write(staging.apply_transitions(orders, events), "orders", run + 1)
