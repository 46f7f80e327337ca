"""Inbound files: ingest, queue metrics and locating stored copies."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywork import schemas as S
from quaywork.functions.columns import clock, from_micros, micros, second_index
from quaywork.functions.skew import carried, globally_numbered, join_checked

CONTAINERS = ("archive", "inbound")


def _as_received(text: DataFrame) -> DataFrame:
    meta = F.col("_metadata")
    return text.select(
        meta["file_path"].alias("FilePath"),
        meta["file_name"].alias("FileName"),
        F.col("value").alias("RawEDIText"),
        from_micros(F.unix_micros(meta["file_modification_time"])).alias("LoadDateTime"),
        F.lit("RAW_LOADED").alias("ProcessStatus"),
        F.lit(None).cast("timestamp_ntz").alias("ParsedDateTime"),
        *[
            F.lit(None).cast("string").alias(c)
            for c in ("ErrorMessage", "ISASender", "ISAReceiver", "ISA_ControlNumber")
        ],
        F.lit(None).cast("timestamp_ntz").alias("CustomerReportedDateTime"),
        F.lit(None).cast("string").alias("CustomerReportedBy"),
    )


def number_files(
    received: DataFrame, after: int = 0, listing: DataFrame | None = None
) -> DataFrame:
    """Add a gap-free RawId that grows with the arrival second.

    Numbering works on paths and times alone, from ``listing`` where one is
    given; the texts stay where they are unless the numbers are too many to
    broadcast.
    """
    second = second_index(F.col("LoadDateTime"))
    found = (received if listing is None else listing).select("FilePath", "LoadDateTime")
    order = [second, F.xxhash64("FilePath"), F.col("FilePath")]
    ids = globally_numbered(found, order, "RawId", after).select("FilePath", "RawId")
    numbered_files = join_checked(received, ids, "FilePath", "inner")
    return numbered_files.select(*S.columns("files"))


def ingest_files(spark: SparkSession, path: str, after: int = 0) -> DataFrame:
    """One RAW_LOADED row per file below ``path``; a blank file keeps its row.

    Ids continue after ``after``.  A file is one row, which Spark limits to
    2 GB; interchanges are far smaller.  Spark's file sources do not list files
    of zero bytes, so those never arrive.
    """
    whole = spark.read.format("text").option("wholetext", "true").load(path)
    # The binary source lists files without opening them.
    meta = F.col("_metadata")
    listing = spark.read.format("binaryFile").load(path).select(
        meta["file_path"].alias("FilePath"),
        from_micros(F.unix_micros(meta["file_modification_time"])).alias("LoadDateTime"),
    )
    return number_files(_as_received(whole), after, listing)


def stream_files(
    spark: SparkSession,
    path: str,
    archive: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Files as they arrive; with ``archive`` a processed file leaves the inbound folder.

    Numbers are given per micro-batch by :func:`number_files`.
    """
    reader = spark.readStream.format("text").option("wholetext", "true")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _as_received(reader.load(path))


def list_files(spark: SparkSession, path: str, container: str = "inbound") -> DataFrame:
    """Names, times and sizes below ``path``; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select(
            F.lit(container).alias("Container"),
            F.element_at(F.split("path", "/"), -1).alias("BlobName"),
            from_micros(F.unix_micros("modificationTime")).alias("ModifiedDateTime"),
            F.col("length").alias("Bytes"),
        )
    )


def queue_metrics(listing: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Files waiting and the age of the oldest in whole seconds; 0 and 0 when empty."""
    elapsed = micros(clock(as_of)) - micros(F.min("ModifiedDateTime"))
    age = (elapsed / F.lit(1_000_000)).cast("bigint")
    return listing.agg(
        F.count(F.lit(1)).alias("filesWaiting"),
        F.coalesce(age, F.lit(0)).cast("bigint").alias("oldestFileAgeSeconds"),
    )


def locate_files(names: DataFrame, listing: DataFrame) -> DataFrame:
    """Stored copy of each FileName: archive before inbound, exact before prefix.

    The stored names that begin with an asked one follow it in the order of
    names, an equal one first.  So asked and stored names are sorted together,
    backwards, and the nearest stored name of either kind of container is carried
    along; if that one does not begin with the asked name, none does.  Rows that
    move are the names and the listing, once each.
    """
    archived = F.col("Container") == CONTAINERS[0]
    stored = listing.where(F.col("BlobName").isNotNull()).select(
        F.col("BlobName").alias("name"), F.struct("Container", "BlobName").alias("blob"), archived.alias("archived")
    )
    asked = names.where(F.col("FileName").isNotNull()).select(
        F.col("FileName").alias("name"), F.lit(None).alias("blob"), F.lit(None).alias("archived")
    )
    rows = stored.unionByName(asked.distinct())
    order = [F.desc("name"), F.asc_nulls_last("archived")]
    nearest = {
        "in_archive": F.when(F.col("archived"), F.col("blob")),
        "elsewhere": F.when(~F.coalesce("archived", F.lit(True)), F.col("blob")),
    }
    found = carried(rows, order, nearest).where("blob IS NULL")

    def fits(column: str) -> Column:
        return F.when(F.startswith(F.col(f"{column}.BlobName"), F.col("name")), F.col(column))

    best = found.select(F.col("name").alias("FileName"), F.coalesce(*map(fits, nearest)).alias("_b"))
    return names.join(best, "FileName", "left").select(
        *names.columns, F.col("_b.Container").alias("Container"), F.col("_b.BlobName").alias("BlobName")
    )


def read_order_staging(spark: SparkSession, path: str, batch: int) -> DataFrame:
    """Orders from CSV with a header; malformed lines keep their text in ``_corrupt``."""
    declared = S.schema("customer_orders_staging")
    fields = [f for f in declared.fields if f.name != "LoadBatchID"]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", _corrupt string"
    return (
        spark.read.schema(ddl)
        .option("header", "true")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .csv(path)
        .withColumn("LoadBatchID", F.lit(batch))
    )


def read_intake_scores(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(S.schema("intake_scores"))
        .option("header", "true")
        .option("escape", "\"")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )
