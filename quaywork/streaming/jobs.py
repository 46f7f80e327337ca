"""Streams over inbound files and events.

The functions ending in a DataFrame return an unstarted stream; ``run_*``
functions start one, work off what is there and stop.  All state and progress
live under a checkpoint folder, so a lost executor or a restart resumes there.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quaywork.functions.columns import micros
from quaywork.functions.skew import join_checked
from quaywork.operators import interchange
from quaywork.operators.lookup import RATE_LIMIT, RATE_WINDOW_SECONDS
from quaywork.schemas import STALE_MINUTES
from quaywork.session import ROCKSDB
from quaywork.streaming import state


def event_time(column: str) -> Column:
    """Watermarks need a zoned timestamp; the wall-clock value is kept as UTC."""
    return F.timestamp_micros(micros(F.col(column).cast("timestamp_ntz")))


def table_stream(
    spark: SparkSession, folder: str, name: str, schema: T.StructType, max_files: int = 16
) -> DataFrame:
    """One stored table as a stream of its rows.

    ``max_files`` bounds a micro-batch, and with it what one key can bring to
    one call of a stateful job.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name)
    return reader.option("maxFilesPerTrigger", max_files).parquet(folder)


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Append a stream to a parquet folder until its source is drained."""
    _drain(stream.writeStream.format("parquet").outputMode(mode).option("path", path), checkpoint)


def run_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> None:
    _drain(stream.writeStream.foreachBatch(handle).outputMode(mode), checkpoint)


def _drain(writer, checkpoint: str) -> StreamingQuery:
    running = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    running.awaitTermination()
    return running


def keep_latest(path: str) -> Callable[[DataFrame, int], None]:
    """Batch writer whose output is replaced, not doubled, when a batch is retried."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def _newest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    rest = [c for c in rows.columns if c not in (*keys, order)]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"), F.max(order).alias(order)).select(
        *keys, "_row.*", order
    )


def _numbers(spark: SparkSession, path: str, kind: str) -> list[int]:
    """The numbers of the folders ``kind=n`` below ``path`` that were written to the end."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}=*/_SUCCESS")) or []
    return sorted(int(s.getPath().getParent().getName().partition("=")[2]) for s in found)


def _since_snapshot(spark: SparkSession, path: str, upto: int | None = None) -> tuple[DataFrame, int]:
    """Rows of the newest snapshot and of the batches after it, with ``_order``, and the last batch among them."""
    snapshots = _numbers(spark, path, "snapshot")
    base = snapshots[-1] if snapshots else -1
    batches = [b for b in _numbers(spark, path, "batch") if b > base and (upto is None or b <= upto)]
    parts = [f"{path}/snapshot={base}"] if snapshots else []
    frames = [spark.read.parquet(p).withColumn("_order", F.lit(base)) for p in parts]
    if batches:
        tail = spark.read.option("basePath", path).parquet(*[f"{path}/batch={b}" for b in batches])
        frames.append(tail.withColumnRenamed("batch", "_order"))
    return reduce(DataFrame.unionByName, frames), max([base, *batches])


def compact_latest(spark: SparkSession, path: str, keys: list[str]) -> int:
    """Merge all batches but the last into one snapshot; returns the batch it reaches to, -1 if there is none.

    A snapshot holds one row a key, so that reading costs a snapshot and the
    batches since, however many there were.  The last batch stays out, since a
    restart may write it again.  A snapshot counts once it is complete; the
    batches it replaces are left to whoever clears the folder.
    """
    batches = _numbers(spark, path, "batch")
    done = _numbers(spark, path, "snapshot")
    upto = batches[-2] if len(batches) > 1 else -1
    if upto > (done[-1] if done else -1):
        rows, _ = _since_snapshot(spark, path, upto)
        _newest(rows, keys, "_order").drop("_order").write.mode("overwrite").parquet(f"{path}/snapshot={upto}")
    return upto


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Newest row per key: the newest snapshot, if one was made, and the batches of :func:`keep_latest` after it."""
    return _newest(_since_snapshot(spark, path)[0], keys, "_order").drop("_order")


def ingest(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Each inbound file lands once: the checkpoint remembers what was picked up."""
    run_to_parquet(stream, path, checkpoint)


def dedupe_files(
    files: DataFrame, time_column: str = "LoadDateTime", horizon: str = "7 days", by_content: bool = True
) -> DataFrame:
    """A file name (and content) passes once within the horizon."""
    keys = ["FileName"]
    stamped = files.withColumn("_at", event_time(time_column))
    if by_content:
        stamped = stamped.withColumn("_hash", F.sha2(F.col("RawEDIText").cast("binary"), 256))
        keys.append("_hash")
    unique = stamped.withWatermark("_at", horizon).dropDuplicatesWithinWatermark(keys)
    return unique.drop("_at", "_hash")


def stream_parse(files: DataFrame, path: str, checkpoint: str, strict: bool = False) -> None:
    """Parse each micro-batch; a retried batch overwrites its own output."""

    def parse(batch: DataFrame, batch_id: int) -> None:
        parsed = interchange.parse_files(batch, strict)
        parsed.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    run_batches(files, parse, checkpoint)


def read_parsed(spark: SparkSession, path: str) -> DataFrame:
    """The nested parse results; a file delivered again counts in its last batch only.

    Only the ids are shuffled to find the last batch.  Files of several batches
    are few as a rule; then the parsed content stays where it is.
    """
    rows = spark.read.option("basePath", path).parquet(f"{path}/batch=*").where(F.col("RawId").isNotNull())
    again = (
        rows.groupBy("RawId")
        .agg(F.max("batch").alias("_last"), F.min("batch").alias("_first"))
        .where("_first < _last")
        .drop("_first")
    )
    placed = join_checked(rows, again, "RawId", "left")
    return placed.where("_last IS NULL OR batch = _last").drop("batch", "_last")


def window_counts(
    files: DataFrame,
    sender: str = "ISASender",
    time_column: str = "LoadDateTime",
    width: str = "1 hour",
    slide: str | None = None,
    delay: str = "1 hour",
) -> DataFrame:
    """Files per sender and window; rows later than the delay are dropped."""
    stamped = files.select(F.col(sender).alias("sender"), event_time(time_column).alias("at"))
    window = F.window("at", width, slide) if slide else F.window("at", width)
    return (
        stamped.withWatermark("at", delay)
        .groupBy(window.alias("w"), "sender")
        .agg(F.count(F.lit(1)).alias("files"))
        .select(
            F.unix_micros("w.start").alias("start_micros"),
            F.unix_micros("w.end").alias("end_micros"),
            "sender",
            "files",
        )
    )


#: Buckets that keys with small state are dealt into; each is one call a micro-batch.
BUCKETS = 1_024


def _with_state(
    events: DataFrame,
    key: str,
    processor,
    output: str,
    mode: str = "append",
    time_mode: str = "none",
) -> DataFrame:
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return events.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=T.StructType.fromDDL(output),
        outputMode=mode,
        timeMode=time_mode,
    )


def _with_bucketed_state(events: DataFrame, processor, mode: str = "append", time_mode: str = "none") -> DataFrame:
    """State of keys that are many: a call serves the rows of a bucket of them."""
    bucket = F.pmod(F.xxhash64(processor.KEY), F.lit(BUCKETS)).cast("int")
    # As text a key stays exact beside missing ones.
    dealt = events.withColumn(state.BUCKET, bucket).withColumn(processor.KEY, F.col(processor.KEY).cast("string"))
    return _with_state(dealt, state.BUCKET, processor, processor.OUTPUT, mode, time_mode)


def order_state(events: DataFrame) -> DataFrame:
    """Order status after each micro-batch; orders start as READY."""
    shaped = events.select(
        "WMSOrderHeaderStagingId", "EventId", micros(F.col("EventTime")).alias("EventMicros"), "Action", "Message"
    )
    return _with_bucketed_state(shaped, state.OrderState(), "update")


def rate_limit(
    events: DataFrame, seconds: int = RATE_WINDOW_SECONDS, limit: int = RATE_LIMIT
) -> DataFrame:
    """Denied flag per request; late rows count when they arrive."""
    shaped = events.select("Key", "EventId", micros(F.col("EventTime")).alias("EventMicros"))
    kind = events.schema["Key"].dataType.simpleString()
    output = f"Key {kind}, EventId bigint, Denied boolean"
    return _with_state(shaped, "Key", state.RateWindow(seconds, limit), output)


def stale_alerts(events: DataFrame, minutes: int = STALE_MINUTES, delay: str = "10 minutes") -> DataFrame:
    """Alert once when an item of (ItemId, EventId, EventTime, Enters) stays too long.

    Event-time timers fire as the watermark passes an item's deadline, so an
    item that never moves again is reported as well.
    """
    shaped = events.select(
        "ItemId",
        "EventId",
        micros(F.col("EventTime")).alias("EventMicros"),
        "Enters",
        event_time("EventTime").alias("at"),
    ).withWatermark("at", delay)
    return _with_bucketed_state(shaped, state.StaleStay(minutes), time_mode="eventtime")


def session_progress(events: DataFrame) -> DataFrame:
    """Build progress after each micro-batch."""
    shaped = events.withColumn("EventMicros", micros(F.col("EventTime"))).drop("EventTime")
    return _with_bucketed_state(shaped, state.SessionProgress(), "update")


def session_totals(events: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Event count per closed activity session of each request."""
    stamped = events.select("CRNumber", event_time("EventTime").alias("at")).withWatermark("at", delay)
    return (
        stamped.groupBy(F.session_window("at", gap).alias("s"), "CRNumber")
        .agg(F.count(F.lit(1)).alias("events"))
        .select(
            "CRNumber",
            F.unix_micros("s.start").alias("start_micros"),
            F.unix_micros("s.end").alias("end_micros"),
            "events",
        )
    )

