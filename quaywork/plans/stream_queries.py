"""Streaming jobs run to the end of their source; results equal the batch twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaywork.functions.columns import from_micros, timestamp_text
from quaywork.operators import interchange as I
from quaywork.plans.domain import Domain
from quaywork.plans.registry import query
from quaywork.session import scratch_path
from quaywork.streaming import jobs


#: Parts at least, and rows a part holds at most or so; a part is a micro-batch, whose cost is mostly fixed.
PARTS, ROWS_PER_PART = 4, 2_000_000


def _timed_events(d: Domain, label: str, late: bool = False) -> DataFrame:
    """The events as a stream of parts in order of time, one part a micro-batch, at least ``PARTS`` of them.

    The rows are dealt out by ranges of time in one shuffle, and each part is
    then read alone, so the work grows with the rows and not with rows times
    parts.  With ``late`` the last part also brings the earliest events once
    more, long after the watermark has passed them.
    """
    events = d.table("events")
    facts = events.agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("low")).first()
    parts = max(PARTS, -(-facts["n"] // ROWS_PER_PART))
    path = scratch_path(d.spark, label)
    # Equal times fall into one range, rows without a time into the first.
    dealt = events.repartitionByRange(parts, "ts").withColumn("_part", F.spark_partition_id())
    dealt.write.partitionBy("_part").parquet(f"{path}/dealt")
    written = d.spark.read.schema(dealt.schema).parquet(f"{path}/dealt")
    filled = sorted(r["_part"] for r in written.select("_part").distinct().collect())
    for i in filled:
        rows = written.where(F.col("_part") == i).drop("_part")
        if late and i == filled[-1]:
            rows = rows.unionByName(events.where(F.col("ts") == F.lit(facts["low"]).cast(events.schema["ts"].dataType)))
        # One file a part, since a micro-batch takes one file, in row groups that several tasks can read.
        rows.coalesce(1).write.mode("append").option("parquet.block.size", 4 << 20).parquet(f"{path}/events")
    return d.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/events")


def _stream(d: Domain, view: str) -> DataFrame:
    """A domain view over the events table, read as a stream in several micro-batches."""

    class Streamed(Domain):
        def table(self, name):
            if name == "events":
                return _timed_events(d, view)
            return super().table(name)

    return getattr(Streamed(d.spark, d.folder), view)


def _appended(d: Domain, stream: DataFrame, label: str) -> DataFrame:
    path = scratch_path(d.spark, label)
    jobs.run_to_parquet(stream, f"{path}/out", f"{path}/checkpoint")
    return d.spark.read.parquet(f"{path}/out")


def _updated(d: Domain, stream: DataFrame, label: str, key: str) -> DataFrame:
    path = scratch_path(d.spark, label)
    jobs.run_batches(stream, jobs.keep_latest(f"{path}/out"), f"{path}/checkpoint", "update")
    return jobs.read_latest(d.spark, f"{path}/out", [key])


def _text_of(micros_column: str):
    return timestamp_text(from_micros(F.col(micros_column)))


def _delivered(d: Domain, label: str) -> tuple[DataFrame, str]:
    """The received files as bundles in an inbound folder, a third of them sent twice."""
    path = scratch_path(d.spark, label)
    stamped = d.raw_files.select(
        "RawId", "FileName", "RawEDIText", F.expr("timestamp_ntz'2001-08-01 00:00:00' AS LoadDateTime")
    )
    stamped.write.parquet(f"{path}/inbound")
    first = d.spark.read.parquet(f"{path}/inbound")
    first.where("RawId % 3 = 0").write.mode("append").parquet(f"{path}/inbound")
    stream = d.spark.readStream.schema(first.schema).parquet(f"{path}/inbound")
    return stream, path


@query(
    "s1_stream_ingest",
    "files",
    "SELECT RawId, FileName, CASE WHEN RawId % 3 = 0 THEN 2 ELSE 1 END AS deliveries FROM files",
)
def stream_ingest(d):
    stream, path = _delivered(d, "ingest")
    # Two runs over the same folder: the second finds nothing new.
    for _ in range(2):
        jobs.ingest(stream.select("RawId", "FileName"), f"{path}/raw", f"{path}/checkpoint")
    landed = d.spark.read.parquet(f"{path}/raw")
    return landed.groupBy("RawId", "FileName").agg(F.count(F.lit(1)).alias("deliveries"))


@query("s2_dedupe_files", "files", "SELECT RawId, FileName FROM files")
def dedupe_files(d):
    stream, path = _delivered(d, "dedupe")
    unique = jobs.dedupe_files(stream).select("RawId", "FileName")
    jobs.run_to_parquet(unique, f"{path}/unique", f"{path}/checkpoint")
    return d.spark.read.parquet(f"{path}/unique")


@query(
    "s3_stream_parse",
    "goodtxn",
    """SELECT HeaderId, RawId, lpad(CAST(idx AS VARCHAR), 4, '0') AS STControlNumber, concat('ORDER', o_orderkey) AS WarehouseOrderNumber,
       st AS STSegmentSeq, se AS SESegmentSeq FROM goodtxn""",
)
def stream_parse(d):
    stream, path = _delivered(d, "parse")
    jobs.stream_parse(jobs.dedupe_files(stream), f"{path}/parsed", f"{path}/checkpoint")
    return I.headers(jobs.read_parsed(d.spark, f"{path}/parsed")).select(
        "HeaderId", "RawId", "STControlNumber", "WarehouseOrderNumber", "STSegmentSeq", "SESegmentSeq"
    )


@query(
    "s4_stream_counts",
    "",
    """SELECT epoch_us(w) AS start_micros, epoch_us(w + INTERVAL 6 HOUR) AS end_micros, sender, count(*) AS files
       FROM (SELECT event_type AS sender, ts, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS w FROM events)
       WHERE w + INTERVAL 6 HOUR <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 1 HOUR GROUP BY ALL""",
)
def stream_counts(d):
    source = _timed_events(d, "events-counts", late=True)
    counts = jobs.window_counts(source, "event_type", "ts", "6 hours")
    return _appended(d, counts, "counts")


@query(
    "s4_sliding_counts",
    "",
    """SELECT epoch_us(w) AS start_micros, epoch_us(w + INTERVAL 48 HOUR) AS end_micros, sender, count(*) AS files
       FROM (SELECT event_type AS sender, ts, unnest([time_bucket(INTERVAL 24 HOUR, ts, TIMESTAMP '1970-01-01'),
         time_bucket(INTERVAL 24 HOUR, ts, TIMESTAMP '1970-01-01') - INTERVAL 24 HOUR]) AS w FROM events)
       WHERE w + INTERVAL 48 HOUR <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 1 HOUR GROUP BY ALL""",
)
def sliding_counts(d):
    source = _timed_events(d, "events-sliding", late=True)
    counts = jobs.window_counts(source, "event_type", "ts", "48 hours", "24 hours")
    return _appended(d, counts, "sliding")


@query(
    "s5_order_state",
    "oevents",
    """SELECT id AS WMSOrderHeaderStagingId, arg_max(Action, EventTime) AS IntegrationStatus, count(*) FILTER (Action = 'SENT') AS AttemptCount,
       strftime(max(EventTime) FILTER (Action IN ('SENT', 'FAILED')), '%Y-%m-%d %H:%M:%S') AS LastAttemptDateTime,
       strftime(max(EventTime) FILTER (Action = 'SUCCESS'), '%Y-%m-%d %H:%M:%S') AS ProcessedDateTime,
       CASE WHEN arg_max(Action, EventTime) = 'FAILED' THEN arg_max(coalesce(Message, ''), EventTime) END AS ErrorMessage
       FROM (SELECT *, lag(Action, 1, 'READY') OVER (PARTITION BY id ORDER BY EventTime, EventId) AS before FROM oevents)
       WHERE Action <> 'SENT' OR before IN ('READY', 'FAILED') GROUP BY id""",
)
def order_state(d):
    states = _updated(
        d, jobs.order_state(_stream(d, "order_events")), "orders", "WMSOrderHeaderStagingId"
    )
    return states.select(
        "WMSOrderHeaderStagingId",
        "IntegrationStatus",
        "AttemptCount",
        _text_of("LastAttemptMicros").alias("LastAttemptDateTime"),
        _text_of("ProcessedMicros").alias("ProcessedDateTime"),
        "ErrorMessage",
    )


@query(
    "s6_stale_alerts",
    "",
    """WITH moves AS (SELECT user_id AS item, ts, event_id, event_type = 'click' AS enters FROM events WHERE event_type IN ('click', 'view')),
       marked AS (SELECT *, coalesce(lag(enters) OVER (PARTITION BY item ORDER BY ts, event_id), false) AS inside,
         min(CASE WHEN NOT enters THEN ts END) OVER (PARTITION BY item ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS leaves FROM moves)
       SELECT item AS ItemId, epoch_us(ts) AS EnteredMicros FROM marked WHERE enters AND NOT inside
       AND coalesce(leaves, (SELECT date_trunc('millisecond', max(ts)) FROM moves) - INTERVAL 10 MINUTE) - ts > INTERVAL 60 MINUTE""",
)
def stale_alerts(d):
    source = _timed_events(d, "events-stale")
    moves = source.where("event_type IN ('click', 'view')").select(
        F.col("user_id").alias("ItemId"),
        F.col("event_id").alias("EventId"),
        F.col("ts").alias("EventTime"),
        (F.col("event_type") == "click").alias("Enters"),
    )
    return _appended(d, jobs.stale_alerts(moves), "stale")


@query(
    "s7_stream_rate_limit",
    "",
    """RECURSIVE WITH ev AS (SELECT event_type AS k, ts, event_id FROM events),
       anchors AS (SELECT k, min(ts) AS a FROM ev GROUP BY k
         UNION ALL SELECT n.k, min(e.ts) FROM anchors n JOIN ev e ON e.k = n.k AND e.ts > n.a + INTERVAL 10 HOUR GROUP BY n.k, n.a)
       SELECT k AS Key, event_id AS EventId, row_number() OVER (PARTITION BY k, a ORDER BY ts, event_id) > 20 AS Denied
       FROM (SELECT ev.*, anchors.a FROM ev ASOF JOIN anchors ON anchors.k = ev.k AND anchors.a <= ev.ts)""",
)
def stream_rate_limit(d):
    source = _timed_events(d, "events-rate")
    calls = source.select(
        F.col("event_type").alias("Key"), F.col("ts").alias("EventTime"), F.col("event_id").alias("EventId")
    )
    return _appended(d, jobs.rate_limit(calls, 36_000), "rate")


@query(
    "s8_session_progress",
    "progress",
    """SELECT CRNumber, arg_max(SessionId, ts) FILTER (SessionId IS NOT NULL) AS SessionId, CAST(sum(spent) AS BIGINT) AS TokensSoFar,
       arg_max(StatusDetail, ts) FILTER (kind = 'system') AS LastAction, arg_max(value, ts) FILTER (kind = 'result') AS CostUsd,
       arg_max(Subtype, ts) FILTER (kind = 'result') AS ResultSubtype, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS UpdatedDateTime FROM progress GROUP BY 1""",
)
def session_progress(d):
    latest = _updated(d, jobs.session_progress(_stream(d, "progress_events")), "progress", "CRNumber")
    return latest.withColumn("UpdatedDateTime", _text_of("UpdatedMicros")).drop("UpdatedMicros")


@query(
    "s8_session_totals",
    "",
    """WITH e AS (SELECT user_id AS u, ts, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 6 HOUR, true) AS opens FROM events),
       g AS (SELECT *, count(*) FILTER (opens) OVER (PARTITION BY u ORDER BY ts) AS k FROM e)
       SELECT u AS CRNumber, epoch_us(min(ts)) AS start_micros, epoch_us(max(ts) + INTERVAL 6 HOUR) AS end_micros, count(*) AS events FROM g GROUP BY u, k
       HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 1 HOUR""",
)
def session_totals(d):
    return _appended(d, jobs.session_totals(_stream(d, "progress_events"), "6 hours"), "sessions")
