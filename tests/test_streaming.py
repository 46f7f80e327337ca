"""Streams in several micro-batches give the batch result, also after redelivery."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from quaywork import schemas as S
from quaywork.functions.columns import from_micros
from quaywork.operators import change_requests as H
from quaywork.operators import interchange as I
from quaywork.operators import lookup as L
from quaywork.operators import staging as C
from quaywork.plans import stream_queries
from quaywork.plans.domain import Domain
from quaywork.sources import files as A
from quaywork.streaming import jobs
from tests.test_interchange import ORDER, whole
from tests.test_sources import put
from tests.test_staging import order_rows

NOW = datetime(2026, 8, 1, 12, 0)


def in_parts(spark, rows, schema, folder, parts=3):
    """Rows in arrival order as files that are picked up one per micro-batch."""
    size = -(-len(rows) // parts)
    for i in range(parts):
        path = f"{folder}/part{i}"
        chunk = rows[i * size : (i + 1) * size]
        spark.createDataFrame(chunk, schema).coalesce(1).write.parquet(path)
        for name in os.listdir(path):
            if name.endswith(".parquet"):
                stamp = 1_700_000_000 + i * 100
                os.utime(f"{path}/{name}", (stamp, stamp))
    kind = spark.createDataFrame([], schema).schema
    return spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))


def test_ingest_parse_and_redelivery(spark, tmp_path):
    inbound, archive = tmp_path / "inbound", tmp_path / "archive"
    inbound.mkdir()
    put(inbound, "a.edi", whole(ORDER.format(n=1)))
    put(inbound, "b.edi", whole(ORDER.format(n=2)))
    paths = {n: str(tmp_path / n) for n in ("raw", "ck1", "ck2", "parsed")}

    def run():
        stream = jobs.dedupe_files(A.stream_files(spark, str(inbound), str(archive)))
        jobs.ingest(stream, paths["raw"], paths["ck1"])

    run()
    put(inbound, "a2.edi", whole(ORDER.format(n=3)))
    put(inbound, "b.edi", whole(ORDER.format(n=2)), age=-500)  # delivered again, newer
    run()
    landed = spark.read.parquet(paths["raw"])
    assert sorted(r["FileName"] for r in landed.collect()) == ["a.edi", "a2.edi", "b.edi"]
    # The files of the first run have left the inbound folder.
    moved = [f for _, _, names in os.walk(archive) for f in names if f.endswith(".edi")]
    assert "a.edi" in moved
    ids = A.number_files(landed)
    ids.write.parquet(str(tmp_path / "numbered"))
    numbered = spark.read.parquet(str(tmp_path / "numbered"))
    stream = spark.readStream.schema(numbered.schema).parquet(str(tmp_path / "numbered"))
    for _ in range(2):
        jobs.stream_parse(stream, paths["parsed"], paths["ck2"])
    got = I.headers(jobs.read_parsed(spark, paths["parsed"])).collect()
    want = I.headers(I.parse_files(numbered)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 3
    # A repeated delivery in a later batch replaces, it does not double.
    I.parse_files(numbered).write.parquet(f"{paths['parsed']}/batch=9")
    again = I.headers(jobs.read_parsed(spark, paths["parsed"]))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, want))


def test_order_state_over_batches(spark, tmp_path):
    rng = random.Random(2)
    rows = [
        (i, rng.randint(1, 6), NOW + timedelta(minutes=i), rng.choice(["SENT", "SENT", "SUCCESS", "FAILED"]), f"m{i}")
        for i in range(90)
    ]
    stream = in_parts(spark, rows, S.schema("order_events"), tmp_path / "in")
    out = str(tmp_path / "out")
    jobs.run_batches(jobs.order_state(stream), jobs.keep_latest(out), str(tmp_path / "ck"), "update")
    assert len([d for d in os.listdir(out) if d.startswith("batch=")]) >= 3
    got = jobs.read_latest(spark, out, ["WMSOrderHeaderStagingId"]).select(
        "WMSOrderHeaderStagingId", "IntegrationStatus", "AttemptCount",
        from_micros(F.col("LastAttemptMicros")).alias("a"), from_micros(F.col("ProcessedMicros")).alias("p"), "ErrorMessage",
    )
    events = spark.createDataFrame(rows, S.schema("order_events"))
    want = C.apply_transitions(order_rows(spark, range(1, 7)), events).select(
        "WMSOrderHeaderStagingId", "IntegrationStatus", "AttemptCount", "LastAttemptDateTime", "ProcessedDateTime", "ErrorMessage"
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_rate_limit_over_batches(spark, tmp_path):
    rng = random.Random(4)
    rows = sorted(
        [(f"k{rng.randint(1, 3)}", NOW + timedelta(seconds=rng.randint(0, 20_000)), i) for i in range(300)], key=lambda r: (r[1], r[2])
    )
    schema = "Key string, EventTime timestamp_ntz, EventId bigint"
    stream = in_parts(spark, rows, schema, tmp_path / "in")
    jobs.run_to_parquet(jobs.rate_limit(stream, 1800, 5), str(tmp_path / "out"), str(tmp_path / "ck"))
    got = {r["EventId"]: r["Denied"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r["EventId"]: r["Denied"] for r in L.rate_limit(spark.createDataFrame(rows, schema), 1800, 5).collect()}
    assert got == want


def test_stale_alerts_fire_once_and_by_timer(spark, tmp_path):
    def at(minutes):
        return NOW + timedelta(minutes=minutes)

    rows = [
        (1, 1, at(0), True),  # never leaves: the timer reports it
        (2, 2, at(0), True),
        (3, 3, at(0), True),
        (2, 4, at(60), False),  # exactly an hour is in time
        (3, 5, at(61), False),
        (3, 6, at(62), True),  # enters again, too recent to be stale
        (9, 7, at(100), False),
        (9, 8, at(101), False),
        (9, 9, at(102), False),
    ]
    stream = in_parts(spark, rows, "ItemId bigint, EventId bigint, EventTime timestamp_ntz, Enters boolean", tmp_path / "in")
    jobs.run_to_parquet(jobs.stale_alerts(stream), str(tmp_path / "out"), str(tmp_path / "ck"))
    got = sorted(r["ItemId"] for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [1, 3]


def test_progress_over_batches(spark, tmp_path):
    rng = random.Random(8)
    rows = []
    for i in range(120):
        kind = rng.choice(["assistant", "system", "result"])
        rows.append(
            (rng.randint(1, 4), NOW + timedelta(seconds=i), i, kind, {"system": "post_turn_summary", "result": "success"}.get(kind),
             rng.choice([None, f"s{i}"]), i, 1, rng.choice([None, f"step {i}"]), float(i) if kind == "result" else None)
        )
    schema = (
        "CRNumber bigint, EventTime timestamp_ntz, EventId bigint, EventType string, Subtype string, SessionId string, "
        "InputTokens bigint, OutputTokens bigint, StatusDetail string, TotalCostUsd double"
    )
    stream = in_parts(spark, rows, schema, tmp_path / "in")
    out = str(tmp_path / "out")
    jobs.run_batches(jobs.session_progress(stream), jobs.keep_latest(out), str(tmp_path / "ck"), "update")
    columns = ["CRNumber", "SessionId", "TokensSoFar", "LastAction", "CostUsd", "ResultSubtype"]
    got = jobs.read_latest(spark, out, ["CRNumber"]).select(*columns)
    want = H.progress_fold(spark.createDataFrame(rows, schema)).select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_late_rows_are_dropped(spark, tmp_path):
    rows = [("A", NOW), ("A", NOW + timedelta(hours=5)), ("A", NOW - timedelta(hours=9)), ("B", NOW + timedelta(hours=9))]
    stream = in_parts(spark, rows, "ISASender string, LoadDateTime timestamp_ntz", tmp_path / "in", parts=4)
    jobs.run_to_parquet(jobs.window_counts(stream), str(tmp_path / "out"), str(tmp_path / "ck"))
    got = spark.read.parquet(str(tmp_path / "out")).select(from_micros(F.col("start_micros")).alias("w"), "sender", "files")
    assert sorted(map(tuple, got.collect())) == [(NOW, "A", 1), (NOW + timedelta(hours=5), "A", 1)]


def test_compaction_changes_nothing_and_bounds_reading(spark, tmp_path):
    out = str(tmp_path / "out")
    write = jobs.keep_latest(out)
    rows = lambda b: [(k, f"{b}-{k}") for k in range(b % 3, 9, 2)]
    newest = {}
    for b in range(7):
        write(spark.createDataFrame(rows(b), "k bigint, v string"), b)
        newest.update(rows(b))
        if b in (2, 5):
            assert jobs.compact_latest(spark, out, ["k"]) == b - 1
        assert {r["k"]: r["v"] for r in jobs.read_latest(spark, out, ["k"]).collect()} == newest
    # A batch that is written again replaces itself; what the snapshot holds is not read again.
    write(spark.createDataFrame([(1, "again")], "k bigint, v string"), 6)
    got = {r["k"]: r["v"] for r in jobs.read_latest(spark, out, ["k"]).collect()}
    assert got[1] == "again"
    files = jobs.read_latest(spark, out, ["k"]).inputFiles()
    assert not any(f"batch={b}" in f for f in files for b in range(5)) and any("snapshot=4" in f for f in files)
    # An unfinished snapshot does not count.
    (tmp_path / "out" / "snapshot=6").mkdir()
    assert {r["k"]: r["v"] for r in jobs.read_latest(spark, out, ["k"]).collect()} == got


def test_keys_share_buckets_and_stay_exact(spark, tmp_path, monkeypatch):
    """Keys of one bucket keep their own state and timers; large ids stay exact beside a missing one."""
    monkeypatch.setattr(jobs, "BUCKETS", 2)
    ids = [None, *range(2**60 + 1, 2**60 + 20)]
    actions = ["SENT", "FAILED", "SENT", "SUCCESS"]
    rows = [(n * 100 + i, k, NOW + timedelta(minutes=n), a, f"{k}") for n, a in enumerate(actions) for i, k in enumerate(ids)]
    stream = in_parts(spark, rows, S.schema("order_events"), tmp_path / "in", parts=4)
    out = str(tmp_path / "out")
    jobs.run_batches(jobs.order_state(stream), jobs.keep_latest(out), str(tmp_path / "ck"), "update")
    got = jobs.read_latest(spark, out, ["WMSOrderHeaderStagingId"]).collect()
    assert {r["WMSOrderHeaderStagingId"] for r in got} == set(ids) and len(got) == len(ids)
    assert {(r["IntegrationStatus"], r["AttemptCount"]) for r in got} == {("SUCCESS", 2)}

    stays = [(k, i, NOW + timedelta(minutes=i), True) for i, k in enumerate(ids[1:])]
    stays += [(ids[2], 50, NOW + timedelta(minutes=50), False), (7, 51, NOW + timedelta(minutes=81), False), (7, 52, NOW + timedelta(minutes=81), False)]
    schema = "ItemId bigint, EventId bigint, EventTime timestamp_ntz, Enters boolean"
    stream = in_parts(spark, stays, schema, tmp_path / "in2", parts=2)
    jobs.run_to_parquet(jobs.stale_alerts(stream), str(tmp_path / "out2"), str(tmp_path / "ck2"))
    got = sorted(r["ItemId"] for r in spark.read.parquet(str(tmp_path / "out2")).collect())
    # The watermark ends at 71 minutes: who came in before minute 11 and has not left is reported.
    assert got == [k for i, k in enumerate(ids[1:]) if i < 11 and i != 1]


def test_parts_are_bounded_where_times_crowd(spark, tmp_path, monkeypatch):
    """Micro-batches hold about equal numbers of rows, in order of time, and no row is lost."""
    monkeypatch.setattr(stream_queries, "ROWS_PER_PART", 100)
    times = [NOW + timedelta(seconds=i) for i in range(990)] + [NOW + timedelta(days=3 * i) for i in range(1, 11)]
    rows = [(i, t) for i, t in enumerate(times)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz").write.parquet(str(tmp_path / "events.parquet"))
    stream = stream_queries._timed_events(Domain(spark, str(tmp_path)), "parts")
    sizes, ends = [], []

    def look(batch, batch_id):
        n, low, high = batch.agg(F.count("ts"), F.min("ts"), F.max("ts")).first()
        sizes.append(n)
        ends.extend([low, high])

    jobs.run_batches(stream, look, str(tmp_path / "ck"))
    assert sum(sizes) == 1000 and len(sizes) >= 8 and max(sizes) < 300 and ends == sorted(ends)
