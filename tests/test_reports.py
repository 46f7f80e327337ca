"""Report rules on small tables with known outcomes."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quaywork import schemas as S
from quaywork.functions.columns import (
    compact_date,
    from_micros,
    hours_between,
    micros,
    minutes_between,
    round_binary,
)
from quaywork.operators import reports as R
from quaywork.sources.files import queue_metrics

NOW = datetime(2026, 7, 27, 17, 0, 0)


def file_rows(spark, rows):
    """rows: id, minutes ago, status, error, sender, reported"""
    full = [
        (i, f"f{i}", None, NOW - timedelta(minutes=age), status, None, error, sender, "R", f"{i:09d}",
         NOW if reported else None, "ann" if reported else None)
        for i, age, status, error, sender, reported in rows
    ]
    return spark.createDataFrame(full, S.schema("files"))


def order_rows(spark, rows):
    """rows: id, status, minutes since creation, minutes since attempt, error"""
    full = [
        (i, "S", i, "f", f"O{i}", None, "940", None, None, None, status, 1,
         NOW - timedelta(minutes=tried) if tried is not None else None, error, NOW - timedelta(minutes=made), None)
        for i, status, made, tried, error in rows
    ]
    return spark.createDataFrame(full, S.schema("wms_orders"))


@pytest.fixture()
def domain(spark):
    files = file_rows(
        spark,
        [
            (1, 500, "STAGED", None, "LOW", False),
            (2, 500, "STAGED", None, "LOW", False),
            (3, 500, "STAGED", None, "HD", False),
            (4, 500, "STAGED", None, "HD", False),
            (5, 61, "PARSED", None, None, False),
            (6, 60, "RAW_LOADED", None, "TGT", False),
            (7, 9, "PARSE_FAILED", "File was empty.", "TGT", False),
            (8, 9, "PARSE_FAILED", "x", "TGT", True),
            (9, 9, "STAGED", None, "TGT", False),
        ],
    )
    headers = spark.createDataFrame(
        [(10, 1), (20, 2), (21, 2), (22, 2), (30, 3), (40, 4), (50, 5)], "HeaderId bigint, RawId bigint"
    )
    orders = order_rows(
        spark,
        [
            (10, "SUCCESS", 400, None, None),
            (20, "SUCCESS", 400, None, None),
            (21, "FAILED", 400, 300, "Invalid SKU on line 2"),
            (22, "FAILED", 400, 300, None),
            (30, "SENT", 400, 61, None),
            (40, "READY", 60, None, None),
        ],
    )
    lines = spark.createDataFrame(
        [(21, 1, "A"), (21, 2, "B")], "WMSOrderHeaderStagingId bigint, LineNumber int, SKU string"
    )
    return files, headers, orders, lines


def test_reconciliation_outcomes(domain):
    files, headers, orders, _ = domain
    got = {r["RawId"]: r for r in R.file_reconciliation(files, headers, orders, NOW).collect()}
    outcome = {i: (r["FileStatus"], r["AttentionReason"]) for i, r in got.items()}
    assert outcome == {
        1: ("Delivered", None),
        2: ("Needs Attention", "2 of 3 order(s) rejected by WMS: Invalid SKU on line 2"),
        3: ("Needs Attention", "1 order(s) stuck awaiting WMS pickup"),
        4: ("In Progress", None),
        5: ("Needs Attention", "Not staged to WMS after 61 min"),
        6: ("In Progress", None),
        7: ("Parse Failed", "File was empty."),
        8: ("Reported to Customer", "x"),
        9: ("Needs Attention", None),
    }
    assert (got[2]["OrderCount"], got[2]["SuccessCount"], got[2]["FailedOrderCount"]) == (3, 1, 2)
    assert got[7]["OrderCount"] == 0 and got[1]["LoadDateTime"] == "2026-07-27 08:40:00"


def test_detail_and_customers(domain):
    files, headers, orders, lines = domain
    recon = R.file_reconciliation(files, headers, orders, NOW)
    rows = sorted(tuple(r) for r in R.report_detail(recon, headers, orders, lines).where("rawId in (2, 7)").collect())
    sku = "2 of 3 order(s) rejected by WMS: Invalid SKU on line 2"
    assert [(r[0], r[4], r[5], r[6]) for r in rows] == [
        (2, "O21", "Line 1 — A", "Invalid SKU on line 2"),
        (2, "O21", "Line 2 — B", "Invalid SKU on line 2"),
        (2, "O22", "—", sku),
        (2, "—", "—", sku),
        (7, "—", "—", "File was empty."),
    ]
    buckets = {r["status"]: r["count"] for r in R.outcome_buckets(recon).collect()}
    assert buckets == {"Delivered": 1, "Reported to Customer": 1, "In Progress": 2, "Needs Attention": 4, "Parse Failed": 1}
    assert sorted(r[0] for r in R.actionable_customers(recon).collect()) == ["HD", "LOW", "TGT"]
    assert [r["RawId"] for r in R.actionable_files(recon, "TGT").collect()] == [9, 7]


def test_funnel_keeps_empty_gates(spark, domain):
    files, _, orders, _ = domain
    gates = {r["GateName"]: r for r in R.pipeline_funnel(files, orders, NOW).collect()}
    assert [gates[g[0]]["ItemCount"] for g in S.GATES] == [9, 1, 2, 1, 1, 2, 2]
    assert gates["Parsed Successfully"]["GateStatusColor"] == "RED"
    assert gates["WMS Awaiting Pickup"]["GateStatusColor"] == "GREEN"  # exactly 60 minutes
    empty = {r["GateName"]: r for r in R.pipeline_funnel(files.limit(0), orders.limit(0), NOW).collect()}
    assert len(empty) == 7 and {r["ItemCount"] for r in empty.values()} == {0}
    assert empty["Parsed Successfully"]["OldestItemAgeMinutes"] is None


def test_summary_of_nothing(spark, domain):
    files, _, orders, _ = domain
    row = R.dashboard_summary(files.limit(0), orders.limit(0)).first()
    assert row["filesReceived"] == 0 and row["filesParsed"] is None and row["filesWaiting"] == 0
    chart = [(r["name"], r["count"]) for r in R.status_chart(R.dashboard_summary(files, orders)).collect()]
    assert chart[0] == ("Received", 9) and len(chart) == 7
    text = spark.createDataFrame([(None, "3")], "filesParsed bigint, wmsReady string")
    safe = R.normalize_summary(text).first()
    assert (safe["filesParsed"], safe["wmsReady"], safe["queueStatus"]) == (0, 3, "GREEN")


def test_queue_metrics(spark):
    listing = spark.createDataFrame(
        [("a", NOW - timedelta(seconds=120)), ("b", NOW - timedelta(seconds=30))], "BlobName string, ModifiedDateTime timestamp_ntz"
    )
    assert tuple(queue_metrics(listing, NOW).first()) == (2, 120)
    assert tuple(queue_metrics(listing.limit(0), NOW).first()) == (0, 0)


def test_calendars(spark):
    files = file_rows(spark, [(1, 0, "PARSED", None, "A", False), (2, 60 * 24 * 29, "x_Failed", None, None, False), (3, 60 * 24 * 40, "PARSED", None, "C", False)])
    days = {r["date"]: r["count"] for r in R.daily_volume(files, 30, NOW).collect()}
    assert len(days) == 30 and sum(days.values()) == 2 and days["2026-06-28"] == 1 and days["2026-07-27"] == 1
    grid = R.volume_by_sender_day(files, 7, NOW).collect()
    assert len(grid) == 7 and sum(r["count"] for r in grid) == 1 and {r["sender"] for r in grid} == {"A"}
    by_sender = {r["sender"]: (r["received"], r["errored"]) for r in R.status_by_sender(files, 24 * 30, NOW).collect()}
    assert by_sender == {"A": (1, 0), None: (0, 1)}


def test_logs(spark):
    log = spark.createDataFrame(
        [
            (1, "a", "SUCCESS", NOW, None, 1),
            (2, "a", "SUCCESS", NOW, None, 1),
            (3, "b", "ERROR", NOW, "bad", 1),
            (4, "c", "PENDING", NOW - timedelta(minutes=1), None, 1),
        ],
        S.schema("proc_log"),
    )
    row = R.current_status(log.where("LogID < 4"), NOW).first()
    assert (row["TotalFilesProcessed"], row["Successful"], row["SuccessRatePct"]) == (2, 2, 100.0)
    none = R.current_status(log, NOW + timedelta(days=3)).first()
    assert none["TotalFilesProcessed"] == 0 and none["SuccessRatePct"] is None
    hours = {r["FileName"]: r["HoursSinceProcessing"] for r in R.files_needing_attention(log, NOW).collect()}
    assert hours == {"b": 0, "c": 1}
    day = NOW - timedelta(days=1)
    runs = spark.createDataFrame([("r1", "OK", day, 3, 0, 9)] * 2 + [("r2", "OK", NOW, 1, 0, 9)], S.schema("run_log"))
    moved = log.withColumn("ProcessDateTime", F.lit(str(day)).cast("timestamp_ntz"))
    report = R.processing_report(runs, moved, as_of=NOW).collect()
    # Today's later run is outside, and the doubled run row doubles the sums only.
    assert [(r["AdfPipelineRunId"], r["UniqueFilesInRun"], r["SuccessfulFiles"], r["FailedFiles"]) for r in report] == [("r1", 3, 4, 2)]


def test_run_rate(spark):
    costs = spark.createDataFrame([(NOW.date(), 10.0), (NOW.date() - timedelta(days=40), 99.0)], "Day date, Amount double")
    row = R.month_run_rate(costs, 17.0, NOW).first()
    assert (row["spendMtd"], row["projectedMonthEnd"], row["percentUsed"]) == (10.0, round(10 / 27 * 31, 2), 59)
    assert R.month_run_rate(costs, 0, NOW).first()["percentUsed"] == 0


def test_boundary_counting_and_rounding(spark):
    pair = spark.sql("SELECT timestamp_ntz'2026-01-01 00:59:59' AS a, timestamp_ntz'2026-01-01 01:00:00' AS b")
    row = pair.select(minutes_between(F.col("a"), F.col("b")), hours_between(F.col("a"), F.col("b"))).first()
    assert tuple(row) == (1, 1)
    values = [1.265, 1.275, 0.235, 0.125, 0.375, 2.675, 1000.005, 0.004, 0.005, 0.0, -1.265, 123456.785, 7.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(round_binary(F.col("v"), 2)).collect()] == [round(v, 2) for v in values]
    back = spark.sql("SELECT timestamp_ntz'1969-12-31 23:59:59.5' AS t UNION ALL SELECT timestamp_ntz'2026-07-01 12:34:56.789123'")
    assert back.where(from_micros(micros(F.col("t"))) == F.col("t")).count() == 2
    dates = spark.createDataFrame([("20260731",), ("2026731",), ("20260231",), (None,)], "d string")
    assert [str(r[0]) for r in dates.select(compact_date(F.col("d"))).collect()] == ["2026-07-31", "None", "None", "None"]


def test_age_text(spark):
    ages = [None, 0, 59, 60, 63, 69, 75, 105, 4269, 615, -5]
    df = spark.createDataFrame([(a,) for a in ages], "m bigint")
    # The binary quotient decides: 69 / 60 is just below its tie, 75 / 60 is one.
    assert [r[0] for r in df.select(R.format_age(F.col("m"))).collect()] == [
        "—", "0 min", "59 min", "1.0 hr", "1.1 hr", "1.1 hr", "1.3 hr", "1.8 hr", "71.2 hr", "10.3 hr", "-5 min"
    ]


def test_results_do_not_depend_on_the_session_zone(spark, domain):
    files, headers, orders, _ = domain
    expected = sorted(map(tuple, R.file_reconciliation(files, headers, orders, NOW).collect()), key=str)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = sorted(map(tuple, R.file_reconciliation(files, headers, orders, NOW).collect()), key=str)
        assert got == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_fourteen_files(spark):
    """A day of fourteen files: three delivered, one moving, one rejected, nine unreadable."""
    reasons = list(S.ENVELOPE_REASONS.values())
    files = file_rows(
        spark,
        [(14 - i, 4000 - i, "STAGED", None, "LOW", False) for i in range(5)]
        + [(9 - i, 4269, "PARSE_FAILED", r, "TGT", False) for i, r in enumerate(reasons)],
    )
    headers = spark.createDataFrame([(140, 14), (130, 13), (120, 12), (110, 11), (100, 10)], "HeaderId bigint, RawId bigint")
    orders = order_rows(
        spark,
        [(140, "SUCCESS", 4268, None, None), (130, "SUCCESS", 4268, None, None), (120, "SUCCESS", 4268, None, None),
         (110, "READY", 50, None, None), (100, "FAILED", 100, 99, "Invalid SKU on line 2")],
    )
    recon = R.file_reconciliation(files, headers, orders, NOW)
    buckets = {r["status"]: r["count"] for r in R.outcome_buckets(recon).collect()}
    assert buckets == {"Delivered": 3, "Reported to Customer": 0, "In Progress": 1, "Needs Attention": 1, "Parse Failed": 9}
    why = {r["RawId"]: r["AttentionReason"] for r in recon.collect()}
    assert why[10] == "1 of 1 order(s) rejected by WMS: Invalid SKU on line 2" and why[11] is None
    assert [why[9 - i] for i in range(9)] == reasons
    gates = {r["GateName"]: (r["ItemCount"], r["OldestItemAgeMinutes"], r["GateStatusColor"]) for r in R.pipeline_funnel(files, orders, NOW).collect()}
    assert gates["Files Received"] == (14, 4269, "GREEN") and gates["Parse Failed"] == (9, 4269, "GREEN")
    assert gates["WMS Awaiting Pickup"] == (1, 50, "GREEN") and gates["WMS Success"] == (3, 4268, "GREEN")
    assert gates["Parsed Successfully"] == (0, None, "GREEN") and gates["WMS Failed"] == (1, 99, "GREEN")
    summary = R.dashboard_summary(files, orders).first()
    assert (summary["filesReceived"], summary["filesFailed"], summary["wmsPickedUp"]) == (14, 9, 4)


def test_badges(spark):
    df = spark.createDataFrame([("PARSED", 59), ("READY", 60), ("SENT", 300), ("FAILED", 301), ("STAGED", None)], "s string, n int")
    rows = df.select(R.status_class(F.col("s")), R.queue_color(F.col("n"))).collect()
    assert [tuple(r) for r in rows] == [
        ("good", "queue-green"), ("ready", "queue-yellow"), ("sent", "queue-yellow"), ("bad", "queue-red"), ("neutral", "queue-green")
    ]
