from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from quaywork import schemas as S
from quaywork.functions.skew import bounded_pieces, numbered, previous, running_sum
from quaywork.operators import staging as C
from quaywork.operators import upsert as D

NOW = datetime(2026, 8, 1, 12, 0)


def headers(spark, *rows):
    return spark.createDataFrame(
        rows, "HeaderId bigint, RawId bigint, FileName string, TransactionSetCode string, WarehouseOrderNumber string, ShipDate string"
    )


def test_stage_headers_policies(spark):
    h = headers(
        spark,
        (1, 1, "a", "940", "O1", "20260731"),
        (2, 1, "a", "940", None, "20260731"),
        (3, 1, "a", "940", "O3", "20260231"),
        (4, 2, "b", "940", "O4", "2026-07-30"),
        (5, 2, "B", "940", "O5", None),
    )
    a = spark.createDataFrame(
        [(1, 11, "ST", "Second", "2"), (1, 10, "st", "First", "1"), (1, 9, "SF", "From", "0")],
        "HeaderId bigint, AddressId bigint, EntityCode string, Name string, IdCode string",
    )
    staged = spark.createDataFrame([(5,)], "SourceHeaderId bigint")
    rows = {r["SourceHeaderId"]: r for r in C.stage_headers(h, a, staged, as_of=NOW).collect()}
    assert sorted(rows) == [1, 3, 4]
    assert rows[1]["ShipToName"] == "First" and str(rows[1]["ShipDate"]) == "2026-07-31"
    assert rows[3]["ShipDate"] is None and rows[4]["ShipDate"] is None and rows[4]["ShipToName"] is None
    assert (rows[1]["IntegrationStatus"], rows[1]["AttemptCount"]) == ("READY", 0)
    assert [r["HeaderId"] for r in C.header_rejects(h, staged).collect()] == [2]
    assert sorted(r["SourceHeaderId"] for r in C.stage_headers(h, a, None, "b ").collect()) == [4, 5]
    assert C.stage_headers(h, a, C.stage_headers(h, a)).count() == 0


def test_stage_lines_numbers_the_remaining(spark):
    details = spark.createDataFrame(
        [(1, 100 + i, 1.0, "EA", "VN", None if i == 2 else f"P{i}") for i in range(6)] + [(2, 300, 1.0, "EA", None, None)],
        "HeaderId bigint, DetailId bigint, QuantityOrdered double, UOM string, ProductQualifier string, ProductId string",
    )
    orders = spark.createDataFrame([(1, 1, "f"), (2, 2, "f")], "WMSOrderHeaderStagingId bigint, SourceHeaderId bigint, SourceFileName string")
    done = spark.createDataFrame([(1, 100), (1, 103)], "WMSOrderHeaderStagingId bigint, SourceDetailId bigint")
    rows = C.stage_lines(details, orders, done, as_of=NOW).orderBy("LineNumber").collect()
    assert [(r["SourceDetailId"], r["LineNumber"], r["SKU"]) for r in rows] == [
        (101, 1, "P1"), (102, 2, "VN"), (104, 3, "P4"), (105, 4, "P5")
    ]
    assert [r["DetailId"] for r in C.line_rejects(details, orders).collect()] == [300]


def test_mark_staged(spark):
    files = spark.createDataFrame([(1, "PARSED"), (2, "PARSED"), (3, "PARSED"), (4, "RAW_LOADED")], "RawId bigint, ProcessStatus string")
    h = spark.createDataFrame([(10, 1), (11, 1), (20, 2), (21, 2)], "HeaderId bigint, RawId bigint")
    orders = spark.createDataFrame([(10,), (11,), (20,)], "SourceHeaderId bigint")
    got = {r["RawId"]: r["ProcessStatus"] for r in C.mark_staged(files, h, orders).collect()}
    assert got == {1: "STAGED", 2: "PARSED", 3: "STAGED", 4: "RAW_LOADED"}


def order_rows(spark, ids, status="READY"):
    rows = [(i, "S", i, f"f{i}", f"O{i}", None, "940", None, None, None, status, 0, None, None, NOW, None) for i in ids]
    return spark.createDataFrame(rows, S.schema("wms_orders"))


def test_transitions_match_a_sequential_fold(spark):
    rng = random.Random(5)
    events = []
    for i in range(600):
        order = 1 if rng.random() < 0.4 else rng.randint(2, 12)
        when = NOW + timedelta(minutes=rng.randint(0, 900))
        action = rng.choice(["SENT", "SENT", "SUCCESS", "FAILED"])
        events.append((i, order, when, action, f"m{i}" if rng.random() < 0.5 else None))
    orders = order_rows(spark, range(1, 11)).unionByName(order_rows(spark, [11], "SUCCESS")).unionByName(order_rows(spark, [13], "FAILED"))
    state = {r["WMSOrderHeaderStagingId"]: [r["IntegrationStatus"], 0, None, None, None] for r in orders.collect()}
    log = []
    for i, order, when, action, message in sorted(events, key=lambda e: (e[2], e[0])):
        if order not in state:
            continue
        s = state[order]
        if action == "SENT":
            if s[0] not in ("READY", "FAILED"):
                continue
            s[0], s[1], s[2], s[4] = "SENT", s[1] + 1, when, None
            log.append((order, when, "SEND_ATTEMPT", "SENT", S.SENT_MESSAGE))
        elif action == "SUCCESS":
            s[0], s[3], s[4] = "SUCCESS", when, None
            log.append((order, when, "WMS_RESPONSE", "SUCCESS", message or S.ACCEPTED_MESSAGE))
        else:
            s[0], s[2], s[4] = "FAILED", when, message
            log.append((order, when, "WMS_RESPONSE", "FAILED", message))
    table = spark.createDataFrame(events, S.schema("order_events"))
    got = {
        r["WMSOrderHeaderStagingId"]: [r["IntegrationStatus"], r["AttemptCount"], r["LastAttemptDateTime"], r["ProcessedDateTime"], r["ErrorMessage"]]
        for r in C.apply_transitions(orders, table).collect()
    }
    assert got == state
    written = [
        (r["WMSOrderHeaderStagingId"], r["CreatedDateTime"], r["EventType"], r["EventStatus"], r["EventMessage"])
        for r in C.integration_log(orders, table).collect()
    ]
    assert sorted(written, key=str) == sorted(log, key=str)


def test_ready_orders_and_bulk_accept(spark):
    orders = order_rows(spark, range(1, 15)).withColumn("AttemptCount", F.when(F.col("WMSOrderHeaderStagingId") < 3, 3).otherwise(0))
    assert [r["SourceHeaderId"] for r in C.ready_orders(orders).collect()] == list(range(3, 13))
    mixed = orders.withColumn("IntegrationStatus", F.when(F.col("SourceHeaderId") == 4, "SENT").otherwise("READY"))
    after = {r["SourceHeaderId"]: r for r in C.bulk_accept(mixed, NOW).collect()}
    assert after[4]["IntegrationStatus"] == "SENT" and after[5]["ProcessedDateTime"] == NOW and after[5]["AttemptCount"] == 1
    assert C.bulk_accept_count(mixed).first()["pickedUp"] == 13 and C.bulk_accept_log(mixed, NOW).count() == 13


def test_sliced_windows_match_plain_ones(spark):
    rng = random.Random(9)
    rows = [(1 if rng.random() < 0.6 else rng.randint(2, 9), rng.randint(0, 500), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, t int, i int")
    order = [F.col("t"), F.col("i")]
    slice_by = F.floor(F.col("t") / 37)
    got = numbered(df, ["k"], order, slice_by, "n")
    got = previous(got, ["k"], order, slice_by, F.col("i"), "p")
    got = running_sum(got, ["k"], order, slice_by, F.col("t"), "s")
    seen: dict = {}
    for k, t, i in sorted(rows):
        n, p, s = seen.get(k, (0, None, 0))
        seen[k] = (n + 1, i, s + t)
        seen[(k, t, i)] = (n + 1, p, s + t)
    for r in got.collect():
        assert (r["n"], r["p"], r["s"]) == seen[(r["k"], r["t"], r["i"])]


def test_bounded_pieces_cover_everything(spark):
    df = spark.range(1000)
    pieces = bounded_pieces(df, "id", 90)
    assert len(pieces) == 12 and sum(p.count() for p in pieces) == 1000


def staging_row(order, amount, batch, qty):
    return (order, 1, None, amount, "U", None, "CA", "n", "s", qty, batch)


def test_upserts(spark):
    from decimal import Decimal

    target = spark.createDataFrame(
        [(1, 1, None, Decimal("5.00"), "F", NOW, NOW, None, "TX", "c", "s", 1), (None, 2, None, None, "F", NOW, NOW, None, "TX", "c", "s", 2)],
        S.schema("customer_orders"),
    )
    stage = spark.createDataFrame(
        [
            staging_row(1, Decimal("6.00"), 1, 10),
            staging_row(1, Decimal("7.00"), 2, 20),
            staging_row(3, Decimal("8.00"), None, 30),
            staging_row(3, Decimal("8.00"), None, 30),
            staging_row(None, Decimal("9.00"), 2, 40),
        ],
        S.schema("customer_orders_staging"),
    )
    merged = D.merge_orders(target, stage).collect()
    assert sorted((r["OrderID"] or 0, r["quantity"]) for r in merged) == [(0, 2), (0, 40), (1, 20), (3, 30)]
    assert [r["OrderID"] for r in D.version_conflicts(stage).collect()] == [1]
    batch = D.merge_batch(target, stage, 2, NOW + timedelta(days=1))
    rows = {(r["OrderID"], r["_action"]): r for r in batch.collect()}
    assert rows[(1, "update")]["OrderAmount"] == Decimal("7.00") and rows[(1, "update")]["ModifiedDate"] > NOW
    assert {r["_action"]: r["rows"] for r in D.affected_rows(batch).collect()} == {"update": 1, "insert": 1}
    assert D.clear_staging(stage).count() == 0 and D.clear_staging(stage, 2).count() == 3
    again = D.merge_orders(D.merge_orders(target, stage.where("OrderID is not null")), stage.where("OrderID is not null"))
    assert again.count() == 3
    pairs = spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")
    new = spark.createDataFrame([(1, 2), (2, 2), (2, 2)], "a int, b int")
    assert sorted(map(tuple, D.insert_if_absent(pairs, new, ["a", "b"]).collect())) == [(1, 1), (1, 2), (2, 2)]
    assert sorted(map(tuple, D.delete_join(pairs, new, ["b"]).collect())) == [(1, 1)]
