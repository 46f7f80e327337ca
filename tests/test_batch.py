from __future__ import annotations

from datetime import datetime, timedelta

from quaywork import schemas as S
from quaywork.operators import reports as R
from quaywork.plans.batch import apply_responses, run_batch
from tests.test_interchange import ORDER, whole
from tests.test_sources import put

NOW = datetime(2026, 8, 1, 12, 0)


def snapshot(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_overlapping_deliveries(spark, tmp_path):
    folder = str(tmp_path / "house")
    day1, day2 = tmp_path / "day1", tmp_path / "day2"
    day1.mkdir()
    day2.mkdir()
    first = whole(ORDER.format(n=1), 1)
    put(day1, "a.edi", first, age=90)
    put(day1, "again.edi", first, age=80)
    put(day2, "a.edi", first, age=70)
    put(day2, "renamed.edi", first, age=60)
    put(day2, "b.edi", whole(ORDER.format(n=2) + ORDER.format(n=3).replace("*VN*", "**"), 2), age=50)
    house = run_batch(spark, str(day1), folder, 1, NOW)
    assert snapshot(house.run_rows("skipped", 1), "FileName") == [("again.edi",)]
    for _ in range(2):
        house = run_batch(spark, str(day2), folder, 2, NOW + timedelta(hours=1))
    assert snapshot(house.run_rows("skipped", 2), "FileName") == [("a.edi",), ("renamed.edi",)]
    orders = [r["WarehouseOrderNumber"] for r in house.run_rows("orders", 2).collect()]
    assert sorted(orders) == sorted(set(orders)) and "ORDER1" in orders and "ORDER2" in orders
    assert snapshot(house.run_rows("files", 2), "FileName") == [("a.edi",), ("b.edi",)]
    lines, rejects = house.run_rows("lines", 2).count(), house.run_rows("line_rejects", 2).count()
    assert lines + rejects == house.run_rows("details", 2).count()


def test_three_runs(spark, tmp_path):
    folder = str(tmp_path / "house")
    day1, day2 = tmp_path / "day1", tmp_path / "day2"
    day1.mkdir()
    day2.mkdir()
    put(day1, "good.edi", whole(ORDER.format(n=1) + ORDER.format(n=2), 2), age=90)
    put(day1, "bad.edi", whole(ORDER.format(n=3).replace("*10*", "*0*")), age=80)
    put(day1, "noorder.edi", whole(ORDER.format(n=4).replace("ORDER4", "")), age=70)
    put(day2, "late.edi", whole(ORDER.format(n=5)), age=0)
    for _ in range(2):  # a repeated run replaces itself
        house = run_batch(spark, str(day1), folder, 1, NOW)
    assert snapshot(house.run_rows("files", 1), "FileName", "ProcessStatus") == [
        ("bad.edi", "PARSE_FAILED"), ("good.edi", "STAGED"), ("noorder.edi", "PARSED")
    ]
    assert snapshot(house.all_rows("orders"), "WarehouseOrderNumber", "ShipToName") == [("ORDER1", "NAME"), ("ORDER2", "NAME")]
    assert house.all_rows("lines").count() == 2 and house.all_rows("rejects").count() == 1

    run_batch(spark, str(day2), folder, 2, NOW + timedelta(hours=1))
    files = house.run_rows("files", 2)
    assert snapshot(files, "RawId", "FileName", "ProcessStatus") == [
        (1, "good.edi", "STAGED"), (2, "bad.edi", "PARSE_FAILED"), (3, "noorder.edi", "PARSED"), (4, "late.edi", "STAGED")
    ]
    orders = house.run_rows("orders", 2)
    assert orders.count() == 3
    target = orders.where("WarehouseOrderNumber = 'ORDER5'").first()["WMSOrderHeaderStagingId"]
    events = spark.createDataFrame(
        [(1, target, NOW + timedelta(hours=2), "SENT", None), (2, target, NOW + timedelta(hours=3), "FAILED", "no stock")],
        S.schema("order_events"),
    )
    after = apply_responses(spark, folder, 2, events)
    assert snapshot(after, "WarehouseOrderNumber", "IntegrationStatus", "AttemptCount")[-1] == ("ORDER5", "FAILED", 1)
    recon = R.file_reconciliation(files, house.all_rows("headers"), after, NOW + timedelta(hours=4))
    assert {r["FileName"]: r["FileStatus"] for r in recon.collect()} == {
        "good.edi": "Needs Attention", "bad.edi": "Parse Failed", "noorder.edi": "Needs Attention", "late.edi": "Needs Attention"
    }
    assert house.all_rows("events").count() == 4 and house.all_rows("audit_log").count() == 4
