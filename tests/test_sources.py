from __future__ import annotations

import os
from datetime import datetime
from decimal import Decimal

from quaywork import schemas as S
from quaywork.operators import interchange as I
from quaywork.sources import files as A
from quaywork.sources import sinks
from tests.test_interchange import ORDER, whole

NOW = datetime(2026, 8, 1, 12, 0)


def put(folder, name, text, age=0):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    stamp = NOW.timestamp() - age
    os.utime(path, (stamp, stamp))


def test_ingest_numbers_by_arrival(spark, tmp_path):
    put(tmp_path, "b.edi", whole(ORDER.format(n=1)), age=50)
    put(tmp_path, "a.edi", whole(ORDER.format(n=2)), age=10)
    put(tmp_path, "c.edi", "\r\n", age=99)
    received = A.ingest_files(spark, str(tmp_path), after=7)
    assert received.schema.fieldNames() == S.columns("files")
    assert {r["FileName"]: r["RawId"] for r in received.collect()} == {"c.edi": 8, "b.edi": 9, "a.edi": 10}
    isa = {r["FileName"]: r["ISASender"] for r in I.enrich_isa(received).collect()}
    assert isa == {"a.edi": "SENDER", "b.edi": "SENDER", "c.edi": None}
    listing = A.list_files(spark, str(tmp_path))
    assert sorted(r["BlobName"] for r in listing.collect()) == ["a.edi", "b.edi", "c.edi"]
    assert A.queue_metrics(listing).first()["filesWaiting"] == 3


def test_write_parse_once(spark, tmp_path):
    rows = [(1, "a", whole(ORDER.format(n=1))), (2, "b", whole(ORDER.format(n=2).replace("*10*", "*0*")))]
    df = spark.createDataFrame(rows, "RawId bigint, FileName string, RawEDIText string")
    places = sinks.write_parse(df, str(tmp_path / "out"))
    counts = {k: spark.read.parquet(v).count() for k, v in places.items()}
    assert counts == {"parsed": 2, "headers": 1, "addresses": 1, "details": 1, "controls": 1, "rejects": 1}


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, None, Decimal("1.50"), NOW, NOW.date(), b"x", True)], "i int, s string, d decimal(10,2), t timestamp_ntz, e date, b binary, o boolean")
    assert tuple(sinks.sheet_safe(df).first()) == ("1", "", "1.5", "2026-08-01T12:00:00", "2026-08-01", "x", "true")
    out = str(tmp_path / "csv")
    for _ in range(2):
        sinks.export_tabular(df, out)
    lines = [open(os.path.join(out, f)).read() for f in os.listdir(out) if f.endswith(".csv")]
    header, row = "i,s,d,t,e,b,o\n", "1,,1.5,2026-08-01T12:00:00,2026-08-01,x,true\n"
    assert set(lines) <= {header, header + row} and header + row in lines
    detail = spark.createDataFrame([("A", 1), ("B", 2)], "isaSender string, rawId int")
    sinks.write_customer_reports(detail, str(tmp_path / "reports"))
    assert {"isaSender=A", "isaSender=B"} <= set(os.listdir(tmp_path / "reports"))


def test_logs(spark, tmp_path):
    activity = spark.createDataFrame([("f", "ERROR", NOW, "bad", None)], "FileName string, ProcessStatus string, ProcessDateTime timestamp_ntz, ErrorMessage string, RecordsProcessed int")
    log, audit = str(tmp_path / "log"), str(tmp_path / "audit")
    for _ in range(2):
        sinks.append_processing(activity, log, audit)
    assert spark.read.parquet(log).count() == 2
    assert spark.read.parquet(audit).first()["Details"] == "Records Processed: "
    runs = spark.createDataFrame([(datetime(2026, 8, 1, 12, 0, 29),), (datetime(2026, 8, 1, 12, 0, 30),)], "RunDateTime timestamp_ntz")
    assert [r[0].minute for r in sinks.run_entries(runs).collect()] == [0, 1]


def test_json_columns(spark):
    df = spark.createDataFrame(
        [(1, '[{"question":"q","answer":"a"}]', '["x"]', None, "", Decimal("1.2650"))],
        "CRNumber int, ClarificationJson string, RequirementsJson string, TouchPointsJson string, OutOfScopeJson string, EstimatedCostUsd decimal(10,4)",
    )
    row = sinks.read_json_columns(df).first()
    assert row["clarification"][0]["answer"] == "a" and row["requirements"] == ["x"]
    assert row["touchPoints"] == [] and row["outOfScope"] == [] and row["EstimatedCostUsd"] == round(1.265, 2)
    back = sinks.write_json_columns(sinks.read_json_columns(df)).first()
    assert back["ClarificationJson"] == '[{"question":"q","answer":"a"}]' and back["TouchPointsJson"] == "[]"


def test_csv_staging(spark, tmp_path):
    header = "OrderID,CustomerID,OrderDate,OrderAmount,Status,UnitPrice,ShipToState,CustomerName,sku,quantity"
    put(tmp_path, "o.csv", header + "\n1,2,2026-01-02,3.50,U,1.25,TX,n,s,4\nx,2,2026-01-02,3.50,U,1.25,TX,n,s,4\n")
    rows = A.read_order_staging(spark, str(tmp_path), 5).collect()
    assert rows[0]["OrderID"] == 1 and rows[0]["LoadBatchID"] == 5 and rows[0]["_corrupt"] is None
    assert rows[1]["OrderID"] is None and rows[1]["_corrupt"].startswith("x,")
