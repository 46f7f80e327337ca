from __future__ import annotations

from quaywork.operators import integrity
from quaywork.plans.views import register_views
from tests.test_reports import NOW, domain  # noqa: F401


def test_views_by_name(spark, domain):  # noqa: F811
    files, headers, orders, lines = domain
    names = register_views(spark, {"files": files, "headers": headers, "wms_orders": orders, "wms_lines": lines}, NOW)
    assert "vw_FileReconciliation" in names and "vw_EDI940_CurrentStatus" not in names
    row = spark.sql("SELECT FileStatus FROM vw_FileReconciliation WHERE RawId = 1").first()
    assert row[0] == "Delivered"
    assert spark.sql("SELECT count(*) FROM vw_PiplineFunnel WHERE GateStatusColor = 'RED'").first()[0] == 1
    text = "ISA* a **b"
    got = spark.sql(f"SELECT GetEDIElement('{text}', 0), GetEDIElement('{text}', 1), GetEDIElement('{text}', 2), GetEDIElement('{text}', 9), GetEDIElement(NULL, 0)").first()
    assert tuple(got) == ("ISA", "a", None, None, None)


def test_key_checks(spark):
    headers = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "HeaderId bigint, RawId bigint")
    details = spark.createDataFrame([(1, 5), (3, 6), (3, 7), (None, 8)], "HeaderId bigint, DetailId bigint")
    assert [tuple(r) for r in integrity.duplicate_keys(headers, ["HeaderId"]).collect()] == [(1, 2)]
    assert [tuple(r) for r in integrity.orphans(details, headers, "HeaderId").collect()] == [(3, 2)]
    found = {(r["kind"], r["table"]): r["violations"] for r in integrity.check_tables({"headers": headers, "details": details}).collect()}
    assert found == {("primary key", "headers"): 1, ("primary key", "details"): 0, ("foreign key", "details"): 1}
