"""Queries in SQL over the registered views, and the declared-key checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaywork.operators import integrity
from quaywork.operators import interchange as I
from quaywork.plans.domain import ORDERS_NOW
from quaywork.plans.registry import query
from quaywork.plans.views import register_views
from quaywork.session import written_once


@query(
    "sql_reconciliation_view",
    "recon",
    """SELECT FileStatus, ISASender, count(*) AS files, CAST(sum(OrderCount) AS BIGINT) AS orders FROM recon WHERE ProcessStatus <> 'PARSE_FAILED' GROUP BY ALL""",
)
def reconciliation_view(d):
    register_views(
        d.spark, {"files": d.files, "headers": d.headers, "wms_orders": d.wms_orders}, ORDERS_NOW
    )
    return d.spark.sql(
        """SELECT FileStatus, ISASender, count(*) AS files, sum(OrderCount) AS orders
           FROM vw_FileReconciliation WHERE ProcessStatus <> 'PARSE_FAILED' GROUP BY FileStatus, ISASender"""
    )


@query(
    "sql_edi_element",
    "txn",
    """SELECT RawId, st + 1 AS SegmentSeq, concat('ORDER', o_orderkey) AS order_number, strftime(o_orderdate, '%Y%m%d') AS ship_date,
       CAST(NULL AS VARCHAR) AS blank_element FROM txn""",
)
def edi_element_function(d):
    register_views(d.spark, {})
    I.tokenize(d.raw_files).createOrReplaceTempView("segments")
    return d.spark.sql(
        """SELECT RawId, SegmentSeq, GetEDIElement(SegmentText, 2) AS order_number, GetEDIElement(SegmentText, 4) AS ship_date,
           GetEDIElement(SegmentText, 3) AS blank_element FROM segments WHERE SegmentId = 'W05'"""
    )


@query(
    "key_duplicates",
    "staged",
    "SELECT OrderID, count(*) AS rows FROM staged GROUP BY 1 HAVING count(*) > 1",
)
def key_duplicates(d):
    return integrity.duplicate_keys(d.customer_orders_staging, ["OrderID"])


@query(
    "key_orphans",
    "details",
    """SELECT HeaderId, count(*) AS rows FROM details WHERE CAST(floor(HeaderId / 4) AS BIGINT) % 10 = 2 GROUP BY 1""",
)
def key_orphans(d):
    staged = d.wms_orders.select(F.col("SourceHeaderId").alias("HeaderId"))
    return integrity.orphans(d.details, staged, "HeaderId")


@query(
    "key_check",
    "",
    """SELECT * FROM (VALUES ('primary key', 'headers', 'HeaderId', 0), ('primary key', 'addresses', 'HeaderId, AddressId', 0),
       ('primary key', 'details', 'HeaderId, DetailId', 0), ('primary key', 'controls', 'HeaderId', 0), ('foreign key', 'addresses', 'HeaderId', 0),
       ('foreign key', 'details', 'HeaderId', 0), ('foreign key', 'controls', 'HeaderId', 0)) t(kind, "table", "key", violations)""",
)
def key_check(d):
    # The checks read the parse more than ten times.
    parsed = written_once(d.parsed, "parsed")
    tables = {
        "headers": I.headers(parsed),
        "addresses": I.addresses(parsed),
        "details": I.details(parsed),
        "controls": I.controls(parsed),
    }
    return integrity.check_tables(tables)
