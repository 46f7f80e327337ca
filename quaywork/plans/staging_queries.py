"""Queries over staging, order transitions and upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaywork.operators import staging as C
from quaywork.operators import upsert as D
from quaywork.plans.domain import ORDERS_NOW
from quaywork.plans.registry import query


def _staged_already(d):
    return d.wms_orders.where("RawId % 2 = 0")


@query(
    "c1_stage_headers",
    "headers",
    """SELECT h.HeaderId AS SourceHeaderId, h.FileName AS SourceFileName, h.WarehouseOrderNumber, '940' AS OrderType, h.ShipDay AS ShipDate,
       CASE WHEN h.HeaderId % 5 <> 0 THEN c.c_name END AS ShipToName,
       CASE WHEN h.HeaderId % 5 <> 0 THEN CAST(h.o_custkey AS VARCHAR) END AS ShipToId, 'READY' AS IntegrationStatus
       FROM headers h LEFT JOIN customer c ON c.c_custkey = h.o_custkey
       WHERE NOT (h.RawId % 10 > 2 AND h.RawId % 2 = 0)""",
)
def stage_headers(d):
    rows = C.stage_headers(d.headers, d.addresses, _staged_already(d), as_of=ORDERS_NOW)
    return rows.select(
        "SourceHeaderId",
        "SourceFileName",
        "WarehouseOrderNumber",
        "OrderType",
        "ShipDate",
        "ShipToName",
        "ShipToId",
        "IntegrationStatus",
    )


@query(
    "c2_stage_lines",
    "details",
    """SELECT HeaderId AS WMSOrderHeaderStagingId, DetailId AS SourceDetailId,
       row_number() OVER (PARTITION BY HeaderId ORDER BY DetailId) AS LineNumber, SKU, QuantityOrdered, UOM
       FROM details WHERE CAST(floor(HeaderId / 4) AS BIGINT) % 10 > 2 AND NOT (rn % 3 = 1)""",
)
def stage_lines(d):
    # Every third line of an order was staged by an earlier, interrupted run.
    done = d.wms_lines.where("LineNumber % 3 = 1")
    rows = C.stage_lines(d.details, d.wms_orders, done, as_of=ORDERS_NOW)
    return rows.drop("CreatedDateTime")


@query(
    "c3_mark_staged",
    "files",
    """SELECT RawId, CASE WHEN RawId % 10 = 2 AND RawId % 3 = 0 THEN 'STAGED' ELSE ProcessStatus END AS ProcessStatus FROM files""",
)
def mark_staged(d):
    # The PARSED files with an id divisible by three have all their orders staged.
    newly = d.headers.where("RawId % 10 = 2 AND RawId % 3 = 0").select(
        F.col("HeaderId").alias("SourceHeaderId")
    )
    staged = d.wms_orders.select("SourceHeaderId").unionByName(newly)
    return C.mark_staged(d.files, d.headers, staged).select("RawId", "ProcessStatus")


@query(
    "c3_staging_log",
    "worders",
    """SELECT DISTINCT SourceFileName, 'LOAD_STAGING' AS EventType, 'SUCCESS' AS EventStatus,
       'EDI 940 records loaded to WMS staging tables.' AS EventMessage, '2001-08-01 12:00:00' AS CreatedDateTime FROM worders""",
)
def staging_log(d):
    return C.staging_log(d.wms_orders, ORDERS_NOW).select(
        "SourceFileName", "EventType", "EventStatus", "EventMessage", "CreatedDateTime"
    )


@query(
    "c4_ready_orders",
    "worders",
    """SELECT id AS WMSOrderHeaderStagingId, id AS SourceHeaderId, SourceFileName, WarehouseOrderNumber, CAST(NULL AS VARCHAR) AS CustomerOrderNumber,
       '940' AS OrderType, ShipDate, ShipToName, ShipToId, AttemptCount, strftime(CreatedDateTime, '%Y-%m-%d %H:%M:%S') AS CreatedDateTime
       FROM worders WHERE IntegrationStatus IN ('READY', 'FAILED') AND AttemptCount < 3 ORDER BY worders.CreatedDateTime, id LIMIT 10""",
)
def ready_orders(d):
    return C.ready_orders(d.wms_orders)


@query(
    "c5_transitions",
    "applied",
    """SELECT w.id AS WMSOrderHeaderStagingId, coalesce(a.last_action, w.IntegrationStatus) AS IntegrationStatus,
       w.AttemptCount + coalesce(a.sends, 0) AS AttemptCount,
       strftime(coalesce(a.attempt, w.LastAttemptDateTime), '%Y-%m-%d %H:%M:%S') AS LastAttemptDateTime,
       CASE WHEN a.last_action IS NULL THEN w.ErrorMessage WHEN a.last_action = 'FAILED' THEN a.last_message END AS ErrorMessage,
       strftime(coalesce(a.processed, w.ProcessedDateTime), '%Y-%m-%d %H:%M:%S') AS ProcessedDateTime
       FROM worders w LEFT JOIN (SELECT id, arg_max(Action, EventTime) AS last_action, arg_max(coalesce(Message, ''), EventTime) AS last_message,
         count(*) FILTER (Action = 'SENT') AS sends, max(EventTime) FILTER (Action IN ('SENT', 'FAILED')) AS attempt,
         max(EventTime) FILTER (Action = 'SUCCESS') AS processed FROM applied GROUP BY id) a ON a.id = w.id""",
)
def transitions(d):
    return C.apply_transitions(d.wms_orders, d.order_events).select(
        "WMSOrderHeaderStagingId",
        "IntegrationStatus",
        "AttemptCount",
        "LastAttemptDateTime",
        "ErrorMessage",
        "ProcessedDateTime",
    )


@query(
    "c6_integration_log",
    "applied",
    """SELECT id AS WMSOrderHeaderStagingId, id AS SourceHeaderId, SourceFileName,
       CASE WHEN Action = 'SENT' THEN 'SEND_ATTEMPT' ELSE 'WMS_RESPONSE' END AS EventType, Action AS EventStatus,
       CASE Action WHEN 'SENT' THEN 'Order marked as sent to WMS.' WHEN 'SUCCESS' THEN coalesce(Message, 'WMS accepted order.') ELSE Message END AS EventMessage,
       strftime(EventTime, '%Y-%m-%d %H:%M:%S') AS CreatedDateTime FROM applied""",
)
def integration_log(d):
    return C.integration_log(d.wms_orders, d.order_events)


@query(
    "c7_bulk_accept",
    "worders",
    """SELECT id AS WMSOrderHeaderStagingId, CASE WHEN IntegrationStatus = 'READY' THEN 'SUCCESS' ELSE IntegrationStatus END AS IntegrationStatus,
       CASE WHEN IntegrationStatus = 'READY' THEN AttemptCount + 1 ELSE AttemptCount END AS AttemptCount, ErrorMessage,
       CASE WHEN IntegrationStatus = 'READY' THEN '2001-08-01 12:00:00' ELSE strftime(ProcessedDateTime, '%Y-%m-%d %H:%M:%S') END AS ProcessedDateTime
       FROM worders""",
)
def bulk_accept(d):
    return C.bulk_accept(d.wms_orders, ORDERS_NOW).select(
        "WMSOrderHeaderStagingId", "IntegrationStatus", "AttemptCount", "ErrorMessage", "ProcessedDateTime"
    )


@query(
    "c7_bulk_accept_count",
    "worders",
    "SELECT count(*) AS pickedUp FROM worders WHERE IntegrationStatus = 'READY'",
)
def bulk_accept_count(d):
    return C.bulk_accept_count(d.wms_orders)


@query(
    "c8_mark_reported",
    "recon",
    """SELECT RawId, CASE WHEN FileStatus = 'Needs Attention' THEN '2001-08-01 12:00:00' ELSE CustomerReportedDateTime END AS CustomerReportedDateTime,
       CASE WHEN FileStatus = 'Needs Attention' THEN 'ann' ELSE CustomerReportedBy END AS CustomerReportedBy FROM recon""",
)
def mark_reported(d):
    from quaywork.operators import reports as R

    recon = R.file_reconciliation(d.files, d.headers, d.wms_orders, ORDERS_NOW)
    chosen = recon.where(F.col("FileStatus") == "Needs Attention")
    return C.mark_reported(d.files, chosen, "ann", ORDERS_NOW).select(
        "RawId", "CustomerReportedDateTime", "CustomerReportedBy"
    )


_LAST = "WITH src AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY OrderID ORDER BY v DESC) AS k FROM staged) WHERE k = 1)"


@query(
    "d1_merge_orders",
    "target staged",
    _LAST
    + """ SELECT t.OrderID, CustomerID, coalesce(s.OrderDate, t.OrderDate) AS OrderDate, OrderAmount, Status,
       CreatedDate, coalesce(s.UnitPrice, t.UnitPrice) AS UnitPrice, coalesce(s.ShipToState, t.ShipToState) AS ShipToState,
       t.CustomerName, t.sku, coalesce(s.quantity, t.quantity) AS quantity
       FROM target t LEFT JOIN (SELECT OrderID, OrderDate, UnitPrice, ShipToState, quantity FROM src) s ON s.OrderID = t.OrderID
       UNION ALL SELECT OrderID, NULL, OrderDate, NULL, NULL, NULL, UnitPrice, ShipToState, CustomerName, sku, quantity
       FROM src WHERE OrderID NOT IN (SELECT OrderID FROM target)""",
)
def merge_orders(d):
    merged = D.merge_orders(d.customer_orders, d.customer_orders_staging, ("UnitPrice",))
    return merged.drop("ModifiedDate")


@query(
    "d1_version_conflicts",
    "staged",
    "SELECT OrderID, count(DISTINCT v) AS versions FROM staged GROUP BY OrderID HAVING count(DISTINCT v) > 1",
)
def version_conflicts(d):
    return D.version_conflicts(d.customer_orders_staging)


_BATCH = "WITH src AS (SELECT DISTINCT OrderID, CustomerID, OrderDate, OrderAmount, Status FROM staged WHERE LoadBatchID = 1)"


@query(
    "d2_merge_batch",
    "target staged",
    _BATCH
    + """ SELECT t.OrderID, coalesce(s.CustomerID, t.CustomerID) AS CustomerID, coalesce(s.OrderDate, t.OrderDate) AS OrderDate,
       coalesce(s.OrderAmount, t.OrderAmount) AS OrderAmount, coalesce(s.Status, t.Status) AS Status, CreatedDate,
       CASE WHEN s.OrderID IS NULL THEN ModifiedDate ELSE '2001-08-01 12:00:00' END AS ModifiedDate,
       CASE WHEN s.OrderID IS NOT NULL THEN 'update' END AS _action
       FROM target t LEFT JOIN src s ON s.OrderID = t.OrderID
       UNION ALL SELECT OrderID, CustomerID, OrderDate, OrderAmount, Status, '2001-08-01 12:00:00', '2001-08-01 12:00:00', 'insert'
       FROM src WHERE OrderID NOT IN (SELECT OrderID FROM target)""",
)
def merge_batch(d):
    merged = D.merge_batch(d.customer_orders, d.customer_orders_staging, 1, ORDERS_NOW)
    return merged.select(
        "OrderID", "CustomerID", "OrderDate", "OrderAmount", "Status", "CreatedDate", "ModifiedDate", "_action"
    )


@query(
    "d2_affected_rows",
    "target staged",
    _BATCH
    + """ SELECT CASE WHEN t.OrderID IS NULL THEN 'insert' ELSE 'update' END AS _action, count(*) AS rows
       FROM src s LEFT JOIN target t ON t.OrderID = s.OrderID GROUP BY 1""",
)
def affected_rows(d):
    return D.affected_rows(D.merge_batch(d.customer_orders, d.customer_orders_staging, 1, ORDERS_NOW))


@query(
    "d3_clear_staging",
    "staged",
    "SELECT OrderID, LoadBatchID, count(*) AS n FROM staged WHERE LoadBatchID IS NULL OR LoadBatchID <> 1 GROUP BY ALL",
)
def clear_staging(d):
    left = D.clear_staging(d.customer_orders_staging, 1)
    return left.groupBy("OrderID", "LoadBatchID").agg(F.count(F.lit(1)).alias("n"))


@query(
    "d4_insert_if_absent",
    "user_roles",
    """SELECT u AS UserOid, r AS RoleId FROM user_roles UNION SELECT concat('user', c_custkey), 3 FROM customer WHERE c_custkey % 4 = 0""",
)
def insert_if_absent(d):
    grants = d.table("customer").where("c_custkey % 4 = 0").select(
        F.expr("concat('user', c_custkey) AS UserOid"), F.lit(3).alias("RoleId")
    )
    return D.insert_if_absent(d.access["user_roles"], grants, ["UserOid", "RoleId"])


@query(
    "d5_delete_join",
    "user_roles",
    """SELECT u AS UserOid, r AS RoleId FROM user_roles WHERE r NOT IN (SELECT r_regionkey FROM region WHERE r_name = 'ASIA')""",
)
def delete_join(d):
    doomed = d.access["roles"].where(F.col("RoleName") == "ASIA")
    return D.delete_join(d.access["user_roles"], doomed, ["RoleId"])
