"""Staging of parsed orders and the order status machine.

Order status: READY -> SENT -> SUCCESS | FAILED, FAILED being retryable.  A SENT
event only applies to a READY or FAILED order; a response always applies.
Skipped SENT events are not logged.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaywork import schemas as S
from quaywork.functions.columns import ci_key, clock, compact_date, minute_index
from quaywork.functions.skew import numbered, previous

LINES_PER_SLICE = 4096


def _unstaged(headers: DataFrame, staged: DataFrame | None, file_name: str | None) -> DataFrame:
    if file_name is not None:
        headers = headers.where(ci_key(F.col("FileName")) == ci_key(F.lit(file_name)))
    if staged is not None:
        done = staged.select(F.col("SourceHeaderId").alias("HeaderId"))
        headers = headers.join(done, "HeaderId", "left_anti")
    return headers


def stage_headers(
    headers: DataFrame,
    addresses: DataFrame,
    staged: DataFrame | None = None,
    file_name: str | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """New READY orders, one per header that is not staged yet.

    The ship-to party is the first ``ST`` address.  A header without an order
    number cannot be staged; see :func:`header_rejects`.
    """
    ship_to = (
        addresses.where(ci_key(F.col("EntityCode")) == "ST")
        .groupBy("HeaderId")
        .agg(F.min_by(F.struct("Name", "IdCode"), "AddressId").alias("_party"))
    )
    fresh = _unstaged(headers, staged, file_name).where(F.col("WarehouseOrderNumber").isNotNull())
    return fresh.join(ship_to, "HeaderId", "left").select(
        F.col("HeaderId").alias("WMSOrderHeaderStagingId"),
        F.lit("EDI940").alias("SourceSystem"),
        F.col("HeaderId").alias("SourceHeaderId"),
        F.col("FileName").alias("SourceFileName"),
        "WarehouseOrderNumber",
        F.lit(None).cast("string").alias("CustomerOrderNumber"),
        F.col("TransactionSetCode").alias("OrderType"),
        compact_date(F.col("ShipDate")).alias("ShipDate"),
        F.col("_party.Name").alias("ShipToName"),
        F.col("_party.IdCode").alias("ShipToId"),
        F.lit("READY").alias("IntegrationStatus"),
        F.lit(0).alias("AttemptCount"),
        F.lit(None).cast("timestamp_ntz").alias("LastAttemptDateTime"),
        F.lit(None).cast("string").alias("ErrorMessage"),
        clock(as_of).alias("CreatedDateTime"),
        F.lit(None).cast("timestamp_ntz").alias("ProcessedDateTime"),
    )


def header_rejects(
    headers: DataFrame, staged: DataFrame | None = None, file_name: str | None = None
) -> DataFrame:
    return (
        _unstaged(headers, staged, file_name)
        .where(F.col("WarehouseOrderNumber").isNull())
        .select("HeaderId", "FileName", F.lit("missing order number").alias("Reason"))
    )


def _candidate_lines(
    details: DataFrame, orders: DataFrame, staged: DataFrame | None, file_name: str | None
) -> DataFrame:
    if file_name is not None:
        orders = orders.where(ci_key(F.col("SourceFileName")) == ci_key(F.lit(file_name)))
    lines = details.join(
        orders.select(F.col("SourceHeaderId").alias("HeaderId"), "WMSOrderHeaderStagingId"), "HeaderId"
    )
    if staged is not None:
        done = staged.select("WMSOrderHeaderStagingId", F.col("SourceDetailId").alias("DetailId"))
        lines = lines.join(done, ["WMSOrderHeaderStagingId", "DetailId"], "left_anti")
    return lines.withColumn("SKU", F.coalesce("ProductId", "ProductQualifier"))


def stage_lines(
    details: DataFrame,
    orders: DataFrame,
    staged: DataFrame | None = None,
    file_name: str | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """New order lines, numbered per order over the lines that were not staged yet."""
    lines = _candidate_lines(details, orders, staged, file_name)
    # Ids of one order are consecutive runs, so an id range is an even slice.
    ranked = numbered(
        lines,
        ["HeaderId"],
        [F.col("DetailId")],
        F.floor(F.col("DetailId") / F.lit(LINES_PER_SLICE)),
        "LineNumber",
    )
    return ranked.where(F.col("SKU").isNotNull()).select(
        "WMSOrderHeaderStagingId",
        F.col("DetailId").alias("SourceDetailId"),
        F.col("LineNumber").cast("int").alias("LineNumber"),
        "SKU",
        "QuantityOrdered",
        "UOM",
        clock(as_of).alias("CreatedDateTime"),
    )


def line_rejects(details: DataFrame, orders: DataFrame, staged: DataFrame | None = None) -> DataFrame:
    return (
        _candidate_lines(details, orders, staged, None)
        .where(F.col("SKU").isNull())
        .select("HeaderId", "DetailId", F.lit("missing SKU").alias("Reason"))
    )


def mark_staged(files: DataFrame, headers: DataFrame, orders: DataFrame) -> DataFrame:
    """PARSED files without an unstaged header become STAGED."""
    waiting = (
        headers.join(orders.select(F.col("SourceHeaderId").alias("HeaderId")), "HeaderId", "left_anti")
        .select("RawId", F.lit(True).alias("_waiting"))
        .distinct()
    )
    done = (F.col("ProcessStatus") == "PARSED") & F.col("_waiting").isNull()
    return (
        files.join(waiting, "RawId", "left")
        .withColumn("ProcessStatus", F.when(done, "STAGED").otherwise(F.col("ProcessStatus")))
        .drop("_waiting")
    )


def staging_log(staged_orders: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """One load event per staged file."""
    return staged_orders.select("SourceFileName").distinct().select(
        F.lit(None).cast("bigint").alias("WMSOrderHeaderStagingId"),
        F.lit(None).cast("bigint").alias("SourceHeaderId"),
        "SourceFileName",
        F.lit("LOAD_STAGING").alias("EventType"),
        F.lit("SUCCESS").alias("EventStatus"),
        F.lit(S.STAGED_MESSAGE).alias("EventMessage"),
        clock(as_of).alias("CreatedDateTime"),
    )


def ready_orders(orders: DataFrame, max_rows: int = 10) -> DataFrame:
    """Oldest orders the warehouse may pick up, retries included."""
    return (
        orders.where(
            F.col("IntegrationStatus").isin("READY", "FAILED")
            & (F.col("AttemptCount") < S.MAX_ATTEMPTS)
        )
        .orderBy("CreatedDateTime", "WMSOrderHeaderStagingId")
        .limit(max_rows)
        .select(
            "WMSOrderHeaderStagingId",
            "SourceHeaderId",
            "SourceFileName",
            "WarehouseOrderNumber",
            "CustomerOrderNumber",
            "OrderType",
            "ShipDate",
            "ShipToName",
            "ShipToId",
            "AttemptCount",
            "CreatedDateTime",
        )
    )


def applied_events(orders: DataFrame, events: DataFrame) -> DataFrame:
    """The events that change their order, in (EventTime, EventId) order.

    After any SENT event an order is SENT or SUCCESS, after a response it is
    that response.  So a SENT event applies exactly when the event before it
    was FAILED, or when it is the first and the order was READY or FAILED:
    one look back decides, and no per-order event list is ever built.
    """
    key = "WMSOrderHeaderStagingId"
    chained = previous(
        events,
        [key],
        [F.col("EventTime"), F.col("EventId")],
        minute_index(F.col("EventTime")),
        F.col("Action"),
        "_before",
    )
    state = orders.select(
        key, "SourceHeaderId", "SourceFileName", F.col("IntegrationStatus").alias("_initial")
    )
    before = F.coalesce(F.col("_before"), F.col("_initial"))
    sendable = (F.col("Action") != "SENT") | before.isin("READY", "FAILED")
    return chained.join(state, key).where(sendable).drop("_before", "_initial")


def apply_transitions(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Order snapshot after a batch of events."""
    key = "WMSOrderHeaderStagingId"
    is_sent = F.col("Action") == "SENT"
    change = (
        applied_events(orders, events)
        .groupBy(key)
        .agg(
            F.max_by(F.struct("Action", "Message"), F.struct("EventTime", "EventId")).alias("_last"),
            F.sum(F.when(is_sent, 1).otherwise(0)).cast("int").alias("_sends"),
            F.max(F.when(F.col("Action").isin("SENT", "FAILED"), F.col("EventTime"))).alias("_attempt"),
            F.max(F.when(F.col("Action") == "SUCCESS", F.col("EventTime"))).alias("_processed"),
        )
    )
    moved = F.col("_last").isNotNull()
    return (
        orders.join(change, key, "left")
        .withColumn("IntegrationStatus", F.coalesce("_last.Action", "IntegrationStatus"))
        .withColumn("AttemptCount", F.col("AttemptCount") + F.coalesce("_sends", F.lit(0)))
        .withColumn("LastAttemptDateTime", F.coalesce("_attempt", "LastAttemptDateTime"))
        .withColumn("ProcessedDateTime", F.coalesce("_processed", "ProcessedDateTime"))
        .withColumn(
            "ErrorMessage",
            F.when(moved & (F.col("_last.Action") == "FAILED"), F.col("_last.Message"))
            .when(moved, F.lit(None).cast("string"))
            .otherwise(F.col("ErrorMessage")),
        )
        .select(*orders.columns)
    )


def integration_log(orders: DataFrame, events: DataFrame) -> DataFrame:
    """One log row per applied transition."""
    sent = F.col("Action") == "SENT"
    return applied_events(orders, events).select(
        "WMSOrderHeaderStagingId",
        "SourceHeaderId",
        "SourceFileName",
        F.when(sent, "SEND_ATTEMPT").otherwise("WMS_RESPONSE").alias("EventType"),
        F.col("Action").alias("EventStatus"),
        F.when(sent, F.lit(S.SENT_MESSAGE))
        .when(F.col("Action") == "SUCCESS", F.coalesce("Message", F.lit(S.ACCEPTED_MESSAGE)))
        .otherwise(F.col("Message"))
        .alias("EventMessage"),
        F.col("EventTime").alias("CreatedDateTime"),
    )


def bulk_accept(orders: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Accept every READY order at once; the processed time is set as well."""
    ready = F.col("IntegrationStatus") == "READY"
    return orders.withColumns(
        {
            "IntegrationStatus": F.when(ready, "SUCCESS").otherwise(F.col("IntegrationStatus")),
            "AttemptCount": F.when(ready, F.coalesce("AttemptCount", F.lit(0)) + 1).otherwise(
                F.col("AttemptCount")
            ),
            "ErrorMessage": F.when(~F.coalesce(ready, F.lit(False)), F.col("ErrorMessage")),
            "ProcessedDateTime": F.when(ready, clock(as_of)).otherwise(F.col("ProcessedDateTime")),
        }
    )


def bulk_accept_log(orders: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return orders.where(F.col("IntegrationStatus") == "READY").select(
        "WMSOrderHeaderStagingId",
        "SourceHeaderId",
        "SourceFileName",
        F.lit("WMS_RESPONSE").alias("EventType"),
        F.lit("SUCCESS").alias("EventStatus"),
        F.lit(S.ACCEPTED_MESSAGE).alias("EventMessage"),
        clock(as_of).alias("CreatedDateTime"),
    )


def bulk_accept_count(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("IntegrationStatus") == "READY").agg(
        F.count(F.lit(1)).alias("pickedUp")
    )


def mark_reported(
    files: DataFrame, reported: DataFrame, by: str, as_of: datetime | None = None
) -> DataFrame:
    """Set the reported time and author of the given files, nothing else."""
    chosen = reported.select("RawId", F.lit(True).alias("_chosen")).distinct()
    hit = F.col("_chosen").isNotNull()
    return (
        files.join(chosen, "RawId", "left")
        .withColumn(
            "CustomerReportedDateTime",
            F.when(hit, clock(as_of)).otherwise(F.col("CustomerReportedDateTime")),
        )
        .withColumn(
            "CustomerReportedBy", F.when(hit, F.lit(by)).otherwise(F.col("CustomerReportedBy"))
        )
        .drop("_chosen")
    )
