"""Operational reports over files, orders and logs.

Every time-relative report takes ``as_of``.  Where a report has a fixed set of
output rows (gates, outcomes, chart bars) it is one aggregate row unfolded, so
empty categories stay and nothing needs a join.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaywork import schemas as S
from quaywork.functions.columns import (
    clock,
    count_where,
    hours_between,
    join_text,
    minutes_between,
    round_binary,
    timestamp_text,
)

SUMMARY_COUNTERS = (
    "filesReceived",
    "filesParsed",
    "filesFailed",
    "wmsReady",
    "wmsSent",
    "wmsSuccess",
    "wmsFailed",
    "wmsPickedUp",
    "filesWaiting",
    "oldestFileAgeSeconds",
)
CHART_BARS = (
    ("Received", "filesReceived"),
    ("Parsed", "filesParsed"),
    ("Parse Failed", "filesFailed"),
    ("WMS Ready", "wmsReady"),
    ("WMS Sent", "wmsSent"),
    ("WMS Success", "wmsSuccess"),
    ("WMS Failed", "wmsFailed"),
)
DASH = "—"


def file_summary(files: DataFrame) -> DataFrame:
    status = F.col("ProcessStatus")
    return files.agg(
        F.count(F.lit(1)).alias("filesReceived"),
        count_where(status == "PARSED").alias("filesParsed"),
        count_where(status == "PARSE_FAILED").alias("filesFailed"),
    )


def wms_summary(orders: DataFrame) -> DataFrame:
    status = F.col("IntegrationStatus")
    return orders.agg(
        count_where(status == "READY").alias("wmsReady"),
        count_where(status == "SENT").alias("wmsSent"),
        count_where(status == "SUCCESS").alias("wmsSuccess"),
        count_where(status == "FAILED").alias("wmsFailed"),
        count_where(status.isin("SENT", "SUCCESS", "FAILED")).alias("wmsPickedUp"),
    )


def dashboard_summary(files: DataFrame, orders: DataFrame, queue: DataFrame | None = None) -> DataFrame:
    """One row of all counters; without a queue listing its two counters are 0."""
    parts = file_summary(files).unionByName(wms_summary(orders), allowMissingColumns=True)
    if queue is not None:
        waiting = queue.select("filesWaiting", "oldestFileAgeSeconds")
        parts = parts.unionByName(waiting, allowMissingColumns=True)
    merged = parts.agg(*[F.max(c).alias(c) for c in parts.columns])
    for name in ("filesWaiting", "oldestFileAgeSeconds"):
        value = F.coalesce(F.col(name), F.lit(0)) if name in parts.columns else F.lit(0)
        merged = merged.withColumn(name, value.cast("bigint"))
    return merged


def recent_files(files: DataFrame, n: int = 20) -> DataFrame:
    return (
        files.orderBy(F.col("RawId").desc())
        .limit(n)
        .select(
            F.col("RawId").alias("rawId"),
            F.col("ISA_ControlNumber").alias("isaControlNumber"),
            F.col("ISASender").alias("isaSender"),
            F.col("FileName").alias("fileName"),
            F.col("ProcessStatus").alias("processStatus"),
            timestamp_text(F.col("LoadDateTime")).alias("loadDateTime"),
            F.col("ErrorMessage").alias("errorMessage"),
        )
    )


def recent_orders(orders: DataFrame, n: int = 20) -> DataFrame:
    return (
        orders.orderBy(F.col("WMSOrderHeaderStagingId").desc())
        .limit(n)
        .select(
            F.col("WMSOrderHeaderStagingId").alias("wmsOrderHeaderStagingId"),
            F.col("WarehouseOrderNumber").alias("warehouseOrderNumber"),
            F.col("IntegrationStatus").alias("integrationStatus"),
            F.col("AttemptCount").alias("attemptCount"),
            F.col("ErrorMessage").alias("errorMessage"),
        )
    )


def _calendar(days: int, as_of: datetime | None) -> Column:
    today = clock(as_of).cast("date")
    return F.sequence(F.date_sub(today, days - 1), today)


def _in_calendar(files: DataFrame, days: int, as_of: datetime | None) -> DataFrame:
    """A range on the raw column, so the scan can prune."""
    today = clock(as_of).cast("date")
    first = F.date_sub(today, days - 1).cast("timestamp_ntz")
    after = F.date_add(today, 1).cast("timestamp_ntz")
    return files.where((F.col("LoadDateTime") >= first) & (F.col("LoadDateTime") < after))


def daily_volume(files: DataFrame, days: int = 30, as_of: datetime | None = None) -> DataFrame:
    """Files per calendar day, days without files included."""
    counts = (
        _in_calendar(files, days, as_of)
        .groupBy(F.col("LoadDateTime").cast("date").alias("_day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    zeros = files.sparkSession.range(1).select(
        F.explode(_calendar(days, as_of)).alias("_day"), F.lit(0).cast("bigint").alias("n")
    )
    return (
        counts.unionByName(zeros)
        .groupBy("_day")
        .agg(F.sum("n").alias("count"))
        .select(F.col("_day").cast("string").alias("date"), "count")
    )


def status_by_sender(files: DataFrame, hours: int = 48, as_of: datetime | None = None) -> DataFrame:
    """Received and errored files per sender in the window; no sender is a group too."""
    start = clock(as_of) - F.expr(f"INTERVAL '{hours}' HOUR")
    failed = F.col("ProcessStatus").ilike("%fail%")
    return (
        files.where(F.col("LoadDateTime") >= start)
        .groupBy(F.col("ISASender").alias("sender"))
        .agg(
            F.sum(F.when(failed, 0).otherwise(1)).alias("received"),
            count_where(failed).alias("errored"),
        )
    )


def volume_by_sender_day(files: DataFrame, days: int = 7, as_of: datetime | None = None) -> DataFrame:
    """Files per sender and day, zero-filled for every sender seen in the window."""
    per_sender = (
        _in_calendar(files, days, as_of)
        .groupBy("ISASender", F.col("LoadDateTime").cast("date").alias("_day"))
        .agg(F.count(F.lit(1)).alias("n"))
        # At most one entry per calendar day.
        .groupBy("ISASender")
        .agg(F.map_from_entries(F.collect_list(F.struct("_day", "n"))).alias("_counts"))
    )
    return per_sender.select(
        F.col("ISASender").alias("sender"), "_counts", F.explode(_calendar(days, as_of)).alias("_day")
    ).select(
        F.col("_day").cast("string").alias("date"),
        "sender",
        F.coalesce(F.try_element_at("_counts", F.col("_day")), F.lit(0)).alias("count"),
    )


def pipeline_funnel(files: DataFrame, orders: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Items and oldest entry per gate, from one pass over each table."""
    entered = F.coalesce("ParsedDateTime", "LoadDateTime")
    file_gates = {
        "Files Received": (F.lit(True), F.col("LoadDateTime")),
        "Parsed Successfully": (F.col("ProcessStatus") == "PARSED", entered),
        "Parse Failed": (F.col("ProcessStatus") == "PARSE_FAILED", entered),
    }
    status = F.col("IntegrationStatus")
    order_gates = {
        "WMS Awaiting Pickup": (status == "READY", F.col("CreatedDateTime")),
        "WMS Sent": (status == "SENT", F.coalesce("LastAttemptDateTime", "CreatedDateTime")),
        "WMS Success": (status == "SUCCESS", F.coalesce("ProcessedDateTime", "CreatedDateTime")),
        "WMS Failed": (status == "FAILED", F.coalesce("LastAttemptDateTime", "CreatedDateTime")),
    }

    def gates(table: DataFrame, rules: dict) -> DataFrame:
        measures = []
        for name, (inside, since) in rules.items():
            measures.append(F.count(F.when(inside, 1)).alias(f"n {name}"))
            measures.append(F.min(F.when(inside, since)).alias(f"t {name}"))
        unfolded = F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("GateName"),
                        F.lit(order).alias("GateOrder"),
                        F.lit(monitored).alias("IsMonitoredGate"),
                        F.col(f"n {name}").alias("ItemCount"),
                        F.col(f"t {name}").alias("OldestItemDateTime"),
                    )
                    for name, order, monitored in S.GATES
                    if name in rules
                ]
            )
        ).alias("g")
        return table.agg(*measures).select(unfolded).select("g.*")

    age = minutes_between(F.col("OldestItemDateTime"), clock(as_of))
    red = (
        (F.col("IsMonitoredGate") == 1)
        & (F.col("ItemCount") > 0)
        & (F.col("OldestItemAgeMinutes") > S.STALE_MINUTES)
    )
    return (
        gates(files, file_gates)
        .unionByName(gates(orders, order_gates))
        .withColumn("OldestItemAgeMinutes", age)
        .withColumn("GateStatusColor", F.when(red, "RED").otherwise("GREEN"))
    )


def file_reconciliation(
    files: DataFrame, headers: DataFrame, orders: DataFrame, as_of: datetime | None = None
) -> DataFrame:
    """One outcome per received file; the worst order decides, a report overrides."""
    status = F.col("IntegrationStatus")
    in_flight = status.isin("READY", "SENT")
    joined = headers.select("RawId", "HeaderId").join(
        orders.select(
            F.col("SourceHeaderId").alias("HeaderId"),
            "IntegrationStatus",
            F.coalesce("LastAttemptDateTime", "CreatedDateTime").alias("_since"),
            F.col("ErrorMessage").alias("_error"),
        ),
        "HeaderId",
        "left",
    )
    rollup = joined.groupBy("RawId").agg(
        F.count("HeaderId").alias("OrderCount"),
        count_where(status == "SUCCESS").alias("SuccessCount"),
        count_where(status == "FAILED").alias("FailedOrderCount"),
        count_where(in_flight).alias("InFlightCount"),
        F.min(F.when(in_flight, F.col("_since"))).alias("_oldest"),
        F.max(F.when(status == "FAILED", F.col("_error"))).alias("_sample"),
    )
    now = clock(as_of)
    early = F.col("ProcessStatus").isin("RAW_LOADED", "PARSED")
    staged = F.col("ProcessStatus") == "STAGED"
    waited = minutes_between(F.col("LoadDateTime"), now)
    stuck_early = early & (waited > S.STALE_MINUTES)
    rejected = staged & (F.col("FailedOrderCount") > 0)
    flying = staged & (F.col("InFlightCount") > 0)
    stuck_flying = flying & (minutes_between(F.col("_oldest"), now) > S.STALE_MINUTES)
    failed = F.col("ProcessStatus") == "PARSE_FAILED"
    outcome = (
        F.when(F.col("CustomerReportedDateTime").isNotNull(), "Reported to Customer")
        .when(failed, "Parse Failed")
        .when(stuck_early | rejected | stuck_flying, "Needs Attention")
        .when(early | flying, "In Progress")
        .when(staged & (F.col("SuccessCount") > 0), "Delivered")
        .otherwise("Needs Attention")
    )
    reason = (
        F.when(failed, F.col("ErrorMessage"))
        .when(stuck_early, join_text("Not staged to WMS after ", waited, " min"))
        .when(
            rejected,
            join_text(
                F.col("FailedOrderCount"), " of ", F.col("OrderCount"),
                " order(s) rejected by WMS: ", F.col("_sample"),
            ),
        )
        .when(stuck_flying, join_text(F.col("InFlightCount"), " order(s) stuck awaiting WMS pickup"))
    )
    counts = ("OrderCount", "SuccessCount", "FailedOrderCount", "InFlightCount")
    return (
        files.join(rollup, "RawId", "left")
        .withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in counts})
        .select(
            "RawId",
            "FileName",
            "ISASender",
            "ISA_ControlNumber",
            timestamp_text(F.col("LoadDateTime")).alias("LoadDateTime"),
            "ProcessStatus",
            *counts,
            outcome.alias("FileStatus"),
            reason.alias("AttentionReason"),
            timestamp_text(F.col("CustomerReportedDateTime")).alias("CustomerReportedDateTime"),
            "CustomerReportedBy",
        )
    )


def newest_reconciled(reconciled: DataFrame, n: int = 500) -> DataFrame:
    return reconciled.orderBy(F.col("RawId").desc()).limit(n)


def report_detail(
    reconciled: DataFrame,
    headers: DataFrame,
    orders: DataFrame,
    lines: DataFrame,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Failed order lines of the chosen files, at least one row per file."""
    chosen = reconciled
    if ids is not None:
        chosen = chosen.join(ids.select("RawId"), "RawId", "left_semi")
    failed = (
        orders.where(F.col("IntegrationStatus") == "FAILED")
        .select(
            F.col("SourceHeaderId").alias("HeaderId"),
            "WMSOrderHeaderStagingId",
            "WarehouseOrderNumber",
            F.col("ErrorMessage").alias("_error"),
        )
        .join(
            lines.select("WMSOrderHeaderStagingId", "LineNumber", "SKU"),
            "WMSOrderHeaderStagingId",
            "left",
        )
    )
    # Headers without a failed order still count: each yields a placeholder row.
    by_file = headers.select("RawId", "HeaderId").join(failed, "HeaderId", "left")
    item = F.when(
        F.col("LineNumber").isNotNull(),
        join_text("Line ", F.col("LineNumber"), f" {DASH} ", F.col("SKU")),
    ).otherwise(F.lit(DASH))
    return (
        chosen.select("RawId", "FileName", "ISASender", "ISA_ControlNumber", "AttentionReason")
        .join(by_file, "RawId", "left")
        .select(
            F.col("RawId").alias("rawId"),
            F.col("FileName").alias("fileName"),
            F.col("ISASender").alias("isaSender"),
            F.col("ISA_ControlNumber").alias("isaControlNumber"),
            F.coalesce("WarehouseOrderNumber", F.lit(DASH)).alias("po"),
            item.alias("lineItem"),
            F.coalesce("_error", "AttentionReason", F.lit("No details available")).alias("errorMessage"),
        )
    )


def outcome_buckets(reconciled: DataFrame) -> DataFrame:
    measures = [
        F.count(F.when(F.col("FileStatus") == name, 1)).alias(name) for name in S.OUTCOMES
    ]
    unfolded = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(i + 1).alias("position"),
                    F.lit(name).alias("status"),
                    F.col(f"`{name}`").alias("count"),
                )
                for i, name in enumerate(S.OUTCOMES)
            ]
        )
    )
    return reconciled.agg(*measures).select(unfolded)


def actionable_files(reconciled: DataFrame, customer: str | None = None, n: int = 20) -> DataFrame:
    rows = reconciled.where(F.col("FileStatus").isin(*S.ACTIONABLE))
    if customer:
        rows = rows.where(F.col("ISASender") == customer)
    return newest_reconciled(rows, n)


def actionable_customers(reconciled: DataFrame) -> DataFrame:
    return (
        reconciled.where(F.col("FileStatus").isin(*S.ACTIONABLE) & (F.col("ISASender") != ""))
        .select("ISASender")
        .distinct()
    )


def customer_reports(detail: DataFrame) -> DataFrame:
    """Header of each customer's exception report: its files and exception lines."""
    by_file = detail.groupBy("isaSender", "rawId").agg(F.count(F.lit(1)).alias("n"))
    return by_file.groupBy(F.col("isaSender").alias("customer")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("n").alias("exceptionLines")
    )


def current_status(log: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Today's run of the processing log; the rate divides rows by distinct files."""
    now = clock(as_of)
    today = now.cast("date")
    start = today.cast("timestamp_ntz")
    end = F.date_add(today, 1).cast("timestamp_ntz")
    todays = log.where((F.col("ProcessDateTime") >= start) & (F.col("ProcessDateTime") < end))
    good = count_where(F.col("ProcessStatus") == "SUCCESS")
    # Two levels, so the distinct names are spread over the cluster.
    per_file = todays.groupBy("FileName").agg(
        good.alias("good"), count_where(F.col("ProcessStatus") == "ERROR").alias("bad")
    )
    totals = per_file.agg(
        F.count("FileName").alias("TotalFilesProcessed"),
        F.sum("good").alias("Successful"),
        F.sum("bad").alias("Failed"),
    )
    rate = F.try_divide(F.col("Successful").cast("double"), F.col("TotalFilesProcessed")) * 100
    return totals.select(
        today.alias("Date"), "TotalFilesProcessed", "Successful", "Failed", rate.alias("SuccessRatePct")
    )


def files_needing_attention(log: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return log.where(F.col("ProcessStatus").isin("ERROR", "PENDING", "FAILED")).select(
        "FileName",
        "ProcessStatus",
        "ProcessDateTime",
        "ErrorMessage",
        hours_between(F.col("ProcessDateTime"), clock(as_of)).alias("HoursSinceProcessing"),
    )


def recent_loads(log: DataFrame, n: int = 100) -> DataFrame:
    display = (
        F.when(F.col("LoadStatus") == "SUCCESS", "Complete")
        .when(F.col("LoadStatus") == "FAILURE", "Failed")
        .otherwise("In Progress")
    )
    return (
        log.orderBy(F.col("CreatedDate").desc(), F.col("LoadLogID").desc())
        .limit(n)
        .select(
            "LoadLogID",
            "PipelineName",
            "PipelineRunID",
            "ActivityName",
            "LoadStatus",
            "RowsCopied",
            "RowsAffected",
            "ErrorCode",
            "ErrorMessage",
            "LoadDurationSeconds",
            "CreatedDate",
            display.alias("StatusDisplay"),
        )
    )


def processing_report(
    runs: DataFrame,
    log: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """File outcomes per pipeline run, matched on an equal timestamp.

    ``end`` defaults to today's midnight, so later runs of today stay out.  The
    file log is aggregated per timestamp before it meets the runs.
    """
    today = clock(as_of).cast("date")
    since = clock(start) if start else F.date_sub(today, 7).cast("timestamp_ntz")
    until = clock(end) if end else today.cast("timestamp_ntz")
    inside = F.col("ProcessDateTime").between(since, until)
    columns = S.columns("run_log")
    grouped_runs = runs.where(inside).groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    outcomes = (
        log.where(inside)
        .groupBy("ProcessDateTime", "FileName")
        .agg(
            count_where(F.col("ProcessStatus") == "SUCCESS").alias("good"),
            count_where(F.col("ProcessStatus") == "ERROR").alias("bad"),
        )
        .groupBy("ProcessDateTime")
        .agg(F.count("FileName").alias("_files"), F.sum("good").alias("_good"), F.sum("bad").alias("_bad"))
    )
    return grouped_runs.join(outcomes, "ProcessDateTime", "left").select(
        *columns,
        F.coalesce("_files", F.lit(0)).alias("UniqueFilesInRun"),
        (F.coalesce("_good", F.lit(0)) * F.col("_copies")).alias("SuccessfulFiles"),
        (F.coalesce("_bad", F.lit(0)) * F.col("_copies")).alias("FailedFiles"),
    )


def latest_failed_isa(files: DataFrame) -> DataFrame:
    return files.where(F.col("ProcessStatus").ilike("%fail%")).agg(
        F.max_by(F.struct("ISA_ControlNumber"), "RawId")["ISA_ControlNumber"].alias("isaControlNumber")
    )


def customer_errors(
    files: DataFrame, detail: DataFrame, days: int = 30, as_of: datetime | None = None
) -> DataFrame:
    """Exception lines of recent files, dated by the file's load time."""
    since = clock(as_of) - F.expr(f"INTERVAL '{days}' DAY")
    dated = files.where(F.col("LoadDateTime") >= since).select(
        F.col("RawId").alias("rawId"), F.col("LoadDateTime").alias("ErrorDate")
    )
    return detail.join(dated, "rawId")


def operational_alerts(funnel: DataFrame, reconciled: DataFrame) -> DataFrame:
    """Red gates and files that need attention, in one list."""
    gates = funnel.where(F.col("GateStatusColor") == "RED").select(
        F.lit("GATE").alias("AlertType"),
        F.col("GateName").alias("Subject"),
        join_text("Oldest item waiting ", F.col("OldestItemAgeMinutes"), " min").alias("Detail"),
    )
    stuck = reconciled.where(F.col("FileStatus") == "Needs Attention").select(
        F.lit("FILE").alias("AlertType"),
        F.col("FileName").alias("Subject"),
        F.col("AttentionReason").alias("Detail"),
    )
    return gates.unionByName(stuck)


def month_run_rate(costs: DataFrame, budget: float, as_of: datetime | None = None) -> DataFrame:
    """Month-to-date spend of (Day, Amount), its projection and share of the budget."""
    today = clock(as_of).cast("date")
    month = costs.where((F.col("Day") >= F.trunc(today, "month")) & (F.col("Day") <= today))
    spend = F.coalesce(F.col("_spend"), F.lit(0.0))
    share = F.rint(spend / F.lit(budget) * 100).cast("bigint") if budget else F.lit(0).cast("bigint")
    return month.agg(F.sum("Amount").cast("double").alias("_spend")).select(
        round_binary(spend, 2).alias("spendMtd"),
        F.lit(float(budget)).alias("budget"),
        round_binary(spend / F.day(today) * F.day(F.last_day(today)), 2).alias("projectedMonthEnd"),
        share.alias("percentUsed"),
    )


def normalize_summary(summary: DataFrame) -> DataFrame:
    """Counters as numbers, NULL and missing ones as 0; status defaults to GREEN."""

    def number(name: str) -> Column:
        if name not in summary.columns:
            return F.lit(0).cast("bigint")
        return F.coalesce(F.col(name).cast("string").try_cast("double"), F.lit(0.0)).cast("bigint")

    status = F.lit("GREEN")
    if "queueStatus" in summary.columns:
        status = F.coalesce(F.col("queueStatus"), status)
    return summary.select(
        *[number(c).alias(c) for c in SUMMARY_COUNTERS], status.alias("queueStatus")
    )


def status_chart(summary: DataFrame) -> DataFrame:
    bars = F.array(
        *[F.struct(F.lit(name).alias("name"), F.col(c).alias("count")) for name, c in CHART_BARS]
    )
    return normalize_summary(summary).select(F.inline(bars))


def status_class(status: Column) -> Column:
    return (
        F.when(status.isin("PARSED", "SUCCESS"), "good")
        .when(status == "READY", "ready")
        .when(status == "SENT", "sent")
        .when(status.isin("PARSE_FAILED", "FAILED"), "bad")
        .otherwise("neutral")
    )


def queue_color(seconds: Column) -> Column:
    value = F.coalesce(seconds, F.lit(0))
    return (
        F.when(value < 60, "queue-green").when(value <= 300, "queue-yellow").otherwise("queue-red")
    )


def format_age(minutes: Column) -> Column:
    """``n min`` under an hour, else hours with one decimal, a dash for NULL.

    The decimal is that of the binary quotient: a true tie goes up, but most
    apparent ties (69 / 60) are a little below or above in binary.  Scaling
    the quotient to an integer makes that visible without rounding.
    """
    quotient = minutes.cast("double") / 60
    scale = F.pow(F.lit(2.0), 53 - F.floor(F.log2(quotient)))
    sixth = F.floor(minutes / 6).cast("bigint")
    over = (quotient * scale).cast("bigint") * 20 >= (2 * sixth + 1) * scale.cast("bigint")
    tenths = sixth + F.when(minutes % 6 > 3, 1).when((minutes % 6 == 3) & over, 1).otherwise(0)
    text = F.concat(
        F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit(" hr")
    )
    return (
        F.when(minutes.isNull(), F.lit(DASH))
        .when(minutes < 60, F.concat(minutes.cast("string"), F.lit(" min")))
        .otherwise(text)
    )


