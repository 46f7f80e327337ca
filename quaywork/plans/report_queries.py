"""Queries over the operational reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaywork.functions.columns import floor_hour, second_index
from quaywork.operators import reports as R
from quaywork.plans.domain import EVENTS_NOW, ORDERS_NOW, Domain
from quaywork.plans.registry import query
from quaywork.sources import files as A
from quaywork.sources import sinks

_NOW = "TIMESTAMP '2001-08-01 12:00:00'"
_ENOW = "TIMESTAMP '2024-01-31 00:00:00'"


def recon(d: Domain):
    return R.file_reconciliation(d.files, d.headers, d.wms_orders, ORDERS_NOW)


def detail(d: Domain, reconciled=None):
    return R.report_detail(
        recon(d) if reconciled is None else reconciled, d.headers, d.wms_orders, d.wms_lines
    )


def listing(d: Domain):
    """Waiting files as a listing: the unparsed files by load time."""
    return d.files.where("ProcessStatus = 'RAW_LOADED'").select(
        F.lit("inbound").alias("Container"),
        F.col("FileName").alias("BlobName"),
        F.col("LoadDateTime").alias("ModifiedDateTime"),
    )


_QUEUE = f"""SELECT count(*) AS filesWaiting, coalesce(date_diff('second', min(LoadDateTime), {_NOW}), 0) AS oldestFileAgeSeconds
    FROM files WHERE ProcessStatus = 'RAW_LOADED'"""


@query("a5_queue_metrics", "files", _QUEUE)
def queue_metrics(d):
    return A.queue_metrics(listing(d), ORDERS_NOW)


@query(
    "a6_locate_files",
    "files",
    """SELECT FileName, CASE WHEN RawId % 4 = 3 THEN NULL WHEN RawId % 4 = 2 THEN 'inbound' ELSE 'archive' END AS Container,
       CASE RawId % 4 WHEN 0 THEN FileName WHEN 1 THEN concat(FileName, '.txt') WHEN 2 THEN FileName END AS BlobName FROM files""",
)
def locate_files(d):
    # Archived as named, archived with a suffix, still inbound, or gone.
    name = F.col("FileName")
    case = F.col("RawId") % 4
    stored = d.files.select(
        F.explode(
            F.when(
                case == 0,
                F.array(
                    F.struct(F.lit("archive").alias("Container"), name.alias("BlobName")),
                    F.struct(F.lit("inbound").alias("Container"), name.alias("BlobName")),
                    F.struct(
                        F.lit("archive").alias("Container"), F.concat(name, F.lit(".bak")).alias("BlobName")
                    ),
                ),
            )
            .when(
                case == 1,
                F.array(
                    F.struct(
                        F.lit("archive").alias("Container"), F.concat(name, F.lit(".txt")).alias("BlobName")
                    ),
                    F.struct(F.lit("inbound").alias("Container"), name.alias("BlobName")),
                ),
            )
            .when(case == 2, F.array(F.struct(F.lit("inbound").alias("Container"), name.alias("BlobName"))))
        ).alias("s")
    ).select("s.*")
    return A.locate_files(d.files.select("FileName"), stored)


@query(
    "a7_export_shape",
    "worders",
    """SELECT CAST(id AS VARCHAR) AS WMSOrderHeaderStagingId, '' AS CustomerOrderNumber, ShipDate, coalesce(ErrorMessage, '') AS ErrorMessage,
       strftime(CreatedDateTime, '%Y-%m-%dT%H:%M:%S') AS CreatedDateTime, coalesce(strftime(LastAttemptDateTime, '%Y-%m-%dT%H:%M:%S'), '') AS LastAttemptDateTime
       FROM worders""",
)
def export_shape(d):
    return sinks.sheet_safe(d.wms_orders).select(
        "WMSOrderHeaderStagingId",
        "CustomerOrderNumber",
        "ShipDate",
        "ErrorMessage",
        "CreatedDateTime",
        "LastAttemptDateTime",
    )


@query(
    "a9_log_entries",
    "proc_log",
    """SELECT FileName, ProcessStatus AS Action, strftime(ProcessDateTime, '%Y-%m-%d %H:%M:%S') AS ActionDateTime,
       concat('Records Processed: ', RecordsProcessed) AS Details FROM proc_log""",
)
def log_entries(d):
    return sinks.audit_entries(d.proc_log)


@query(
    "a9_load_entries",
    "",
    f"""SELECT event_id AS LoadLogID, CASE WHEN event_id % 4 = 0 THEN NULL ELSE date_diff('second', ts, ts + CAST(event_id % 200 AS INTEGER) * INTERVAL 700 MILLISECOND) END AS LoadDurationSeconds,
       strftime(CASE WHEN event_id % 4 = 0 THEN {_ENOW} ELSE ts + CAST(event_id % 200 AS INTEGER) * INTERVAL 700 MILLISECOND END, '%Y-%m-%d %H:%M:%S') AS LoadEndTime,
       coalesce(CASE WHEN event_id % 3 = 0 THEN user_id END, 0) AS RowsCopied FROM events""",
)
def load_entries(d):
    return sinks.load_entries(_load_log(d), EVENTS_NOW).select(
        "LoadLogID", "LoadDurationSeconds", "LoadEndTime", "RowsCopied"
    )


def _load_log(d):
    ended = F.expr(
        "CASE WHEN event_id % 4 <> 0 THEN ts + make_dt_interval(0, 0, 0, cast((event_id % 200) * 0.7 as decimal(18,6))) END"
    )
    return d.table("events").select(
        F.col("event_id").alias("LoadLogID"),
        F.expr("concat('load_', event_type) AS PipelineName"),
        F.expr("concat('run', user_id) AS PipelineRunID"),
        F.lit("Copy").alias("ActivityName"),
        F.expr(
            "CASE event_type WHEN 'error' THEN 'FAILURE' WHEN 'signup' THEN 'STARTED' ELSE 'SUCCESS' END AS LoadStatus"
        ),
        F.expr("CASE WHEN event_id % 3 = 0 THEN cast(user_id as int) END AS RowsCopied"),
        F.lit(None).cast("int").alias("RowsAffected"),
        F.lit(None).cast("string").alias("ErrorCode"),
        F.lit(None).cast("string").alias("ErrorMessage"),
        F.col("ts").alias("LoadStartTime"),
        ended.alias("LoadEndTime"),
        F.col("ts").alias("CreatedDate"),
    )


@query(
    "a10_json_roundtrip",
    "",
    """SELECT CAST(doc_id AS BIGINT) AS doc_id, CASE WHEN doc_id % 5 = 0 THEN 0 ELSE 2 END AS n_requirements,
       CASE WHEN doc_id % 5 <> 0 THEN source END AS second_requirement,
       CASE WHEN doc_id % 5 = 0 THEN '[]' ELSE concat('["', lang, '","', source, '"]') END AS RequirementsJson,
       CAST(printf('%.2f', n_chars / 1000.0::DOUBLE) AS DOUBLE) AS EstimatedCostUsd FROM documents""",
)
def json_roundtrip(d):
    stored = d.table("documents").select(
        "doc_id",
        F.expr(
            "CASE WHEN doc_id % 10 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN '' "
            "ELSE concat('[\"', lang, '\", \"', source, '\"]') END AS RequirementsJson"
        ),
        F.expr("cast(n_chars / 1000.0 as decimal(10,4)) AS EstimatedCostUsd"),
    )
    read = sinks.read_json_columns(stored)
    written = sinks.write_json_columns(read.withColumn("_r", F.col("requirements")))
    return written.select(
        "doc_id",
        F.size("_r").alias("n_requirements"),
        F.get("_r", F.lit(1)).alias("second_requirement"),
        "RequirementsJson",
        "EstimatedCostUsd",
    )


@query(
    "e1_file_summary",
    "files",
    """SELECT count(*) AS filesReceived, count(*) FILTER (ProcessStatus = 'PARSED') AS filesParsed,
       count(*) FILTER (ProcessStatus = 'PARSE_FAILED') AS filesFailed FROM files""",
)
def file_summary(d):
    return R.file_summary(d.files)


_WMS = """SELECT count(*) FILTER (IntegrationStatus = 'READY') AS wmsReady, count(*) FILTER (IntegrationStatus = 'SENT') AS wmsSent,
    count(*) FILTER (IntegrationStatus = 'SUCCESS') AS wmsSuccess, count(*) FILTER (IntegrationStatus = 'FAILED') AS wmsFailed,
    count(*) FILTER (IntegrationStatus <> 'READY') AS wmsPickedUp FROM worders"""


@query("e2_wms_summary", "worders", _WMS)
def wms_summary(d):
    return R.wms_summary(d.wms_orders)


_SUMMARY = f"""SELECT * FROM (SELECT count(*) AS filesReceived, count(*) FILTER (ProcessStatus = 'PARSED') AS filesParsed,
    count(*) FILTER (ProcessStatus = 'PARSE_FAILED') AS filesFailed FROM files), ({_WMS}), ({_QUEUE})"""


@query("e3_dashboard_summary", "files worders", _SUMMARY)
def dashboard_summary(d):
    return R.dashboard_summary(d.files, d.wms_orders, A.queue_metrics(listing(d), ORDERS_NOW))


@query(
    "e4_recent_files",
    "files",
    """SELECT RawId AS rawId, ISA_ControlNumber AS isaControlNumber, ISASender AS isaSender, FileName AS fileName, ProcessStatus AS processStatus,
       strftime(LoadDateTime, '%Y-%m-%d %H:%M:%S') AS loadDateTime, ErrorMessage AS errorMessage FROM files ORDER BY files.RawId DESC LIMIT 20""",
)
def recent_files(d):
    return R.recent_files(d.files)


@query(
    "e5_recent_orders",
    "worders",
    """SELECT id AS wmsOrderHeaderStagingId, WarehouseOrderNumber AS warehouseOrderNumber, IntegrationStatus AS integrationStatus,
       AttemptCount AS attemptCount, ErrorMessage AS errorMessage FROM worders ORDER BY id DESC LIMIT 20""",
)
def recent_orders(d):
    return R.recent_orders(d.wms_orders)


@query(
    "e6_daily_volume",
    "files",
    f"""SELECT strftime(day, '%Y-%m-%d') AS date, count(f.RawId) AS count
       FROM (SELECT unnest(generate_series(DATE '2001-07-03', DATE '2001-08-01', INTERVAL 1 DAY)) AS day)
       LEFT JOIN files f ON CAST(f.LoadDateTime AS DATE) = CAST(day AS DATE) GROUP BY day""",
)
def daily_volume(d):
    return R.daily_volume(d.files, 30, ORDERS_NOW)


@query(
    "e7_status_by_sender",
    "files",
    f"""SELECT ISASender AS sender, count(*) FILTER (ProcessStatus NOT ILIKE '%fail%') AS received,
       count(*) FILTER (ProcessStatus ILIKE '%fail%') AS errored FROM files WHERE LoadDateTime >= {_NOW} - INTERVAL 48 HOUR GROUP BY 1""",
)
def status_by_sender(d):
    return R.status_by_sender(d.files, 48, ORDERS_NOW)


@query(
    "e8_volume_by_sender_day",
    "files",
    """SELECT strftime(day, '%Y-%m-%d') AS date, s.ISASender AS sender, count(f.RawId) AS count
       FROM (SELECT unnest(generate_series(DATE '2001-07-26', DATE '2001-08-01', INTERVAL 1 DAY)) AS day)
       CROSS JOIN (SELECT DISTINCT ISASender FROM files WHERE CAST(LoadDateTime AS DATE) BETWEEN '2001-07-26' AND '2001-08-01') s
       LEFT JOIN files f ON CAST(f.LoadDateTime AS DATE) = CAST(day AS DATE) AND f.ISASender IS NOT DISTINCT FROM s.ISASender GROUP BY day, s.ISASender""",
)
def volume_by_sender_day(d):
    return R.volume_by_sender_day(d.files, 7, ORDERS_NOW)


@query(
    "e9_pipeline_funnel",
    "files worders",
    f"""WITH defs(GateName, GateOrder, IsMonitoredGate) AS (VALUES ('Files Received', 1, 0), ('Parsed Successfully', 2, 1), ('Parse Failed', 3, 0),
         ('WMS Awaiting Pickup', 4, 1), ('WMS Sent', 5, 0), ('WMS Success', 6, 0), ('WMS Failed', 7, 0)),
       items AS (SELECT 1 AS g, LoadDateTime AS t FROM files
         UNION ALL SELECT CASE ProcessStatus WHEN 'PARSED' THEN 2 ELSE 3 END, coalesce(ParsedDateTime, LoadDateTime) FROM files WHERE ProcessStatus IN ('PARSED', 'PARSE_FAILED')
         UNION ALL SELECT CASE IntegrationStatus WHEN 'READY' THEN 4 WHEN 'SENT' THEN 5 WHEN 'SUCCESS' THEN 6 ELSE 7 END,
           coalesce(LastAttemptDateTime, ProcessedDateTime, CreatedDateTime) FROM worders)
       SELECT GateName, GateOrder, IsMonitoredGate, count(t) AS ItemCount, strftime(min(t), '%Y-%m-%d %H:%M:%S') AS OldestItemDateTime,
         date_diff('minute', min(t), {_NOW}) AS OldestItemAgeMinutes,
         CASE WHEN IsMonitoredGate = 1 AND date_diff('minute', min(t), {_NOW}) > 60 THEN 'RED' ELSE 'GREEN' END AS GateStatusColor
       FROM defs LEFT JOIN items ON g = GateOrder GROUP BY GateName, GateOrder, IsMonitoredGate""",
)
def pipeline_funnel(d):
    return R.pipeline_funnel(d.files, d.wms_orders, ORDERS_NOW)


_RECON = """SELECT RawId, FileName, ISASender, ISA_ControlNumber, LoadDateTime, ProcessStatus, OrderCount, SuccessCount, FailedOrderCount,
    InFlightCount, FileStatus, AttentionReason, CustomerReportedDateTime, CustomerReportedBy FROM recon"""


@query("e10_file_reconciliation", "recon", _RECON)
def file_reconciliation(d):
    return recon(d)


@query("e10_newest_reconciled", "recon", _RECON + " ORDER BY RawId DESC LIMIT 500")
def newest_reconciled(d):
    return R.newest_reconciled(recon(d))


@query(
    "e11_report_detail",
    "detail recon",
    """SELECT rawId, fileName, isaSender, isaControlNumber, po, lineItem, errorMessage FROM detail
       WHERE rawId IN (SELECT RawId FROM recon WHERE FileStatus IN ('Needs Attention', 'Parse Failed'))""",
)
def report_detail(d):
    reconciled = recon(d)
    chosen = reconciled.where(F.col("FileStatus").isin("Needs Attention", "Parse Failed"))
    return detail(d, chosen)


@query(
    "e12_outcome_buckets",
    "recon",
    """SELECT position, status, count(RawId) AS count FROM (VALUES (1, 'Delivered'), (2, 'Reported to Customer'), (3, 'In Progress'),
       (4, 'Needs Attention'), (5, 'Parse Failed')) b(position, status) LEFT JOIN recon ON FileStatus = status GROUP BY ALL""",
)
def outcome_buckets(d):
    return R.outcome_buckets(recon(d))


@query(
    "e12_actionable_files",
    "recon",
    """SELECT RawId, FileName, FileStatus, AttentionReason FROM recon WHERE FileStatus IN ('Needs Attention', 'Parse Failed')
       AND ISASender = 'BUILDING' ORDER BY RawId DESC LIMIT 20""",
)
def actionable_files(d):
    return R.actionable_files(recon(d), "BUILDING").select(
        "RawId", "FileName", "FileStatus", "AttentionReason"
    )


@query(
    "e12_actionable_customers",
    "recon",
    "SELECT DISTINCT ISASender FROM recon WHERE FileStatus IN ('Needs Attention', 'Parse Failed') AND ISASender IS NOT NULL",
)
def actionable_customers(d):
    return R.actionable_customers(recon(d))


@query(
    "e13_customer_report",
    "detail recon",
    """SELECT isaSender AS customer, count(DISTINCT rawId) AS files, count(*) AS exceptionLines FROM detail
       WHERE rawId IN (SELECT RawId FROM recon WHERE FileStatus IN ('Needs Attention', 'Parse Failed')) GROUP BY 1""",
)
def customer_report(d):
    return R.customer_reports(report_detail(d))


@query(
    "e14_current_status",
    "proc_log",
    """SELECT '2024-01-15' AS Date, count(DISTINCT FileName) AS TotalFilesProcessed, count(*) FILTER (ProcessStatus = 'SUCCESS') AS Successful,
       count(*) FILTER (ProcessStatus = 'ERROR') AS Failed,
       count(*) FILTER (ProcessStatus = 'SUCCESS')::DOUBLE / nullif(count(DISTINCT FileName), 0) * 100 AS SuccessRatePct
       FROM proc_log WHERE CAST(ProcessDateTime AS DATE) = DATE '2024-01-15'""",
)
def current_status(d):
    return R.current_status(d.proc_log, EVENTS_NOW.replace(day=15, hour=9))


@query(
    "e15_files_needing_attention",
    "proc_log",
    f"""SELECT FileName, ProcessStatus, strftime(ProcessDateTime, '%Y-%m-%d %H:%M:%S') AS ProcessDateTime, ErrorMessage,
       date_diff('hour', proc_log.ProcessDateTime, {_ENOW}) AS HoursSinceProcessing FROM proc_log WHERE ProcessStatus <> 'SUCCESS'""",
)
def files_needing_attention(d):
    return R.files_needing_attention(d.proc_log, EVENTS_NOW)


@query(
    "e16_recent_loads",
    "",
    """SELECT event_id AS LoadLogID, concat('load_', event_type) AS PipelineName, concat('run', user_id) AS PipelineRunID, 'Copy' AS ActivityName,
       CASE event_type WHEN 'error' THEN 'FAILURE' WHEN 'signup' THEN 'STARTED' ELSE 'SUCCESS' END AS LoadStatus,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS CreatedDate,
       CASE event_type WHEN 'error' THEN 'Failed' WHEN 'signup' THEN 'In Progress' ELSE 'Complete' END AS StatusDisplay
       FROM events ORDER BY ts DESC, event_id DESC LIMIT 100""",
)
def recent_loads(d):
    logged = sinks.load_entries(_load_log(d), EVENTS_NOW)
    return R.recent_loads(logged).select(
        "LoadLogID", "PipelineName", "PipelineRunID", "ActivityName", "LoadStatus", "CreatedDate", "StatusDisplay"
    )


@query(
    "e17_processing_report",
    "proc_log",
    """WITH hourly AS (SELECT *, date_trunc('hour', ProcessDateTime) AS h FROM proc_log WHERE ProcessDateTime < TIMESTAMP '2024-01-31 01:00:00'),
       runs AS (SELECT h, count(*) AS FilesProcessed, count(*) FILTER (ProcessStatus = 'ERROR') AS FilesFailed FROM hourly
         WHERE h BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-15 00:00:00' GROUP BY h)
       SELECT concat('run-', strftime(r.h, '%Y-%m-%d %H:%M:%S')) AS AdfPipelineRunId, CASE WHEN FilesFailed > 0 THEN 'PARTIAL' ELSE 'SUCCEEDED' END AS PipelineStatus,
         strftime(r.h, '%Y-%m-%d %H:%M:%S') AS ProcessDateTime, FilesProcessed, FilesFailed, FilesProcessed % 60 AS ExecutionDuration,
         count(DISTINCT p.FileName) AS UniqueFilesInRun, count(*) FILTER (p.ProcessStatus = 'SUCCESS') AS SuccessfulFiles,
         count(*) FILTER (p.ProcessStatus = 'ERROR') AS FailedFiles
       FROM runs r LEFT JOIN hourly p ON p.h = r.h AND p.FileName <> 'order_7.edi' GROUP BY ALL""",
)
def processing_report(d):
    hourly = d.proc_log.withColumn("ProcessDateTime", floor_hour(F.col("ProcessDateTime")))
    failed = F.count(F.when(F.col("ProcessStatus") == "ERROR", 1))
    runs = hourly.groupBy("ProcessDateTime").agg(
        F.count(F.lit(1)).cast("int").alias("FilesProcessed"), failed.cast("int").alias("FilesFailed")
    ).select(
        F.concat(F.lit("run-"), F.substring(F.col("ProcessDateTime").cast("string"), 1, 19)).alias("AdfPipelineRunId"),
        F.when(F.col("FilesFailed") > 0, "PARTIAL").otherwise("SUCCEEDED").alias("PipelineStatus"),
        "ProcessDateTime",
        "FilesProcessed",
        "FilesFailed",
        (F.col("FilesProcessed") % 60).alias("ExecutionDuration"),
    )
    logged = hourly.where(F.col("FileName") != "order_7.edi")
    return R.processing_report(runs, logged, as_of=EVENTS_NOW.replace(day=15, hour=9))


@query(
    "e18_latest_failed_isa",
    "files",
    "SELECT ISA_ControlNumber AS isaControlNumber FROM files WHERE ProcessStatus ILIKE '%fail%' ORDER BY RawId DESC LIMIT 1",
)
def latest_failed_isa(d):
    return R.latest_failed_isa(d.files)


@query(
    "e19_customer_errors",
    "detail recon",
    f"""SELECT rawId, fileName, isaSender, isaControlNumber, po, lineItem, errorMessage, strftime(loaded, '%Y-%m-%d %H:%M:%S') AS ErrorDate
       FROM detail WHERE loaded >= {_NOW} - INTERVAL 10 DAY
       AND rawId IN (SELECT RawId FROM recon WHERE FileStatus IN ('Needs Attention', 'Parse Failed'))""",
)
def customer_errors(d):
    return R.customer_errors(d.files, report_detail(d), 10, ORDERS_NOW)


@query(
    "e19_operational_alerts",
    "recon files worders",
    f"""SELECT 'FILE' AS AlertType, FileName AS Subject, AttentionReason AS Detail FROM recon WHERE FileStatus = 'Needs Attention'
       UNION ALL SELECT 'GATE', 'Parsed Successfully', concat('Oldest item waiting ', date_diff('minute', min(ParsedDateTime), {_NOW}), ' min')
         FROM files WHERE ProcessStatus = 'PARSED' HAVING date_diff('minute', min(ParsedDateTime), {_NOW}) > 60
       UNION ALL SELECT 'GATE', 'WMS Awaiting Pickup', concat('Oldest item waiting ', date_diff('minute', min(CreatedDateTime), {_NOW}), ' min')
         FROM worders WHERE IntegrationStatus = 'READY' HAVING date_diff('minute', min(CreatedDateTime), {_NOW}) > 60""",
)
def operational_alerts(d):
    return R.operational_alerts(R.pipeline_funnel(d.files, d.wms_orders, ORDERS_NOW), recon(d))


@query(
    "e20_month_run_rate",
    "",
    """SELECT round(s, 2) AS spendMtd, 5000.0::DOUBLE AS budget, round(s / 15 * 31, 2) AS projectedMonthEnd,
       CAST(round(s / 5000 * 100) AS BIGINT) AS percentUsed
       FROM (SELECT CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS s FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-16')""",
)
def month_run_rate(d):
    costs = d.table("events").select(
        F.col("ts").cast("date").alias("Day"), F.col("value").cast("decimal(18,2)").alias("Amount")
    )
    return R.month_run_rate(costs, 5000.0, EVENTS_NOW.replace(day=15, hour=9))


@query(
    "e21_status_chart",
    "files worders",
    f"""SELECT name, count FROM ({_SUMMARY}) s, LATERAL (VALUES ('Received', filesReceived), ('Parsed', filesParsed), ('Parse Failed', filesFailed),
       ('WMS Ready', wmsReady), ('WMS Sent', wmsSent), ('WMS Success', wmsSuccess), ('WMS Failed', wmsFailed)) v(name, count)""",
)
def status_chart(d):
    return R.status_chart(dashboard_summary(d))


@query(
    "e22_normalize_summary",
    "files",
    """SELECT count(*) AS filesReceived, 0 AS filesParsed, 0 AS filesFailed, 0 AS wmsReady, 0 AS wmsSent, 0 AS wmsSuccess, 0 AS wmsFailed,
       0 AS wmsPickedUp, count(*) FILTER (ProcessStatus = 'RAW_LOADED') AS filesWaiting, 0 AS oldestFileAgeSeconds, 'GREEN' AS queueStatus FROM files""",
)
def normalize_summary(d):
    raw = d.files.agg(
        F.count(F.lit(1)).alias("filesReceived"),
        F.count(F.when(F.col("ProcessStatus") == "RAW_LOADED", 1)).cast("string").alias("filesWaiting"),
        F.max(F.lit(None).cast("string")).alias("queueStatus"),
        F.max(F.lit(None).cast("bigint")).alias("wmsReady"),
    )
    return R.normalize_summary(raw)


@query(
    "e23_status_class",
    "files",
    f"""SELECT ProcessStatus, CASE ProcessStatus WHEN 'PARSED' THEN 'good' WHEN 'PARSE_FAILED' THEN 'bad' ELSE 'neutral' END AS statusClass,
       CASE WHEN date_diff('second', LoadDateTime, {_NOW}) < 60 THEN 'queue-green' WHEN date_diff('second', LoadDateTime, {_NOW}) <= 300 THEN 'queue-yellow'
         ELSE 'queue-red' END AS queueColor, count(*) AS n FROM files GROUP BY ALL""",
)
def status_class(d):
    now = F.lit("2001-08-01 12:00:00").cast("timestamp_ntz")
    age = second_index(now) - second_index(F.col("LoadDateTime"))
    return (
        d.files.select(
            "ProcessStatus",
            R.status_class(F.col("ProcessStatus")).alias("statusClass"),
            R.queue_color(age).alias("queueColor"),
        )
        .groupBy("ProcessStatus", "statusClass", "queueColor")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "e24_format_age",
    "files",
    f"""SELECT RawId, CASE WHEN RawId % 19 = 0 THEN '—' WHEN m < 60 THEN concat(m, ' min')
       ELSE concat(printf('%.1f', m / 60.0::DOUBLE + CASE WHEN m % 30 = 15 THEN 1e-9 ELSE 0 END), ' hr') END AS age
       FROM (SELECT RawId, date_diff('minute', LoadDateTime, {_NOW}) AS m FROM files)""",
)
def format_age(d):
    from quaywork.functions.columns import minutes_between

    now = F.lit("2001-08-01 12:00:00").cast("timestamp_ntz")
    age = F.when(F.col("RawId") % 19 != 0, minutes_between(F.col("LoadDateTime"), now))
    return d.files.select("RawId", R.format_age(age).alias("age"))
