"""Declared schemas, column widths and the fixed vocabularies of the domain."""

from __future__ import annotations

import re

from pyspark.sql.types import StructType

_DDL = {
    "files": """RawId bigint, FileName string, RawEDIText string, LoadDateTime timestamp_ntz,
        ProcessStatus string, ParsedDateTime timestamp_ntz, ErrorMessage string, ISASender string,
        ISAReceiver string, ISA_ControlNumber string, CustomerReportedDateTime timestamp_ntz,
        CustomerReportedBy string""",
    "headers": """HeaderId bigint, RawId bigint, FileName string, ISAControlNumber string,
        GSControlNumber string, STControlNumber string, TransactionSetCode string,
        WarehouseOrderNumber string, ShipDate string, STSegmentSeq int, SESegmentSeq int""",
    "addresses": """HeaderId bigint, RawId bigint, AddressId bigint, EntityCode string, Name string,
        IdQualifier string, IdCode string""",
    "details": """HeaderId bigint, RawId bigint, DetailId bigint, LineNumber string,
        QuantityOrdered decimal(18,4), UOM string, ProductQualifier string, ProductId string,
        ProductQualifier2 string, ProductId2 string""",
    "controls": """HeaderId bigint, RawId bigint, SE01_SegmentCount int, SE02_ControlNumber string,
        GE01_TransactionCount int, GE02_GroupControlNumber string, IEA01_GroupCount int,
        IEA02_InterchangeControlNumber string""",
    "wms_orders": """WMSOrderHeaderStagingId bigint, SourceSystem string, SourceHeaderId bigint,
        SourceFileName string, WarehouseOrderNumber string, CustomerOrderNumber string,
        OrderType string, ShipDate date, ShipToName string, ShipToId string,
        IntegrationStatus string, AttemptCount int, LastAttemptDateTime timestamp_ntz,
        ErrorMessage string, CreatedDateTime timestamp_ntz, ProcessedDateTime timestamp_ntz""",
    "wms_lines": """WMSOrderDetailStagingId bigint, WMSOrderHeaderStagingId bigint,
        SourceDetailId bigint, LineNumber int, SKU string, QuantityOrdered decimal(18,4),
        UOM string, CreatedDateTime timestamp_ntz""",
    "wms_events": """WMSOrderHeaderStagingId bigint, SourceHeaderId bigint, SourceFileName string,
        EventType string, EventStatus string, EventMessage string, CreatedDateTime timestamp_ntz""",
    "order_events": """EventId bigint, WMSOrderHeaderStagingId bigint, EventTime timestamp_ntz,
        Action string, Message string""",
    "proc_log": """LogID bigint, FileName string, ProcessStatus string,
        ProcessDateTime timestamp_ntz, ErrorMessage string, RecordsProcessed int""",
    "run_log": """AdfPipelineRunId string, PipelineStatus string, ProcessDateTime timestamp_ntz,
        FilesProcessed int, FilesFailed int, ExecutionDuration int""",
    "load_log": """LoadLogID bigint, PipelineName string, PipelineRunID string, ActivityName string,
        LoadStatus string, RowsCopied int, RowsAffected int, ErrorCode string,
        ErrorMessage string, LoadStartTime timestamp_ntz, LoadEndTime timestamp_ntz,
        LoadDurationSeconds int, CreatedDate timestamp_ntz""",
    "customer_orders": """OrderID bigint, CustomerID bigint, OrderDate date, OrderAmount decimal(10,2),
        Status string, CreatedDate timestamp_ntz, ModifiedDate timestamp_ntz,
        UnitPrice decimal(10,4), ShipToState string, CustomerName string, sku string,
        quantity int""",
    "customer_orders_staging": """OrderID bigint, CustomerID bigint, OrderDate date,
        OrderAmount decimal(10,2), Status string, UnitPrice decimal(10,4), ShipToState string,
        CustomerName string, sku string, quantity int, LoadBatchID int""",
    "aliases": "AliasId bigint, Alias string, CustomerCode string",
    "error_kb": """ErrorKnowledgeBaseId bigint, ErrorPattern string, Explanation string,
        RemediationStep string""",
    "feedback": """FeedbackId bigint, UserOid string, MessageHash string, Channel string,
        Source string, QuestionText string, ResponseText string, Rating smallint, Comment string,
        CreatedDateTime timestamp_ntz""",
    "intake_scores": """run_date timestamp_ntz, context_length int, model string,
        prompt_variant string, case_set string, name string, request string,
        expected_tier string, actual_tier string, tier_match boolean, forced_escalation string,
        outcome string, schema_valid boolean, detail string, rounds int, latency_sec double,
        estimated_tokens int""",
}


def schema(table: str) -> StructType:
    return StructType.fromDDL(_DDL[table])


def columns(table: str) -> list[str]:
    """Column names, also before a session exists."""
    return re.findall(r"(?:^|,)\s*(\w+) ", _DDL[table])


# Declared text widths of the parsed tables.
WIDTHS = {
    "headers": {
        "ISAControlNumber": 50,
        "GSControlNumber": 50,
        "STControlNumber": 50,
        "TransactionSetCode": 10,
        "WarehouseOrderNumber": 50,
        "ShipDate": 20,
    },
    "addresses": {"EntityCode": 20, "Name": 100, "IdQualifier": 20, "IdCode": 50},
    "details": {
        "UOM": 20,
        "ProductQualifier": 20,
        "ProductId": 100,
        "ProductQualifier2": 20,
        "ProductId2": 100,
    },
    "controls": {
        "SE02_ControlNumber": 50,
        "GE02_GroupControlNumber": 50,
        "IEA02_InterchangeControlNumber": 50,
    },
}

# Messages and status texts that results must carry verbatim.
BAD_QUANTITY = "EDI 940 validation failed: W01 quantity is missing, invalid, or zero."
BAD_QUANTITY_CODE = 51001
TOO_LONG = "String or binary data would be truncated"
NO_TRANSACTIONS = "No ST*940 transaction sets were parsed from this file."
UNTERMINATED_ST = "unterminated ST"
ENVELOPE_REASONS = {
    "empty": "File was empty.",
    "encoding": "File was not valid ASCII/EDI text.",
    "isa": "ISA segment failed control-number validation.",
    "duplicate": "Duplicate ISA control number.",
    "no_gs": "No GS segment was found in this file.",
    "no_st": NO_TRANSACTIONS,
    "truncated": "File ended before an SE segment was found.",
    "st_se": "ST segment count did not match SE trailer.",
    "gs_ge": "GS segment count did not match trailer.",
}
SENT_MESSAGE = "Order marked as sent to WMS."
ACCEPTED_MESSAGE = "WMS accepted order."
STAGED_MESSAGE = "EDI 940 records loaded to WMS staging tables."
MAX_ATTEMPTS = 3
STALE_MINUTES = 60

# Funnel gates as (name, order, monitored).
GATES = (
    ("Files Received", 1, 0),
    ("Parsed Successfully", 2, 1),
    ("Parse Failed", 3, 0),
    ("WMS Awaiting Pickup", 4, 1),
    ("WMS Sent", 5, 0),
    ("WMS Success", 6, 0),
    ("WMS Failed", 7, 0),
)

# File outcomes in display order, and the ones that need action.
OUTCOMES = ("Delivered", "Reported to Customer", "In Progress", "Needs Attention", "Parse Failed")
ACTIONABLE = ("Needs Attention", "Parse Failed")
