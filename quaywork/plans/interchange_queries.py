"""Queries over rendered and parsed interchanges (files in, tables out)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaywork import schemas as S
from quaywork.functions.columns import edi_element
from quaywork.operators import interchange as I
from quaywork.plans.domain import ORDERS_NOW
from quaywork.plans.registry import query
from quaywork.session import written_once

_BAD = S.BAD_QUANTITY


@query(
    "a2_isa_fields",
    "files",
    "SELECT RawId, ISASender, ISAReceiver, ISA_ControlNumber FROM files",
)
def isa_fields(d):
    return I.enrich_isa(d.raw_files).select("RawId", "ISASender", "ISAReceiver", "ISA_ControlNumber")


@query(
    "b1_pick_raw",
    "files",
    """SELECT RawId, FileName, g AS Delivery FROM (
       SELECT RawId * 3 + k AS RawId, FileName, k AS g,
         row_number() OVER (PARTITION BY FileName ORDER BY RawId * 3 + k DESC) AS rn
       FROM files, (VALUES (0), (1), (2)) t(k) WHERE NOT (k = 2 AND RawId % 2 = 0)) WHERE rn = 1""",
)
def pick_raw(d):
    # Each file was delivered three times; the last of every second one is parsed already.
    delivered = d.files.withColumn("Delivery", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).select(
        (F.col("RawId") * 3 + F.col("Delivery")).alias("RawId"),
        "FileName",
        "Delivery",
        F.when((F.col("Delivery") == 2) & (F.col("RawId") % 2 == 0), "PARSED")
        .otherwise("RAW_LOADED")
        .alias("ProcessStatus"),
    )
    return I.newest_unparsed(delivered).select("RawId", "FileName", "Delivery")


@query(
    "b2_tokenize",
    "txn lines",
    """SELECT RawId, SegmentId, count(*) AS n, CAST(sum(seq) AS BIGINT) AS seq_sum FROM (
       SELECT DISTINCT RawId, 'ISA' AS SegmentId, 1 AS seq FROM txn
       UNION ALL SELECT DISTINCT RawId, 'GS', 2 FROM txn
       UNION ALL SELECT RawId, 'ST', st FROM txn UNION ALL SELECT RawId, 'W05', st + 1 FROM txn
       UNION ALL SELECT RawId, 'N1', st + 2 FROM txn UNION ALL SELECT RawId, 'SE', se FROM txn
       UNION ALL SELECT t.RawId, 'W01', t.st + 2 + l.rn FROM txn t JOIN lines l ON l.l_orderkey = t.o_orderkey
       UNION ALL SELECT RawId, 'GE', max(se) + 1 FROM txn GROUP BY 1
       UNION ALL SELECT RawId, 'IEA', max(se) + 2 FROM txn GROUP BY 1) GROUP BY ALL""",
)
def tokenize(d):
    return (
        I.tokenize(d.raw_files)
        .groupBy("RawId", "SegmentId")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("SegmentSeq").alias("seq_sum"))
    )


@query(
    "b3_elements",
    "txn lines",
    """SELECT t.RawId, t.st + 2 + l.rn AS SegmentSeq,
       CASE WHEN t.RawId % 10 = 0 AND l.l_linenumber = 1 THEN '0' ELSE CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) END AS E01,
       'EA' AS E02, 'VN' AS E03, concat('P', l.l_partkey) AS E04, CAST(NULL AS VARCHAR) AS E05
       FROM txn t JOIN lines l ON l.l_orderkey = t.o_orderkey""",
)
def elements(d):
    segments = I.tokenize(d.raw_files).where("SegmentId = 'W01'")
    return segments.select(
        "RawId",
        "SegmentSeq",
        *[edi_element(F.col("SegmentText"), i).alias(f"E{i:02d}") for i in range(1, 6)],
    )


@query(
    "b4_envelope",
    "txn files",
    """SELECT f.RawId, f.ISA_ControlNumber AS ISAControlNumber, CAST(f.RawId AS VARCHAR) AS GSControlNumber,
       g.n AS GE01_TransactionCount, CAST(f.RawId AS VARCHAR) AS GE02_GroupControlNumber, 1 AS IEA01_GroupCount,
       f.ISA_ControlNumber AS IEA02_InterchangeControlNumber
       FROM files f JOIN (SELECT RawId, count(*) AS n FROM txn GROUP BY 1) g ON g.RawId = f.RawId""",
)
def envelope(d):
    return I.envelope(d.parsed)


@query("b5_transactions", "txn", "SELECT RawId, st AS STSegmentSeq, se AS SESegmentSeq FROM txn")
def transactions(d):
    return I.transactions(d.parsed)


@query(
    "b6_assign_segments",
    "txn",
    "SELECT RawId, st AS STSegmentSeq, st + i AS SegmentSeq FROM (SELECT *, unnest(range(0, n + 4)) AS i FROM txn)",
)
def assign_segments(d):
    return I.assigned_segments(d.parsed)


@query(
    "b7_headers",
    "goodtxn",
    """SELECT HeaderId, RawId, concat('order_', RawId, '.edi') AS FileName, lpad(CAST(RawId AS VARCHAR), 9, '0') AS ISAControlNumber,
       CAST(RawId AS VARCHAR) AS GSControlNumber, lpad(CAST(idx AS VARCHAR), 4, '0') AS STControlNumber, '940' AS TransactionSetCode,
       concat('ORDER', o_orderkey) AS WarehouseOrderNumber, strftime(o_orderdate, '%Y%m%d') AS ShipDate,
       st AS STSegmentSeq, se AS SESegmentSeq FROM goodtxn""",
)
def headers(d):
    return I.headers(d.parsed)


@query(
    "b8_addresses",
    "goodtxn",
    """SELECT HeaderId, RawId, RawId * 2147483648 + st + 2 AS AddressId, 'ST' AS EntityCode, c_name AS Name,
       '9' AS IdQualifier, CAST(o_custkey AS VARCHAR) AS IdCode FROM goodtxn JOIN customer ON c_custkey = o_custkey""",
)
def addresses(d):
    return I.addresses(d.parsed)


@query(
    "b9_details",
    "goodtxn lines",
    """SELECT t.HeaderId, t.RawId, t.RawId * 2147483648 + t.st + 2 + l.rn AS DetailId, CAST(t.st + 2 + l.rn AS VARCHAR) AS LineNumber,
       CAST(l.l_quantity AS DOUBLE) AS QuantityOrdered, 'EA' AS UOM, 'VN' AS ProductQualifier, concat('P', l.l_partkey) AS ProductId,
       CAST(NULL AS VARCHAR) AS ProductQualifier2, CAST(NULL AS VARCHAR) AS ProductId2
       FROM goodtxn t JOIN lines l ON l.l_orderkey = t.o_orderkey""",
)
def details(d):
    return I.details(d.parsed)


@query(
    "b10_invalid_qty",
    "txn lines",
    f"""SELECT t.RawId, t.st AS STSegmentSeq, t.st + 2 + l.rn AS SegmentSeq, 51001 AS ErrorCode, '{_BAD}' AS ErrorMessage
       FROM txn t JOIN lines l ON l.l_orderkey = t.o_orderkey WHERE t.RawId % 10 = 0 AND l.l_linenumber = 1""",
)
def invalid_qty(d):
    return I.invalid_quantities(d.parsed)


@query(
    "b11_controls",
    "goodtxn",
    """SELECT HeaderId, RawId, n + 4 AS SE01_SegmentCount, lpad(CAST(idx AS VARCHAR), 4, '0') AS SE02_ControlNumber,
       sets AS GE01_TransactionCount, CAST(RawId AS VARCHAR) AS GE02_GroupControlNumber, 1 AS IEA01_GroupCount,
       lpad(CAST(RawId AS VARCHAR), 9, '0') AS IEA02_InterchangeControlNumber FROM goodtxn""",
)
def controls(d):
    return I.controls(d.parsed)


@query(
    "b12_parse_status",
    "files badfiles",
    f"""SELECT f.RawId, CASE WHEN b.RawId IS NULL THEN 'PARSED' ELSE 'PARSE_FAILED' END AS ProcessStatus,
       CASE WHEN b.RawId IS NULL THEN '2001-08-01 12:00:00' END AS ParsedDateTime,
       CASE WHEN b.RawId IS NOT NULL THEN '{_BAD}' END AS ErrorMessage
       FROM files f LEFT JOIN badfiles b ON b.RawId = f.RawId""",
)
def parse_status(d):
    # The files are parsed and joined to the outcome: rendered once.
    received = written_once(d.raw_files, "received")
    after = I.apply_parse_status(received, I.parse_files(received), ORDERS_NOW)
    return after.select("RawId", "ProcessStatus", "ParsedDateTime", "ErrorMessage")


@query(
    "b13_reparse",
    "goodtxn",
    """SELECT RawId, concat('ORDER', o_orderkey) AS WarehouseOrderNumber,
       CASE WHEN RawId % 3 = 0 THEN lpad(CAST(idx AS VARCHAR), 4, '0') ELSE 'old' END AS STControlNumber FROM goodtxn""",
)
def reparse(d):
    # Every third file is parsed again; the others keep their earlier rows.
    columns = ["RawId", "WarehouseOrderNumber", "STControlNumber"]
    fresh = written_once(I.headers(d.parsed).select(*columns), "headers")
    earlier = fresh.withColumn("STControlNumber", F.lit("old"))
    again = d.files.select("RawId").where("RawId % 3 = 0")
    return I.replace_results(earlier, again, fresh.where("RawId % 3 = 0"))


@query(
    "b14_length_check",
    "txn lines",
    """SELECT t.RawId, t.st AS STSegmentSeq, 'details' AS TableName, 'UOM' AS ColumnName, 25 AS ValueLength, 20 AS MaxLength
       FROM txn t JOIN lines l ON l.l_orderkey = t.o_orderkey WHERE l.l_partkey % 100 = 7""",
)
def length_check(d):
    # One part in a hundred gets a unit that is too long for its column.
    text = F.regexp_replace("RawEDIText", r"\*EA\*VN\*(P(?:[0-9]*0)?7)~", "*" + "U" * 25 + "*VN*$1~")
    return I.overlong_values(I.parse_files(d.raw_files.withColumn("RawEDIText", text)))


@query(
    "b15_envelope_check",
    "files",
    """SELECT RawId, FileName, CASE RawId % 11
       WHEN 1 THEN 'GS segment count did not match trailer.' WHEN 2 THEN 'ST segment count did not match SE trailer.'
       WHEN 3 THEN 'No GS segment was found in this file.' WHEN 4 THEN 'No ST*940 transaction sets were parsed from this file.'
       WHEN 5 THEN 'ISA segment failed control-number validation.' WHEN 6 THEN 'Duplicate ISA control number.'
       WHEN 7 THEN 'File ended before an SE segment was found.' WHEN 8 THEN 'File was empty.'
       WHEN 9 THEN 'File was not valid ASCII/EDI text.' END AS Reason FROM files""",
)
def envelope_check(d):
    return I.envelope_check(d.damaged_files)


@query(
    "b16_render_roundtrip",
    "",
    """SELECT concat('ORDER', o.o_orderkey) AS order_number, concat('P', l.l_partkey) AS sku, count(*) AS line_count,
       sum(CAST(l.l_quantity AS DOUBLE)) AS quantity FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
       WHERE NOT (CAST(floor(l_orderkey / 4) AS BIGINT) % 10 = 0) GROUP BY ALL""",
)
def render_roundtrip(d):
    parsed = written_once(d.parsed, "parsed")
    order = I.headers(parsed).where("RawId % 10 <> 0").select(
        "HeaderId", F.col("WarehouseOrderNumber").alias("order_number")
    )
    return (
        I.details(parsed)
        .join(order, "HeaderId")
        .groupBy("order_number", F.col("ProductId").alias("sku"))
        .agg(F.count(F.lit(1)).alias("line_count"), F.sum("QuantityOrdered").alias("quantity"))
    )
