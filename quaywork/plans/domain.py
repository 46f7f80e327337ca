"""The given tables seen as warehouse-order data.

Every view is a lazy DataFrame derived by Spark from the parquet tables, so its
size grows with them.  ``oracle.py`` states the same definitions in SQL.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywork.functions.skew import numbered
from quaywork.operators import interchange

ORDERS_NOW = datetime(2001, 8, 1, 12, 0, 0)
EVENTS_NOW = datetime(2024, 1, 31, 0, 0, 0)

_NOW = "timestamp_ntz'2001-08-01 12:00:00'"


class Domain:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def files(self) -> DataFrame:
        """Four orders make a file; the first order's customer names the sender."""
        first = (
            self.table("orders")
            .select(F.expr("cast(floor(o_orderkey / 4) as bigint) AS RawId"), "o_orderkey", "o_custkey")
            .groupBy("RawId")
            .agg(F.min_by("o_custkey", "o_orderkey").alias("c_custkey"))
        )
        customer = self.table("customer").select("c_custkey", "c_mktsegment")
        return (
            first.join(customer, "c_custkey", "left")
            .withColumn(
                "ProcessStatus",
                F.expr(
                    "CASE RawId % 10 WHEN 0 THEN 'PARSE_FAILED' WHEN 1 THEN 'RAW_LOADED' "
                    "WHEN 2 THEN 'PARSED' ELSE 'STAGED' END"
                ),
            )
            .withColumn(
                "LoadDateTime",
                F.expr(f"{_NOW} - cast((RawId * 7919) % 43200 as int) * interval '1' minute"),
            )
            .select(
                "RawId",
                F.expr("concat('order_', RawId, '.edi') AS FileName"),
                "LoadDateTime",
                "ProcessStatus",
                F.expr(
                    "CASE WHEN RawId % 10 > 1 THEN LoadDateTime + interval '5' minute END AS ParsedDateTime"
                ),
                F.expr(
                    "CASE WHEN RawId % 10 = 0 THEN CASE RawId % 3 "
                    "WHEN 0 THEN 'EDI 940 validation failed: W01 quantity is missing, invalid, or zero.' "
                    "WHEN 1 THEN 'Duplicate ISA control number.' END END AS ErrorMessage"
                ),
                F.expr("CASE WHEN RawId % 29 <> 0 THEN c_mktsegment END AS ISASender"),
                F.lit("WAREHOUSE").alias("ISAReceiver"),
                F.lpad(F.col("RawId").cast("string"), 9, "0").alias("ISA_ControlNumber"),
                F.expr(
                    "CASE WHEN RawId % 17 = 0 THEN LoadDateTime + interval '90' minute END "
                    "AS CustomerReportedDateTime"
                ),
                F.expr("CASE WHEN RawId % 17 = 0 THEN 'ops' END AS CustomerReportedBy"),
            )
        )

    @cached_property
    def _parsed_orders(self) -> DataFrame:
        return self.table("orders").withColumn(
            "RawId", F.expr("cast(floor(o_orderkey / 4) as bigint)")
        )

    @cached_property
    def headers(self) -> DataFrame:
        """Orders of the files that were parsed or staged."""
        return self._parsed_orders.where("RawId % 10 > 1").select(
            F.col("o_orderkey").alias("HeaderId"),
            "RawId",
            F.expr("concat('order_', RawId, '.edi') AS FileName"),
            F.lit("940").alias("TransactionSetCode"),
            F.expr("concat('ORDER', o_orderkey) AS WarehouseOrderNumber"),
            # Every 13th order carries a spelled date that staging cannot read.
            F.expr(
                "CASE WHEN o_orderkey % 13 = 0 THEN substring(cast(o_orderdate as string), 1, 10) "
                "ELSE replace(substring(cast(o_orderdate as string), 1, 10), '-', '') END AS ShipDate"
            ),
            "o_custkey",
        )

    @cached_property
    def addresses(self) -> DataFrame:
        """A ship-from party for each order and a ship-to party for most."""
        customer = self.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
        named = self.headers.select("HeaderId", "o_custkey").join(customer, "o_custkey", "left")
        parties = F.array(
            F.struct(
                (F.col("HeaderId") * 2).alias("AddressId"),
                F.lit("SF").alias("EntityCode"),
                F.lit("DISTRIBUTION").alias("Name"),
                F.lit("DC1").alias("IdCode"),
            ),
            F.struct(
                (F.col("HeaderId") * 2 + 1).alias("AddressId"),
                F.when(F.col("HeaderId") % 5 == 0, "BT").otherwise("ST").alias("EntityCode"),
                F.col("c_name").alias("Name"),
                F.col("o_custkey").cast("string").alias("IdCode"),
            ),
        )
        return named.select("HeaderId", F.explode(parties).alias("p")).select("HeaderId", "p.*")

    @cached_property
    def details(self) -> DataFrame:
        """Order lines; every 50th part lacks a product id."""
        order = [
            F.col(c)
            for c in (
                "l_linenumber",
                "l_partkey",
                "l_suppkey",
                "l_extendedprice",
                "l_shipdate",
                "l_discount",
                "l_tax",
            )
        ]
        lines = self.table("lineitem").where("cast(floor(l_orderkey / 4) as bigint) % 10 > 1")
        ranked = numbered(lines, ["l_orderkey"], order, F.col("l_linenumber"), "line")
        return ranked.select(
            F.col("l_orderkey").alias("HeaderId"),
            (F.col("l_orderkey") * 1_048_576 + F.col("line")).alias("DetailId"),
            F.col("l_quantity").cast("decimal(18,4)").alias("QuantityOrdered"),
            F.lit("EA").alias("UOM"),
            F.lit("VN").alias("ProductQualifier"),
            F.expr("CASE WHEN l_partkey % 50 <> 0 THEN concat('P', l_partkey) END AS ProductId"),
        )

    @cached_property
    def wms_orders(self) -> DataFrame:
        """One staged order per order of a STAGED file."""
        customer = self.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
        staged = (
            self._parsed_orders.where("RawId % 10 > 2")
            .join(customer, "o_custkey", "left")
            .withColumn(
                "IntegrationStatus",
                F.expr(
                    "CASE WHEN o_orderstatus = 'P' AND RawId % 3 = 0 THEN 'FAILED' "
                    "WHEN o_orderstatus = 'O' AND RawId % 3 = 1 THEN "
                    "CASE WHEN o_orderkey % 2 = 0 THEN 'READY' ELSE 'SENT' END ELSE 'SUCCESS' END"
                ),
            )
            .withColumn(
                "CreatedDateTime",
                F.expr(f"{_NOW} - cast((RawId * 13) % 120 as int) * interval '1' minute"),
            )
        )
        return staged.select(
            F.col("o_orderkey").alias("WMSOrderHeaderStagingId"),
            F.col("o_orderkey").alias("SourceHeaderId"),
            F.expr("concat('order_', RawId, '.edi') AS SourceFileName"),
            F.expr("concat('ORDER', o_orderkey) AS WarehouseOrderNumber"),
            F.lit(None).cast("string").alias("CustomerOrderNumber"),
            F.lit("940").alias("OrderType"),
            F.expr("cast(o_orderdate as date) AS ShipDate"),
            F.col("c_name").alias("ShipToName"),
            F.col("o_custkey").cast("string").alias("ShipToId"),
            "IntegrationStatus",
            F.expr("cast(o_orderkey % 4 as int) AS AttemptCount"),
            F.expr(
                "CASE IntegrationStatus WHEN 'SENT' THEN CreatedDateTime + interval '3' minute "
                "WHEN 'FAILED' THEN CreatedDateTime + interval '10' minute END AS LastAttemptDateTime"
            ),
            F.expr(
                "CASE WHEN IntegrationStatus = 'FAILED' THEN CASE o_orderkey % 3 "
                "WHEN 0 THEN 'Invalid SKU on line 2' WHEN 1 THEN 'Unknown ship-to location' END END "
                "AS ErrorMessage"
            ),
            "CreatedDateTime",
            F.expr(
                "CASE WHEN IntegrationStatus = 'SUCCESS' THEN CreatedDateTime + interval '7' minute END "
                "AS ProcessedDateTime"
            ),
            "RawId",
        )

    @cached_property
    def wms_lines(self) -> DataFrame:
        """Lines of the staged orders with the file-independent line number."""
        return self.details.where("cast(floor(HeaderId / 4) as bigint) % 10 > 2").select(
            F.col("HeaderId").alias("WMSOrderHeaderStagingId"),
            F.col("DetailId").alias("SourceDetailId"),
            F.expr("cast(DetailId % 1048576 as int) AS LineNumber"),
            F.expr("coalesce(ProductId, ProductQualifier) AS SKU"),
            "QuantityOrdered",
            "UOM",
        )

    @cached_property
    def texts(self) -> DataFrame:
        """Rendered interchange text per file; each tenth file has zero quantities."""
        orders = self._parsed_orders.join(
            self.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name"),
            "o_custkey",
            "left",
        )
        files = self.files.select(
            "RawId", F.col("ISASender").alias("Sender"), F.col("ISA_ControlNumber").alias("ControlNumber")
        )
        shaped = orders.join(files, "RawId").select(
            "RawId",
            F.col("o_orderkey").alias("OrderId"),
            "Sender",
            F.lit("WAREHOUSE").alias("Receiver"),
            "ControlNumber",
            F.lit("20010801").alias("DateText"),
            F.expr("concat('ORDER', o_orderkey) AS OrderNumber"),
            F.expr(
                "replace(substring(cast(o_orderdate as string), 1, 10), '-', '') AS ShipDate"
            ),
            F.col("c_name").alias("ShipToName"),
            F.col("o_custkey").cast("string").alias("ShipToId"),
        )
        lines = self.table("lineitem").select(
            F.col("l_orderkey").alias("OrderId"),
            F.struct(
                "l_linenumber",
                "l_partkey",
                "l_suppkey",
                "l_extendedprice",
                "l_shipdate",
                "l_discount",
                "l_tax",
            ).alias("SortKey"),
            F.expr(
                "CASE WHEN cast(floor(l_orderkey / 4) as bigint) % 10 = 0 AND l_linenumber = 1 THEN '0' "
                "ELSE cast(cast(l_quantity as int) as string) END AS Quantity"
            ),
            F.lit("EA").alias("UOM"),
            F.lit("VN").alias("Qualifier"),
            F.expr("concat('P', l_partkey) AS Sku"),
        )
        # An order stays one set up to a million lines, some 50 MB of text, and its file one file.
        rendered = interchange.render_940(shaped, lines, max_lines=1_000_000, max_transactions=9_999)
        # Continuation files get the ids after the highest first one.
        groups = self._parsed_orders.agg((F.max("RawId") + 1).alias("groups")).scalar()
        return rendered.select(
            F.when(F.col("FilePart") == 0, F.col("RawId"))
            .otherwise(F.col("RawId") + F.col("FilePart") * groups)
            .alias("RawId"),
            "RawEDIText",
        )

    @cached_property
    def raw_files(self) -> DataFrame:
        """Files as received: text present, nothing parsed yet."""
        return self.texts.select(
            "RawId",
            F.expr("concat('order_', RawId, '.edi') AS FileName"),
            "RawEDIText",
            F.lit("RAW_LOADED").alias("ProcessStatus"),
            F.lit(None).cast("timestamp_ntz").alias("ParsedDateTime"),
            F.lit(None).cast("string").alias("ErrorMessage"),
        )

    @cached_property
    def damaged_files(self) -> DataFrame:
        """Received files, nine in eleven with one envelope defect."""
        text = F.col("RawEDIText")
        defect = F.col("RawId") % 11
        damaged = (
            F.when(defect == 1, F.replace(text, F.lit("~IEA*1*"), F.lit("~IEA*2*")))
            .when(defect == 2, F.regexp_replace(text, r"~SE\*[0-9]+\*", "~SE*999*"))
            .when(defect == 3, F.regexp_replace(text, r"~GS\*[^~]*", ""))
            .when(defect == 4, F.replace(text, F.lit("~ST*940*"), F.lit("~ST*945*")))
            .when(defect == 5, F.regexp_replace(text, r"~IEA\*1\*[0-9]+", "~IEA*1*999999999"))
            .when(
                defect == 6,
                F.regexp_replace(
                    F.regexp_replace(text, r"\*U\*00401\*[0-9]+", "*U*00401*777777777"),
                    r"~IEA\*1\*[0-9]+",
                    "~IEA*1*777777777",
                ),
            )
            .when(defect == 7, F.regexp_replace(text, r"~SE\*[^~]*", ""))
            .when(defect == 8, F.lit("\r\n"))
            .when(defect == 9, F.replace(text, F.lit("~W05*N*"), F.lit("~W05*Ñ*")))
            .otherwise(text)
        )
        return self.raw_files.withColumn("RawEDIText", damaged)

    @cached_property
    def parsed(self) -> DataFrame:
        return interchange.parse_files(self.raw_files)

    @cached_property
    def aliases(self) -> DataFrame:
        """Free-text customer names: each segment under its lower-case short form."""
        segments = self.table("customer").select("c_mktsegment").distinct()
        return segments.select(
            F.xxhash64("c_mktsegment").alias("AliasId"),
            F.concat(F.lower(F.substring("c_mktsegment", 1, 4)), F.lit("s")).alias("Alias"),
            F.col("c_mktsegment").alias("CustomerCode"),
        )

    @cached_property
    def error_kb(self) -> DataFrame:
        """Error knowledge: one entry per part type, plus the known failures."""
        kb = self.table("region").select(
            F.expr("cast(r_regionkey as bigint) AS ErrorKnowledgeBaseId"),
            F.expr(
                "CASE r_regionkey WHEN 0 THEN 'w01 quantity' WHEN 1 THEN 'Duplicate ISA' "
                "WHEN 2 THEN 'Invalid SKU%line' WHEN 3 THEN 'quantity is missing' "
                "ELSE 'ship-to' END AS ErrorPattern"
            ),
            F.expr("concat('Explained by ', r_name, '.') AS Explanation"),
            F.expr("CASE WHEN r_regionkey <> 1 THEN concat('Call ', r_name, '.') END AS RemediationStep"),
        )
        return kb

    @cached_property
    def questions(self) -> DataFrame:
        """Questions about the orders, and whatever users said in conversations."""
        asked = self._parsed_orders.select(
            F.col("o_orderkey").alias("QuestionId"),
            F.expr(
                "CASE o_orderkey % 8 WHEN 0 THEN concat('Where is PO ORDER', o_orderkey + 3, '?') "
                "WHEN 1 THEN concat('What happened with ISA ', RawId, '?') "
                "WHEN 2 THEN concat('Please send me order_', RawId, '.edi') "
                "WHEN 3 THEN 'Can I get the failed files for customer furns' "
                "WHEN 4 THEN concat('download interchange control number: ', lpad(cast(RawId as string), 9, '0')) "
                "WHEN 5 THEN concat('is Warehouse  Order #ORDER', o_orderkey, ' shipped') "
                "WHEN 6 THEN concat('give me a summary of purchase order ORDER', o_orderkey) "
                "ELSE 'hello there' END AS Text"
            ),
        )
        said = (
            self.table("conversations")
            .where("role = 'user'")
            .select(F.expr("-1 - (conv_id * 1000 + turn) AS QuestionId"), F.col("text").alias("Text"))
        )
        return asked.unionByName(said)

    @cached_property
    def order_events(self) -> DataFrame:
        """Warehouse responses: each event moves the order its user id names."""
        return self.table("events").select(
            F.col("event_id").alias("EventId"),
            F.expr("user_id * 8 + 5 AS WMSOrderHeaderStagingId"),
            F.col("ts").alias("EventTime"),
            F.expr(
                "CASE event_type WHEN 'click' THEN 'SENT' WHEN 'purchase' THEN 'SENT' "
                "WHEN 'view' THEN 'SUCCESS' ELSE 'FAILED' END AS Action"
            ),
            F.expr(
                "CASE WHEN event_type = 'view' AND event_id % 2 = 0 THEN 'Accepted at dock' "
                "WHEN event_type IN ('error', 'signup') THEN concat('Rejected: code ', event_id % 7) END "
                "AS Message"
            ),
        )

    @cached_property
    def proc_log(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("LogID"),
            F.expr("concat('order_', user_id, '.edi') AS FileName"),
            F.expr(
                "CASE event_type WHEN 'purchase' THEN 'PENDING' WHEN 'signup' THEN 'FAILED' "
                "WHEN 'error' THEN 'ERROR' ELSE 'SUCCESS' END AS ProcessStatus"
            ),
            F.col("ts").alias("ProcessDateTime"),
            F.expr("CASE WHEN event_type = 'error' THEN concat('code ', event_id % 5) END AS ErrorMessage"),
            F.get_json_object("props", "$.k").cast("int").alias("RecordsProcessed"),
        )

    @cached_property
    def change_requests(self) -> DataFrame:
        """Documents as change requests in every state of their life."""
        return self.table("documents").select(
            (F.col("doc_id") + 1).alias("CRNumber"),
            F.expr("concat('Request ', doc_id) AS Title"),
            F.expr("substring('ABC', cast(doc_id % 3 as int) + 1, 1) AS Tier"),
            F.expr(
                "CASE doc_id % 9 WHEN 0 THEN 'Pending Gate 1 review' "
                "WHEN 1 THEN 'Pending Build Approval -- Gate 1 approved by ann on 2026-07-01 10:00 UTC' "
                "WHEN 2 THEN 'Pending Build Approval -- previous attempt failed (spent $1.00 of $2.00 budget), retry below' "
                "WHEN 3 THEN 'Approved (Gate 1) by ann on 2026-07-01 10:00 UTC' "
                "WHEN 4 THEN 'Implemented -- branch pushed' "
                "WHEN 5 THEN 'Merged (Gate 2) by ann on 2026-07-02 10:00 UTC' "
                "WHEN 6 THEN 'Rolled back (Gate 2) by ann on 2026-07-03 10:00 UTC' "
                "WHEN 7 THEN 'Auto-denied -- Tier C, handle manually' "
                "ELSE 'Rejected (Gate 1) by ann on 2026-07-01 10:00 UTC' END AS Status"
            ),
            F.col("text").alias("OriginalRequest"),
            F.expr(
                "CASE WHEN doc_id % 9 = 4 THEN CASE WHEN doc_id % 2 = 0 THEN 'Clean' "
                "ELSE 'Conflicts detected -- manual resolution needed' END END AS MergeReadiness"
            ),
            F.expr("CASE WHEN doc_id % 9 IN (4, 5) AND doc_id % 5 <> 0 THEN concat('cr-', doc_id) END AS Branch"),
            F.expr("CASE WHEN doc_id % 9 = 5 AND doc_id % 7 <> 0 THEN concat('c', doc_id) END AS MergeCommit"),
            F.col("n_chars").alias("EstimatedTokens"),
        )

    @cached_property
    def feedback(self) -> DataFrame:
        """Ratings of the documents' passages."""
        return self.table("documents").select(
            F.col("doc_id").alias("FeedbackId"),
            F.expr("concat('user', doc_id % 50) AS UserOid"),
            F.expr("CASE WHEN doc_id % 2 = 0 THEN 'support' ELSE 'other' END AS Channel"),
            F.expr("CASE WHEN doc_id % 3 = 0 THEN 'ai' END AS Source"),
            F.expr("CASE WHEN doc_id % 19 = 0 THEN '  ' ELSE concat(' Question ', doc_id % 40, ' ') END AS QuestionText"),
            F.expr("concat('Reply in ', lang) AS ResponseText"),
            F.expr("cast(CASE WHEN doc_id % 23 = 0 THEN 5 WHEN doc_id % 3 = 0 THEN -1 ELSE 1 END as smallint) AS Rating"),
            F.expr("CASE WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 4 = 1 THEN text ELSE concat(' note ', doc_id) END AS Comment"),
            F.expr("timestamp_ntz'2024-01-01 00:00:00' + cast(doc_id as int) * interval '1' minute AS CreatedDateTime"),
        )

    @cached_property
    def customer_orders(self) -> DataFrame:
        """The order mart before an upsert: two in three orders."""
        return self.table("orders").where("o_orderkey % 3 <> 0").select(
            F.col("o_orderkey").cast("bigint").alias("OrderID"),
            F.col("o_custkey").cast("bigint").alias("CustomerID"),
            F.col("o_orderdate").cast("date").alias("OrderDate"),
            F.col("o_totalprice").cast("decimal(10,2)").alias("OrderAmount"),
            F.col("o_orderstatus").alias("Status"),
            F.expr("timestamp_ntz'2001-01-01 00:00:00' AS CreatedDate"),
            F.expr("timestamp_ntz'2001-01-01 00:00:00' AS ModifiedDate"),
            F.expr("cast(9.5 as decimal(10,4)) AS UnitPrice"),
            F.lit("TX").alias("ShipToState"),
            F.expr("concat('Customer ', o_custkey) AS CustomerName"),
            F.expr("concat('SKU', o_orderkey % 100) AS sku"),
            F.expr("cast(o_orderkey % 7 as int) AS quantity"),
        )

    @cached_property
    def customer_orders_staging(self) -> DataFrame:
        """Every second order staged, each tenth twice and in two versions."""
        version = F.explode(
            F.when(F.col("o_orderkey") % 10 == 0, F.array(F.lit(0), F.lit(0), F.lit(1))).otherwise(
                F.array(F.lit(0))
            )
        )
        return (
            self.table("orders")
            .where("o_orderkey % 2 = 0")
            .withColumn("v", version)
            .select(
                F.col("o_orderkey").cast("bigint").alias("OrderID"),
                F.col("o_custkey").cast("bigint").alias("CustomerID"),
                F.col("o_orderdate").cast("date").alias("OrderDate"),
                F.expr("cast(cast(o_totalprice as decimal(10,2)) + v + 1 as decimal(10,2)) AS OrderAmount"),
                F.lit("U").alias("Status"),
                F.expr("cast(8.25 + v as decimal(10,4)) AS UnitPrice"),
                F.lit("CA").alias("ShipToState"),
                F.expr("concat('Customer ', o_custkey) AS CustomerName"),
                F.expr("concat('SKU', o_orderkey % 100) AS sku"),
                F.expr("cast(o_orderkey % 7 + v as int) AS quantity"),
                F.expr("CASE WHEN o_orderkey % 14 <> 0 THEN cast(o_orderkey % 3 + v * 3 as int) END AS LoadBatchID"),
            )
        )

    @cached_property
    def access(self) -> dict[str, DataFrame]:
        """Users are customers; groups, roles and permissions come from geography."""
        customer = self.table("customer")
        nation = self.table("nation")
        supplier = self.table("supplier")
        return {
            "user_roles": customer.where("c_custkey % 3 = 0").select(
                F.expr("concat('user', c_custkey) AS UserOid"), F.expr("c_nationkey % 5 AS RoleId")
            ),
            "user_groups": customer.where("c_custkey % 2 = 0").select(
                F.expr("concat('user', c_custkey) AS UserOid"),
                F.expr("cast(c_custkey % 7 as int) AS GroupId"),
            ),
            "group_roles": nation.select(
                F.expr("n_nationkey % 6 AS GroupId"), F.expr("n_regionkey AS RoleId")
            ).distinct(),
            "role_permissions": supplier.select(
                F.expr("cast(s_suppkey % 5 as int) AS RoleId"), F.expr("s_nationkey AS PermissionId")
            ).distinct(),
            "roles": self.table("region").select(
                F.expr("r_regionkey AS RoleId"), F.expr("r_name AS RoleName")
            ),
            "permissions": nation.select(
                F.expr("n_nationkey AS PermissionId"), F.expr("n_name AS PermissionName")
            ),
        }

    @cached_property
    def capacity_days(self) -> DataFrame:
        """Orders shipped a day, with crew hours and line complexity as predictors."""
        lines = self.table("lineitem").groupBy("l_orderkey").agg(
            F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty")
        )
        return (
            self.table("orders")
            .select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
            .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .groupBy("day")
            .agg(
                F.count(F.lit(1)).alias("orders_shipped"),
                F.sum(F.coalesce("qty", F.lit(0.0))).alias("units"),
                F.sum(F.coalesce("n_lines", F.lit(0))).alias("lines"),
            )
            .select(
                "day",
                "orders_shipped",
                (F.col("units") / 25).alias("packer_hours"),
                (F.col("lines") / F.col("orders_shipped")).alias("complexity"),
            )
        )

    @cached_property
    def progress_events(self) -> DataFrame:
        """Build sessions: each user's events as progress messages."""
        return self.table("events").select(
            F.col("user_id").alias("CRNumber"),
            F.col("ts").alias("EventTime"),
            F.col("event_id").alias("EventId"),
            F.expr(
                "CASE event_type WHEN 'view' THEN 'system' WHEN 'purchase' THEN 'result' ELSE 'assistant' END AS EventType"
            ),
            F.expr("CASE WHEN event_type = 'view' THEN 'post_turn_summary' WHEN event_type = 'purchase' THEN 'success' END AS Subtype"),
            F.expr("CASE WHEN event_id % 3 = 0 THEN concat('s', event_id % 11) END AS SessionId"),
            F.get_json_object("props", "$.k").cast("bigint").alias("InputTokens"),
            F.expr("cast(event_id % 5 as bigint) AS OutputTokens"),
            F.expr("CASE WHEN event_id % 4 <> 0 THEN concat('step ', event_id) END AS StatusDetail"),
            F.expr("CASE WHEN event_type = 'purchase' THEN value END AS TotalCostUsd"),
        )
