"""The domain views of ``domain.py`` as SQL text, for checking results elsewhere."""

from __future__ import annotations

_ORDERS_NOW = "TIMESTAMP '2001-08-01 12:00:00'"
_LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_discount, l_tax"

# name -> (names it builds on, body)
VIEWS: dict[str, tuple[str, str]] = {
    "po": ("", "SELECT *, CAST(floor(o_orderkey / 4) AS BIGINT) AS RawId FROM orders"),
    "files": (
        "po",
        f"""SELECT f.RawId, concat('order_', f.RawId, '.edi') AS FileName,
        {_ORDERS_NOW} - CAST((f.RawId * 7919) % 43200 AS INTEGER) * INTERVAL 1 MINUTE AS LoadDateTime,
        CASE f.RawId % 10 WHEN 0 THEN 'PARSE_FAILED' WHEN 1 THEN 'RAW_LOADED' WHEN 2 THEN 'PARSED' ELSE 'STAGED' END AS ProcessStatus,
        CASE WHEN f.RawId % 10 > 1 THEN {_ORDERS_NOW} - CAST((f.RawId * 7919) % 43200 AS INTEGER) * INTERVAL 1 MINUTE + INTERVAL 5 MINUTE END AS ParsedDateTime,
        CASE WHEN f.RawId % 10 = 0 THEN CASE f.RawId % 3
          WHEN 0 THEN 'EDI 940 validation failed: W01 quantity is missing, invalid, or zero.'
          WHEN 1 THEN 'Duplicate ISA control number.' END END AS ErrorMessage,
        CASE WHEN f.RawId % 29 <> 0 THEN c.c_mktsegment END AS ISASender,
        'WAREHOUSE' AS ISAReceiver, lpad(CAST(f.RawId AS VARCHAR), 9, '0') AS ISA_ControlNumber,
        CASE WHEN f.RawId % 17 = 0 THEN {_ORDERS_NOW} - CAST((f.RawId * 7919) % 43200 AS INTEGER) * INTERVAL 1 MINUTE + INTERVAL 90 MINUTE END AS CustomerReportedDateTime,
        CASE WHEN f.RawId % 17 = 0 THEN 'ops' END AS CustomerReportedBy
        FROM (SELECT RawId, arg_min(o_custkey, o_orderkey) AS ck FROM po GROUP BY RawId) f
        LEFT JOIN customer c ON c.c_custkey = f.ck""",
    ),
    "headers": (
        "po",
        """SELECT o_orderkey AS HeaderId, RawId, concat('order_', RawId, '.edi') AS FileName,
        '940' AS TransactionSetCode, concat('ORDER', o_orderkey) AS WarehouseOrderNumber,
        CASE WHEN o_orderkey % 13 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y%m%d') END AS ShipDate,
        CASE WHEN o_orderkey % 13 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS ShipDay, o_custkey
        FROM po WHERE RawId % 10 > 1""",
    ),
    "details": (
        "",
        f"""SELECT l_orderkey AS HeaderId, l_orderkey * 1048576 + rn AS DetailId, rn,
        CAST(l_quantity AS DOUBLE) AS QuantityOrdered, 'EA' AS UOM,
        CASE WHEN l_partkey % 50 <> 0 THEN concat('P', l_partkey) ELSE 'VN' END AS SKU
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS rn FROM lineitem)
        WHERE CAST(floor(l_orderkey / 4) AS BIGINT) % 10 > 1""",
    ),
    "worders": (
        "po",
        f"""SELECT *, CASE IntegrationStatus WHEN 'SENT' THEN CreatedDateTime + INTERVAL 3 MINUTE
          WHEN 'FAILED' THEN CreatedDateTime + INTERVAL 10 MINUTE END AS LastAttemptDateTime,
        CASE WHEN IntegrationStatus = 'SUCCESS' THEN CreatedDateTime + INTERVAL 7 MINUTE END AS ProcessedDateTime,
        CASE WHEN IntegrationStatus = 'FAILED' THEN CASE id % 3 WHEN 0 THEN 'Invalid SKU on line 2'
          WHEN 1 THEN 'Unknown ship-to location' END END AS ErrorMessage
        FROM (SELECT o.o_orderkey AS id, o.RawId, concat('order_', o.RawId, '.edi') AS SourceFileName,
          concat('ORDER', o.o_orderkey) AS WarehouseOrderNumber,
          strftime(o.o_orderdate, '%Y-%m-%d') AS ShipDate, c.c_name AS ShipToName,
          CAST(o.o_custkey AS VARCHAR) AS ShipToId, o.o_orderkey % 4 AS AttemptCount,
          CASE WHEN o.o_orderstatus = 'P' AND o.RawId % 3 = 0 THEN 'FAILED'
            WHEN o.o_orderstatus = 'O' AND o.RawId % 3 = 1 THEN CASE WHEN o.o_orderkey % 2 = 0 THEN 'READY' ELSE 'SENT' END
            ELSE 'SUCCESS' END AS IntegrationStatus,
          {_ORDERS_NOW} - CAST((o.RawId * 13) % 120 AS INTEGER) * INTERVAL 1 MINUTE AS CreatedDateTime
          FROM po o LEFT JOIN customer c ON c.c_custkey = o.o_custkey WHERE o.RawId % 10 > 2)""",
    ),
    "recon": (
        "files headers worders",
        f"""SELECT f.RawId, f.FileName, f.ISASender, f.ISA_ControlNumber, f.ErrorMessage, f.LoadDateTime AS loaded,
        strftime(f.LoadDateTime, '%Y-%m-%d %H:%M:%S') AS LoadDateTime, f.ProcessStatus, OrderCount, SuccessCount, FailedOrderCount, InFlightCount,
        strftime(f.CustomerReportedDateTime, '%Y-%m-%d %H:%M:%S') AS CustomerReportedDateTime, f.CustomerReportedBy,
        CASE WHEN f.CustomerReportedDateTime IS NOT NULL THEN 'Reported to Customer'
          WHEN f.ProcessStatus = 'PARSE_FAILED' THEN 'Parse Failed'
          WHEN f.ProcessStatus <> 'STAGED' AND date_diff('minute', f.LoadDateTime, {_ORDERS_NOW}) > 60 THEN 'Needs Attention'
          WHEN f.ProcessStatus <> 'STAGED' THEN 'In Progress'
          WHEN FailedOrderCount > 0 THEN 'Needs Attention'
          WHEN InFlightCount > 0 THEN CASE WHEN date_diff('minute', oldest, {_ORDERS_NOW}) > 60 THEN 'Needs Attention' ELSE 'In Progress' END
          WHEN SuccessCount > 0 THEN 'Delivered' ELSE 'Needs Attention' END AS FileStatus,
        CASE WHEN f.ProcessStatus = 'PARSE_FAILED' THEN f.ErrorMessage
          WHEN f.ProcessStatus <> 'STAGED' THEN CASE WHEN date_diff('minute', f.LoadDateTime, {_ORDERS_NOW}) > 60
            THEN concat('Not staged to WMS after ', date_diff('minute', f.LoadDateTime, {_ORDERS_NOW}), ' min') END
          WHEN FailedOrderCount > 0 THEN concat(FailedOrderCount, ' of ', OrderCount, ' order(s) rejected by WMS: ', sample)
          WHEN InFlightCount > 0 AND date_diff('minute', oldest, {_ORDERS_NOW}) > 60
            THEN concat(InFlightCount, ' order(s) stuck awaiting WMS pickup') END AS AttentionReason
        FROM files f JOIN (
          SELECT f2.RawId, count(h.HeaderId) AS OrderCount,
            count(*) FILTER (w.IntegrationStatus = 'SUCCESS') AS SuccessCount,
            count(*) FILTER (w.IntegrationStatus = 'FAILED') AS FailedOrderCount,
            count(*) FILTER (w.IntegrationStatus IN ('READY', 'SENT')) AS InFlightCount,
            min(coalesce(w.LastAttemptDateTime, w.CreatedDateTime)) FILTER (w.IntegrationStatus IN ('READY', 'SENT')) AS oldest,
            max(w.ErrorMessage) FILTER (w.IntegrationStatus = 'FAILED') AS sample
          FROM files f2 LEFT JOIN headers h ON h.RawId = f2.RawId LEFT JOIN worders w ON w.id = h.HeaderId
          GROUP BY f2.RawId) g ON g.RawId = f.RawId""",
    ),
    "detail": (
        "recon headers worders details",
        """SELECT r.RawId AS rawId, r.FileName AS fileName, r.ISASender AS isaSender, r.ISA_ControlNumber AS isaControlNumber,
        coalesce(w.WarehouseOrderNumber, '—') AS po,
        CASE WHEN d.rn IS NOT NULL THEN concat('Line ', d.rn, ' — ', d.SKU) ELSE '—' END AS lineItem,
        coalesce(w.ErrorMessage, r.AttentionReason, 'No details available') AS errorMessage, r.loaded
        FROM recon r LEFT JOIN headers h ON h.RawId = r.RawId
        LEFT JOIN worders w ON w.id = h.HeaderId AND w.IntegrationStatus = 'FAILED'
        LEFT JOIN details d ON d.HeaderId = w.id""",
    ),
    # What the rendered text of an order looks like once parsed.
    "lines": (
        "",
        f"""SELECT *, CAST(floor(l_orderkey / 4) AS BIGINT) AS RawId,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS rn FROM lineitem""",
    ),
    "txn": (
        "po",
        """SELECT *, RawId * 2147483648 + st AS HeaderId, st + n + 3 AS se FROM (
          SELECT o.*, coalesce(c.n, 0) AS n,
            row_number() OVER (PARTITION BY o.RawId ORDER BY o.o_orderkey) AS idx,
            CAST(3 + coalesce(sum(coalesce(c.n, 0) + 4) OVER (PARTITION BY o.RawId ORDER BY o.o_orderkey
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS st,
            count(*) OVER (PARTITION BY o.RawId) AS sets
          FROM po o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) c ON c.l_orderkey = o.o_orderkey)""",
    ),
    "badfiles": (
        "lines",
        "SELECT DISTINCT RawId FROM lines WHERE RawId % 10 = 0 AND l_linenumber = 1",
    ),
    "goodtxn": ("txn badfiles", "SELECT * FROM txn WHERE RawId NOT IN (SELECT RawId FROM badfiles)"),
    "proc_log": (
        "",
        """SELECT event_id AS LogID, concat('order_', user_id, '.edi') AS FileName,
        CASE event_type WHEN 'purchase' THEN 'PENDING' WHEN 'signup' THEN 'FAILED' WHEN 'error' THEN 'ERROR' ELSE 'SUCCESS' END AS ProcessStatus,
        ts AS ProcessDateTime, CASE WHEN event_type = 'error' THEN concat('code ', event_id % 5) END AS ErrorMessage,
        CAST(json_extract_string(props, '$.k') AS INTEGER) AS RecordsProcessed FROM events""",
    ),
    "oevents": (
        "",
        """SELECT event_id AS EventId, user_id * 8 + 5 AS id, ts AS EventTime,
        CASE event_type WHEN 'click' THEN 'SENT' WHEN 'purchase' THEN 'SENT' WHEN 'view' THEN 'SUCCESS' ELSE 'FAILED' END AS Action,
        CASE WHEN event_type = 'view' AND event_id % 2 = 0 THEN 'Accepted at dock'
          WHEN event_type IN ('error', 'signup') THEN concat('Rejected: code ', event_id % 7) END AS Message FROM events""",
    ),
    "applied": (
        "worders oevents",
        """SELECT * FROM (SELECT e.*, w.SourceFileName,
          coalesce(lag(e.Action) OVER (PARTITION BY e.id ORDER BY e.EventTime, e.EventId), w.IntegrationStatus) AS before
          FROM oevents e JOIN worders w ON w.id = e.id)
        WHERE Action <> 'SENT' OR before IN ('READY', 'FAILED')""",
    ),
    "questions": (
        "po",
        """SELECT o_orderkey AS QuestionId, CASE o_orderkey % 8
          WHEN 0 THEN concat('Where is PO ORDER', o_orderkey + 3, '?')
          WHEN 1 THEN concat('What happened with ISA ', RawId, '?')
          WHEN 2 THEN concat('Please send me order_', RawId, '.edi')
          WHEN 3 THEN 'Can I get the failed files for customer furns'
          WHEN 4 THEN concat('download interchange control number: ', lpad(CAST(RawId AS VARCHAR), 9, '0'))
          WHEN 5 THEN concat('is Warehouse  Order #ORDER', o_orderkey, ' shipped')
          WHEN 6 THEN concat('give me a summary of purchase order ORDER', o_orderkey)
          ELSE 'hello there' END AS Text FROM po
        UNION ALL SELECT -1 - (conv_id * 1000 + turn), text FROM conversations WHERE role = 'user'""",
    ),
    "entities": (
        "questions",
        r"""SELECT *, nullif(regexp_extract(Text, '(?i)(?:^|[^\pL\pN_])(?:po|p\.o\.|purchase\s+order|order|warehouse\s+order)\b[\s#:\-]*([a-zA-Z0-9\-]+)', 1), '') AS PoNumber,
        nullif(regexp_extract(Text, '(?i)(?:^|[^\pL\pN_])(?:isa|isa\s+number|control\s+number|interchange|interchange\s+control\s+number)\b[\s#:\-]*([0-9]{1,9})', 1), '') AS IsaNumber,
        nullif(regexp_extract(Text, '(?i)(?:^|[^\pL\pN_])customer\b[\s#:\-]*([a-zA-Z0-9\-]+)', 1), '') AS Customer,
        nullif(regexp_extract(Text, '(?i)(?:^|[^\pL\pN_-])([\pL\pN_\-]+\.edi)(?:[^\pL\pN_]|$)', 1), '') AS FileName
        FROM questions""",
    ),
    "intents": (
        "entities",
        r"""SELECT *, CASE WHEN wants AND FileName IS NOT NULL THEN 'file_by_name'
          WHEN wants AND regexp_matches(Text, '(?i)\b(error|errors|failed|failure|failures)\b.{0,20}\bfiles?\b|\bfiles?\b.{0,20}\b(error|errors|failed|failure|failures)\b') THEN 'failed_files'
          WHEN wants AND IsaNumber IS NOT NULL THEN 'file_by_isa'
          WHEN IsaNumber IS NOT NULL THEN 'isa_lookup' WHEN PoNumber IS NOT NULL THEN 'po_lookup' ELSE 'unknown' END AS Intent
        FROM (SELECT *, regexp_matches(Text, '(?i)(?:^|[^\pL\pN_])(download|retrieve|copy of|send me|give me|can i get|get me)(?:[^\pL\pN_]|$)') AS wants FROM entities)""",
    ),
    "kb": (
        "",
        """SELECT CAST(r_regionkey AS BIGINT) AS id,
        CASE r_regionkey WHEN 0 THEN 'w01 quantity' WHEN 1 THEN 'Duplicate ISA' WHEN 2 THEN 'Invalid SKU%line'
          WHEN 3 THEN 'quantity is missing' ELSE 'ship-to' END AS pat,
        CASE WHEN r_regionkey <> 1 THEN concat('Explained by ', r_name, '. Call ', r_name, '.')
          ELSE concat('Explained by ', r_name, '.') END AS Note FROM region""",
    ),
    "crs": (
        "",
        """SELECT doc_id + 1 AS CRNumber, doc_id, text, concat('Request ', doc_id) AS Title,
        substr('ABC', CAST(doc_id % 3 AS INTEGER) + 1, 1) AS Tier, n_chars,
        CASE doc_id % 9 WHEN 0 THEN 'Pending Gate 1 review'
          WHEN 1 THEN 'Pending Build Approval -- Gate 1 approved by ann on 2026-07-01 10:00 UTC'
          WHEN 2 THEN 'Pending Build Approval -- previous attempt failed (spent $1.00 of $2.00 budget), retry below'
          WHEN 3 THEN 'Approved (Gate 1) by ann on 2026-07-01 10:00 UTC'
          WHEN 4 THEN 'Implemented -- branch pushed'
          WHEN 5 THEN 'Merged (Gate 2) by ann on 2026-07-02 10:00 UTC'
          WHEN 6 THEN 'Rolled back (Gate 2) by ann on 2026-07-03 10:00 UTC'
          WHEN 7 THEN 'Auto-denied -- Tier C, handle manually'
          ELSE 'Rejected (Gate 1) by ann on 2026-07-01 10:00 UTC' END AS Status,
        CASE WHEN doc_id % 9 = 4 THEN CASE WHEN doc_id % 2 = 0 THEN 'Clean' ELSE 'Conflicts detected -- manual resolution needed' END END AS MergeReadiness,
        CASE WHEN doc_id % 9 IN (4, 5) AND doc_id % 5 <> 0 THEN concat('cr-', doc_id) END AS Branch,
        CASE WHEN doc_id % 9 = 5 AND doc_id % 7 <> 0 THEN concat('c', doc_id) END AS MergeCommit FROM documents""",
    ),
    "feedback": (
        "",
        f"""SELECT doc_id AS FeedbackId, concat('user', doc_id % 50) AS UserOid,
        'support' AS Channel, CASE WHEN doc_id % 3 = 0 THEN 'ai' ELSE 'unknown' END AS Source,
        CASE WHEN doc_id % 19 = 0 THEN '' ELSE concat('Question ', doc_id % 40) END AS QuestionText,
        concat('Reply in ', lang) AS ResponseText,
        CASE WHEN doc_id % 23 = 0 THEN 5 WHEN doc_id % 3 = 0 THEN -1 ELSE 1 END AS Rating,
        nullif(regexp_replace(CASE WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 4 = 1 THEN text ELSE concat(' note ', doc_id) END, '^\\s+|\\s+$', '', 'g'), '') AS Comment,
        TIMESTAMP '2024-01-01 00:00:00' + CAST(doc_id AS INTEGER) * INTERVAL 1 MINUTE AS CreatedDateTime FROM documents""",
    ),
    "goodfeedback": (
        "feedback",
        """SELECT *, sha256(concat(QuestionText, chr(31), ResponseText)) AS MessageHash FROM feedback
        WHERE Rating IN (1, -1) AND QuestionText <> '' AND ResponseText <> '' AND coalesce(length(Comment), 0) <= 1000""",
    ),
    "target": (
        "",
        """SELECT o_orderkey AS OrderID, o_custkey AS CustomerID, strftime(o_orderdate, '%Y-%m-%d') AS OrderDate,
        round(o_totalprice, 2) AS OrderAmount, o_orderstatus AS Status, '2001-01-01 00:00:00' AS CreatedDate,
        '2001-01-01 00:00:00' AS ModifiedDate, 9.5::DOUBLE AS UnitPrice, 'TX' AS ShipToState,
        concat('Customer ', o_custkey) AS CustomerName, concat('SKU', o_orderkey % 100) AS sku,
        o_orderkey % 7 AS quantity FROM orders WHERE o_orderkey % 3 <> 0""",
    ),
    "staged": (
        "",
        """SELECT o_orderkey AS OrderID, o_custkey AS CustomerID, strftime(o_orderdate, '%Y-%m-%d') AS OrderDate,
        round(o_totalprice + v + 1, 2) AS OrderAmount, 'U' AS Status, (8.25 + v)::DOUBLE AS UnitPrice, 'CA' AS ShipToState,
        concat('Customer ', o_custkey) AS CustomerName, concat('SKU', o_orderkey % 100) AS sku,
        o_orderkey % 7 + v AS quantity, CASE WHEN o_orderkey % 14 <> 0 THEN o_orderkey % 3 + v * 3 END AS LoadBatchID, v
        FROM orders, (VALUES (0, 0), (0, 1), (1, 2)) t(v, n)
        WHERE o_orderkey % 2 = 0 AND (n = 0 OR o_orderkey % 10 = 0)""",
    ),
    "user_roles": (
        "",
        "SELECT concat('user', c_custkey) AS u, c_nationkey % 5 AS r FROM customer WHERE c_custkey % 3 = 0",
    ),
    "user_groups": (
        "",
        "SELECT concat('user', c_custkey) AS u, c_custkey % 7 AS g FROM customer WHERE c_custkey % 2 = 0",
    ),
    "group_roles": ("", "SELECT DISTINCT n_nationkey % 6 AS g, n_regionkey AS r FROM nation"),
    "role_permissions": ("", "SELECT DISTINCT s_suppkey % 5 AS r, s_nationkey AS p FROM supplier"),
    "effective": (
        "user_roles user_groups group_roles role_permissions",
        """SELECT DISTINCT x.u AS UserOid, n.n_name AS PermissionName FROM (
          SELECT u, r FROM user_roles UNION SELECT ug.u, gr.r FROM user_groups ug JOIN group_roles gr ON gr.g = ug.g) x
        JOIN role_permissions rp ON rp.r = x.r JOIN nation n ON n.n_nationkey = rp.p""",
    ),
    "days": (
        "",
        """SELECT CAST(o.o_orderdate AS DATE) AS day, count(*) AS orders_shipped,
        sum(coalesce(q, 0)) / 25 AS packer_hours, sum(coalesce(n, 0)) / count(*) AS complexity
        FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY 1) l
        ON l.l_orderkey = o.o_orderkey GROUP BY 1""",
    ),
    "progress": (
        "",
        """SELECT user_id AS CRNumber, ts, event_id,
        CASE event_type WHEN 'view' THEN 'system' WHEN 'purchase' THEN 'result' ELSE 'assistant' END AS kind,
        CASE WHEN event_type = 'purchase' THEN 'success' END AS Subtype,
        CASE WHEN event_id % 3 = 0 THEN concat('s', event_id % 11) END AS SessionId,
        CASE WHEN event_type NOT IN ('view', 'purchase') THEN CAST(json_extract_string(props, '$.k') AS BIGINT) + event_id % 5 ELSE 0 END AS spent,
        CASE WHEN event_id % 4 <> 0 THEN concat('step ', event_id) ELSE '' END AS StatusDetail, value FROM events""",
    ),
}


def with_views(needs: str, body: str) -> str:
    """SQL text with the needed views, each after those it builds on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for inner in VIEWS[name][0].split():
            add(inner)
        if name not in ordered:
            ordered.append(name)

    for name in needs.split():
        add(name)
    recursive = body.startswith("RECURSIVE ")
    body = body.removeprefix("RECURSIVE ")
    parts = [f"{name} AS MATERIALIZED ({VIEWS[name][1]})" for name in ordered]
    if body.startswith("WITH "):
        head, body = body[5:], ""
        parts.append(head)
    if not parts:
        return body
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} {body}"
