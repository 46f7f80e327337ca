"""Queries over questions, feedback, access and change requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaywork.operators import access as Acc
from quaywork.operators import change_requests as H
from quaywork.operators import lookup as L
from quaywork.plans.registry import query


@query("f1_extract_entities", "entities", "SELECT QuestionId, PoNumber, IsaNumber, Customer, FileName FROM entities")
def extract_entities(d):
    return L.extract_entities(d.questions).drop("Text")


@query("f2_classify_intent", "intents", "SELECT QuestionId, Intent FROM intents")
def classify_intent(d):
    return L.classify_intent(d.questions).select("QuestionId", "Intent")


@query(
    "f3_isa_lookup",
    "entities files",
    """SELECT e.QuestionId, e.IsaNumber, f.RawId, f.FileName, f.ISA_ControlNumber, f.ProcessStatus,
       strftime(f.LoadDateTime, '%Y-%m-%d %H:%M:%S') AS LoadDateTime, f.ErrorMessage
       FROM entities e LEFT JOIN files f ON f.RawId = CAST(e.IsaNumber AS BIGINT) WHERE e.IsaNumber IS NOT NULL""",
)
def isa_lookup(d):
    return L.isa_lookup(L.extract_entities(d.questions), d.files)


@query(
    "f4_po_lookup",
    "entities worders",
    """SELECT e.QuestionId, e.PoNumber, CASE WHEN w.id IS NULL THEN 0 ELSE 1 END AS Rank, w.id AS WMSOrderHeaderStagingId, w.IntegrationStatus, w.AttemptCount, w.ErrorMessage,
       CASE WHEN w.id IS NULL THEN concat('I couldn''t find PO/order ', e.PoNumber, ' in the WMS staging queue yet. It may not have been received or parsed.')
       ELSE concat('PO/order ', w.WarehouseOrderNumber, ' is ', CASE w.IntegrationStatus WHEN 'READY' THEN 'parsed and waiting to be sent to WMS'
         WHEN 'SENT' THEN 'sent to WMS and awaiting confirmation' WHEN 'SUCCESS' THEN 'successfully picked up by WMS'
         ELSE concat('picked up by WMS but failed: ', coalesce(w.ErrorMessage, 'no error message recorded')) END,
         ' (attempts: ', w.AttemptCount, ').') END AS Reply
       FROM entities e LEFT JOIN worders w ON upper(w.WarehouseOrderNumber) = upper(e.PoNumber) WHERE e.PoNumber IS NOT NULL""",
)
def po_lookup(d):
    return L.po_lookup(L.extract_entities(d.questions), d.wms_orders)


@query(
    "f5_failed_files",
    "files",
    """SELECT RawId AS rawId, FileName AS fileName, ISASender AS sender, ProcessStatus AS processStatus, ErrorMessage AS errorMessage,
       strftime(LoadDateTime, '%Y-%m-%d %H:%M:%S') AS loadDateTime FROM files
       WHERE ProcessStatus = 'PARSE_FAILED' AND ISASender = 'BUILDING' ORDER BY files.RawId DESC LIMIT 20""",
)
def failed_files(d):
    return L.failed_files(d.files, "building")


@query(
    "f6_resolve_alias",
    "entities",
    """SELECT QuestionId, Customer, coalesce(s, Customer) AS CustomerCode FROM entities
       LEFT JOIN (SELECT DISTINCT c_mktsegment AS s FROM customer) ON upper(Customer) = concat(substr(s, 1, 4), 'S') WHERE Customer IS NOT NULL""",
)
def resolve_alias(d):
    asked = L.extract_entities(d.questions).where(F.col("Customer").isNotNull())
    return L.resolve_alias(asked, d.aliases).select("QuestionId", "Customer", "CustomerCode")


_NOTES = """notes AS (SELECT m.msg, arg_min(k.Note, k.id) AS Note FROM (SELECT DISTINCT ErrorMessage AS msg FROM {t}) m
    JOIN kb k ON m.msg ILIKE concat('%', k.pat, '%') GROUP BY m.msg)"""


@query(
    "f7_explain_error",
    "kb worders",
    "WITH " + _NOTES.format(t="worders")
    + " SELECT id AS WMSOrderHeaderStagingId, ErrorMessage, Note FROM worders LEFT JOIN notes ON msg = ErrorMessage WHERE ErrorMessage IS NOT NULL",
)
def explain_error(d):
    failed = d.wms_orders.where(F.col("ErrorMessage").isNotNull())
    return L.explain_error(failed.select("WMSOrderHeaderStagingId", "ErrorMessage"), d.error_kb)


@query(
    "f8_describe_status",
    "kb files",
    "WITH " + _NOTES.format(t="files")
    + """ SELECT RawId, CASE ProcessStatus
       WHEN 'PARSED' THEN concat('File ', FileName, ' (ISA ', ISA_ControlNumber, ') was received and parsed successfully at ', t, '.')
       WHEN 'PARSE_FAILED' THEN concat('File ', FileName, ' (ISA ', ISA_ControlNumber, ') was received at ', t, ' but failed to parse: ',
         coalesce(ErrorMessage, 'no error message was recorded'), ' (' || Note || ')')
       ELSE concat('File ', FileName, ' (ISA ', ISA_ControlNumber, ') was received at ', t, '. Current status: ', ProcessStatus, '.') END AS Narrative
       FROM (SELECT *, strftime(LoadDateTime, '%Y-%m-%d %H:%M:%S') AS t FROM files) LEFT JOIN notes ON msg = ErrorMessage""",
)
def describe_status(d):
    return L.describe_status(L.explain_error(d.files, d.error_kb)).select("RawId", "Narrative")


@query(
    "f9_failed_downloads",
    "files",
    """SELECT FileName, 'archive' AS Container, FileName AS BlobName FROM (SELECT RawId, FileName FROM files WHERE ProcessStatus = 'PARSE_FAILED'
       ORDER BY RawId DESC LIMIT 5) WHERE RawId % 3 <> 0""",
)
def failed_downloads(d):
    stored = d.files.where("RawId % 3 <> 0").select(
        F.lit("archive").alias("Container"), F.col("FileName").alias("BlobName")
    )
    return L.failed_downloads(d.files, stored)


@query(
    "f10_history_tail",
    "",
    r"""SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS k FROM conversations
       WHERE role IN ('user', 'assistant') AND regexp_matches(text, '\S')) WHERE k <= 5""",
)
def history_tail(d):
    return L.history_tail(d.table("conversations"))


@query(
    "f11_capture_feedback",
    "goodfeedback",
    """SELECT FeedbackId, UserOid, Channel, Source, QuestionText, ResponseText, Rating, Comment, MessageHash FROM goodfeedback""",
)
def capture_feedback(d):
    return L.capture_feedback(d.feedback).drop("CreatedDateTime")


@query(
    "f11_feedback_rejects",
    "feedback",
    """SELECT FeedbackId, CASE WHEN Rating NOT IN (1, -1) THEN 'rating must be 1 (helpful) or -1 (not helpful)'
       WHEN QuestionText = '' THEN 'question and reply are required' ELSE 'comment must be 1000 characters or fewer' END AS Problem
       FROM feedback WHERE Rating NOT IN (1, -1) OR QuestionText = '' OR length(Comment) > 1000""",
)
def feedback_rejects(d):
    return L.feedback_rejects(d.feedback)


@query(
    "f12_negative_feedback_context",
    "goodfeedback",
    """SELECT coalesce(string_agg(line, chr(10) ORDER BY CreatedDateTime DESC), '') AS Context FROM (
       SELECT CreatedDateTime, Comment, concat('- A user disliked a past reply to "', QuestionText, '" because: "', Comment, '"') AS line
       FROM goodfeedback WHERE Rating = -1 ORDER BY CreatedDateTime DESC LIMIT 5) WHERE Comment IS NOT NULL""",
)
def negative_feedback_context(d):
    return L.negative_feedback_context(L.capture_feedback(d.feedback))


@query(
    "f13_repeat_complaints",
    "goodfeedback",
    "SELECT MessageHash, count(*) AS n FROM goodfeedback GROUP BY 1 HAVING count(*) > 1",
)
def repeat_complaints(d):
    return L.repeat_complaints(L.capture_feedback(d.feedback))


@query(
    "f14_rate_limit",
    "",
    """RECURSIVE WITH ev AS (SELECT event_type AS k, ts, event_id FROM events),
       anchors AS (SELECT k, min(ts) AS a FROM ev GROUP BY k
         UNION ALL SELECT n.k, min(e.ts) FROM anchors n JOIN ev e ON e.k = n.k AND e.ts > n.a + INTERVAL 10 HOUR GROUP BY n.k, n.a)
       SELECT k AS Key, event_id AS EventId, row_number() OVER (PARTITION BY k, a ORDER BY ts, event_id) > 20 AS Denied
       FROM (SELECT ev.*, anchors.a FROM ev ASOF JOIN anchors ON anchors.k = ev.k AND anchors.a <= ev.ts)""",
)
def rate_limit(d):
    calls = d.table("events").select(
        F.col("event_type").alias("Key"), F.col("ts").alias("EventTime"), F.col("event_id").alias("EventId")
    )
    return L.rate_limit(calls, seconds=36_000).select("Key", "EventId", "Denied")


@query(
    "f15_search_lines",
    "",
    r"""SELECT Id, LineNo, substr(regexp_replace(line, '^\s+|\s+$', '', 'g'), 1, 200) AS Snippet FROM (
       SELECT Id, unnest(range(1, len(ls) + 1)) AS LineNo, unnest(ls) AS line
       FROM (SELECT doc_id AS Id, regexp_split_to_array(text, '\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]') AS ls FROM documents))
       WHERE contains(lower(line), 'the') ORDER BY Id, LineNo LIMIT 20""",
)
def search_lines(d):
    corpus = d.table("documents").select(F.col("doc_id").alias("Id"), F.col("text").alias("Text"))
    return L.search_lines(corpus, "The")


@query("r1_effective_permissions", "effective", "SELECT UserOid, PermissionName FROM effective")
def effective_permissions(d):
    a = d.access
    return Acc.effective_permissions(
        a["user_roles"], a["user_groups"], a["group_roles"], a["role_permissions"], a["permissions"]
    )


@query(
    "r2_role_matrix",
    "role_permissions",
    "SELECT r_name AS RoleName, n_name AS PermissionName FROM role_permissions JOIN region ON r_regionkey = r JOIN nation ON n_nationkey = p",
)
def role_matrix(d):
    return Acc.role_matrix(d.access["roles"], d.access["role_permissions"], d.access["permissions"])


@query(
    "r3_check_permission",
    "effective",
    """SELECT concat('user', c_custkey) AS UserOid, concat('user', c_custkey) IN (SELECT UserOid FROM effective WHERE PermissionName IN
       (SELECT n_name FROM nation WHERE n_nationkey IN (3, 7))) AS Allowed FROM customer""",
)
def check_permission(d):
    users = d.table("customer").select(F.expr("concat('user', c_custkey) AS UserOid"))
    # The caller names the permissions asked for; here they are looked up by id.
    names = d.access["permissions"].where("PermissionId IN (3, 7)").select("PermissionName").collect()
    return Acc.check_permission(users, effective_permissions(d), [r[0] for r in names])


@query(
    "h1_list_crs",
    "crs",
    "SELECT CRNumber, Title, Tier, Status FROM crs WHERE doc_id % 9 < 5",
)
def list_crs(d):
    return H.list_requests(d.change_requests, "active").select("CRNumber", "Title", "Tier", "Status")


@query(
    "h1_list_closed",
    "crs",
    "SELECT CRNumber, Title, Tier, Status FROM crs WHERE doc_id % 9 > 4",
)
def list_closed(d):
    return H.list_requests(d.change_requests, "closed").select("CRNumber", "Title", "Tier", "Status")


_KEYWORDS = ("license", "secret", "Worthless", "the")


@query(
    "h2_forced_tier",
    "crs",
    """SELECT CRNumber, ForcedKeyword, CASE WHEN ForcedKeyword IS NOT NULL AND Tier <> 'C'
         THEN concat('(force-escalated to Tier C: matched keyword ''', ForcedKeyword, ''')') ELSE '' END AS RiskNotes,
       CASE WHEN ForcedKeyword IS NOT NULL THEN 'C' ELSE Tier END AS Tier,
       CASE WHEN ForcedKeyword IS NOT NULL OR Tier = 'C' THEN 'Auto-denied -- Tier C, handle manually' ELSE 'Pending Gate 1 review' END AS Status
       FROM (SELECT *, CASE WHEN contains(lower(text), 'license') THEN 'license' WHEN contains(lower(text), 'secret') THEN 'secret'
         WHEN contains(lower(text), 'worthless') THEN 'Worthless' WHEN contains(lower(text), 'the') THEN 'the' END AS ForcedKeyword FROM crs)""",
)
def forced_tier(d):
    opened = d.change_requests.withColumn("RiskNotes", F.lit(""))
    return H.force_tier(opened, F.col("OriginalRequest"), _KEYWORDS).select(
        "CRNumber", "ForcedKeyword", "RiskNotes", "Tier", "Status"
    )


@query(
    "h3_cost_ratio",
    "crs",
    """SELECT CRNumber, round(n_chars / 1000000.0 * 6, 6) AS EstimatedCostUsd, round(n_chars / 1000000.0 * 6 / 20 * 100, 6) AS CostRatioPct FROM crs""",
)
def cost_ratio(d):
    return H.cost_ratio(d.change_requests).select(
        "CRNumber",
        F.round("EstimatedCostUsd", 6).alias("EstimatedCostUsd"),
        F.round("CostRatioPct", 6).alias("CostRatioPct"),
    )


@query(
    "h4_assign_numbers",
    "",
    """SELECT doc_id, (SELECT max(doc_id) + 1 FROM documents WHERE doc_id % 2 = 0) + row_number() OVER (ORDER BY doc_id) AS CRNumber
       FROM documents WHERE doc_id % 2 = 1""",
)
def assign_numbers(d):
    documents = d.table("documents").select("doc_id")
    existing = documents.where("doc_id % 2 = 0").select((F.col("doc_id") + 1).alias("CRNumber"))
    return H.assign_numbers(documents.where("doc_id % 2 = 1"), existing, "doc_id").select(
        "doc_id", "CRNumber"
    )


@query(
    "h5_status_badge",
    "crs",
    """SELECT CRNumber, CASE WHEN CRNumber < 1000 THEN concat('CR-', lpad(CAST(CRNumber AS VARCHAR), 3, '0')) ELSE concat('CR-', CRNumber) END AS Code,
       CASE doc_id % 9 WHEN 0 THEN 'neutral' WHEN 1 THEN 'ready' WHEN 2 THEN 'bad' WHEN 3 THEN 'ready' WHEN 4 THEN 'ready' WHEN 5 THEN 'good' ELSE 'bad' END AS Badge,
       CASE Tier WHEN 'A' THEN 'good' WHEN 'B' THEN 'ready' ELSE 'bad' END AS TierBadge,
       doc_id % 9 = 4 AND doc_id % 2 = 1 AS NeedsAttention, doc_id % 9 > 4 AS IsClosed FROM crs""",
)
def status_badge(d):
    return H.with_badges(d.change_requests).select(
        "CRNumber", "Code", "Badge", "TierBadge", "NeedsAttention", "IsClosed"
    )


def _decisions(d):
    actions = F.array(*[F.lit(a) for a in ("approve", "reject", "start-build", "merge", "rollback", "build-failed")])
    return d.table("documents").where("doc_id % 2 = 0").select(
        (F.col("doc_id") + 1).alias("CRNumber"),
        F.get(actions, (F.col("doc_id") % 6).cast("int")).alias("Action"),
        F.col("doc_id").alias("EventId"),
        F.lit("bob").alias("Actor"),
        (F.col("doc_id") % 4 == 0).alias("IsAdmin"),
        F.lit("2026-08-01 09:30:00").cast("timestamp_ntz").alias("EventTime"),
        F.lit(None).cast("string").alias("Detail"),
    )


_DECIDED = """decided AS (SELECT *, CASE
    WHEN action = 'approve' AND doc_id % 9 = 0 THEN 'Pending Build Approval -- Gate 1 approved by bob on 2026-08-01 09:30 UTC'
    WHEN action = 'reject' AND doc_id % 9 = 0 THEN 'Rejected (Gate 1) by bob on 2026-08-01 09:30 UTC'
    WHEN action = 'reject' AND doc_id % 9 IN (1, 2) AND doc_id % 4 = 0 THEN 'Rejected (Pre-Build) by bob on 2026-08-01 09:30 UTC'
    WHEN action = 'start-build' AND doc_id % 9 IN (1, 2) AND doc_id % 4 = 0 THEN 'Approved (Gate 1) by bob on 2026-08-01 09:30 UTC'
    WHEN action = 'merge' AND doc_id % 9 = 4 AND doc_id % 4 = 0 AND Branch IS NOT NULL THEN 'Merged (Gate 2) by bob on 2026-08-01 09:30 UTC'
    WHEN action = 'rollback' AND doc_id % 9 = 5 AND doc_id % 4 = 0 AND MergeCommit IS NOT NULL THEN 'Rolled back (Gate 2) by bob on 2026-08-01 09:30 UTC'
    WHEN action = 'build-failed' AND doc_id % 9 = 3 THEN 'Pending Build Approval -- previous attempt failed (see logs), retry below' END AS next
    FROM (SELECT *, CASE WHEN doc_id % 2 = 0 THEN (['approve', 'reject', 'start-build', 'merge', 'rollback', 'build-failed'])[CAST(doc_id % 6 AS INTEGER) + 1] END AS action FROM crs))"""


@query("h6_transition_cr", "crs", f"WITH {_DECIDED} SELECT CRNumber, coalesce(next, Status) AS Status FROM decided")
def transition_cr(d):
    return H.transition_requests(d.change_requests, _decisions(d)).select("CRNumber", "Status")


@query(
    "h6_transition_rejects",
    "crs",
    f"WITH {_DECIDED} SELECT CRNumber, doc_id AS EventId, action AS Action, concat('not allowed from ''', Status, '''') AS Reason FROM decided WHERE action IS NOT NULL AND next IS NULL",
)
def transition_rejects(d):
    return H.transition_rejects(d.change_requests, _decisions(d))


def _histories(d):
    """Six events for every request, two of them at the same time."""
    actions = F.array(*[F.lit(a) for a in ("approve", "reject", "start-build", "merge", "rollback", "build-failed")])
    events = d.table("documents").select("doc_id", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("k"))
    place = F.expr("cast((doc_id * 7 + k * (2 + doc_id div 9 % 5) + doc_id div 54) % 6 as int)")
    return events.select(
        (F.col("doc_id") + 1).alias("CRNumber"),
        F.col("k").cast("bigint").alias("EventId"),
        F.get(actions, place).alias("Action"),
        F.lit("eve").alias("Actor"),
        ((F.col("doc_id") + F.col("k")) % 3 != 0).alias("IsAdmin"),
        F.expr("timestamp_ntz'2026-08-01 09:30:00' + least(k, 5) * interval '1' minute AS EventTime"),
        F.lit("x").alias("Detail"),
    )


#: One event after another, as the life cycle is told.
_FOLD = """events AS (SELECT doc_id, CAST(k AS INTEGER) AS k, (['approve', 'reject', 'start-build', 'merge', 'rollback', 'build-failed'])
        [CAST((doc_id * 7 + k * (2 + doc_id // 9 % 5) + doc_id // 54) % 6 AS INTEGER) + 1] AS action, (doc_id + k) % 3 <> 0 AS admin,
        concat(' by eve on 2026-08-01 09:', 30 + least(k, 5), ' UTC') AS signed FROM documents, range(1, 7) r(k)),
    fold AS (SELECT doc_id, CRNumber, Branch, MergeCommit, 0 AS k, '' AS action, Status AS met, NULL::VARCHAR AS next, Status FROM crs
      UNION ALL SELECT doc_id, CRNumber, Branch, MergeCommit, k, action, met, next, coalesce(next, met) FROM (
        SELECT f.doc_id, CRNumber, Branch, MergeCommit, e.k, e.action, f.Status AS met, CASE
          WHEN e.action = 'approve' AND f.Status = 'Pending Gate 1 review' THEN 'Pending Build Approval -- Gate 1 approved' || signed
          WHEN e.action = 'reject' AND f.Status = 'Pending Gate 1 review' THEN 'Rejected (Gate 1)' || signed
          WHEN e.action = 'reject' AND f.Status LIKE 'Pending Build Approval%' AND admin THEN 'Rejected (Pre-Build)' || signed
          WHEN e.action = 'start-build' AND f.Status LIKE 'Pending Build Approval%' AND admin THEN 'Approved (Gate 1)' || signed
          WHEN e.action = 'build-failed' AND f.Status LIKE 'Approved%' THEN 'Pending Build Approval -- previous attempt failed (x), retry below'
          WHEN e.action = 'merge' AND f.Status LIKE 'Implemented%' AND admin AND Branch IS NOT NULL THEN 'Merged (Gate 2)' || signed
          WHEN e.action = 'rollback' AND f.Status LIKE 'Merged%' AND admin AND MergeCommit IS NOT NULL THEN 'Rolled back (Gate 2)' || signed
          END AS next FROM fold f JOIN events e ON e.doc_id = f.doc_id AND e.k = f.k + 1))"""


@query("h6_history", "crs", "RECURSIVE WITH " + _FOLD + " SELECT CRNumber, Status FROM fold WHERE k = 6")
def request_history(d):
    return H.transition_requests(d.change_requests, _histories(d)).select("CRNumber", "Status")


@query(
    "h6_history_rejects",
    "crs",
    "RECURSIVE WITH " + _FOLD
    + " SELECT CRNumber, CAST(k AS BIGINT) AS EventId, action AS Action, concat('not allowed from ''', met, '''') AS Reason"
    " FROM fold WHERE k > 0 AND next IS NULL",
)
def request_history_rejects(d):
    return H.transition_rejects(d.change_requests, _histories(d))


@query(
    "h7_progress_fold",
    "progress",
    """SELECT CRNumber, arg_max(SessionId, ts) FILTER (SessionId IS NOT NULL) AS SessionId, CAST(sum(spent) AS BIGINT) AS TokensSoFar,
       arg_max(StatusDetail, ts) FILTER (kind = 'system') AS LastAction, arg_max(value, ts) FILTER (kind = 'result') AS CostUsd,
       arg_max(Subtype, ts) FILTER (kind = 'result') AS ResultSubtype, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS UpdatedDateTime FROM progress GROUP BY 1""",
)
def progress_fold(d):
    return H.progress_fold(d.progress_events)


@query(
    "h7_progress_trail",
    "progress",
    """SELECT CRNumber, event_id AS EventId, CAST(sum(spent) OVER (PARTITION BY CRNumber ORDER BY ts, event_id) AS BIGINT) AS TokensSoFar FROM progress""",
)
def progress_trail(d):
    return H.progress_trail(d.progress_events).select("CRNumber", "EventId", "TokensSoFar")


def _replies(d):
    """Model replies around documents: valid, incomplete, broken and bare."""
    return d.table("documents").select(
        "doc_id",
        F.expr(
            """concat(text, CASE doc_id % 6
               WHEN 0 THEN concat('\n```json\n{"title": "t', doc_id, '", "tier": "A", "risk_notes": "", "requirements": ["x"], "touch_points": [], "out_of_scope": [], "estimated_tokens": ', n_chars, '}\n```\nend')
               WHEN 1 THEN '\n```json {"title": "only", "tier": "D", "estimated_tokens": 0} ```'
               WHEN 2 THEN '\n```json {"title": 5, "tier": "B", "risk_notes": [], "requirements": "x", "touch_points": {}, "out_of_scope": null, "estimated_tokens": "9"} ```'
               WHEN 3 THEN '\n```json {broken} ```'
               WHEN 4 THEN '\n{"title": "no fence"}'
               ELSE '' END) AS Text"""
        ),
    )


@query(
    "h8_extract_json_block",
    "",
    """SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN concat('t', doc_id) WHEN 1 THEN 'only' WHEN 2 THEN '5' END AS title,
       CASE doc_id % 6 WHEN 0 THEN 'A' WHEN 1 THEN 'D' WHEN 2 THEN 'B' END AS tier, doc_id % 6 < 3 AS found FROM documents""",
)
def extract_json_block(d):
    blocks = H.extract_json_block(_replies(d))
    return blocks.select(
        "doc_id",
        F.get_json_object("JsonText", "$.title").alias("title"),
        F.get_json_object("JsonText", "$.tier").alias("tier"),
        F.col("JsonText").isNotNull().alias("found"),
    )


@query(
    "h9_validate_record",
    "",
    """SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN '' WHEN 1 THEN
       'missing key: risk_notes|missing key: requirements|missing key: touch_points|missing key: out_of_scope|tier: expected one of A/B/C, got ''D''|estimated_tokens: expected a realistic non-zero estimate, got <= 0'
       ELSE 'title: expected str, got int|risk_notes: expected str, got list|requirements: expected list, got str|touch_points: expected list, got dict|out_of_scope: expected list, got NoneType|estimated_tokens: expected int, got str' END AS problems
       FROM documents WHERE doc_id % 6 < 3""",
)
def validate_record(d):
    blocks = H.extract_json_block(_replies(d)).where(F.col("JsonText").isNotNull())
    return H.validate_record(blocks).select("doc_id", F.array_join("Problems", "|").alias("problems"))


@query(
    "h10_transcript_pairs",
    "",
    """SELECT a.conv_id, a.turn, regexp_replace(a.text, '^\\s+|\\s+$', '', 'g') AS Question, b.text AS Answer FROM conversations a JOIN conversations b
       ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 WHERE a.turn % 2 = 1""",
)
def transcript_pairs(d):
    # Half of the questions carry the prompt marker.
    turns = d.table("conversations").withColumn(
        "text",
        F.when(
            (F.col("turn") % 4 == 1), F.concat(F.lit("QUESTION: "), F.trim("text"))
        ).otherwise(F.col("text")),
    )
    return H.transcript_pairs(turns)


@query(
    "h11_score_runs",
    "",
    """SELECT strftime(date_trunc('day', TIMESTAMP '2026-01-01' + CAST(d.doc_id % 3 AS INTEGER) * INTERVAL 1 DAY), '%Y-%m-%d %H:%M:%S') AS run_date, 2048 AS context_length,
       d.lang AS prompt_variant, CASE WHEN d.doc_id % 2 = 0 THEN 'synthetic' ELSE 'held_out' END AS case_set, count(*) AS cases,
       CAST(sum(l.quality) AS BIGINT) AS tier_matches, CAST(sum(1 - l.toxic) AS BIGINT) AS schema_valid_cases, round(avg(d.n_chars), 6) AS avg_latency_sec
       FROM labels l JOIN documents d ON d.doc_id = l.doc_id GROUP BY ALL""",
)
def score_runs(d):
    scored = d.table("labels").join(d.table("documents").select("doc_id", "lang", "n_chars"), "doc_id")
    results = scored.select(
        F.expr("timestamp_ntz'2026-01-01 00:00:00' + cast(doc_id % 3 as int) * interval '1' day AS run_date"),
        F.lit(2048).alias("context_length"),
        F.col("lang").alias("prompt_variant"),
        F.expr("CASE WHEN doc_id % 2 = 0 THEN 'synthetic' ELSE 'held_out' END AS case_set"),
        (F.col("quality") == 1).alias("tier_match"),
        (F.col("toxic") == 0).alias("schema_valid"),
        F.col("n_chars").cast("double").alias("latency_sec"),
    )
    return H.score_runs(results).withColumn("avg_latency_sec", F.round("avg_latency_sec", 6))


@query(
    "h12_mapping_conflicts",
    "",
    """SELECT source AS Customer, lang AS TargetColumn, count(*) AS rows, count(DISTINCT doc_id % 4) AS sources,
       CASE WHEN count(DISTINCT doc_id % 4) > 1 THEN 'conflict' ELSE 'duplicate' END AS Kind
       FROM documents GROUP BY 1, 2 HAVING count(*) > 1""",
)
def mapping_conflicts(d):
    mappings = d.table("documents").select(
        F.col("source").alias("Customer"),
        F.concat(F.lit("c"), (F.col("doc_id") % 4).cast("string")).alias("SourceColumn"),
        F.col("lang").alias("TargetColumn"),
    )
    return H.mapping_conflicts(mappings)
