"""Change-request records: listing, tiering, costs, life cycle and intake data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaywork.functions.columns import join_text, minute_index, strip
from quaywork.functions.skew import globally_numbered, latest_before, running_sum

# Status texts, prefixes and the cost defaults.
PENDING = "Pending Gate 1 review"
PENDING_BUILD = "Pending Build Approval"
AUTO_DENIED = "Auto-denied -- Tier C, handle manually"
CLOSED_PREFIXES = ("Merged", "Closed", "Auto-denied", "Rolled back", "Rejected")
RATE_PER_MILLION = 6.0
MONTHLY_BUDGET = 20.0
JSON_FENCE = r"(?s)```json\s*(\{.*?\})\s*```"
INTAKE_SCHEMA = (
    "title string, tier string, risk_notes string, requirements array<string>, "
    "touch_points array<string>, out_of_scope array<string>, estimated_tokens bigint"
)
# Required intake keys with the type name a problem report uses.
REQUIRED_KEYS = {
    "title": "str",
    "tier": "str",
    "risk_notes": "str",
    "requirements": "list",
    "touch_points": "list",
    "out_of_scope": "list",
    "estimated_tokens": "int",
}
QUESTION_MARK = "QUESTION:"


def _starts_with_any(status: Column, prefixes: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [status.startswith(p) for p in prefixes])


def is_closed(status: Column) -> Column:
    return _starts_with_any(status, CLOSED_PREFIXES)


def list_requests(requests: DataFrame, group: str | None = None) -> DataFrame:
    """All, ``closed`` or ``active`` requests; callers sort newest first."""
    closed = is_closed(F.col("Status"))
    if group == "closed":
        return requests.where(closed)
    if group == "active":
        return requests.where(~closed)
    return requests


def first_keyword(text: Column, keywords: Sequence[str]) -> Column:
    """First keyword, in list order, that the text contains in any case."""
    lowered = F.lower(text)
    found = F.lit(None).cast("string")
    for keyword in reversed(keywords):
        found = F.when(lowered.contains(keyword.lower()), F.lit(keyword)).otherwise(found)
    return found


def force_tier(requests: DataFrame, text: Column, keywords: Sequence[str]) -> DataFrame:
    """Escalate to tier C on a keyword, note it, and set the opening status."""
    keyword = F.col("ForcedKeyword")
    escalated = keyword.isNotNull() & (F.col("Tier") != "C")
    note = strip(
        join_text(
            F.col("RiskNotes"), " (force-escalated to Tier C: matched keyword '", keyword, "')"
        )
    )
    return (
        requests.withColumn("ForcedKeyword", first_keyword(text, keywords))
        .withColumn("RiskNotes", F.when(escalated, note).otherwise(F.col("RiskNotes")))
        .withColumn("Tier", F.when(escalated, "C").otherwise(F.col("Tier")))
        .withColumn("Status", F.when(F.col("Tier") == "C", AUTO_DENIED).otherwise(PENDING))
    )


def cost_ratio(
    requests: DataFrame, rate: float = RATE_PER_MILLION, budget: float = MONTHLY_BUDGET
) -> DataFrame:
    dollars = F.coalesce(F.col("EstimatedTokens"), F.lit(0)) / F.lit(1_000_000.0) * F.lit(rate)
    return requests.withColumn("EstimatedCostUsd", dollars).withColumn(
        "CostRatioPct", F.col("EstimatedCostUsd") / F.lit(budget) * 100
    )


def assign_numbers(new: DataFrame, existing: DataFrame, order: str) -> DataFrame:
    """Number a new batch without gaps, after the highest existing number.

    ``order`` is a unique column.  The batch is numbered by a prefix sum over
    its ranges, so no task sees all of it, however sparse the values are.
    """
    top = existing.agg(F.coalesce(F.max("CRNumber"), F.lit(0)).alias("top")).first()["top"]
    return globally_numbered(new, [F.col(order)], "CRNumber", int(top))


def status_badge(status: Column) -> Column:
    return (
        F.when(status == PENDING, "neutral")
        .when(status.startswith("Merged"), "good")
        .when(
            status.startswith(PENDING_BUILD),
            F.when(status.contains("previous attempt failed"), "bad").otherwise("ready"),
        )
        .when(_starts_with_any(status, ("Approved", "Implemented")), "ready")
        .when(_starts_with_any(status, ("Rejected", "Auto-denied", "Rolled back")), "bad")
        .otherwise("neutral")
    )


def tier_badge(tier: Column) -> Column:
    return F.when(tier == "A", "good").when(tier == "B", "ready").otherwise("bad")


def request_code(number: Column) -> Column:
    digits = number.cast("string")
    return F.concat(
        F.lit("CR-"), F.when(F.length(digits) < 3, F.lpad(digits, 3, "0")).otherwise(digits)
    )


def with_badges(requests: DataFrame) -> DataFrame:
    attention = F.col("Status").startswith("Implemented") & F.coalesce(
        F.col("MergeReadiness").startswith("Conflicts"), F.lit(False)
    )
    return requests.withColumns(
        {
            "Code": request_code(F.col("CRNumber")),
            "Badge": status_badge(F.col("Status")),
            "TierBadge": tier_badge(F.col("Tier")),
            "NeedsAttention": attention,
            "IsClosed": is_closed(F.col("Status")),
        }
    )


def _folded(requests: DataFrame, events: DataFrame) -> DataFrame:
    """Every event of a known request with ``_new``, the status it sets or NULL, and ``_old``, the one it meets.

    Events take effect in the order of time and id.  No history is gathered,
    since little of it matters: the first decision at gate 1 counts; while a
    build is pending or running, the kind of the last start or failure says
    which, applied or not; the first rejection that meets a pending build ends
    it; the first merge and the first rollback after it count.  Starting,
    merging, rolling back and late rejection are for administrators.
    """
    status, action, at = F.col("_status"), F.col("Action"), F.struct("EventTime", "EventId")
    admin = F.coalesce(F.col("IsAdmin"), F.lit(False))
    stage = (
        F.when(status == PENDING, "gate 1")
        .when(status.startswith(PENDING_BUILD), "waiting")
        .when(status.startswith("Approved"), "building")
        .when(status.startswith("Implemented"), "built")
        .when(status.startswith("Merged"), "merged")
        .otherwise("closed")
    )
    known = requests.select("CRNumber", F.col("Status").alias("_status"), "Branch", "MergeCommit")
    joined = events.join(known, "CRNumber").withColumn("_stage", stage).withColumn("_at", at)
    decision = (F.col("_stage") == "gate 1") & action.isin("approve", "reject")
    merge = (F.col("_stage") == "built") & (action == "merge") & admin & (F.col("Branch") != "")
    firsts = joined.groupBy("CRNumber").agg(
        F.min(F.when(decision, F.struct("_at", "Action"))).alias("_gate"),
        F.min(F.when(merge, F.col("_at"))).alias("_merged"),
    )
    opened = (F.col("_gate.Action") == "approve") & (F.col("_at") > F.col("_gate._at"))
    marked = joined.join(firsts, "CRNumber").withColumn(
        "_in_build", F.col("_stage").isin("waiting", "building") | F.coalesce(opened, F.lit(False))
    )
    turn = F.when(F.col("_in_build") & admin & (action == "start-build"), "building").when(
        F.col("_in_build") & (action == "build-failed"), "waiting"
    )
    order, slices = [F.col("EventTime"), F.col("EventId")], minute_index(F.col("EventTime"))
    turned = latest_before(marked, ["CRNumber"], order, slices, turn, "_turn")
    building = F.coalesce("_turn", F.when(F.col("_stage") == "building", "building"), F.lit("waiting")) == "building"
    back = (action == "rollback") & admin & (F.col("MergeCommit") != "")
    after_merge = (F.col("_stage") == "merged") | (F.col("_at") > F.col("_merged"))
    ends = turned.groupBy("CRNumber").agg(
        F.min(F.when(F.col("_in_build") & admin & (action == "reject") & ~building, F.col("_at"))).alias("_ended"),
        F.min(F.when(back & after_merge, F.col("_at"))).alias("_undone"),
    )
    stamp = F.substring(F.col("EventTime").cast("string"), 1, 16)
    signed = F.concat(F.lit(" by "), "Actor", F.lit(" on "), stamp, F.lit(" UTC"))
    open_build = F.col("_in_build") & (F.col("_ended").isNull() | (F.col("_at") < F.col("_ended")))
    first_decision = decision & (F.col("_at") == F.col("_gate._at"))
    new = (
        F.when(
            first_decision & (action == "approve"),
            F.concat(F.lit(f"{PENDING_BUILD} -- Gate 1 approved"), signed),
        )
        .when(first_decision, F.concat(F.lit("Rejected (Gate 1)"), signed))
        .when(F.col("_at") == F.col("_ended"), F.concat(F.lit("Rejected (Pre-Build)"), signed))
        .when(
            open_build & admin & (action == "start-build") & ~building,
            F.concat(F.lit("Approved (Gate 1)"), signed),
        )
        .when(
            open_build & (action == "build-failed") & building,
            F.concat(
                F.lit(f"{PENDING_BUILD} -- previous attempt failed ("),
                F.coalesce("Detail", F.lit("see logs")),
                F.lit("), retry below"),
            ),
        )
        .when(F.col("_at") == F.col("_merged"), F.concat(F.lit("Merged (Gate 2)"), signed))
        .when(F.col("_at") == F.col("_undone"), F.concat(F.lit("Rolled back (Gate 2)"), signed))
    )
    decided = turned.join(ends, "CRNumber").withColumn("_new", new)
    met = latest_before(decided, ["CRNumber"], order, slices, F.col("_new"), "_last")
    return met.withColumn("_old", F.coalesce("_last", "_status"))


def transition_requests(requests: DataFrame, events: DataFrame) -> DataFrame:
    """Snapshot after a batch of events, one row a request; illegal events change nothing.

    ``events``: CRNumber, EventId (unique in a request), EventTime, Action,
    Actor, IsAdmin, Detail.
    """
    applied = _folded(requests, events).where(F.col("_new").isNotNull())
    last = applied.groupBy("CRNumber").agg(F.max_by("_new", "_at").alias("_new"))
    return (
        requests.join(last, "CRNumber", "left")
        .withColumn("Status", F.coalesce("_new", "Status"))
        .select(*requests.columns)
    )


def transition_rejects(requests: DataFrame, events: DataFrame) -> DataFrame:
    """Every event that was refused, with the status that refused it."""
    refused = _folded(requests, events).where(F.col("_new").isNull())
    unknown = events.join(requests.select("CRNumber"), "CRNumber", "left_anti")
    return refused.select(
        "CRNumber", "EventId", "Action", join_text("not allowed from '", F.col("_old"), "'").alias("Reason")
    ).unionAll(unknown.select("CRNumber", "EventId", "Action", F.lit("unknown request").alias("Reason")))


def progress_fold(events: DataFrame) -> DataFrame:
    """Latest progress of each build, as partial aggregates only."""
    at = F.struct("EventTime", "EventId")
    is_result = F.col("EventType") == "result"
    is_summary = (F.col("EventType") == "system") & (F.col("Subtype") == "post_turn_summary")
    spent = F.coalesce("InputTokens", F.lit(0)) + F.coalesce("OutputTokens", F.lit(0))
    return events.groupBy("CRNumber").agg(
        F.max_by("SessionId", F.when(F.col("SessionId").isNotNull(), at)).alias("SessionId"),
        F.coalesce(
            F.sum(F.when(F.col("EventType") == "assistant", spent)), F.lit(0)
        ).cast("bigint").alias("TokensSoFar"),
        F.max_by(F.coalesce("StatusDetail", F.lit("")), F.when(is_summary, at)).alias("LastAction"),
        F.max_by("TotalCostUsd", F.when(is_result, at)).alias("CostUsd"),
        F.max_by("Subtype", F.when(is_result, at)).alias("ResultSubtype"),
        F.max("EventTime").alias("UpdatedDateTime"),
    )


def progress_trail(events: DataFrame) -> DataFrame:
    """Running token count after each event."""
    spent = F.when(
        F.col("EventType") == "assistant",
        F.coalesce("InputTokens", F.lit(0)) + F.coalesce("OutputTokens", F.lit(0)),
    ).otherwise(F.lit(0))
    return running_sum(
        events.select("CRNumber", "EventTime", "EventId", spent.cast("bigint").alias("_spent")),
        ["CRNumber"],
        [F.col("EventTime"), F.col("EventId")],
        minute_index(F.col("EventTime")),
        F.col("_spent"),
        "TokensSoFar",
    ).drop("_spent")


def extract_json_block(replies: DataFrame, column: str = "Text") -> DataFrame:
    """Adds ``JsonText`` (first fenced block or NULL) and its typed ``Record``."""
    block = F.when(F.col(column).rlike(JSON_FENCE), F.regexp_extract(column, JSON_FENCE, 1))
    valid = F.when(F.get_json_object(block, "$").isNotNull(), block)
    return replies.withColumn("JsonText", valid).withColumn(
        "Record", F.from_json("JsonText", INTAKE_SCHEMA)
    )


#: Kinds of JSON values as the messages name them.  Fixed values.
VALUE_KINDS = {"string": "str", "array": "list", "object": "dict", "boolean": "bool", "null": "NoneType"}


def _value_kind(document: Column, key: str) -> Column:
    raw = F.schema_of_variant(F.variant_get(document, f"$.{key}", "variant"))
    lowered = F.lower(F.coalesce(raw, F.lit("void")))
    return (
        F.when(lowered.startswith("array"), VALUE_KINDS["array"])
        .when(lowered.startswith("object"), VALUE_KINDS["object"])
        .when(lowered == "string", VALUE_KINDS["string"])
        .when(lowered == "boolean", VALUE_KINDS["boolean"])
        .when((lowered == "bigint") | lowered.rlike(r"^decimal\([0-9]+,0\)$"), "int")
        .when(lowered == "void", VALUE_KINDS["null"])
        .otherwise("float")
    )


def validate_record(replies: DataFrame, column: str = "JsonText") -> DataFrame:
    """Adds ``Problems``, the list of schema problems of a JSON record text.

    Strings and containers lose their kind as map values, so kinds are read
    from the text through the variant parser.  The text is parsed once for the
    map and once for the variant; kinds are columns before messages use them.
    """
    parsed = replies.withColumn("_fields", F.from_json(column, "map<string,string>")).withColumn(
        "_document", F.try_parse_json(column)
    )
    wanted_keys = dict.fromkeys([*REQUIRED_KEYS, "tier", "estimated_tokens"])
    kinds = F.struct(*[_value_kind(F.col("_document"), key).alias(key) for key in wanted_keys])
    known = parsed.withColumn("_kinds", kinds).withColumn("_keys", F.map_keys("_fields"))

    def kind(key: str) -> Column:
        return F.col(f"_kinds.{key}")

    problems = []
    for key, wanted in REQUIRED_KEYS.items():
        accepted = ("int", "bool") if wanted == "int" else (wanted,)
        problems.append(
            F.when(~F.array_contains("_keys", key), f"missing key: {key}").when(
                ~kind(key).isin(*accepted), F.concat(F.lit(f"{key}: expected {wanted}, got "), kind(key))
            )
        )
    tier = F.try_element_at("_fields", F.lit("tier"))
    problems.append(
        F.when(
            F.array_contains("_keys", "tier") & ~F.coalesce(tier.isin("A", "B", "C"), F.lit(False)),
            F.concat(
                F.lit("tier: expected one of A/B/C, got "),
                F.when(kind("tier") == "str", F.concat(F.lit("'"), tier, F.lit("'"))).otherwise(
                    F.coalesce(tier, F.lit("None"))
                ),
            ),
        )
    )
    tokens = F.try_element_at("_fields", F.lit("estimated_tokens"))
    number = F.when(tokens == "false", 0).otherwise(tokens.try_cast("decimal(38,0)"))
    problems.append(
        F.when(
            kind("estimated_tokens").isin("int", "bool") & (number <= 0),
            "estimated_tokens: expected a realistic non-zero estimate, got <= 0",
        )
    )
    found = F.filter(F.array(*problems), lambda p: p.isNotNull())
    return known.withColumn("Problems", found).drop("_fields", "_document", "_kinds", "_keys")


def transcript_pairs(turns: DataFrame) -> DataFrame:
    """Clarifying question and answer pairs of (conv_id, turn, text).

    Turns are numbered from 0; turn 0 is the request, every odd turn asks and
    the next one answers, so the pairing is an equi-join.
    """
    asked = turns.where(F.col("turn") % 2 == 1).select(
        "conv_id", "turn", strip(F.col("text")).alias("_q")
    )
    answered = turns.where((F.col("turn") > 0) & (F.col("turn") % 2 == 0)).select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("Answer")
    )
    question = F.when(
        F.col("_q").startswith(QUESTION_MARK),
        strip(F.substring(F.col("_q"), len(QUESTION_MARK) + 1, 1 << 30)),
    ).otherwise(F.col("_q"))
    return asked.join(answered, ["conv_id", "turn"]).select(
        "conv_id", "turn", question.alias("Question"), "Answer"
    )


def score_runs(results: DataFrame) -> DataFrame:
    """Quality per run, prompt variant and case set."""
    return results.groupBy("run_date", "context_length", "prompt_variant", "case_set").agg(
        F.count(F.lit(1)).alias("cases"),
        F.sum(F.col("tier_match").cast("int")).alias("tier_matches"),
        F.sum(F.col("schema_valid").cast("int")).alias("schema_valid_cases"),
        F.avg("latency_sec").alias("avg_latency_sec"),
    )


def mapping_conflicts(mappings: DataFrame) -> DataFrame:
    """Targets a customer's mapping fills more than once."""
    return (
        mappings.groupBy("Customer", "SourceColumn", "TargetColumn")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("Customer", "TargetColumn")
        .agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("sources"))
        .where(F.col("rows") > 1)
        .withColumn("Kind", F.when(F.col("sources") > 1, "conflict").otherwise("duplicate"))
    )


def apply_mapping(rows: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return rows.select(*[F.col(source).alias(target) for source, target in mapping.items()])
