"""Question answering as batch joins over a table of questions.

A question is matched by patterns first; the files, orders and error notes it
asks for are then joined for all questions at once.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quaywork.functions.columns import (
    ci_key,
    first_where,
    join_text,
    micros,
    strip,
    timestamp_text,
)
from quaywork.functions.skew import BROADCAST_ROWS, latest_before, numbered
from quaywork.session import scratch_path

# The question patterns.  (?U) makes word boundaries Unicode-aware.
PO_PATTERN = (
    r"(?iU)\b(?:po|p\.o\.|purchase\s+order|order|warehouse\s+order)\b[\s#:\-]*([a-zA-Z0-9\-]+)"
)
ISA_PATTERN = (
    r"(?iU)\b(?:isa|isa\s+number|control\s+number|interchange|interchange\s+control\s+number)\b"
    r"[\s#:\-]*([0-9]{1,9})"
)
CUSTOMER_PATTERN = r"(?iU)\bcustomer\b[\s#:\-]*([a-zA-Z0-9\-]+)"
FILE_REQUEST_PATTERN = r"(?iU)\b(download|retrieve|copy of|send me|give me|can i get|get me)\b"
FILENAME_PATTERN = r"(?iU)\b([\w\-]+\.edi)\b"
ERROR_FILES_PATTERN = (
    r"(?iU)\b(error|errors|failed|failure|failures)\b.{0,20}\bfiles?\b"
    r"|\bfiles?\b.{0,20}\b(error|errors|failed|failure|failures)\b"
)
# Status phrases and reply texts.
STATUS_TEXT = {
    "READY": "parsed and waiting to be sent to WMS",
    "SENT": "sent to WMS and awaiting confirmation",
    "SUCCESS": "successfully picked up by WMS",
}
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
COMMENT_LIMIT = 1000
RATE_WINDOW_SECONDS = 3600
RATE_LIMIT = 20
#: Times that share a slice where a key is cut.
SLICE_MICROS = 60_000_000
#: Distinct times of one key that are walked along in one row.
FOLDED_TIMES = 50_000


def _found(text: Column, pattern: str) -> Column:
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1))


def extract_entities(questions: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("Text"), F.lit(""))
    return questions.withColumns(
        {
            "PoNumber": _found(text, PO_PATTERN),
            "IsaNumber": _found(text, ISA_PATTERN),
            "Customer": _found(text, CUSTOMER_PATTERN),
            "FileName": _found(text, FILENAME_PATTERN),
        }
    )


def classify_intent(questions: DataFrame) -> DataFrame:
    """Entities plus the intent; a file request without a target falls through."""
    text = F.coalesce(F.col("Text"), F.lit(""))
    wants_file = text.rlike(FILE_REQUEST_PATTERN)
    intent = (
        F.when(wants_file & F.col("FileName").isNotNull(), "file_by_name")
        .when(wants_file & text.rlike(ERROR_FILES_PATTERN), "failed_files")
        .when(wants_file & F.col("IsaNumber").isNotNull(), "file_by_isa")
        .when(F.col("IsaNumber").isNotNull(), "isa_lookup")
        .when(F.col("PoNumber").isNotNull(), "po_lookup")
        .otherwise("unknown")
    )
    return extract_entities(questions).withColumn("Intent", intent)


def isa_key(number: Column) -> Column:
    """Control number without leading zeros; all zeros is ``0``."""
    stripped = F.ltrim(F.trim(number), F.lit("0"))
    return F.when(number.isNotNull(), F.when(stripped == "", "0").otherwise(stripped))


def control_number_of(text: Column) -> Column:
    """ISA.13 read from raw interchange text."""
    segments = F.split(F.translate(text, "\r\n", ""), "~", -1)
    isa = first_where(
        F.transform(segments, lambda s: F.split(strip(s), r"\*", -1)),
        lambda e: (F.upper(strip(F.get(e, F.lit(0)))) == "ISA") & (F.size(e) > 13),
    )
    return strip(F.get(isa, F.lit(13)))


def isa_lookup(questions: DataFrame, files: DataFrame) -> DataFrame:
    """Newest file per asked control number; questions without a match stay."""
    asked = questions.where(F.col("IsaNumber").isNotNull()).withColumn(
        "_key", isa_key(F.col("IsaNumber"))
    )
    newest = (
        files.withColumn("_key", isa_key(F.col("ISA_ControlNumber")))
        .where(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(
            F.max_by(
                F.struct(
                    "RawId",
                    F.col("FileName").alias("FileName"),
                    "ISA_ControlNumber",
                    "ProcessStatus",
                    "LoadDateTime",
                    "ErrorMessage",
                ),
                "RawId",
            ).alias("_file")
        )
    )
    return asked.join(newest, "_key", "left").select(
        "QuestionId",
        "IsaNumber",
        F.col("_file.RawId").alias("RawId"),
        F.col("_file.FileName").alias("FileName"),
        F.col("_file.ISA_ControlNumber").alias("ISA_ControlNumber"),
        F.col("_file.ProcessStatus").alias("ProcessStatus"),
        F.col("_file.LoadDateTime").alias("LoadDateTime"),
        F.col("_file.ErrorMessage").alias("ErrorMessage"),
    )


def order_status_text(status: Column, error: Column) -> Column:
    text = F.when(
        status == "FAILED",
        join_text(
            "picked up by WMS but failed: ",
            F.coalesce(F.nullif(error, F.lit("")), F.lit("no error message recorded")),
        ),
    )
    for name, phrase in STATUS_TEXT.items():
        text = text.when(status == name, phrase)
    return text.otherwise(join_text("in status ", F.coalesce(status, F.lit("UNKNOWN"))))


def po_lookup(questions: DataFrame, orders: DataFrame, per_question: int = 5) -> DataFrame:
    """Up to five orders per asked number with the reply sentence on each."""
    wanted = questions.where(F.col("PoNumber").isNotNull()).select("QuestionId", "PoNumber")
    ranking = W.partitionBy("_po").orderBy("WMSOrderHeaderStagingId")
    # Ranked per number before the join, so repeated questions share the work.
    candidates = (
        orders.select(
            ci_key(F.col("WarehouseOrderNumber")).alias("_po"),
            "WMSOrderHeaderStagingId",
            "WarehouseOrderNumber",
            "IntegrationStatus",
            "AttemptCount",
            "ErrorMessage",
        )
        .withColumn("Rank", F.row_number().over(ranking))
        .where(F.col("Rank") <= per_question)
    )
    matched = wanted.withColumn("_po", ci_key(F.col("PoNumber"))).join(candidates, "_po", "left")
    reply = F.when(
        F.col("WMSOrderHeaderStagingId").isNull(),
        join_text(
            "I couldn't find PO/order ",
            F.col("PoNumber"),
            " in the WMS staging queue yet. It may not have been received or parsed.",
        ),
    ).otherwise(
        join_text(
            "PO/order ",
            F.col("WarehouseOrderNumber"),
            " is ",
            order_status_text(F.col("IntegrationStatus"), F.col("ErrorMessage")),
            " (attempts: ",
            F.coalesce("AttemptCount", F.lit(0)),
            ").",
        )
    )
    return matched.select(
        "QuestionId",
        "PoNumber",
        F.coalesce("Rank", F.lit(0)).alias("Rank"),
        "WMSOrderHeaderStagingId",
        "IntegrationStatus",
        "AttemptCount",
        "ErrorMessage",
        reply.alias("Reply"),
    )


def resolve_alias(terms: DataFrame, aliases: DataFrame, column: str = "Customer") -> DataFrame:
    """Adds ``CustomerCode``: the code of a known alias, else the term as typed."""
    known = aliases.groupBy(ci_key(F.trim("Alias")).alias("_alias")).agg(
        F.min_by("CustomerCode", "AliasId").alias("_code")
    )
    return (
        terms.withColumn("_alias", ci_key(strip(F.col(column))))
        .join(known, "_alias", "left")
        .withColumn("CustomerCode", F.coalesce("_code", column))
        .drop("_alias", "_code")
    )


def failed_files(files: DataFrame, customer: str | None = None, n: int = 20) -> DataFrame:
    failed = files.where(F.col("ProcessStatus") == "PARSE_FAILED")
    if customer:
        failed = failed.where(ci_key(F.col("ISASender")) == ci_key(F.lit(customer)))
    return (
        failed.orderBy(F.col("RawId").desc())
        .limit(n)
        .select(
            F.col("RawId").alias("rawId"),
            F.col("FileName").alias("fileName"),
            F.col("ISASender").alias("sender"),
            F.col("ProcessStatus").alias("processStatus"),
            F.col("ErrorMessage").alias("errorMessage"),
            timestamp_text(F.col("LoadDateTime")).alias("loadDateTime"),
        )
    )


#: Parts of a LIKE pattern: a class, a wildcard, literal text.  Fixed value.
LIKE_PARTS = r"\[\^?[^\]]+\]|[%_]|[^%_\[]+|\["
GRAM = 3


def like_regex(pattern: Column) -> Column:
    """The regular expression of a LIKE pattern with ``%``, ``_`` and ``[...]``; all else is literal."""

    def part(p: Column) -> Column:
        inside = F.regexp_replace(F.substring(p, F.lit(2), F.length(p) - 2), r"([\\\[&])", r"\\$1")
        literal = F.concat(F.lit(r"\Q"), F.replace(p, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
        return (
            F.when(p == "%", ".*")
            .when(p == "_", ".")
            .when(p.startswith("[") & (F.length(p) > 1), F.concat(F.lit("["), inside, F.lit("]")))
            .otherwise(literal)
        )

    parts = F.regexp_extract_all(pattern, F.lit(LIKE_PARTS), F.lit(0))
    return F.concat(F.lit("(?is)"), F.array_join(F.transform(parts, part), ""))


def _rare_gram(pattern: Column) -> Column:
    """The first letters of the longest literal part; empty if no part is long enough."""
    parts = F.regexp_extract_all(F.lower(pattern), F.lit(LIKE_PARTS), F.lit(0))
    literal = F.filter(parts, lambda p: (F.length(p) >= GRAM) & ~p.startswith("["))
    longest = F.array_max(F.transform(literal, lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))))
    return F.coalesce(F.substring(longest["p"], 1, GRAM), F.lit(""))


def explain_error(errors: DataFrame, kb: DataFrame, column: str = "ErrorMessage") -> DataFrame:
    """Adds ``Note``: explanation and remediation of the first matching pattern.

    Patterns are substrings with live LIKE wildcards and classes, in any case; a
    backslash is a backslash.  Each distinct message is matched once.  A message
    meets the patterns whose longest literal part begins with three letters it
    contains, by an equi-join; patterns without such a part meet every message.
    """
    messages = (
        errors.where(F.col(column).isNotNull() & (F.col(column) != "")).select(column).distinct()
    )
    entry = kb.where(F.col("ErrorPattern").isNotNull()).select(
        "ErrorKnowledgeBaseId",
        _rare_gram(F.col("ErrorPattern")).alias("_gram"),
        like_regex(F.col("ErrorPattern")).alias("_regex"),
        F.concat_ws(" ", "Explanation", F.nullif("RemediationStep", F.lit(""))).alias("Note"),
    )
    lowered = F.lower(F.col(column))
    places = F.sequence(F.lit(1), F.greatest(F.length(lowered) - GRAM + 1, F.lit(1)))
    grams = F.array_distinct(F.transform(places, lambda i: F.substring(lowered, i, F.lit(GRAM))))
    asked = messages.select(column, F.explode(F.array_union(grams, F.array(F.lit("")))).alias("_gram"))
    notes = (
        asked.join(entry, "_gram")
        .where(F.rlike(F.col(column), F.col("_regex")))
        .groupBy(column)
        .agg(F.min_by("Note", "ErrorKnowledgeBaseId").alias("Note"))
    )
    return errors.join(notes, column, "left").select(*errors.columns, "Note")


def describe_status(files: DataFrame) -> DataFrame:
    """Adds ``Narrative``; needs the ``Note`` of :func:`explain_error`."""
    loaded = F.coalesce(timestamp_text(F.col("LoadDateTime")), F.lit("an unknown time"))
    subject = (
        "File ", F.col("FileName"),
        " (ISA ", F.coalesce("ISA_ControlNumber", F.lit("None")), ") was received ",
    )
    error = F.coalesce(F.nullif("ErrorMessage", F.lit("")), F.lit("no error message was recorded"))
    suffix = F.when(F.col("Note").isNotNull(), F.concat(F.lit(" ("), "Note", F.lit(")")))
    status = F.col("ProcessStatus")
    narrative = (
        F.when(status == "PARSED", join_text(*subject, "and parsed successfully at ", loaded, "."))
        .when(
            status == "PARSE_FAILED",
            join_text(*subject, "at ", loaded, " but failed to parse: ", error, suffix),
        )
        .otherwise(
            join_text(
                *subject, "at ", loaded, ". Current status: ",
                F.coalesce(F.nullif(status, F.lit("")), F.lit("UNKNOWN")), ".",
            )
        )
    )
    return files.withColumn("Narrative", narrative)


def failed_downloads(
    files: DataFrame, listing: DataFrame, customer: str | None = None, n: int = 5
) -> DataFrame:
    """Where the newest failed files are stored; files no longer stored are dropped."""
    from quaywork.sources.files import locate_files

    newest = failed_files(files, customer, 20).orderBy(F.col("rawId").desc()).limit(n)
    located = locate_files(newest.select(F.col("fileName").alias("FileName")), listing)
    return located.where(F.col("BlobName").isNotNull())


def history_tail(turns: DataFrame, n: int = 5) -> DataFrame:
    """Last ``n`` non-blank user and assistant turns of each conversation, in order."""
    spoken = turns.where(
        F.col("role").isin("user", "assistant") & F.col("text").rlike(r"(?U)\S")
    )
    recent = W.partitionBy("conv_id").orderBy(F.col("turn").desc())
    return (
        spoken.withColumn("_back", F.row_number().over(recent))
        .where(F.col("_back") <= n)
        .select("conv_id", "turn", "role", "text")
    )


def _feedback_facts(raw: DataFrame) -> DataFrame:
    question = strip(F.coalesce("QuestionText", F.lit("")))
    answer = strip(F.coalesce("ResponseText", F.lit("")))
    comment = F.nullif(strip(F.col("Comment")), F.lit(""))
    problem = (
        F.when(
            ~F.coalesce(F.col("Rating").isin(1, -1), F.lit(False)),
            "rating must be 1 (helpful) or -1 (not helpful)",
        )
        .when((question == "") | (answer == ""), "question and reply are required")
        .when(F.length(comment) > COMMENT_LIMIT, f"comment must be {COMMENT_LIMIT} characters or fewer")
    )
    channel = F.when(F.col("Channel").isin("support", "intake"), F.col("Channel")).otherwise("support")
    return raw.withColumns(
        {
            "QuestionText": question,
            "ResponseText": answer,
            "Comment": comment,
            "Channel": channel,
            "Source": F.coalesce(F.nullif("Source", F.lit("")), F.lit("unknown")),
            "MessageHash": F.sha2(F.concat(question, F.lit("\x1f"), answer), 256),
            "Problem": problem,
        }
    )


def capture_feedback(raw: DataFrame) -> DataFrame:
    return _feedback_facts(raw).where(F.col("Problem").isNull()).drop("Problem")


def feedback_rejects(raw: DataFrame) -> DataFrame:
    return _feedback_facts(raw).where(F.col("Problem").isNotNull()).select("FeedbackId", "Problem")


def negative_feedback_context(feedback: DataFrame, n: int = 5) -> DataFrame:
    """Text of the newest ``n`` dislikes; blank comments are dropped after the cut."""
    newest = (
        feedback.where(F.col("Rating") == -1)
        .orderBy(F.col("CreatedDateTime").desc(), F.col("FeedbackId").desc())
        .limit(n)
        .where(strip(F.coalesce("Comment", F.lit(""))) != "")
    )
    line = join_text(
        '- A user disliked a past reply to "', F.col("QuestionText"),
        '" because: "', strip(F.col("Comment")), '"',
    )
    lines = F.transform(
        F.sort_array(
            F.collect_list(
                F.struct(
                    (-micros(F.col("CreatedDateTime"))).alias("t"),
                    (-F.col("FeedbackId")).alias("i"),
                    line.alias("line"),
                )
            )
        ),
        lambda x: x["line"],
    )
    return newest.agg(F.array_join(lines, "\n").alias("Context"))


def repeat_complaints(feedback: DataFrame) -> DataFrame:
    return (
        feedback.groupBy("MessageHash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    )


def search_lines(corpus: DataFrame, literal: str, n: int | None = 20) -> DataFrame:
    """Lines containing ``literal`` in any case; ``corpus`` has Id and Text.

    Texts without the literal are dropped before their lines are exploded.
    """
    needle = literal.strip().lower()
    lines = corpus.where(F.lower("Text").contains(needle)).select(
        "Id", F.posexplode(F.split("Text", LINE_BREAK, -1)).alias("_pos", "_line")
    )
    hits = lines.where(F.lower("_line").contains(needle)).select(
        "Id",
        (F.col("_pos") + 1).alias("LineNo"),
        F.substring(strip(F.col("_line")), 1, 200).alias("Snippet"),
    )
    return hits if n is None else hits.orderBy("Id", "LineNo").limit(n)


def _next_starts(times: DataFrame, width: int) -> DataFrame:
    """(Key, _t, _next): the first time of the key that is more than ``width`` later, null if there is none.

    Times and the ends of their windows are put in one order, backwards, so that
    the time sought is the last one before the end in that order.
    """
    points = times.select("Key", F.col("_t").alias("_at"), F.lit(1).alias("_kind"))
    ends = times.select("Key", (F.col("_t") + width).alias("_at"), F.lit(0).alias("_kind"))
    order = [-F.col("_at"), F.col("_kind")]
    slice_by = -F.floor(F.col("_at") / F.lit(SLICE_MICROS))
    seen = latest_before(
        points.unionByName(ends), ["Key"], order, slice_by, F.when(F.col("_kind") == 1, F.col("_at")), "_next"
    )
    return seen.where("_kind = 0").select("Key", (F.col("_at") - width).alias("_t"), "_next")


def _folded_starts(times: DataFrame, width: int) -> DataFrame:
    """(Key, _t) of the starts, walking along the sorted times of a key inside one row."""
    last, none = F.lit(None).cast("bigint"), F.array().cast("array<bigint>")

    def step(done: Column, t: Column) -> Column:
        opened = F.struct(t.alias("last"), F.concat(done["starts"], F.array(t)).alias("starts"))
        return F.when(done["last"].isNull() | (t - done["last"] > width), opened).otherwise(done)

    first = F.struct(last.alias("last"), none.alias("starts"))
    sorted_times = times.groupBy("Key").agg(F.sort_array(F.collect_list("_t")).alias("times"))
    starts = F.aggregate("times", first, step, lambda done: done["starts"])
    return sorted_times.select("Key", F.explode(starts).alias("_t"))


def window_starts(times: DataFrame, width: int, fits: int = FOLDED_TIMES) -> DataFrame:
    """(Key, _t) of the distinct ``times`` that open a window.

    A key's first time opens one, and from each start the next is the first
    time more than ``width`` later.  Keys of up to ``fits`` times are folded.
    In a crowded key every time points to what would follow it, and the pointers
    are followed by doubling: in each round the starts found so far give those
    as many steps further on again, and every pointer is joined with itself.  So
    the joins are a logarithm of a key's windows, and no task walks along it.
    """
    spark = times.sparkSession

    def written(df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    times = written(times, "times")
    counts = written(times.groupBy("Key").agg(F.count("_t").alias("n")), "counts")
    crowded = counts.where(F.col("n") > fits).select("Key")
    many = crowded.count()
    if not many:
        return _folded_starts(times, width)
    crowded = F.broadcast(crowded) if many <= BROADCAST_ROWS else crowded
    hot = times.join(crowded, "Key", "left_semi")
    pointers = written(_next_starts(hot, width).where("_next IS NOT NULL"), "pointers")
    starts = written(hot.groupBy("Key").agg(F.min("_t").alias("_t")), "starts")
    while not pointers.isEmpty():
        further = starts.join(pointers, ["Key", "_t"]).select("Key", F.col("_next").alias("_t"))
        # A start's successors of 1, 2, 4, ... steps are all different, so nothing is found twice.
        starts = written(starts.unionByName(further), "starts")
        second = pointers.select("Key", F.col("_t").alias("_next"), F.col("_next").alias("_after"))
        doubled = pointers.join(second, ["Key", "_next"]).select("Key", "_t", F.col("_after").alias("_next"))
        pointers = written(doubled, "pointers")
    return starts.unionByName(_folded_starts(times.join(crowded, "Key", "left_anti"), width))


def rate_limit(
    events: DataFrame,
    seconds: int = RATE_WINDOW_SECONDS,
    limit: int = RATE_LIMIT,
    fits: int = FOLDED_TIMES,
) -> DataFrame:
    """Marks requests of (Key, EventTime, EventId) beyond ``limit`` per window.

    A window opens with a key's first request and the next one opens with the
    first request more than ``seconds`` later.  The starts are found by
    :func:`window_starts`.  They are more than a window apart, so a stretch of
    that length holds one at most, and a request's own start lies in its stretch
    or the one before: two equi-joins.  Requests are then numbered inside
    (Key, start).  Requests without key are one key, those without time are left
    out.
    """
    width = seconds * 1_000_000
    stamped = events.select(
        F.col("Key").alias("_name"),
        "EventTime",
        "EventId",
        F.coalesce(F.concat(F.lit("="), F.col("Key").cast("string")), F.lit("")).alias("Key"),
        micros(F.col("EventTime")).alias("_t"),
    ).where("_t IS NOT NULL")
    starts = window_starts(stamped.select("Key", "_t").distinct(), width, fits)
    stretch = F.floor(F.col("_t") / F.lit(width)).cast("bigint")
    here = starts.select("Key", stretch.alias("_stretch"), F.col("_t").alias("_here"))
    before = here.select("Key", (F.col("_stretch") + 1).alias("_stretch"), F.col("_here").alias("_before"))
    placed = (
        stamped.withColumn("_stretch", stretch)
        .join(here, ["Key", "_stretch"], "left")
        .join(before, ["Key", "_stretch"], "left")
        .withColumn("WindowStart", F.coalesce(F.when(F.col("_here") <= F.col("_t"), F.col("_here")), "_before"))
    )
    order = [F.col("_t"), F.col("EventId")]
    ranked = numbered(
        placed, ["Key", "WindowStart"], order, F.floor(F.col("_t") / F.lit(SLICE_MICROS)), "_rank"
    )
    return ranked.select(
        F.col("_name").alias("Key"), "EventTime", "EventId", "WindowStart", (F.col("_rank") > limit).alias("Denied")
    )
