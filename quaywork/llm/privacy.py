"""Personal data: exact patterns, and terms that reveal what the patterns protect.

Everything here is DataFrame functions; no row passes through Python.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaywork.llm.common import packed, settle, unpacked, whole_text

# The kinds in their order, and their patterns.  The looks behind and the possessive
# repeats change no match; they keep long runs of one character class from being tried again and again.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold before a pattern is worth trying; each follows from the pattern and its check.
GATES = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){11}",
    "phone": r"\+[0-9]",
}
IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
WORDS = r"(?<![\p{L}\p{M}\p{N}_])[\p{L}\p{M}]++(?![\p{N}_])"
PLACEHOLDERS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
GENERAL = "[TERM]"
BLOCK = 256


@dataclass(frozen=True)
class Options:
    """``support``: different texts that must hold a term and an entity before the
    corpus says anything about the two; copies do not add to it.
    ``generalise_at`` and ``remove_at``: shares of an entity's information
    content from which a term is generalised or removed.
    """

    support: int = 2
    generalise_at: float = 0.5
    remove_at: float = 0.9


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _running(values: Column) -> Column:
    """Sums up to and including each element, in blocks so that long arrays stay cheap."""

    def of(v: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
        totals = F.transform(blocks, lambda b: _sum(F.slice(v, b * BLOCK + 1, F.lit(BLOCK))))

        def within(t: Column) -> Column:
            def block(b: Column) -> Column:
                before = _sum(F.slice(t, F.lit(1), b))
                part = F.slice(v, b * BLOCK + 1, F.lit(BLOCK))
                return _let(
                    F.struct(before.alias("before"), part.alias("part")),
                    lambda x: F.transform(
                        x["part"], lambda _, i: x["before"] + _sum(F.slice(x["part"], F.lit(1), i + 1))
                    ),
                )

            return F.flatten(F.transform(blocks, block))

        return _let(totals, within)

    return _let(values, of)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: start, end (code points, end exclusive), value."""

    def placed(x: Column) -> Column:
        count = F.size(x["hits"])
        gaps = F.transform(F.slice(x["gaps"], F.lit(1), count), F.length)
        earlier = F.concat(
            F.array(F.lit(0)), F.transform(F.slice(x["hits"], F.lit(1), count - 1), F.length)
        )
        starts = _running(F.zip_with(gaps, earlier, lambda g, h: g + h))
        return F.zip_with(
            starts,
            x["hits"],
            lambda s, h: F.struct(s.alias("start"), (s + F.length(h)).alias("end"), h.alias("value")),
        )

    found = F.struct(
        F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits")
    )
    nothing = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return _let(found, lambda x: F.when(F.size(x["hits"]) > 0, placed(x)).otherwise(nothing))


def _valid(kind: str) -> Callable[[Column], Column]:
    def check(span: Column) -> Column:
        value = span["value"]
        if kind == "ip":
            return value.rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")
        digits = F.regexp_replace(value, "[^0-9]", "")
        if kind == "card":
            return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
        if kind == "phone":
            return F.length(digits).between(9, 15)
        return F.lit(True)

    return check


SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


def base_spans(text: Column) -> Column:
    """All spans of the four kinds by start, then kind; failing matches are dropped, not retried."""
    parts = []
    for rank, kind in enumerate(KINDS):
        gate = text.contains("@") if kind == "email" else text.rlike(GATES[kind])
        found = F.filter(matches(text, PATTERNS[kind]), _valid(kind))
        parts.append(F.when(gate, _shaped(found, rank, kind)).otherwise(F.array().cast(SPAN)))
    return F.array_sort(F.concat(*parts))


def _shaped(found: Column, rank: int, kind: str) -> Column:
    def shape(s: Column) -> Column:
        return F.struct(
            s["start"].alias("start"),
            F.lit(rank).alias("rank"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
            s["value"].alias("value"),
        )

    return F.transform(found, shape).cast(SPAN)


def entity(span: Column) -> Column:
    """What a span protects: its kind, and its value without case or punctuation."""
    digits = F.regexp_replace(span["value"], "[^0-9]", "")
    bare = F.when(span["kind"].isin("card", "phone"), digits).otherwise(F.lower(span["value"]))
    return F.concat(span["kind"], F.lit(":"), bare)


def detect(docs: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """``row`` (the carried columns), ``key`` (digest of the text), ``spans``, and ``body`` of texts with spans."""
    body = whole_text(F.col(f"`{text}`"))
    row = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct(F.lit(0).alias("none"))
    found = docs.select(row.alias("row"), F.unhex(F.md5(body)).alias("key"), body.alias("body"))
    found = found.withColumn("spans", base_spans(F.col("body")))
    return found.select("row", "key", "spans", F.when(F.size("spans") > 0, F.col("body")).alias("body"))


def _blanked(body: Column, spans: Column) -> Column:
    """The text with spaces for every span, as many as it has code points, so that words keep their places."""

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(body, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        covered = F.greatest(s["end"] - F.greatest(s["start"], acc["at"]), F.lit(0))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.concat(acc["out"], gap, F.repeat(F.lit(" "), covered)).alias("out"),
        )

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(
        spans, begin, step, lambda acc: F.concat(acc["out"], F.substring(body, acc["at"] + 1, F.length(body)))
    )


def _different_texts(detected: DataFrame) -> DataFrame:
    """One row a different text with spans: key, copies, spans, body, entities."""
    once = (
        detected.where(F.size("spans") > 0)
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("copies"), F.first("spans").alias("spans"), F.first("body").alias("body"))
    )
    return once.withColumn("entities", F.array_distinct(F.transform("spans", entity)))


def _distinct_words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(0)))


def meetings(texts: DataFrame, docs: DataFrame, total: int, options: Options, text: str) -> DataFrame:
    """(key, copies, entity, term, with_entity, with_term): terms that may disclose an entity of their text.

    A pair is left out only where it can not reach the threshold: its entity or
    its term stands in fewer than ``support`` texts, or the term is so common
    that not even standing in every document of the entity would suffice
    (both <= p(e), so with_term <= n^(1-g) * with_entity^g is necessary).  That
    bound is part of the join, so common words never become rows.
    """
    o, n = options, float(max(total, 1))
    known = (
        texts.select("copies", F.explode("entities").alias("entity"))
        .groupBy("entity")
        .agg(F.sum("copies").alias("with_entity"), F.count(F.lit(1)).alias("support"))
        .where((F.col("support") >= o.support) & (F.col("with_entity") < n))
        .withColumn(
            "most",
            F.lit(1 + 1e-9) * F.pow(F.lit(n), 1 - o.generalise_at) * F.pow(F.col("with_entity"), o.generalise_at),
        )
        .drop("support")
    )
    known = settle(known, "known")
    held = settle(texts.select("key", F.explode("entities").alias("entity")).join(known, "entity"), "held")
    words = texts.join(held.select("key").distinct(), "key", "left_semi").select(
        "key", "copies", F.explode(_distinct_words(_blanked(F.col("body"), F.col("spans")))).alias("term")
    )
    words = settle(words, "words")
    wanted = words.groupBy("term").agg(F.count(F.lit(1)).alias("support")).where(F.col("support") >= o.support)
    wanted = settle(wanted.select("term"), "wanted")
    most = known.agg(F.max("most").alias("most")).first()["most"] or 0.0
    # Counted before the join, so that what the join makes is one row a term however common it is; a
    # semi-join would be moved below the counting, an inner join with distinct terms is not.
    every = docs.select(F.explode(_distinct_words(whole_text(F.col(f"`{text}`")))).alias("term"))
    counted = every.groupBy("term").agg(F.count(F.lit(1)).alias("with_term"))
    with_term = settle(counted.where(F.col("with_term") <= most).join(wanted, "term"), "terms-counted")
    rare = words.join(with_term, "term").alias("w")
    held = held.alias("h")
    meet = (F.col("w.key") == F.col("h.key")) & (F.col("w.with_term") <= F.col("h.most"))
    return rare.join(held, meet).select("w.key", "copies", "entity", "term", "with_entity", "with_term")


def disclosing_terms(met: DataFrame, total: int, options: Options) -> DataFrame:
    """(entity, term, disclosure) for terms at or above ``generalise_at``.

    With documents as the unit, an entity's information content is -log p(e),
    and a term discloses PMI(e; t) = log p(e, t) / (p(e) p(t)) of it; the
    disclosure is their ratio, 1 if the term occurs with the entity alone.
    """
    n = F.lit(float(max(total, 1)))
    information = F.log(n / F.col("with_entity"))
    shared = F.log(F.col("both") * n / (F.col("with_entity") * F.col("with_term")))
    return (
        met.groupBy("entity", "term", "with_entity", "with_term")
        .agg(F.sum("copies").alias("both"), F.count(F.lit(1)).alias("support"))
        .where(F.col("support") >= options.support)
        .withColumn("disclosure", F.when(information > 0, shared / information))
        .where(F.col("disclosure") >= options.generalise_at)
        .select("entity", "term", "disclosure")
    )


def term_spans(detected: DataFrame, docs: DataFrame, options: Options, text: str) -> DataFrame:
    """(key, terms): for each text every place of the terms that disclose one of its entities.

    Equal texts share one row.  A term that several entities flag has the
    largest of their disclosures.
    """
    total = detected.count()
    texts = settle(_different_texts(detected), "texts")
    met = settle(meetings(texts, docs, total, options, text), "met")
    flagged = settle(disclosing_terms(met, total, options), "flagged")
    told = (
        met.join(flagged, ["entity", "term"])
        .groupBy("key", "term")
        .agg(F.max("disclosure").alias("disclosure"))
        .groupBy("key")
        .agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("told"))
    )

    def place(m: Column) -> Column:
        return F.struct(
            m["start"].alias("start"),
            F.lit(len(KINDS)).alias("rank"),
            m["end"].alias("end"),
            F.lit(TERM).alias("kind"),
            F.try_element_at(F.col("told"), F.lower(m["value"])).alias("disclosure"),
        )

    words = matches(_blanked(F.col("body"), F.col("spans")), WORDS)
    places = F.filter(F.transform(words, place), lambda p: p["disclosure"].isNotNull())
    return settle(texts.join(told, "key").select("key", places.alias("terms")), "terms")


def find_private(
    docs: DataFrame,
    options: Options = Options(),
    text: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """Every document with ``spans``: the personal data in its whole text.

    A span has start, end (code points, end exclusive), kind, and for terms the
    disclosure (null for the exact patterns); they are in order of start, then
    kind.  ``carry`` names the columns to return (all but the text).

    Null texts count as empty; texts without spans have an empty array.
    Repeated rows: each is returned, and equal texts have equal spans.  Columns
    that bear an added name are replaced.  Empty input: no rows.

    Documents are the unit of co-occurrence, however long they are, and every
    place of a term is returned that discloses an entity of its document.
    Texts are read twice, once for the patterns and once for term counts; only
    those with spans are shuffled, one of each different text.
    """
    columns = [c for c in docs.columns if c != text] if carry is None else list(carry)
    detected = settle(detect(docs, text, columns), "detected")
    terms = term_spans(detected, docs, options, text)
    joined = detected.join(terms, "key", "left").withColumn("spans", _all_spans())
    return unpacked(joined, ["spans"], without=["none"])


def _all_spans() -> Column:
    base = F.transform(
        "spans",
        lambda s: F.struct(
            s["start"].alias("start"),
            s["rank"].alias("rank"),
            s["end"].alias("end"),
            s["kind"].alias("kind"),
            F.lit(None).cast("double").alias("disclosure"),
        ),
    )
    return F.when(F.col("terms").isNull(), base).otherwise(F.array_sort(F.concat(base, F.col("terms"))))


def span_list(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))
        ),
        ",",
    )


def _rewritten(body: Column, spans: Column, o: Options) -> Column:
    """The text with every span replaced; overlapping spans become one, named by the first."""

    def tag(s: Column) -> Column:
        out = F.when(s["disclosure"] >= o.remove_at, F.lit("")).otherwise(F.lit(GENERAL))
        for kind, mark in PLACEHOLDERS.items():
            out = F.when(s["kind"] == kind, F.lit(mark)).otherwise(out)
        return out

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(body, acc["at"] + 1, s["start"] - acc["at"])
        taken = F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, tag(s)).alias("out"))
        skipped = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["at"], taken).otherwise(skipped)

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(
        spans, begin, step, lambda acc: F.concat(acc["out"], F.substring(body, acc["at"] + 1, F.length(body)))
    )


def sanitise(docs: DataFrame, options: Options = Options(), text: str = "text") -> DataFrame:
    """The documents with their personal data replaced in the text.

    Exact patterns become a mark of their kind; terms that disclose an entity
    become a general mark, or nothing from ``remove_at`` on, wherever they
    stand in a document that holds the entity.  Overlapping spans become one,
    named by the first.  A text without spans is unchanged, a null text stays
    null.  All columns and repeated rows are kept.  Empty input: no rows.
    """
    detected = settle(detect(docs, text, []), "detected")
    terms = term_spans(detected, docs, options, text)
    body = F.col(f"row.`{text}`")
    found = packed(docs).withColumn("spans", base_spans(whole_text(body)))
    key = F.when(F.size("spans") > 0, F.unhex(F.md5(whole_text(body))))
    joined = _with_terms(found.withColumn("key", key), terms)
    new = F.when(F.size("spans") > 0, _rewritten(body, F.col("spans"), options)).otherwise(body)
    done = joined.withColumn("fresh", new)
    columns = [F.col("fresh").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return done.select(*columns)


def _with_terms(found: DataFrame, terms: DataFrame) -> DataFrame:
    return found.join(terms, "key", "left").withColumn("spans", _all_spans())
