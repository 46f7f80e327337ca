"""Parsing and rendering of X12 940 interchanges.

A received file is one row, so every step from text to parsed transaction is a
projection over that row: segments become an array of structs, SE segments cut
it into blocks, and each ``ST*940`` inside a closed block becomes a nested
transaction.  The parse therefore needs no shuffle at all, and no key can be
skewed; the flat tables are explosions of the nested result.

Policies decided here: a failed file yields no parsed rows; an ``ST*940``
without a following SE is a reject and yields no header; "first" always means
lowest segment sequence.  A header id is ``RawId * 2^31 + STSegmentSeq`` and an
address or detail id is ``RawId * 2^31 + SegmentSeq``; where nested STs share a
segment, the pair (HeaderId, DetailId) is the key.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaywork import schemas as S
from quaywork.functions.columns import (
    blank_to_null,
    clock,
    first_where,
    safe_decimal,
    safe_int,
)
from quaywork.functions.skew import join_checked, numbered
from quaywork.session import scratch_path, written_once

LINES_PER_TRANSACTION = 9_999
TRANSACTIONS_PER_FILE = 100
ID_SPAN = 1 << 31
# Element separator; an escaped single character is split without a regex engine.
ELEMENT = r"\*"


def _segment_texts(text: Column) -> Column:
    # Whole replacements: translate looks at every character by itself.
    unbroken = F.replace(F.replace(text, F.lit("\r"), F.lit("")), F.lit("\n"), F.lit(""))
    pieces = F.transform(F.split(unbroken, "~", -1), lambda s: F.trim(s))
    return F.filter(pieces, lambda s: s != "")


def _segment_id(segment: Column) -> Column:
    name = F.rtrim(F.substring_index(segment, "*", 1))
    # Full case mapping is dear; most names are plain capitals.
    return F.when(name.rlike("^[A-Z0-9]*$"), name).otherwise(F.upper(name))


def newest_unparsed(files: DataFrame) -> DataFrame:
    """Newest RAW_LOADED row of each file name.

    The superseded deliveries are found from ids alone and taken out by an anti
    join.  They are few as a rule; then the file texts are not shuffled.
    """
    waiting = files.where(F.col("ProcessStatus") == "RAW_LOADED")
    newest = (
        waiting.groupBy("FileName")
        .agg(F.max("RawId").alias("_newest"), F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .drop("_n")
    )
    superseded = (
        waiting.select("FileName", "RawId")
        .join(newest, "FileName")
        .where(F.col("RawId") < F.col("_newest"))
        .select("RawId")
    )
    return join_checked(waiting, superseded, "RawId", "left_anti")


def enrich_isa(files: DataFrame) -> DataFrame:
    """Sender, receiver and control number from the first ``ISA*`` segment."""
    isa = first_where(
        _segment_texts(F.col("RawEDIText")), lambda s: F.substring(s, 1, 4).ilike("ISA*")
    )
    elements = F.transform(F.split(isa, ELEMENT, -1), blank_to_null)
    return (
        files.withColumn("_isa", elements)
        .withColumn("ISASender", F.get("_isa", F.lit(6)))
        .withColumn("ISAReceiver", F.get("_isa", F.lit(8)))
        .withColumn("ISA_ControlNumber", F.get("_isa", F.lit(13)))
        .drop("_isa")
    )


def tokenize(files: DataFrame) -> DataFrame:
    """One row per non-empty segment, numbered from 1 in file order."""
    exploded = files.select("RawId", F.posexplode(_segment_texts(F.col("RawEDIText"))))
    return exploded.select(
        "RawId",
        (F.col("pos") + 1).alias("SegmentSeq"),
        _segment_id(F.col("col")).alias("SegmentId"),
        F.col("col").alias("SegmentText"),
    )


def _elements(segment: Column) -> Column:
    """The elements after the segment id trimmed, blank ones NULL."""
    plain = F.split(segment, ELEMENT, -1)
    # Only segments that can hold such elements pay for looking at each.
    padded = F.contains(segment, F.lit(" ")) | F.contains(segment, F.lit("**")) | F.endswith(segment, F.lit("*"))
    return F.when(padded, F.transform(plain, blank_to_null)).otherwise(plain)


def _element(segment: Column, position: int) -> Column:
    return F.get(segment["e"], F.lit(position))


def _first_segment(name: str, segments: str = "segments") -> Column:
    return first_where(F.col(segments), lambda s: s["id"] == name)


def _unfold(df: DataFrame, array: Column | str, name: str, *keep: str) -> DataFrame:
    """Explode a computed array.

    A plain ``explode`` makes the optimizer push a size check on the array below
    the projection that computes it, and so compute it twice; the outer form
    with a filter on its own output does not.
    """
    exploded = df.select(*keep, F.explode_outer(array).alias(name))
    return exploded.where(F.col(name).isNotNull())


def _too_long(record: Column, widths: dict[str, int]) -> Column:
    by_width: dict[int, list[Column]] = {}
    for name, width in widths.items():
        by_width.setdefault(width, []).append(F.length(record[name]))
    # The longest of a width is compared; missing values do not count.
    longest = {width: F.greatest(*sizes) if len(sizes) > 1 else sizes[0] for width, sizes in by_width.items()}
    return reduce(or_, [F.coalesce(size > width, F.lit(False)) for width, size in longest.items()])


def _is_order_start(segment: Column) -> Column:
    return (segment["id"] == "ST") & F.coalesce(_element(segment, 1) == "940", F.lit(False))


def _address(segment: Column) -> Column:
    return F.struct(
        segment["seq"].alias("SegmentSeq"),
        _element(segment, 1).alias("EntityCode"),
        _element(segment, 2).alias("Name"),
        _element(segment, 3).alias("IdQualifier"),
        _element(segment, 4).alias("IdCode"),
    )


def _detail(segment: Column) -> Column:
    return F.struct(
        segment["seq"].alias("SegmentSeq"),
        safe_decimal(_element(segment, 1)).alias("QuantityOrdered"),
        _element(segment, 2).alias("UOM"),
        _element(segment, 3).alias("ProductQualifier"),
        _element(segment, 4).alias("ProductId"),
        _element(segment, 5).alias("ProductQualifier2"),
        _element(segment, 6).alias("ProductId2"),
    )


def _between(first: Column, last: Column) -> Column:
    return F.slice("segments", first, last - first + 1)


def _span(start: Column, end: Column) -> Column:
    """Places of a transaction's ST, SE and first W05, which may be missing."""
    order = first_where(_between(start["seq"], end), lambda s: s["id"] == "W05")
    return F.struct(start["seq"].alias("st"), end.alias("se"), order["seq"].alias("order"))


def _transaction(span: Column) -> Column:
    # What a transform returns is copied, so segments are looked up by place and values come out of one level.
    start, order, trailer = (F.get("segments", span[name] - 1) for name in ("st", "order", "se"))
    inside = _between(span["st"], span["se"])
    return F.struct(
        span["st"].alias("STSegmentSeq"),
        span["se"].alias("SESegmentSeq"),
        _element(start, 1).alias("TransactionSetCode"),
        _element(start, 2).alias("STControlNumber"),
        _element(order, 2).alias("WarehouseOrderNumber"),
        _element(order, 4).alias("ShipDate"),
        safe_int(_element(trailer, 1)).alias("SE01_SegmentCount"),
        _element(trailer, 2).alias("SE02_ControlNumber"),
        F.transform(F.filter(inside, lambda s: s["id"] == "N1"), _address).alias("addresses"),
        F.transform(F.filter(inside, lambda s: s["id"] == "W01"), _detail).alias("details"),
    )


def _transaction_problem(transaction: Column) -> Column:
    header_long = _too_long(
        transaction,
        {k: w for k, w in S.WIDTHS["headers"].items() if k not in ("ISAControlNumber", "GSControlNumber")},
    ) | _too_long(transaction, {"SE02_ControlNumber": 50})
    address_long = F.exists(transaction["addresses"], lambda a: _too_long(a, S.WIDTHS["addresses"]))
    detail_long = F.exists(transaction["details"], lambda d: _too_long(d, S.WIDTHS["details"]))
    bad_quantity = F.exists(
        transaction["details"],
        lambda d: d["QuantityOrdered"].isNull() | (d["QuantityOrdered"] <= 0),
    )
    return F.when(header_long | address_long | detail_long, F.lit(S.TOO_LONG)).when(
        bad_quantity, F.lit(S.BAD_QUANTITY)
    )


def _segmented(files: DataFrame) -> DataFrame:
    """Per file its ``segments``, the ``ranges`` closed by each SE and ``_open``, the place after the last SE."""
    parsed = F.transform(
        _segment_texts(F.col("RawEDIText")),
        lambda s, i: F.struct((i + 1).cast("int").alias("seq"), _segment_id(s).alias("id"), _elements(s).alias("e")),
    )
    closings = F.transform(
        F.filter("segments", lambda s: s["id"] == "SE"), lambda s: s["seq"]
    )
    openings = F.concat(F.array(F.lit(1)), F.transform("_se", lambda n: n + 1))
    return (
        files.withColumn("segments", parsed)
        .withColumn("_se", closings)
        .withColumn("ranges", F.arrays_zip(F.slice(openings, F.lit(1), F.size("_se")).alias("first"), F.col("_se").alias("se")))
        .withColumn("_open", F.element_at(openings, -1))
        .drop("_se")
    )


def split_blocks(files: DataFrame) -> DataFrame:
    """Per file: its segments and the blocks closed by each SE segment.

    A segment's block is the stretch up to and including the next SE, so all
    STs of a block share that SE; what follows the last SE is ``open_tail``.
    """
    blocks = F.transform(
        "ranges", lambda r: F.struct(r["se"].alias("se"), _between(r["first"], r["se"]).alias("segments"))
    )
    return (
        _segmented(files)
        .withColumn("blocks", blocks)
        .withColumn("open_tail", _between(F.col("_open"), F.size("segments")))
        .drop("ranges", "_open")
    )


def parse_files(files: DataFrame, strict: bool = False) -> DataFrame:
    """One row per file with its envelope, nested transactions and first problem.

    ``Problem`` is NULL for a file that parses; otherwise the message of the
    first failing transaction.  ``strict`` also fails files without any
    ``ST*940``.
    """
    frame = ("ISA", "GS", "GE", "IEA")
    first = {name: _first_segment(name, "_frame") for name in frame}
    # A lambda inside a lambda captures the outer variable, so each ST is paired
    # with its own block.
    spans = F.flatten(
        F.transform(
            "ranges",
            lambda r: F.transform(
                F.filter(_between(r["first"], r["se"]), _is_order_start), lambda st: _span(st, r["se"])
            ),
        )
    )
    envelope_long = _too_long(F.col("envelope"), {
        "ISAControlNumber": 50,
        "GSControlNumber": 50,
        "GE02_GroupControlNumber": 50,
        "IEA02_InterchangeControlNumber": 50,
    })
    problem = F.coalesce(
        F.when(envelope_long & (F.size("transactions") > 0), F.lit(S.TOO_LONG)),
        first_where(F.transform("transactions", _transaction_problem), lambda p: p.isNotNull()),
    )
    if strict:
        problem = F.coalesce(
            problem, F.when(F.size("transactions") == 0, F.lit(S.NO_TRANSACTIONS))
        )
    return (
        _segmented(files.select("RawId", "FileName", "RawEDIText"))
        .withColumn("_frame", F.filter("segments", lambda s: s["id"].isin(*frame)))
        .withColumn("_spans", spans)
        .select(
            "RawId",
            "FileName",
            F.struct(
                _element(first["ISA"], 13).alias("ISAControlNumber"),
                _element(first["GS"], 6).alias("GSControlNumber"),
                safe_int(_element(first["GE"], 1)).alias("GE01_TransactionCount"),
                _element(first["GE"], 2).alias("GE02_GroupControlNumber"),
                safe_int(_element(first["IEA"], 1)).alias("IEA01_GroupCount"),
                _element(first["IEA"], 2).alias("IEA02_InterchangeControlNumber"),
            ).alias("envelope"),
            F.transform("_spans", _transaction).alias("transactions"),
            F.transform(
                F.filter(_between(F.col("_open"), F.size("segments")), _is_order_start), lambda s: s["seq"]
            ).alias("unterminated"),
        )
        .withColumn("Problem", problem)
    )


def _accepted(parsed: DataFrame) -> DataFrame:
    header_id = F.col("RawId") * F.lit(ID_SPAN) + F.col("t.STSegmentSeq")
    good = F.when(F.col("Problem").isNull(), F.col("transactions"))
    rows = _unfold(parsed, good, "t", "RawId", "FileName", "envelope")
    return rows.withColumn("HeaderId", header_id)


def envelope(parsed: DataFrame) -> DataFrame:
    return parsed.select("RawId", "envelope.*")


def transactions(parsed: DataFrame) -> DataFrame:
    """Every closed ``ST*940`` with the sequence of its SE."""
    return _unfold(parsed, "transactions", "t", "RawId").select(
        "RawId", "t.STSegmentSeq", "t.SESegmentSeq"
    )


def assigned_segments(parsed: DataFrame) -> DataFrame:
    """Segment numbers by transaction; under nested STs one appears for each."""
    rows = _unfold(parsed, "transactions", "t", "RawId")
    numbers = F.sequence("t.STSegmentSeq", "t.SESegmentSeq")
    return rows.select("RawId", "t.STSegmentSeq", F.explode(numbers).alias("SegmentSeq"))


def headers(parsed: DataFrame) -> DataFrame:
    return _accepted(parsed).select(
        "HeaderId",
        "RawId",
        "FileName",
        "envelope.ISAControlNumber",
        "envelope.GSControlNumber",
        "t.STControlNumber",
        "t.TransactionSetCode",
        "t.WarehouseOrderNumber",
        "t.ShipDate",
        "t.STSegmentSeq",
        "t.SESegmentSeq",
    )


def addresses(parsed: DataFrame) -> DataFrame:
    rows = _unfold(_accepted(parsed), "t.addresses", "a", "HeaderId", "RawId")
    return rows.select(
        "HeaderId",
        "RawId",
        (F.col("RawId") * F.lit(ID_SPAN) + F.col("a.SegmentSeq")).alias("AddressId"),
        "a.EntityCode",
        "a.Name",
        "a.IdQualifier",
        "a.IdCode",
    )


def details(parsed: DataFrame) -> DataFrame:
    rows = _unfold(_accepted(parsed), "t.details", "d", "HeaderId", "RawId")
    return rows.select(
        "HeaderId",
        "RawId",
        (F.col("RawId") * F.lit(ID_SPAN) + F.col("d.SegmentSeq")).alias("DetailId"),
        F.col("d.SegmentSeq").cast("string").alias("LineNumber"),
        "d.QuantityOrdered",
        "d.UOM",
        "d.ProductQualifier",
        "d.ProductId",
        "d.ProductQualifier2",
        "d.ProductId2",
    )


def controls(parsed: DataFrame) -> DataFrame:
    return _accepted(parsed).select(
        "HeaderId",
        "RawId",
        "t.SE01_SegmentCount",
        "t.SE02_ControlNumber",
        "envelope.GE01_TransactionCount",
        "envelope.GE02_GroupControlNumber",
        "envelope.IEA01_GroupCount",
        "envelope.IEA02_InterchangeControlNumber",
    )


def invalid_quantities(parsed: DataFrame) -> DataFrame:
    """The W01 lines that fail their file, with the fixed code and message."""
    rows = _unfold(parsed, "transactions", "t", "RawId")
    lines = _unfold(rows, "t.details", "d", "RawId", "t.STSegmentSeq")
    return lines.where(
        F.col("d.QuantityOrdered").isNull() | (F.col("d.QuantityOrdered") <= 0)
    ).select(
        "RawId",
        "STSegmentSeq",
        F.col("d.SegmentSeq").alias("SegmentSeq"),
        F.lit(S.BAD_QUANTITY_CODE).alias("ErrorCode"),
        F.lit(S.BAD_QUANTITY).alias("ErrorMessage"),
    )


def overlong_values(parsed: DataFrame) -> DataFrame:
    """Each parsed value longer than its declared column, one row per value."""
    rows = _unfold(parsed, "transactions", "t", "RawId", "envelope")

    def checks(table: str, record: Column) -> Column:
        found = [
            F.struct(
                F.lit(table).alias("TableName"),
                F.lit(name).alias("ColumnName"),
                F.length(record[name]).alias("ValueLength"),
                F.lit(width).alias("MaxLength"),
            )
            for name, width in S.WIDTHS[table].items()
        ]
        return F.array(*found)

    def long_ones(table: str) -> Column:
        # Few rows as a rule; only their values are listed.
        return F.filter(f"t.{table}", lambda r: _too_long(r, S.WIDTHS[table]))

    header = F.struct("t.*", "envelope.*")
    every = F.concat(
        checks("headers", header),
        checks("controls", header),
        F.flatten(F.transform(long_ones("addresses"), lambda a: checks("addresses", a))),
        F.flatten(F.transform(long_ones("details"), lambda d: checks("details", d))),
    )
    long_only = F.filter(every, lambda c: c["ValueLength"] > c["MaxLength"])
    return _unfold(rows, long_only, "c", "RawId", "t.STSegmentSeq").select(
        "RawId", "STSegmentSeq", "c.*"
    )


def rejects(parsed: DataFrame) -> DataFrame:
    """Failed files and unterminated transactions; ``STSegmentSeq`` is NULL for a file."""
    reasons = F.concat(
        F.when(
            F.col("Problem").isNotNull(),
            F.array(F.struct(F.lit(None).cast("int").alias("STSegmentSeq"), F.col("Problem").alias("Reason"))),
        ).otherwise(F.array().cast("array<struct<STSegmentSeq:int,Reason:string>>")),
        F.transform(
            "unterminated",
            lambda n: F.struct(n.alias("STSegmentSeq"), F.lit(S.UNTERMINATED_ST).alias("Reason")),
        ),
    )
    return _unfold(parsed, reasons, "r", "RawId", "FileName").select(
        "RawId", "FileName", "r.STSegmentSeq", "r.Reason"
    )


def apply_parse_status(
    files: DataFrame, parsed: DataFrame, as_of: datetime | None = None
) -> DataFrame:
    """The file snapshot after a parse; files that were not parsed are unchanged."""
    outcome = parsed.select("RawId", F.lit(True).alias("_seen"), F.col("Problem").alias("_problem"))
    seen = F.col("_seen").isNotNull()
    good = seen & F.col("_problem").isNull()
    return (
        files.join(outcome, "RawId", "left")
        .withColumn(
            "ProcessStatus",
            F.when(good, "PARSED").when(seen, "PARSE_FAILED").otherwise(F.col("ProcessStatus")),
        )
        .withColumn("ParsedDateTime", F.when(good, clock(as_of)).otherwise(F.col("ParsedDateTime")))
        .withColumn(
            "ErrorMessage", F.when(seen, F.col("_problem")).otherwise(F.col("ErrorMessage"))
        )
        .drop("_seen", "_problem")
    )


def replace_results(existing: DataFrame, parsed_ids: DataFrame, fresh: DataFrame) -> DataFrame:
    """A parsed table after a re-parse: earlier rows of the re-parsed files give way."""
    kept = existing.join(parsed_ids.select("RawId"), "RawId", "left_anti")
    return kept.select(*existing.columns).unionByName(fresh.select(*existing.columns))


def envelope_check(files: DataFrame) -> DataFrame:
    """One reason per file whose control totals do not reconcile, NULL otherwise.

    Checked in this order: empty, encoding, ISA/IEA control number, duplicate
    ISA control number, GS present, ST*940 present, ST closed, ST/SE totals and
    GS/GE totals.
    """

    def element_list(name: str, position: int) -> Column:
        return F.transform(
            F.filter("segments", lambda s: s["id"] == name), lambda s: _element(s, position)
        )

    def count_of(name: str) -> Column:
        return F.size(F.filter("segments", lambda s: s["id"] == name))

    isa = _first_segment("ISA")
    iea = _first_segment("IEA")
    order_starts = F.filter("segments", _is_order_start)

    def loop_differs(block: Column) -> Column:
        start = first_where(block["segments"], lambda s: s["id"] == "ST")
        trailer = F.element_at(block["segments"], -1)
        counted = block["se"] - start["seq"] + 1
        return start.isNotNull() & (
            ~safe_int(_element(trailer, 1)).eqNullSafe(counted)
            | ~_element(start, 2).eqNullSafe(_element(trailer, 2))
        )

    group_total = F.aggregate(
        element_list("GE", 1),
        F.lit(0).cast("bigint"),
        lambda acc, n: acc + F.coalesce(safe_int(n).cast("bigint"), F.lit(0)),
    )
    facts = split_blocks(files.select("RawId", "FileName", "RawEDIText")).select(
        "RawId",
        "FileName",
        _element(isa, 13).alias("_isa13"),
        (F.size("segments") == 0).alias("_empty"),
        F.coalesce(F.col("RawEDIText").rlike(r"[^\x00-\x7F]"), F.lit(False)).alias("_encoding"),
        (_element(isa, 13).isNull() | ~_element(isa, 13).eqNullSafe(_element(iea, 2))).alias("_isa"),
        (count_of("GS") == 0).alias("_no_gs"),
        (F.size(order_starts) == 0).alias("_no_st"),
        F.exists("open_tail", lambda s: s["id"] == "ST").alias("_truncated"),
        F.exists("blocks", loop_differs).alias("_st_se"),
        (
            (group_total != count_of("ST"))
            | ~element_list("GS", 6).eqNullSafe(element_list("GE", 2))
            | ~safe_int(_element(iea, 1)).eqNullSafe(count_of("GS"))
        ).alias("_gs_ge"),
    )
    # Two uses follow; the facts are small, the texts are not read again.
    facts = written_once(facts, "envelope-facts")
    # Only control numbers seen more than once travel to the join.
    repeated = (
        facts.where(F.col("_isa13").isNotNull())
        .groupBy("_isa13")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select("_isa13", F.lit(True).alias("_duplicate"))
    )
    reason = F.lit(None).cast("string")
    for name in reversed(list(S.ENVELOPE_REASONS)):
        reason = F.when(F.coalesce(F.col(f"_{name}"), F.lit(False)), S.ENVELOPE_REASONS[name]).otherwise(reason)
    return facts.join(repeated, "_isa13", "left").select("RawId", "FileName", reason.alias("Reason"))


def _cut(lines: DataFrame, max_lines: int) -> DataFrame:
    """Lines of large orders with ``_set``, the run of ``max_lines`` they fall in by SortKey.

    Lines are dealt out by ranges of order and SortKey, so the number of a
    range never decreases along an order, and an order is numbered range by
    range.  They are written once, since both steps of the numbering must see
    the same ranges.
    """
    spark = lines.sparkSession
    path = scratch_path(spark, "large-orders")
    dealt = lines.repartitionByRange("OrderId", "SortKey", "_w01").withColumn("_range", F.spark_partition_id())
    dealt.write.parquet(path)
    kept = spark.read.schema(dealt.schema).parquet(path)
    placed = numbered(kept, ["OrderId"], [F.col("SortKey"), F.col("_w01")], F.col("_range"), "_place")
    return placed.withColumn("_set", F.floor((F.col("_place") - 1) / F.lit(max_lines))).drop("_range", "_place")


def _file_parts(orders: DataFrame, oversized: DataFrame, max_transactions: int) -> DataFrame:
    """(OrderId, _set, _file, _control) for the sets of those RawIds that outgrow one file.

    The sets of a RawId are counted over all its orders.  Every file after the
    first gets a control number of its own, after the highest given one.
    """
    sets = F.coalesce("_sets", F.lit(1))
    counted = orders.select("RawId", "OrderId").join(oversized, "OrderId", "left").withColumn("_sets", sets)
    crowded = (
        counted.groupBy("RawId").agg(F.sum("_sets").alias("_all")).where(F.col("_all") > max_transactions)
    )
    each = counted.join(crowded.select("RawId"), "RawId", "left_semi").select(
        "RawId", "OrderId", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_sets") - 1)).alias("_set")
    )
    order = [F.col("OrderId"), F.col("_set")]
    placed = numbered(each, ["RawId"], order, F.floor(F.col("OrderId") / 1024), "_place").withColumn(
        "_file", F.floor((F.col("_place") - 1) / F.lit(max_transactions))
    )
    further = placed.where("_file > 0").select("RawId", "_file").distinct().withColumn("_one", F.lit(1))
    ranked = numbered(
        further, ["_one"], [F.col("RawId"), F.col("_file")], F.floor(F.col("RawId") / 1024), "_rank"
    )
    top = orders.agg(F.max(F.col("ControlNumber").cast("bigint")).alias("top")).scalar()
    number = top + F.col("_rank")
    control = F.when(number <= 999_999_999, F.lpad(number.cast("string"), 9, "0")).otherwise(
        F.raise_error(F.lit("control numbers are used up"))
    )
    own = ranked.select("RawId", "_file", control.alias("_control"))
    return placed.join(own, ["RawId", "_file"], "left").select("OrderId", "_set", "_file", "_control")


def render_940(
    orders: DataFrame,
    lines: DataFrame,
    max_lines: int = LINES_PER_TRANSACTION,
    max_transactions: int = TRANSACTIONS_PER_FILE,
) -> DataFrame:
    """Write orders as 940 interchanges, the inverse of the parse.

    ``orders``: RawId, OrderId, Sender, Receiver, ControlNumber, DateText,
    OrderNumber, ShipDate, ShipToName, ShipToId.  ``lines``: OrderId, SortKey
    (a struct), Quantity, UOM, Qualifier, Sku (texts).

    The standard allows 9,999 line loops per transaction set; a larger order
    continues in further sets with the same order number, its lines in SortKey
    order throughout.  A file holds ``max_transactions`` sets, counted over all
    orders of its RawId; the rest continue in the next ``FilePart``, under a
    control number of its own.  So the lines and sets gathered into one text are
    bounded and every line is written.
    """
    if not 0 < max_transactions <= 9_999:
        raise ValueError("set control numbers have four digits")
    segment = F.concat_ws("*", F.lit("W01"), "Quantity", "UOM", "Qualifier", "Sku")
    written = lines.select("OrderId", "SortKey", segment.alias("_w01"))
    oversized = (
        lines.groupBy("OrderId")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > max_lines)
        .select("OrderId", F.ceil(F.col("_n") / F.lit(max_lines)).alias("_sets"))
    )
    big = not oversized.isEmpty()
    keys = ["OrderId"]
    usual = written.withColumn("_set", F.lit(0).cast("bigint"))
    if big:
        keys = ["OrderId", "_set"]
        usual = usual.join(oversized, "OrderId", "left_anti").unionByName(
            _cut(written.join(oversized, "OrderId", "left_semi"), max_lines)
        )
    # A struct inside a struct is dear to compare, so the fields of SortKey stand beside each other; NULL comes first.
    place = [F.col("SortKey").isNotNull().alias("_given")]
    place += [F.col(f"SortKey.`{f}`").alias(f"_by{i}") for i, f in enumerate(lines.schema["SortKey"].dataType.names)]
    sets = (
        # Collecting shrinks nothing, so rows are moved first and gathered after.
        usual.repartition(*keys)
        .groupBy(*keys)
        .agg(
            F.sort_array(F.collect_list(F.struct(*place, "_w01"))).alias("_sorted"),
            *([] if big else [F.lit(0).cast("bigint").alias("_set")]),
        )
        .withColumn("_lines", F.transform("_sorted", lambda x: x["_w01"]))
        .select(
            "OrderId",
            "_set",
            F.array_join("_lines", "~").alias("_body"),
            F.size("_lines").alias("_count"),
        )
    )
    bodies = (
        orders.join(sets, "OrderId", "left")
        .withColumn("_set", F.coalesce("_set", F.lit(0)))
        .withColumn("_count", F.coalesce("_count", F.lit(0)))
        .withColumn(
            "_head",
            F.concat_ws(
                "~",
                F.concat_ws("*", F.lit("W05"), F.lit("N"), "OrderNumber", F.lit(""), "ShipDate"),
                F.concat_ws("*", F.lit("N1"), F.lit("ST"), "ShipToName", F.lit("9"), "ShipToId"),
                "_body",
            ),
        )
    )
    most = orders.groupBy("RawId").count().agg(F.max("count")).first()[0] or 0
    if big or most > max_transactions:
        bodies = bodies.join(_file_parts(orders, oversized, max_transactions), ["OrderId", "_set"], "left")
    else:
        bodies = bodies.withColumn("_file", F.lit(0).cast("bigint")).withColumn("_control", F.lit(None).cast("string"))
    bodies = bodies.withColumn("_file", F.coalesce("_file", F.lit(0))).withColumn(
        "ControlNumber", F.coalesce("_control", "ControlNumber")
    )
    grouped = bodies.repartition("RawId", "_file").groupBy("RawId", "_file").agg(
        F.sort_array(
            F.collect_list(F.struct("OrderId", "_set", "_head", F.col("_count").alias("n")))
        ).alias("_sets"),
        F.min_by(F.struct("Sender", "Receiver", "ControlNumber", "DateText"), "OrderId").alias("_e"),
    )
    control = F.col("_e.ControlNumber")
    transaction = F.transform(
        "_sets",
        lambda t, i: F.concat_ws(
            "~",
            F.concat(F.lit("ST*940*"), F.lpad((i + 1).cast("string"), 4, "0")),
            t["_head"],
            F.concat(
                F.lit("SE*"),
                (t["n"] + 4).cast("string"),
                F.lit("*"),
                F.lpad((i + 1).cast("string"), 4, "0"),
            ),
        ),
    )
    text = F.concat(
        F.concat_ws(
            "~",
            F.concat(
                F.lit("ISA*00*          *00*          *ZZ*"),
                F.coalesce("_e.Sender", F.lit("")),
                F.lit("*ZZ*"),
                F.col("_e.Receiver"),
                F.lit("*"),
                F.substring("_e.DateText", 3, 6),
                F.lit("*1200*U*00401*"),
                control,
                F.lit("*0*P*>"),
            ),
            F.concat(
                F.lit("GS*OW*"),
                F.coalesce("_e.Sender", F.lit("")),
                F.lit("*"),
                F.col("_e.Receiver"),
                F.lit("*"),
                F.col("_e.DateText"),
                F.lit("*1200*"),
                control.cast("bigint").cast("string"),
                F.lit("*X*004010"),
            ),
            F.array_join(transaction, "~"),
            F.concat(
                F.lit("GE*"),
                F.size("_sets").cast("string"),
                F.lit("*"),
                control.cast("bigint").cast("string"),
            ),
            F.concat(F.lit("IEA*1*"), control),
        ),
        F.lit("~"),
    )
    return grouped.select("RawId", F.col("_file").alias("FilePart"), text.alias("RawEDIText"))
