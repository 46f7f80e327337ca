"""Repair of conversation structure: turns aligned to the alternating grammar (s?(ua)+)?."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaywork.functions.skew import numbered
from quaywork.llm.common import settle

#: Costs of the edits.  Fixed values.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: What is white space, and what ends a finished text.  Fixed values.
BLANKS, ENDS = " \t\n\x0b\f\r", ".!?"
#: Turns aligned at once, and pieces of a conversation combined at once.
SLICE, FAN = 64, 64
#: Turn numbers that share a slice while turns are counted.
TURNS = 512
NOTHING, FAR = "", 1 << 40
NAMES = {"u": "user", "a": "assistant"}

PIECES = T.ArrayType(
    T.StructType(
        [T.StructField(c, T.StringType()) for c in ("start", "end")]
        + [T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())]
    )
)

_PIECE_TYPE = pa.list_(
    pa.struct([("start", pa.string()), ("end", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])
)


@dataclass(frozen=True)
class Ending:
    """Wagner-Fischer costs from every turn on to the alternating string that ends in ``end``.

    ``costs[i][m]`` is the least cost of turning the turns from i on into the
    last m letters of the grammar string.  These letters are the same for every
    length, so one table serves all feasible lengths.  Ukkonen's band: a cell
    is filled only if the insertions or deletions that its diagonal needs cost
    no more than the incumbent.
    """

    letters: str
    end: str
    incumbent: int

    def wanted(self, m: int) -> str:
        return self.end if m % 2 else "ua"[self.end == "u"]

    def table(self) -> list[list[int]]:
        n, more, fewer = len(self.letters), self.incumbent // INSERT, self.incumbent // DELETE
        wanted = [self.wanted(m) for m in range(n + more + 2)]
        below = [INSERT * m for m in range(more + 1)]
        costs = [below]
        for i in range(n - 1, -1, -1):
            letter, rest = self.letters[i], n - i
            own, extra = letter.lower(), TRUNCATED if letter.isupper() else 0
            row = [FAR] * (rest + more + 1)
            for m in range(max(0, rest - fewer), rest + more + 1):
                best = below[m] + DELETE if m < len(below) else FAR
                if m:
                    best = min(best, row[m - 1] + INSERT)
                    if letter != "x":
                        best = min(best, below[m - 1] + extra + (0 if own == wanted[m] else REROLE))
                row[m] = best
            costs.append(row)
            below = row
        return costs[::-1]

    def audit(self, costs: list[list[int]], i: int, m: int) -> str:
        """The ASCII-least of the cheapest edits from a cell on: at each step the least letter that keeps the cost."""
        letters, steps, n = self.letters, [], len(self.letters)
        while i < n or m:
            cost = costs[i][m]
            if i < n and m < len(costs[i + 1]) and costs[i + 1][m] + DELETE == cost:
                steps.append("D")
                i += 1
            elif m and costs[i][m - 1] + INSERT == cost:
                steps.append("I")
                m -= 1
            else:
                steps.append("K" if letters[i].lower() == self.wanted(m) else "R")
                i, m = i + 1, m - 1
        return "".join(steps)


def _first_guess(letters: str, start: str, end: str) -> int:
    """The cost of one feasible repair: delete what must go, rerole what does not fit, close with an insertion."""
    cost, last = 0, start
    for letter in letters:
        if letter == "x":
            cost += DELETE
            continue
        cost += TRUNCATED if letter.isupper() else 0
        last = "a" if last == "u" else "u"
        cost += 0 if letter.lower() == last else REROLE
    # Up to two insertions reach the wanted end from wherever this stops.
    return cost + (INSERT * (1 + (last not in "ua" or last == NOTHING)) if last != end else 0)


def _after_system(letters: str, table: Ending, costs: list[list[int]], m: int, incumbent: int) -> tuple[int, str]:
    """The best repair to s and m letters more: turns before the kept s go."""
    best = (FAR, "")
    for i, letter in enumerate(letters):
        if letter.lower() == "s" and m < len(costs[i + 1]):
            cost = DELETE * i + (TRUNCATED if letter == "S" else 0) + costs[i + 1][m]
            if cost <= min(incumbent, best[0]):
                best = min(best, (cost, "D" * i + "K" + table.audit(costs, i + 1, m)))
    return best


@lru_cache(maxsize=20_000)
def repairs(letters: str, start: str = NOTHING, ends: tuple[str, ...] = (NOTHING, "a")) -> dict[str, tuple[int, str]]:
    """The cheapest repair of some turns that follow letter ``start`` and end in each of ``ends``.

    ``letters`` has one for each turn: s, u, a or o (another role), in upper case
    for a truncated text, x for a turn that must go.  Every feasible length of
    the grammar string is compared, the nearest to the number of turns first;
    each incumbent narrows what is tried next.  Equal costs go by audit.
    """
    n, found = len(letters), {}
    for end in ends:
        if end == start:
            found[end] = (DELETE * n, "D" * n)
        if end == NOTHING:
            continue
        if end == "s":
            if start == NOTHING:
                kept = [(TRUNCATED if c == "S" else 0, -i) for i, c in enumerate(letters) if c in "sS"]
                if kept:
                    extra, at = min(kept)
                    found[end] = (DELETE * (n - 1) + extra, "D" * -at + "K" + "D" * (n + at - 1))
            continue
        best = found.get(end, (FAR, ""))
        incumbent = min(best[0], _first_guess(letters, start, end))
        table = Ending(letters, end, incumbent)
        costs = table.table()
        follows = "a" if start == "u" else "u"
        for length in sorted(range(1, n + incumbent // INSERT + 1), key=lambda m: abs(m - n)):
            least = INSERT * (length - n) if length > n else DELETE * (n - length)
            if least > incumbent:
                continue
            if table.wanted(length) == follows and costs[0][length] <= incumbent:
                best = min(best, (costs[0][length], table.audit(costs, 0, length)))
            if start == NOTHING and length > 1 and table.wanted(length - 1) == "u":
                best = min(best, _after_system(letters, table, costs, length - 1, incumbent))
            incumbent = min(incumbent, best[0])
        if best[0] < FAR:
            found[end] = best
    return found


def _combined(pieces: list[list[dict]]) -> list[dict]:
    """Repairs of consecutive pieces as those of the whole.

    No audit of a piece is a proper prefix of an equally dear one with the same
    ends (it would lack insertions, which cost), so least audits stay least when
    they are joined.
    """
    whole = {(r["start"], r["end"]): (r["cost"], r["audit"]) for r in pieces[0]}
    for piece in pieces[1:]:
        longer: dict[tuple[str, str], tuple[int, str]] = {}
        for (start, middle), (cost, audit) in whole.items():
            for r in piece:
                if r["start"] == middle:
                    candidate = (cost + r["cost"], audit + r["audit"])
                    key = start, r["end"]
                    if key not in longer or candidate < longer[key]:
                        longer[key] = candidate
        whole = longer
    return [{"start": s, "end": e, "cost": c, "audit": a} for (s, e), (c, a) in whole.items()]


@F.arrow_udf(PIECES)
def _repaired_whole(letters: pa.Array) -> pa.Array:
    rows = []
    for value in letters:
        found = repairs(value.as_py())
        rows.append([{"start": "", "end": e, "cost": c, "audit": a} for e, (c, a) in found.items()])
    return pa.array(rows, _PIECE_TYPE)


@F.arrow_udf(PIECES)
def _repaired_piece(letters: pa.Array) -> pa.Array:
    rows, states = [], (NOTHING, "s", "u", "a")
    for value in letters:
        row = []
        for start in states:
            found = repairs(value.as_py(), start, states)
            row += [{"start": start, "end": e, "cost": c, "audit": a} for e, (c, a) in found.items()]
        rows.append(row)
    return pa.array(rows, _PIECE_TYPE)


@F.arrow_udf(PIECES)
def _combined_pieces(runs: pa.Array) -> pa.Array:
    return pa.array([_combined([x["pieces"] for x in run.as_py()]) for run in runs], _PIECE_TYPE)


def faulty_turns(
    logs: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(name, id, turn, place, role, text, kind, fault) for every turn, counted from 1.

    Turns go by turn number, null first, then role and text.  ``kind`` is the
    first letter of the role if that is s, u or a, else o.  ``fault`` is the
    first that holds: blank, duplicate (role and text stood earlier in the
    conversation), truncated; else an empty text.  Null roles and texts are one
    space.
    """
    spaced = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role, text)]
    number = F.col(f"`{turn}`").cast("bigint")
    turns = logs.select(
        F.coalesce(F.concat(F.lit("="), F.col(f"`{conversation}`").cast("string")), F.lit("")).alias("name"),
        F.col(f"`{conversation}`").alias("id"),
        number.alias("turn"),
        spaced[0].alias("role"),
        spaced[1].alias("text"),
    )
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    by = F.coalesce(F.floor(F.col("turn") / TURNS), F.lit(-(2**62)))
    first = F.substring("role", 1, 1)
    placed = numbered(turns, ["name"], order, by, "place").select(
        "*",
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("digest"),
        F.when(first.isin("s", "u", "a"), first).otherwise("o").alias("kind"),
    )
    placed = settle(placed, "turns")
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = (
        F.when(trimmed == "", "blank")
        .when(F.col("place") > F.col("earliest"), "duplicate")
        .when(~F.substring(trimmed, -1, 1).isin(*ENDS), "truncated")
        .otherwise("")
    )
    copies = placed.groupBy("name", "digest").agg(F.min("place").alias("earliest"), F.count(F.lit(1)).alias("n"))
    repeated = copies.where("n > 1").drop("n")
    joined = placed.join(repeated, ["name", "digest"], "left")
    return joined.withColumn("fault", fault).drop("digest", "earliest")


def _slices(turns: DataFrame) -> DataFrame:
    """(name, slice, letters, kinds): the turns of a conversation in strings of at most ``SLICE`` letters."""
    letter = F.when(F.col("fault").isin("blank", "duplicate"), "x").otherwise(
        F.when(F.col("fault") == "truncated", F.upper("kind")).otherwise(F.col("kind"))
    )
    row = F.struct("place", letter.alias("letter"), "kind")
    gathered = turns.groupBy("name", F.floor((F.col("place") - 1) / SLICE).alias("slice")).agg(
        F.sort_array(F.collect_list(row)).alias("rows")
    )

    def text(field: str) -> Column:
        return F.array_join(F.transform("rows", lambda x: x[field]), "")

    return gathered.select("name", "slice", text("letter").alias("letters"), text("kind").alias("kinds"))


def _illegal(slices: DataFrame) -> DataFrame:
    """(name, illegal): neighbouring kinds other than su, ua and au, those between slices included."""
    before = F.lag(F.substring("kinds", -1, 1)).over(W.partitionBy("name").orderBy("slice"))
    line = F.concat(F.coalesce(before, F.lit("")), "kinds")
    pairs = F.transform(F.sequence(F.lit(1), F.length("line")), lambda i: F.substring(F.col("line"), i, F.lit(2)))
    bad = F.filter(pairs, lambda p: (F.length(p) == 2) & ~p.isin("su", "ua", "au"))
    counted = slices.withColumn("line", line).select("name", F.size(bad).cast("bigint").alias("bad"))
    return counted.groupBy("name").agg(F.sum("bad").alias("illegal"))


def cheapest_edits(slices: DataFrame) -> DataFrame:
    """(name, cost, audit) from the ``letters`` of each slice.

    Conversations of one slice are aligned at once.  Longer ones are aligned
    slice by slice for every letter before and after, and ``FAN`` neighbours at
    a time are combined until one is left, so a task holds that many pieces.
    """
    top = slices.agg(F.max("slice")).first()[0] or 0
    long = slices.where("slice > 0").select("name").distinct()
    lone = slices.join(long, "name", "left_anti") if top else slices
    done = lone.select("name", _repaired_whole("letters").alias("pieces"))
    if top:
        pieces = slices.join(long, "name", "left_semi").select(
            "name", "slice", _repaired_piece("letters").alias("pieces")
        )
        while top:
            runs = settle(pieces, "pieces").groupBy("name", F.floor(F.col("slice") / FAN).alias("slice")).agg(
                F.sort_array(F.collect_list(F.struct("slice", "pieces"))).alias("run")
            )
            pieces, top = runs.select("name", "slice", _combined_pieces("run").alias("pieces")), top // FAN
        done = done.unionByName(pieces.select("name", "pieces"))
    ended = F.filter("pieces", lambda p: (p["start"] == "") & p["end"].isin("", "a"))
    best = F.array_min(F.transform(ended, lambda p: F.struct(p["cost"].alias("cost"), p["audit"].alias("audit"))))
    return done.select("name", best.alias("best")).select("name", "best.cost", "best.audit")


def audited(turns: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """One row a conversation of ``turns`` (of ``faulty_turns``, written): its faults, and the cheapest edits.

    Returns the conversation id, name, gaps, blank, duplicate, truncated,
    illegal, cost and audit.
    """
    slices = settle(_slices(turns), "slices")

    def of(fault: str) -> Column:
        return F.count(F.when(F.col("fault") == fault, 1)).alias(fault)

    numbers = turns.groupBy("name", "turn").agg(F.min("id").alias("id"), *[of(f) for f in ("blank", "duplicate", "truncated")])
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0).cast("bigint"))
    facts = numbers.groupBy("name").agg(
        F.min("id").alias(conversation),
        gaps.alias("gaps"),
        *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")],
    )
    return facts.join(_illegal(slices), "name").join(cheapest_edits(slices), "name")


def _unfolded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each edit: the place of the turn it concerns (0 for an insertion), and the new role."""
    for batch in batches:
        for name, audit in zip(batch.column(0), batch.column(1), strict=True):
            steps = audit.as_py()
            odd = (len(steps) - steps.count("D")) % 2
            place = position = 0
            for at in range(0, len(steps), 10_000):
                out: list[tuple] = []
                for step in steps[at : at + 10_000]:
                    place += step != "I"
                    if step != "D":
                        role = NAMES["ua"[(position + odd) % 2]] if step in "RI" else None
                        position += 1
                        out.append((position, 0 if step == "I" else place, step, role))
                columns = list(zip(*out, strict=True)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name.as_py()] * len(out), pa.string()),
                        *(pa.array(c, t) for c, t in zip(columns, _EDIT_TYPES, strict=True)),
                    ],
                    names=["name", "position", "place", "edit", "new_role"],
                )


_EDIT_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string()]


def repaired_turns(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """(name, position, role, text, edit): the turns after the cheapest edits, counted from 1.

    ``edit`` is K (kept), R (new role) or I (inserted, empty text); deleted
    turns are left out.
    """
    edits = audits.select("name", "audit").mapInArrow(
        _unfolded, "name string, position bigint, place bigint, edit string, new_role string"
    )
    own = turns.select("name", "place", "role", "text")
    return edits.join(own, ["name", "place"], "left").select(
        "name",
        "position",
        F.coalesce("new_role", "role").alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        "edit",
    )


def joined_digests(lines: DataFrame) -> DataFrame:
    """(name, digest): SHA-256 of the ``line`` values of each name, in order of ``position`` and joined by newlines.

    A digest has to be fed in order; lines stream past in sorted runs, so a
    task holds one batch, however long a conversation is.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None

        def closed(rows: list[tuple[str, str]]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["name", "digest"])

        for batch in batches:
            done = []
            for key, line in zip(batch.column(0), batch.column(1), strict=True):
                key, data = key.as_py(), line.as_py().encode("utf-8", "surrogatepass")
                if key != name:
                    if state is not None:
                        done.append((name, state.hexdigest()))
                    name, state = key, hashlib.sha256(data)
                else:
                    state.update(b"\n")
                    state.update(data)
            yield closed(done)
        if state is not None:
            yield closed([(name, state.hexdigest())])

    ordered = lines.repartition("name").sortWithinPartitions("name", "position").select("name", "line")
    return ordered.mapInArrow(stream, "name string, digest string")


def repair(
    logs: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The audits of all conversations and their repaired turns.

    The first result has one row a conversation (see :func:`audited`), the
    second one row for each turn that is left (see :func:`repaired_turns`), tied
    to the first by ``name``.

    Turn numbers may be null (first), repeat (then by role and text) or have
    gaps.  Null roles and texts are one space, so a null text is blank.  Rows
    without conversation id are one conversation.  Repeated rows are duplicate
    turns.  Other columns are left out.  Empty input: no rows.
    """
    turns = settle(faulty_turns(logs, conversation, turn, role, text), "faulty")
    audits = settle(audited(turns, conversation), "audits")
    return audits, repaired_turns(turns, audits)
