"""Quality rules: text statistics, and decision lists learned from labelled documents."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaywork.llm.common import packed, settle, uniform, unpacked

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = " \t\n\x0b\f\r"
#: What the base rules count and allow.  Fixed values.
SYMBOLS = "#*$%&|<>"
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20

#: Counts of a text.  ``n_lines`` are the lines with a word.
COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_distinct",
    "n_upper",
    "n_digits",
    "n_ends",
    "n_marks",
)


def _ranked(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Equal numbers for equal pairs, in 0, 1, 2, ..."""
    return np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1]


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words that lie in some window of ``window`` words that stands twice or more."""
    if len(words) <= window:
        return 0
    numbers: dict[str, int] = {}
    single = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    if len(numbers) == len(words):
        return 0
    ranks = single
    for width in range(1, window):  # ranks of windows one word longer, so that equal ranks are equal windows
        ranks = _ranked(ranks[:-1], single[width:])
    often = np.bincount(ranks)[ranks] > 1
    if not often.any():
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:-window] += often
    edges[window:] -= often
    return int((np.cumsum(edges[:-1]) > 0).sum())


def counts_of(text: str) -> tuple[int, ...]:
    """The values of ``COUNTS`` for one whole text."""
    words = _WORD.findall(text)
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    latin = (codes >= 0xC0) & (codes <= 0xDE) & (codes != 0xD7)
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(set(words)),
        int((((codes >= 65) & (codes <= 90)) | latin).sum()),
        int(((codes >= 48) & (codes <= 57)).sum()),
        sum(map(text.count, ".!?")),
        sum(map(text.count, ",;:-()\"'")),
    )


@F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def _counted(texts: pa.Array) -> pa.Array:
    rows = [counts_of(t.as_py() or "") for t in texts]
    columns = list(zip(*rows, strict=True)) or [()] * len(COUNTS)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(COUNTS))


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.col(part) / F.nullif(F.col(whole), F.lit(0)), F.lit(0.0))


def statistics() -> dict[str, Column]:
    """What conditions may test, as columns over ``COUNTS``; shares of nothing are zero."""
    return {
        "words": F.col("n_words").cast("double"),
        "word length": _share("word_chars", "n_words"),
        "symbols a character": _share("n_symbols", "word_chars"),
        "repeated lines a line": _share("n_dup_lines", "n_lines"),
        "repeated words a word": _share("n_repeat_words", "n_words"),
        "words a line": _share("n_words", "n_lines"),
        "distinct words a word": _share("n_distinct", "n_words"),
        "capitals a character": _share("n_upper", "word_chars"),
        "digits a character": _share("n_digits", "word_chars"),
        "sentence ends a word": _share("n_ends", "n_words"),
        "other marks a word": _share("n_marks", "n_words"),
    }


def base_failed() -> Column:
    words, repeated = F.col("n_words"), F.col("n_repeat_words")
    return (words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * words)


@dataclass(frozen=True)
class Condition:
    statistic: str
    least: bool
    threshold: float

    def holds(self, values: np.ndarray, names: list[str]) -> np.ndarray:
        column = values[:, names.index(self.statistic)]
        return column >= self.threshold if self.least else column <= self.threshold

    def column(self) -> Column:
        value = statistics()[self.statistic]
        return value >= self.threshold if self.least else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.least else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class Options:
    """Bounds of a fit.

    ``max_rows``: labelled documents that are learned from, the least by a hash
    of their key; a third of them prunes.  A rule is kept if on the pruning rows
    it covers ``least_rows`` bad ones and is right in ``precision`` of its cases.
    """

    max_rows: int = 20_000
    least_rows: int = 3
    precision: float = 0.9
    max_rules: int = 24
    max_conditions: int = 5
    seed: int = 11


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; a document goes by the first that covers it and stays if none does."""

    rules: tuple[Rule, ...]

    def column(self) -> Column:
        """The number of the first rule that covers a row, counted from 1, else 0; over ``COUNTS``."""
        chosen = F.lit(0)
        for number in range(len(self.rules), 0, -1):
            whole = self.rules[number - 1][0].column()
            for condition in self.rules[number - 1][1:]:
                whole = whole & condition.column()
            chosen = F.when(whole, number).otherwise(chosen)
        return chosen

    def __str__(self) -> str:
        lines = [f"{n}. drop if {' and '.join(map(str, r))}" for n, r in enumerate(self.rules, 1)]
        return "\n".join([*lines, "else keep"])


def _covered(rule: Rule, values: np.ndarray, names: list[str]) -> np.ndarray:
    held = np.ones(len(values), bool)
    for condition in rule:
        held &= condition.holds(values, names)
    return held


def _best_condition(values: np.ndarray, bad: np.ndarray, names: list[str]) -> tuple[float, Condition | None]:
    """The condition of the greatest information gain on the rows that a rule covers so far."""
    before = np.log2(bad.mean())
    best: tuple[float, Condition | None] = (1e-9, None)
    for at, name in enumerate(names):
        order = np.argsort(values[:, at], kind="stable")
        value, hits = values[order, at], np.cumsum(bad[order])
        edge = np.flatnonzero(value[:-1] < value[1:])
        if not len(edge):
            continue
        middle = (value[edge] + value[edge + 1]) / 2
        for least in (False, True):
            p = hits[-1] - hits[edge] if least else hits[edge]
            n = len(value) - 1 - edge if least else edge + 1
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / n) - before), -1.0)
            top = int(np.argmax(gain))
            if gain[top] > best[0]:
                best = float(gain[top]), Condition(name, least, float(middle[top]))
    return best


def _grown(values: np.ndarray, bad: np.ndarray, names: list[str], o: Options) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(values), bool)
    while len(rule) < o.max_conditions and bad[inside].any() and not bad[inside].all():
        condition = _best_condition(values[inside], bad[inside], names)[1]
        if condition is None:
            break
        rule += (condition,)
        inside &= condition.holds(values, names)
    return rule


def _pruned(rule: Rule, values: np.ndarray, bad: np.ndarray, names: list[str]) -> tuple[Rule, int, int]:
    """The beginning of a rule that does best on the pruning rows, with the bad and good ones it covers."""
    best = None
    for size in range(1, len(rule) + 1):
        held = _covered(rule[:size], values, names)
        p, n = int((held & bad).sum()), int((held & ~bad).sum())
        worth = (p - n) / (p + n) if p + n else -1.0
        if best is None or worth > best[0]:
            best = worth, rule[:size], p, n
    return best[1:]


def cover(values: np.ndarray, bad: np.ndarray, prunes: np.ndarray, names: list[str], o: Options) -> DecisionList:
    """Sequential covering: grow a rule on some rows, prune it on the others, take what it covers away, go on."""
    rules: list[Rule] = []
    open_rows = np.ones(len(values), bool)
    while len(rules) < o.max_rules:
        grow, prune = open_rows & ~prunes, open_rows & prunes
        if not bad[grow].any() or bad[grow].all():
            break
        rule = _grown(values[grow], bad[grow], names, o)
        if not rule:
            break
        rule, p, n = _pruned(rule, values[prune], bad[prune], names)
        if p < o.least_rows or p < o.precision * (p + n):
            break
        rules.append(rule)
        open_rows &= ~_covered(rule, values, names)
    return DecisionList(tuple(rules))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, COUNTS..., base_failed) for every document; whole texts, null as empty.  No shuffle."""
    counted = packed(docs).withColumn("counts", _counted(F.col(f"row.`{text}`")))
    return counted.select("row", "counts.*").withColumn("base_failed", base_failed())


def fit_rules(
    docs: DataFrame,
    labels: DataFrame,
    options: Options = Options(),
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> DecisionList:
    """Learn a decision list from documents labelled 1 (good) or 0 (bad).

    Labels without a key or value are left out; of several for a key the least
    counts.  The learned rows are bounded by ``max_rows``, so their labels may
    be broadcast and their statistics fitted in one place.  Documents that the
    base rules reject are not learned from.  Without rows of both labels the
    list is empty and keeps everything.
    """
    o = options
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    chosen = (
        known.groupBy(F.col(key).alias("key"))
        .agg(F.min(F.col(label).cast("int")).alias("label"))
        .orderBy(uniform("key", seed=o.seed), "key")
        .limit(o.max_rows)
    )
    chosen = settle(chosen, "labelled")
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("body"))
    # No filter on the counts here: Spark would move it, and the counting, below the join.
    found = measured(rows.join(F.broadcast(chosen), "key"), "body")
    names = list(statistics())
    prunes = (uniform("row.key", seed=o.seed + 1) < 1 / 3).alias("prunes")
    columns = [F.col("row.key").alias("key"), F.col("row.label").alias("label"), prunes, "base_failed"]
    local = found.select(*columns, *[c.alias(n) for n, c in statistics().items()]).toArrow()
    local = local.filter(pc.invert(local["base_failed"]))
    if not local.num_rows:
        return DecisionList(())
    values = np.column_stack([local[n].to_numpy() for n in names]).astype(float)
    # The order of the rows must not depend on how Spark read them.
    order = np.lexsort([*values.T, local["key"].to_numpy()])
    bad = local["label"].to_numpy()[order] == 0
    return cover(values[order], bad, local["prunes"].to_numpy(zero_copy_only=False)[order], names, o)


def judge(docs: DataFrame, rules: DecisionList, text: str = "text") -> DataFrame:
    """Every document with its counts, ``base_failed``, ``rule`` and ``kept``.

    ``rule`` is the number of the first rule that covers a document, 0 if none;
    ``kept`` is true if it passes the base rules and no rule covers it.

    Null and empty texts have no words and fail the base rules.  Repeated rows:
    each is returned.  Columns that bear an added name are replaced.  Empty
    input: no rows.  No shuffle.
    """
    ruled = measured(docs, text).withColumn("rule", rules.column())
    kept = ~F.col("base_failed") & (F.col("rule") == 0)
    return unpacked(ruled.withColumn("kept", kept), [*COUNTS, "base_failed", "rule", "kept"])
