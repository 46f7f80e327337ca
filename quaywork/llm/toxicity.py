"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaywork.llm.common import packed, settle, uniform, unpacked

_TERM = re.compile(r"[^\W_]+")


def hashed_terms(text: str, bits: int) -> set[int]:
    """Buckets of the distinct words of a whole text, letters and digits in lower case."""
    mask, digest = (1 << bits) - 1, xxhash.xxh64_intdigest
    return {digest(t) & mask for t in set(_TERM.findall(text.lower()))}


@dataclass(frozen=True)
class Options:
    """Bounds and strengths of a fit.

    ``max_rows``: labelled documents that are learned from, the least by a hash
    of their key.  Every bucket that ``min_rows`` of them hold may carry a
    weight and a vector.  Of the ``ratios`` that one is taken whose machine has
    the least loss on a fifth of these documents set aside: only buckets whose
    likelihood ratio reaches it alone are admitted; 0 admits all, for labels
    that only pairs of terms tell.  A fit takes ``epochs`` passes, and goes on
    until it has made ``least_steps`` batches of 256 rows or seen ``least_seen``
    terms.
    """

    bits: int = 20
    max_rows: int = 20_000
    min_rows: int = 4
    ratios: tuple[float, ...] = (15.0, 0.0)
    rank: int = 4
    epochs: int = 8
    least_steps: int = 2000
    least_seen: int = 30_000_000
    rate: float = 0.1
    penalty: float = 1e-3
    seed: int = 7


class Machine:
    """Bias, a weight and a vector of pair strengths for each kept bucket."""

    def __init__(self, buckets: np.ndarray, bias: float, weights: np.ndarray, pairs: np.ndarray, bits: int):
        self.places = {int(b): i for i, b in enumerate(buckets)}
        self.bias, self.weights, self.pairs, self.bits = bias, weights, pairs, bits
        self.known: dict[str, int] = {}

    def places_of(self, text: str) -> list[int]:
        known, mask = self.known, (1 << self.bits) - 1
        found = set()
        for term in set(_TERM.findall(text.lower())):
            at = known.get(term)
            if at is None:
                if len(known) > 100_000:
                    known.clear()
                at = known[term] = self.places.get(xxhash.xxh64_intdigest(term) & mask, -1)
            found.add(at)
        found.discard(-1)
        return sorted(found)

    def margins(self, rows: list[list[int]]) -> np.ndarray:
        """Bias plus weights plus all pair strengths, in time linear in the terms."""
        out = np.full(len(rows), self.bias)
        for i, row in enumerate(rows):
            if row:
                vectors = self.pairs[row]
                together = vectors.sum(axis=0)
                out[i] += self.weights[row].sum() + 0.5 * (together @ together - (vectors * vectors).sum())
        return out


class Rows:
    """Bounded labelled documents as sparse rows: the columns of all rows one after the other."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray, labels: np.ndarray):
        self.flat, self.sizes, self.labels = flat, sizes, labels
        self.starts = np.cumsum(sizes) - sizes

    def __len__(self) -> int:
        return len(self.sizes)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), self.sizes)

    def picked(self, rows: np.ndarray) -> Rows:
        sizes = self.sizes[rows]
        first = np.cumsum(sizes) - sizes
        at = np.repeat(self.starts[rows] - first, sizes) + np.arange(sizes.sum())
        return Rows(self.flat[at], sizes, self.labels[rows])

    def admitted(self, columns: np.ndarray) -> Rows:
        """The same rows with only the given sorted columns, numbered anew."""
        place = np.searchsorted(columns, self.flat)
        place[place == len(columns)] = 0
        held = columns[place] == self.flat if len(columns) else np.zeros(len(self.flat), bool)
        sizes = np.bincount(self.owners()[held], minlength=len(self))
        return Rows(place[held], sizes, self.labels)

    def margins(self, bias: float, weights: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        owner, vectors, n = self.owners(), pairs[self.flat], len(self)
        together = [np.bincount(owner, vectors[:, k], n) for k in range(pairs.shape[1])]
        own = np.bincount(owner, (vectors**2).sum(axis=1), n)
        return bias + np.bincount(owner, weights[self.flat], n) + 0.5 * (sum(t**2 for t in together) - own)


def _fit(rows: Rows, size: int, o: Options) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic loss by adaptive gradient steps; a batch moves only the columns it holds."""
    rng = np.random.default_rng(o.seed)
    share = float(np.clip(rows.labels.mean(), 1e-3, 1 - 1e-3))
    bias = float(np.log(share / (1 - share)))
    weights, pairs = np.zeros(size), rng.normal(0, 0.05, (size, o.rank))
    if not len(rows.flat):
        return bias, weights, pairs
    seen_b, seen_w, seen_v = 1e-8, np.full(size, 1e-8), np.full((size, o.rank), 1e-8)
    batches = -(-len(rows) // 256)
    passes = max(o.epochs, min(-(-o.least_steps // batches), o.least_seen // len(rows.flat)))
    for _ in range(passes):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 256):
            part = rows.picked(order[at : at + 256])
            if not len(part.flat):
                continue
            used, x = np.unique(part.flat, return_inverse=True)
            owner, vectors, n = part.owners(), pairs[used], len(part)
            each = vectors[x]
            together = np.stack([np.bincount(owner, each[:, k], n) for k in range(o.rank)], axis=1)
            own = np.bincount(owner, (each**2).sum(axis=1), n)
            margin = bias + np.bincount(owner, weights[used][x], n) + 0.5 * ((together**2).sum(axis=1) - own)
            slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - part.labels) / n
            pull = slope[owner][:, None] * (together[owner] - each)
            g_w = np.bincount(x, slope[owner], len(used)) + o.penalty / 10 * weights[used]
            g_v = np.stack([np.bincount(x, pull[:, k], len(used)) for k in range(o.rank)], axis=1)
            g_v += o.penalty * vectors
            g_b = slope.sum()
            seen_b += g_b**2
            seen_w[used] += g_w**2
            seen_v[used] += g_v**2
            bias -= o.rate * g_b / np.sqrt(seen_b)
            weights[used] -= o.rate * g_w / np.sqrt(seen_w[used])
            pairs[used] = vectors - o.rate * g_v / np.sqrt(seen_v[used])
    return float(bias), weights, pairs


def _likelihood_ratios(rows: Rows, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that hold it, G squared of its 2 x 2 table with the label) for each column."""
    n, bad = len(rows), rows.labels.sum()
    held = np.bincount(rows.flat, minlength=size).astype(float)
    a = np.bincount(rows.flat, rows.labels[rows.owners()], size)
    total = np.zeros(size)
    for count, row, column in (
        (a, held, bad),
        (held - a, held, n - bad),
        (bad - a, n - held, bad),
        (n - bad - held + a, n - held, n - bad),
    ):
        expected = row * column / n
        some = (count > 0) & (expected > 0)
        total[some] += 2 * count[some] * np.log(count[some] / expected[some])
    return held, total


def _columns(rows: Rows, size: int, ratio: float, o: Options) -> np.ndarray:
    held, ratios = _likelihood_ratios(rows, size)
    return np.flatnonzero((held >= o.min_rows) & (ratios >= ratio))


def _chosen_ratio(rows: Rows, size: int, o: Options) -> float:
    """Of ``ratios`` the one whose machine loses least on rows it has not seen."""
    aside = np.random.default_rng(o.seed + 1).random(len(rows)) < 0.2
    learned, tried = (rows.picked(np.flatnonzero(m)) for m in (~aside, aside))
    if len(o.ratios) == 1 or not len(tried) or not 0 < learned.labels.sum() < len(learned):
        return o.ratios[0]
    losses = []
    for ratio in o.ratios:
        columns = _columns(learned, size, ratio, o)
        machine = _fit(learned.admitted(columns), len(columns), o)
        signed = tried.admitted(columns).margins(*machine) * (1 - 2 * tried.labels)
        losses.append(float(np.logaddexp(0, signed).mean()))
    return o.ratios[int(np.argmin(losses))]


def fit_machine(
    docs: DataFrame,
    labels: DataFrame,
    options: Options = Options(),
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Machine:
    """Learn from the labelled documents.

    Labels without a key or value are left out; of several for a key the
    largest counts.  The learned rows are bounded by ``max_rows``, so their
    labels may be broadcast and their buckets fitted in one place.  Without
    rows of both labels, or where no bucket is frequent enough, the bias is all.
    """
    o = options
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    chosen = (
        known.groupBy(F.col(key).alias("key"))
        .agg(F.max(F.col(label).cast("int")).alias("label"))
        .orderBy(uniform("key", seed=o.seed), "key")
        .limit(o.max_rows)
    )
    chosen = settle(chosen, "labelled")
    bits = o.bits

    @F.arrow_udf("array<int>")
    def buckets_of(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(hashed_terms(t.as_py() or "", bits)) for t in texts], pa.list_(pa.int32()))

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("body")).join(F.broadcast(chosen), "key")
    rows = settle(rows.select("key", "label", buckets_of("body").alias("buckets")), "terms")
    local = rows.orderBy("key", "buckets").select("label", "buckets").toArrow()
    truth = local["label"].to_numpy().astype(float)
    if not 0 < truth.sum() < len(truth):
        bias = 4.0 if len(truth) and truth.all() else -4.0
        return Machine(np.array([], np.int64), bias, np.zeros(0), np.zeros((0, o.rank)), o.bits)
    lists = local["buckets"].combine_chunks()
    sparse = Rows(lists.flatten().to_numpy().astype(np.int64), np.diff(lists.offsets.to_numpy()), truth)
    size = 1 << o.bits
    columns = _columns(sparse, size, _chosen_ratio(sparse, size, o), o)
    return Machine(columns, *_fit(sparse.admitted(columns), len(columns), o), o.bits)


def toxicity_score(machine: Machine, docs: DataFrame, text: str = "text") -> Column:
    """Probability of label 1 for each whole text; an empty one gets what the bias says."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        model = shared.value
        margins = model.margins([model.places_of(t.as_py() or "") for t in texts])
        return pa.array(1 / (1 + np.exp(-np.clip(margins, -500, 500))), pa.float64())

    return score(F.col(text))


def score_toxicity(docs: DataFrame, machine: Machine, text: str = "text", at: float = 0.5) -> DataFrame:
    """Every document with ``score`` (0 to 1) and ``predicted`` (1 from ``at`` on).

    Whole texts, null as empty.  Repeated rows: each is returned.  Columns that
    bear an added name are replaced.  Empty input: no rows.  No shuffle.
    """
    scored = packed(docs).withColumn("score", toxicity_score(machine, docs, f"row.`{text}`"))
    return unpacked(
        scored.withColumn("predicted", (F.col("score") >= at).cast("int")), ["score", "predicted"]
    )


def keep_clean(docs: DataFrame, machine: Machine, text: str = "text", at: float = 0.5) -> DataFrame:
    """The documents that score below ``at``, with their own columns."""
    scored = packed(docs).withColumn("score", toxicity_score(machine, docs, f"row.`{text}`"))
    return unpacked(scored.where(F.col("score") < at), [])


def held_out(key: Column | str, folds: int, fold: int) -> Column:
    """Whether crc32 of the key as text falls into a fold; a null key does not."""
    column = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(column.cast("string")) % folds == fold, F.lit(False))
