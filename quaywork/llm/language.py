"""Language of the words of a text by a linear-chain conditional random field."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaywork.llm.common import packed, settle, unpacked

UNDETERMINED = "und"
_WORD = re.compile(r"[^\W\d_]+")
_EDGE = "\n"
#: Odd multipliers that mix code points into feature hashes.
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint64)
STEP = 32


@dataclass(frozen=True)
class Options:
    """Bounds and strengths of a fit.

    Each language gives about ``runs_per_label`` runs of ``STEP`` words, drawn
    from all its texts in proportion to their length; a share ``switched`` of
    the runs changes language halfway.
    """

    bits: int = 16
    runs_per_label: int = 2400
    switched: float = 0.25
    epochs: int = 4
    rate: float = 0.2
    penalty: float = 1e-6
    seed: int = 11


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features(words: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of the words, and the word each belongs to.

    A word between two edges gives its n-grams of 2 to 4 characters, of which
    those at an edge are its prefixes and suffixes, and itself as a lexicon entry.
    """
    line = _EDGE + _EDGE.join(words) + _EDGE
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    edges = codes == ord(_EDGE)
    owner = np.cumsum(edges) - 1
    buckets, owners = [], []
    for n in (2, 3, 4):
        if len(codes) < n:
            continue
        size = len(codes) - n + 1
        mixed = np.full(size, n, np.uint64)
        inner = np.zeros(size, bool)
        for i in range(n):
            mixed = (mixed ^ codes[i : i + size]) * _MIX[i]
            if 0 < i < n - 1:
                inner |= edges[i : i + size]
        at = np.flatnonzero(~inner & ~(edges[:size] & edges[n - 1 :]) if n == 2 else ~inner)
        buckets.append(mixed[at])
        owners.append(owner[at])
    starts = np.flatnonzero(edges)[:-1]
    if len(words):
        power = np.cumprod(np.full(int(np.diff(np.flatnonzero(edges)).max()), 0x100000001B3, np.uint64))
        place = np.arange(len(codes)) - np.flatnonzero(edges)[owner]
        place[-1] = 0
        whole = np.add.reduceat(codes[:-1] * power[place[:-1]], starts)
        buckets.append((whole ^ np.uint64(1)) * _MIX[0])
        owners.append(np.arange(len(words)))
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mixed = np.concatenate(buckets)
    return ((mixed ^ (mixed >> np.uint64(29))) * _MIX[2] >> np.uint64(64 - bits)).astype(np.int64), np.concatenate(
        owners
    ).astype(np.int64)


def emissions(words: list[str], weights: np.ndarray, bits: int) -> np.ndarray:
    """The score of each label for each word."""
    buckets, owners = features(words, bits)
    return np.stack(
        [np.bincount(owners, weights[buckets, k], len(words)) for k in range(weights.shape[1])], axis=1
    ) if len(words) else np.zeros((0, weights.shape[1]))


class Chain:
    """Labels, feature weights, and weights of starts and of passing from one label to the next."""

    def __init__(self, labels: list[str], weights: np.ndarray, start: np.ndarray, steps: np.ndarray, bits: int):
        self.labels, self.weights, self.start, self.steps, self.bits = labels, weights, start, steps, bits
        self.known: dict[str, int] = {}
        self.rows = np.zeros((0, len(labels)))

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Emission scores, computed once for each distinct word while there is room."""
        if len(self.known) > 300_000:
            self.known, self.rows = {}, self.rows[:0]
        fresh = list(set(words).difference(self.known))
        if fresh:
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh)), strict=True))
            self.rows = np.concatenate([self.rows, emissions(fresh, self.weights, self.bits)])
        return self.rows[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]

    def marginals(self, scores: np.ndarray, lengths: list[int]) -> np.ndarray:
        """Probability of each label at each word of several chains, by forward-backward.

        Chains are cut into blocks of ``STEP`` words.  The products of the step
        matrices of all blocks are taken side by side, passed along each chain,
        and then all blocks run forward and backward side by side; the result is
        that of one pass over each whole chain.
        """
        size, total = len(self.labels), len(scores)
        blocks = [-(-n // STEP) for n in lengths]
        count = sum(blocks)
        if not total:
            return np.zeros((0, size))
        starts = np.cumsum([0, *blocks[:-1]])
        slot = np.concatenate(
            [np.arange(n) + s * STEP for n, s in zip(lengths, starts, strict=True) if n]
        )
        emit = np.ones((count * STEP, size))
        emit[slot] = np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -60))
        real = np.zeros(count * STEP, bool)
        real[slot] = True
        emit, real = emit.reshape(count, STEP, size), real.reshape(count, STEP)
        passing = np.exp(self.steps - self.steps.max())
        # The first word of a chain is entered with the start weights instead of a step.
        first = np.exp(self.start - self.start.max())
        head = np.zeros(count, bool)
        head[[s for s, n in zip(starts, lengths, strict=True) if n]] = True
        product = np.broadcast_to(np.eye(size), (count, size, size)).copy()
        for t in range(STEP):
            on = real[:, t]
            moved = product[on] @ passing
            if t == 0:
                moved[head[on]] = first
            moved *= emit[on, t][:, None, :]
            product[on] = moved / moved.max(axis=(1, 2), keepdims=True)
        before = np.empty((count, size))
        after = np.empty((count, size))
        order = np.argsort([-b for b in blocks], kind="stable")
        counts = np.array(blocks)[order]
        heads = np.array(starts)[order]
        alpha = np.full((len(order), size), 1 / size)
        for k in range(int(counts[0]) if len(counts) else 0):
            live = int(np.searchsorted(-counts, -k, "left"))
            at = heads[:live] + k
            before[at] = alpha[:live]
            nxt = np.einsum("bi,bij->bj", alpha[:live], product[at])
            alpha[:live] = nxt / nxt.max(axis=1, keepdims=True)
        beta = np.ones((len(order), size))
        for k in range(int(counts[0]) - 1 if len(counts) else -1, -1, -1):
            live = int(np.searchsorted(-counts, -k, "left"))
            at = heads[:live] + k
            after[at] = beta[:live]
            nxt = np.einsum("bij,bj->bi", product[at], beta[:live])
            beta[:live] = nxt / nxt.max(axis=1, keepdims=True)
        forward = np.empty((count, STEP, size))
        alpha = before
        for t in range(STEP):
            moved = alpha @ passing
            if t == 0:
                moved[head] = first
            moved *= emit[:, t]
            moved /= moved.max(axis=1, keepdims=True)
            alpha = np.where(real[:, t, None], moved, alpha)
            forward[:, t] = alpha
        beta = after
        for t in range(STEP - 1, -1, -1):
            forward[:, t] *= beta
            moved = (emit[:, t] * beta) @ passing.T
            moved /= moved.max(axis=1, keepdims=True)
            beta = np.where(real[:, t, None], moved, beta)
        found = forward.reshape(-1, size)[slot]
        return found / found.sum(axis=1, keepdims=True)


def _fit(rows: list[tuple[list[str], int]], labels: list[str], o: Options) -> Chain:
    """Conditional likelihood by adaptive gradient steps over batches of equally long runs."""
    rng = np.random.default_rng(o.seed)
    size = len(labels)
    weights, start, steps = np.zeros((1 << o.bits, size)), np.zeros(size), np.zeros((size, size))
    runs = [(w, [k] * len(w)) for w, k in rows if w]
    half = STEP // 2
    for _ in range(int(o.switched * len(runs)) if size > 1 else 0):
        (a, i), (b, j) = (runs[x] for x in rng.integers(0, len(rows), 2))
        if len(a) == len(b) == STEP:
            runs.append((a[:half] + b[half:], i[:half] + j[half:]))
    vocabulary = {w: i for i, w in enumerate(sorted({w for run, _ in runs for w in run}))}
    buckets, owners = features(list(vocabulary), o.bits)
    order = np.argsort(owners, kind="stable")
    buckets = buckets[order]
    ends = np.cumsum(np.bincount(owners, minlength=len(vocabulary)))
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    seen = [np.full_like(x, 1e-6) for x in (weights, start, steps)]
    by_length: dict[int, list[int]] = {}
    for i, (run, _) in enumerate(runs):
        by_length.setdefault(len(run), []).append(i)
    for _ in range(o.epochs):
        batches = []
        for members in by_length.values():
            mixed = rng.permutation(members)
            batches += [mixed[at : at + 64] for at in range(0, len(mixed), 64)]
        for pick in (batches[i] for i in rng.permutation(len(batches))):
            words = np.array([[vocabulary[w] for w in runs[i][0]] for i in pick])
            truth = np.array([runs[i][1] for i in pick])
            flat = words.ravel()
            sizes = ends[flat] - begins[flat]
            owner = np.repeat(np.arange(len(flat)), sizes)
            inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            used = buckets[np.repeat(begins[flat], sizes) + inside]
            scores = np.stack([np.bincount(owner, weights[used, k], len(flat)) for k in range(size)], axis=1)
            g_e, g_start, g_steps = _gradient(scores.reshape(*words.shape, size), truth, start, steps)
            g_e = g_e.reshape(-1, size)
            g_w = np.stack([np.bincount(used, g_e[owner, k], 1 << o.bits) for k in range(size)], axis=1)
            for value, g, s in ((weights, g_w, seen[0]), (start, g_start, seen[1]), (steps, g_steps, seen[2])):
                g = g / len(pick) + o.penalty * value
                s += g * g
                value -= o.rate * g / np.sqrt(s)
    return Chain(labels, weights.astype(np.float32), start, steps, o.bits)


def _gradient(scores: np.ndarray, truth: np.ndarray, start: np.ndarray, steps: np.ndarray):
    """Expected minus observed counts of labels, starts and steps."""
    batch, length, size = scores.shape
    emit = np.exp(scores - scores.max(axis=2, keepdims=True))
    passing = np.exp(steps)
    alpha, beta = np.empty_like(emit), np.ones_like(emit)
    alpha[:, 0] = np.exp(start) * emit[:, 0]
    alpha[:, 0] /= alpha[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, length):
        alpha[:, t] = (alpha[:, t - 1] @ passing) * emit[:, t]
        alpha[:, t] /= alpha[:, t].sum(axis=1, keepdims=True)
    for t in range(length - 2, -1, -1):
        beta[:, t] = (emit[:, t + 1] * beta[:, t + 1]) @ passing.T
        beta[:, t] /= beta[:, t].sum(axis=1, keepdims=True)
    at = alpha * beta
    at /= at.sum(axis=2, keepdims=True)
    observed = np.eye(size)[truth]
    expected_steps = np.zeros((size, size))
    for t in range(length - 1):
        joint = alpha[:, t, :, None] * passing * (emit[:, t + 1] * beta[:, t + 1])[:, None, :]
        expected_steps += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    observed_steps = np.einsum("bti,btj->ij", observed[:, :-1], observed[:, 1:])
    return at - observed, (at[:, 0] - observed[:, 0]).sum(axis=0), expected_steps - observed_steps


def fit_chain(
    docs: DataFrame, options: Options = Options(), key: str = "doc_id", text: str = "text", label: str = "lang"
) -> Chain:
    """Learn from documents with a language; every word of one bears its language.

    Rows without text or language are left out.  Every language that occurs is
    learned.  Its texts are cut into stretches of equal length, which are counted
    over all rows; about ``runs_per_label`` of them, those with the least hash,
    give the run of words that begins there.  So what reaches the driver is
    bounded by that many runs a language, however long the texts are.  Without
    such rows the chain has no labels.
    """
    o = options
    # A stretch is about as long as a run: STEP words of five letters and a space.
    parts = (F.floor(F.length("body") / (6 * STEP)) + 1).cast("int")
    usable = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).alias("body"), F.col(label).cast("string").alias("label")
    ).withColumn("parts", parts)
    counted = settle(usable.groupBy("label").agg(F.sum("parts").alias("all_parts")), "languages")
    labels = sorted(r["label"] for r in counted.select("label").collect())
    if not labels:
        return Chain([], np.zeros((1 << o.bits, 0)), np.zeros(0), np.zeros((0, 0)), o.bits)

    def draw(part: Column) -> Column:
        hashed = F.xxhash64(F.lit(o.seed), F.col("key").cast("string"), F.length("body"), part)
        return F.shiftrightunsigned(hashed, 12) / F.lit(float(2**52))

    @F.arrow_udf("array<array<string>>")
    def runs(texts: pa.Array, parts: pa.Array, chosen: pa.Array) -> pa.Array:
        out = []
        for t, n, some in zip(texts, parts, chosen, strict=True):
            words = words_of(t.as_py())
            last = max(0, len(words) - STEP)
            places = sorted({last * i // max(1, n.as_py() - 1) for i in some.as_py()})
            out.append([words[p : p + STEP] for p in places] if words else [])
        return pa.array(out, pa.list_(pa.list_(pa.string())))

    share = F.lit(float(o.runs_per_label)) / F.col("all_parts")
    # One row a language, as many as the model has labels.
    shared = usable.join(F.broadcast(counted), "label").withColumn("share", share)
    picked = shared.withColumn(
        "chosen", F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: draw(i) < F.col("share"))
    )
    sampled = picked.where(F.size("chosen") > 0).select("key", "label", runs("body", "parts", "chosen").alias("runs"))
    each = settle(sampled.select("key", "label", F.posexplode("runs").alias("at", "run")), "language-runs")
    limit = 2 * o.runs_per_label * len(labels)
    rows = each.orderBy(F.xxhash64(F.lit(o.seed), "key", "at"), "label", "run").limit(limit).toArrow().to_pylist()
    place = {name: i for i, name in enumerate(labels)}
    return _fit([(r["run"], place[r["label"]]) for r in rows], labels, o)


def identify(docs: DataFrame, model: Chain, text: str = "text") -> DataFrame:
    """Every document with ``lang_pred``, ``score`` and ``shares``.

    ``shares`` maps each language to its share of the words, summed over the
    label probabilities of all words of the whole text; ``lang_pred`` is the
    language with the largest (ties: the first by name), ``score`` that share.

    Null texts, texts without a letter, and models without labels: ``und`` with
    score 0 and no shares.  Repeated rows: each is returned.  Columns that bear
    an added name are replaced.  Empty input: no rows.  No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<double>")
    def label_shares(texts: pa.Array) -> pa.Array:
        chain_model, out = shared.value, []
        for group in _groups(texts):
            out += _shares(chain_model, group)
        return pa.array(out, pa.list_(pa.float64()))

    found = packed(docs).withColumn("found", label_shares(F.col(f"row.`{text}`")))
    names = F.array(*[F.lit(x) for x in model.labels]).cast("array<string>")
    best = F.array_max("found")
    known = F.size("found") > 0
    done = found.select(
        "row",
        F.when(known, F.element_at(names, F.array_position("found", best).cast("int")))
        .otherwise(UNDETERMINED)
        .alias("lang_pred"),
        F.when(known, best).otherwise(0.0).alias("score"),
        F.when(known, F.map_from_arrays(names, "found")).alias("shares"),
    )
    return unpacked(done, ["lang_pred", "score", "shares"])


def _groups(texts: pa.Array, size: int = 1 << 20) -> Iterator[list[str]]:
    """Texts in groups of about ``size`` characters, so that words in hand stay bounded."""
    group, held = [], 0
    for t in texts:
        group.append(t.as_py() or "")
        held += len(group[-1])
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group


def _shares(model: Chain, texts: list[str]) -> list[list[float]]:
    split = [words_of(t) for t in texts]
    split = [w if any(c.isalpha() for x in w for c in x) else [] for w in split]
    if not model.labels:
        return [[] for _ in split]
    lengths = [len(w) for w in split]
    scores = model.word_scores(list(chain.from_iterable(split)))
    at = model.marginals(scores, [n for n in lengths if n])
    sums = np.concatenate([np.zeros((1, at.shape[1])), np.cumsum(at, axis=0)])
    ends = np.cumsum(lengths)
    out = []
    for n, end in zip(lengths, ends, strict=True):
        share = (sums[end] - sums[end - n]) / n if n else []
        out.append([float(min(1.0, max(0.0, x))) for x in share])
    return out
