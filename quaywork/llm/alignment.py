"""Alignment of two tokenizers over the same texts, and which of their ids go together."""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaywork.functions.skew import BROADCAST_ROWS
from quaywork.llm.common import settle

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"

#: Pairs of ids that may be broadcast, 16 bytes each; beyond that they are joined by a shuffle.
BROADCAST_PAIRS = 20 * BROADCAST_ROWS
#: Windows remembered by a Python worker, and the longest one that is.
REMEMBERED, LONGEST = 200_000, 48
#: How byte-level vocabularies of this kind cut a text before merging.  Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts and words beyond this length are left to the slower encoder, which never recurses.
QUICK_TEXT, QUICK_WORD = 100_000, 2_000
#: Bytes of text that are encoded, and handed on, at once.
AT_ONCE = 1 << 20
#: What the marks of ids are multiplied with for their place in a window, and for their side; both odd.
STEP, MIX = 0x9E3779B97F4A7C15, np.uint64(0xC2B2AE3D27D4EB4F)


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _quick_encoder(model: dict, value: dict[str, int]):
    """The byte-level model as ranks for an encoder several times faster; None if it is more than its merges.

    Ranks are the ids of the model's own vocabulary, which must number its
    merges in order after the 256 bytes, without normaliser and with the usual
    cutting.  Then both encoders give the same ids for every text.
    """
    cutting, names = model.get("pre_tokenizer") or {}, model["model"]["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
    plain = (
        model.get("normalizer") is None
        and cutting.get("type") == "ByteLevel"
        and not cutting.get("add_prefix_space")
        and cutting.get("use_regex", True)
        and not model["model"].get("ignore_merges")
        and all(names.get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
    )
    if not plain:
        return None
    import tiktoken

    added = {t["content"] for t in model.get("added_tokens", ())}
    ranks = {bytes(value[c] for c in name): i for name, i in names.items() if name not in added}
    return tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Pair:
    """Both tokenizers, the bytes of their tokens, and the windows aligned so far.

    Texts are encoded whole.  Byte lengths summed up give the ends of all
    tokens.  Where a token that begins with a space begins in both, both have a
    token end before it, so the text is cut there without touching a group;
    windows between such anchors are aligned by their ids alone and repeat from
    text to text, so an alignment is remembered under its two id tuples.
    """

    def __init__(self, byte_model: bytes, piece_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        # A task has one core; a pool of threads a worker would only compete for it.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.first = Tokenizer.from_str(byte_model.decode())
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        value = byte_alphabet()
        model = json.loads(byte_model)
        names = model["model"]["vocab"]
        self.quick = _quick_encoder(model, value)
        self.bytes_a = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.bytes_a[i] = bytes(value[c] for c in name) if all(c in value for c in name) else name.encode()
        self.bytes_b = [self._piece(i) for i in range(self.second.get_piece_size())]
        self.size_a, self.space_a = self._measured(self.bytes_a)
        self.size_b, self.space_b = self._measured(self.bytes_b)
        self.sizes_a, self.sizes_b = self.size_a.tolist(), self.size_b.tolist()
        self.texts_a, self.texts_b = ([str(i) for i in range(len(v))] for v in (self.bytes_a, self.bytes_b))
        draw = np.random.default_rng(13)
        self.marks_a, self.marks_b = (
            draw.integers(0, 2**64, len(v), np.uint64) for v in (self.bytes_a, self.bytes_b)
        )
        #: Aligned windows by their two id tuples, kept as the bytes of 4-byte numbers.
        self.known: dict[tuple[bytes, bytes], tuple[str, tuple[int, ...]]] = {}

    def _piece(self, i: int) -> bytes:
        piece = self.second.id_to_piece(i)
        if self.second.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    @staticmethod
    def _measured(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.array([len(t) for t in tokens], np.int64), np.array([t[:1] == b" " for t in tokens])

    def byte_ids(self, text: str) -> list[int]:
        if self.quick is None or len(text) > QUICK_TEXT or max(map(len, text.split()), default=0) > QUICK_WORD:
            return self.first.encode(text, add_special_tokens=False).ids
        return self.quick.encode_ordinary(text)

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of each text by both, none where the bytes do not give the text back."""
        theirs = self.second.encode(texts, num_threads=1)
        for text, b in zip(texts, theirs, strict=True):
            whole = " " + text
            a, data = self.byte_ids(whole), whole.encode("utf-8", "surrogatepass")
            same = (
                text
                and b"".join(map(self.bytes_a.__getitem__, a)) == data
                and b"".join(map(self.bytes_b.__getitem__, b)) == data
            )
            yield (a, b) if same else ([], [])

    def _aligned(self, a: array, b: array) -> tuple[str, tuple[int, ...]]:
        """Groups of one window as text, and its links as numbers a * 2^32 + b."""
        size_a, size_b, text_a, text_b = self.sizes_a, self.sizes_b, self.texts_a, self.texts_b
        if len(a) == 1 and len(b) == 1:
            return f"{text_a[a[0]]}|{text_b[b[0]]}", (a[0] << 32 | b[0],)
        groups, links, part_a, part_b = [], [], "", ""
        rest, ahead = iter(b), 0  # bytes that the tokens of b are ahead of those of a
        for one in a:
            part_a = f"{part_a},{text_a[one]}" if part_a else text_a[one]
            ahead -= size_a[one]
            while ahead < 0:
                other = next(rest)
                part_b = f"{part_b},{text_b[other]}" if part_b else text_b[other]
                ahead += size_b[other]
            if ahead == 0:
                groups.append(f"{part_a}|{part_b}")
                links.append(one << 32 | other)
                part_a = part_b = ""
        return ";".join(groups), tuple(links)

    def windows(self, a: list[int], b: list[int]) -> list[tuple[str, tuple[int, ...]]]:
        """The aligned windows of a text in order."""
        parts, order, _ = self.windows_of([(a, b)])
        return [parts[i] for i in order.tolist()]

    def windows_of(self, coded: list[tuple[list[int], list[int]]]) -> tuple[list, np.ndarray, np.ndarray]:
        """The different aligned windows of some texts, which one stands where, and where each text's begin and end.

        The texts are laid end to end, so one pass over arrays finds the anchors
        of all.  Equal windows are found by fingerprints of their ids and then
        compared id by id, so that each is looked up once.
        """
        ids_a, ids_b = (np.fromiter(chain.from_iterable(ids[side] for ids in coded), np.int32) for side in (0, 1))
        offsets_a, offsets_b = _offsets(self.size_a[ids_a]), _offsets(self.size_b[ids_b])
        borders = offsets_a[_offsets([len(a) for a, _ in coded])]
        begins = np.zeros((2, borders[-1] + 1), bool)
        begins[0, offsets_a[:-1][self.space_a[ids_a]]] = True
        begins[1, offsets_b[:-1][self.space_b[ids_b]]] = True
        begins[:, borders] = True
        anchors = np.flatnonzero(begins.all(axis=0))
        cuts_a, cuts_b = np.searchsorted(offsets_a, anchors), np.searchsorted(offsets_b, anchors)
        marks = _fingerprints(self.marks_a[ids_a], cuts_a) * MIX + _fingerprints(self.marks_b[ids_b], cuts_b)
        first, order = _first_places(marks)
        if not (_repeats(ids_a, cuts_a, first[order]) and _repeats(ids_b, cuts_b, first[order])):
            first = order = np.arange(len(marks))
        known, parts, all_a, all_b = self.known, [], ids_a.tobytes(), ids_b.tobytes()
        bounds = ((4 * cuts[first + n]).tolist() for cuts in (cuts_a, cuts_b) for n in (0, 1))
        for i, j, k, m in zip(*bounds, strict=True):
            key = all_a[i:j], all_b[k:m]
            found = known.get(key)
            if found is None:
                found = self._aligned(array("i", key[0]), array("i", key[1]))
                if j - i <= 4 * LONGEST and m - k <= 4 * LONGEST:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[key] = found
            parts.append(found)
        return parts, order, np.searchsorted(anchors, borders)


def _offsets(sizes) -> np.ndarray:
    """Where things of these sizes begin when laid end to end, and the end of the last."""
    return np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64))]).astype(np.int64)


def _first_places(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each different mark stands first, in order, and which of them stands where."""
    _, first, order = np.unique(marks, return_index=True, return_inverse=True)
    by_place = np.argsort(first)
    rank = np.empty_like(by_place)
    rank[by_place] = np.arange(len(first))
    return first[by_place], rank[order]


def _fingerprints(marks: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """64 bits for each window, from the marks of its ids and their order in it, wherever it stands."""
    forth = np.cumprod(np.full(len(marks), STEP, np.uint64))
    back = np.cumprod(np.full(len(marks), pow(STEP, -1, 2**64), np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(marks * forth)])
    return (sums[cuts[1:]] - sums[cuts[:-1]]) * back[cuts[:-1]]


def _repeats(ids: np.ndarray, cuts: np.ndarray, first: np.ndarray) -> bool:
    """Whether every window holds the very ids of the one it is taken to repeat."""
    sizes = np.diff(cuts)
    if not np.array_equal(sizes, sizes[first]):
        return False
    return np.array_equal(ids, ids[np.arange(len(ids)) + np.repeat(cuts[first] - cuts[:-1], sizes)])


_loaded: dict[str, Pair] = {}


def _pair(shared, name: str) -> Pair:
    """One per Python worker."""
    if name not in _loaded:
        _loaded.clear()
        _loaded[name] = Pair(*shared.value)
    return _loaded[name]


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """The texts, null as empty, in runs of about ``AT_ONCE`` characters with the place of the first."""
    start, run, size = 0, [], 0
    for place, value in enumerate(texts):
        text = value.as_py() or ""
        if run and size + len(text) > AT_ONCE:
            yield start, run
            start, run, size = place, [], 0
        run.append(text)
        size += len(text)
    if run:
        yield start, run


def align(
    docs: DataFrame, byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL, text: str = "text"
) -> DataFrame:
    """(row, n_a, n_b, n_groups, groups, pairs, times): every document with the groups of its tokens.

    ``row`` holds the document's other columns.  ``groups`` has the groups in
    order, ``a1,a2|b1;a3|b2,b3``, each up to the next byte offset where tokens
    of both end.  ``pairs`` are the distinct links, a * 2^32 + b for the last
    tokens of a group, and ``times`` how often each occurs here.

    Whole texts.  Null and empty texts, and those that either tokenizer does not
    give back byte for byte, have no tokens: zeros, an empty ``groups``, no
    pairs.  Text that reads like a special token is text.  Repeated rows: each
    is returned.  Empty input: no rows.  No shuffle; both models are read on the
    driver from path parameters and broadcast, their size does not depend on
    the data.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((_content(byte_model), _content(piece_model)))
    name = f"{byte_model}:{piece_model}:{shared._jbroadcast.id()}"
    others = [c for c in docs.columns if c.lower() != text.lower()]
    kept = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(None).alias("none"))
    body = docs.select(kept.alias("row"), F.col(f"`{text}`").alias("body"))
    schema = T.StructType(
        [
            body.schema["row"],
            T.StructField("n_a", T.LongType()),
            T.StructField("n_b", T.LongType()),
            T.StructField("n_groups", T.LongType()),
            T.StructField("groups", T.StringType()),
            T.StructField("pairs", T.ArrayType(T.LongType())),
            T.StructField("times", T.ArrayType(T.IntegerType())),
        ]
    )

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _pair(shared, name)
        for batch in batches:
            rows, texts = batch.column(0), batch.column(1)
            for start, run in _slices(texts):
                coded = list(both.encode(run))
                parts, order, texts_at = both.windows_of(coded)
                each = np.array([len(links) for _, links in parts], np.int64)
                flat = np.array(list(chain.from_iterable(links for _, links in parts)), np.int64)
                ends = _offsets(each[order])
                links = flat[np.repeat(_offsets(each)[order] - ends[:-1], each[order]) + np.arange(ends[-1])]
                names, places = [name for name, _ in parts], order.tolist()
                groups, pairs, times = [], [], []
                for i, j in pairwise(texts_at.tolist()):
                    distinct, often = np.unique(links[ends[i] : ends[j]], return_counts=True)
                    groups.append(";".join(map(names.__getitem__, places[i:j])))
                    pairs.append(distinct)
                    times.append(often.astype(np.int32))
                inner = pa.array(_offsets([len(p) for p in pairs]), pa.int32())
                lists = [pa.ListArray.from_arrays(inner, pa.array(np.concatenate(v))) for v in (pairs, times)]
                sizes_a, sizes_b = ([len(ids[side]) for ids in coded] for side in (0, 1))
                numbers = [pa.array(v, pa.int64()) for v in (sizes_a, sizes_b, np.diff(ends[texts_at]))]
                columns = [rows.slice(start, len(run)), *numbers, pa.array(groups, pa.string()), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return body.mapInArrow(aligned, schema)


def _content(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): how often each pair is linked in the corpus, and whether no link of its b is more frequent.

    Documents hold their distinct pairs, and these are summed before the
    shuffle, so a pair that every document has costs one row a task.
    """
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    counts = each.groupBy(F.col("link.pairs").alias("pair")).agg(F.sum("link.times").alias("n"))
    counts = settle(counts, "pairs")
    b = F.col("pair").bitwiseAND(F.lit(2**32 - 1))
    top = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    marked = counts.withColumn("b", b).join(top, "b")
    return settle(marked.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "counts")


def link_scores(aligned: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``aligned`` (a written table with a distinct ``place`` a row) with n_links, n_best and count_sum in ``score``.

    The counted table of pairs is broadcast up to ``broadcast_pairs`` rows; a
    document's links then meet their counts where the document is, and one row
    a document is shuffled.  A larger table is joined by shuffles, which
    adaptive execution may split where a pair is frequent.  Documents without
    links have zeros.
    """
    counts = pair_counts(aligned)
    counts = F.broadcast(counts) if counts.count() <= broadcast_pairs else counts
    each = aligned.select("place", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "place", F.col("link.pairs").alias("pair"), F.col("link.times").cast("bigint").alias("times")
    )
    sums = each.join(counts, "pair").groupBy("place").agg(
        F.sum("times").alias("n_links"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0).cast("bigint"))).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )
    zero = F.lit(0).cast("bigint")
    found = aligned.drop("pairs", "times").join(sums, "place", "left")
    names = ["n_links", "n_best", "count_sum"]
    return found.select(
        *[c for c in aligned.columns if c not in ("pairs", "times")],
        *[F.coalesce(c, zero).alias(c) for c in names],
    )


def load(spark: SparkSession, byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL) -> Pair:
    """Both tokenizers in this process, for texts outside a table."""
    return Pair(_content(byte_model), _content(piece_model))
