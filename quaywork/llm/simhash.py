"""SimHash near-duplicates by multi-index hashing."""

from __future__ import annotations

import re
import string
from collections.abc import Sequence
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaywork.llm.common import packed, settle, unpacked
from quaywork.llm.components import components

BITS = 64
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


def fingerprint_of(text: str | None, shingle: int = 4) -> int:
    """The SimHash of one whole text as an unsigned number."""
    words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle or None], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    pieces = zip(starts.tolist(), ends.tolist(), strict=True)
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in pieces), np.uint64, len(starts))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # 64 bytes a shingle, so a block at a time
        block = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = 4) -> Column:
    """SimHash over word shingles as a signed 64-bit number."""

    @F.arrow_udf(T.LongType())
    def simhash(texts: pa.Array) -> pa.Array:
        values = np.array([fingerprint_of(t.as_py(), shingle) for t in texts], np.uint64)
        return pa.array(values.view(np.int64))

    return simhash(text)


def segment_plan(count: int, distance: int = 4) -> list[tuple[int, int, int]]:
    """(low bit, width, radius) of each segment, chosen by the expected work for ``count`` fingerprints.

    With radii r1..rm where the sum of (r + 1) exceeds ``distance``, two
    fingerprints within ``distance`` agree on some segment i up to ri bits: were
    each segment off by ri + 1 or more, the sum would exceed ``distance``.  So
    every plan finds the same links; wide segments cost more look-ups, narrow
    ones more false candidates.
    """
    best = None
    for parts in range(1, distance + 2):
        widths = [BITS // parts + (i < BITS % parts) for i in range(parts)]
        radii = [(distance + 1) // parts - 1 + (i < (distance + 1) % parts) for i in range(parts)]
        balls = [sum(comb(w, k) for k in range(r + 1)) for w, r in zip(widths, radii, strict=True)]
        if sum(balls) > 4000:
            continue
        # A look-up is a row that is shuffled, a candidate only a comparison.
        work = sum(20 * count * b + count * count * b / 2**w for b, w in zip(balls, widths, strict=True))
        if best is None or work < best[0]:
            lows = [sum(widths[:i]) for i in range(parts)]
            best = (work, list(zip(lows, widths, radii, strict=True)))
    return best[1]


def _ball(low: int, width: int, radius: int) -> list[int]:
    """All changes of up to ``radius`` bits inside a segment, as signed masks."""
    masks = [
        sum(1 << (low + i) for i in bits) for r in range(radius + 1) for bits in combinations(range(width), r)
    ]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def _asked(number: int, field: int):
    def ask(mask: Column) -> Column:
        value = F.col("fp").bitwiseXOR(mask).bitwiseAND(F.lit(field))
        return F.struct(F.lit(number).alias("part"), value.alias("value"))

    return ask


def links_within(prints: DataFrame, distance: int = 4, plan: list | None = None) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints that differ in at most ``distance`` bits.

    ``prints`` has one column ``fp`` without repeats.  Every fingerprint is
    entered once a segment, and looks up every value of the segment's Hamming
    ball; a match counts once the complete fingerprints are close.  The test is
    part of the join, so false candidates are never rows.  Copies are one
    fingerprint, so no bucket grows with them; a bucket that is still crowded
    is an ordinary skewed join, which adaptive execution splits.  A pair found
    through several segments appears several times.
    """
    plan = plan or segment_plan(max(1, prints.count()), distance)
    entries, asks = [], []
    for number, (low, width, radius) in enumerate(plan):
        field = ((1 << width) - 1) << low
        field = field - (1 << 64) if field >= 1 << 63 else field
        masks = F.array(*[F.lit(m).cast("bigint") for m in _ball(low, width, radius)])
        entries.append(F.struct(F.lit(number).alias("part"), F.col("fp").bitwiseAND(F.lit(field)).alias("value")))
        asks.append(F.transform(masks, _asked(number, field)))
    table = prints.select(F.col("fp").alias("b"), F.inline(F.array(*entries)))
    query = prints.select(F.col("fp").alias("a"), F.inline(F.concat(*asks)))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    same = (query["part"] == table["part"]) & (query["value"] == table["value"])
    return query.join(table, same & (F.col("a") < F.col("b")) & near).select("a", "b")


def simhash_groups(
    docs: DataFrame,
    shingle: int = 4,
    distance: int = 4,
    key: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Every document with its ``fingerprint`` (16 hex digits) and ``component_id``.

    Documents are in one group if a chain of fingerprints links them, each step
    differing in at most ``distance`` bits.  ``component_id`` is the least key
    of the group, its own included; null only if every key of the group is.
    ``carry`` names the columns to return (all).

    Null and empty texts, and those of white space: fingerprint zero, linked
    like any other.  Texts of fewer words than a shingle: one shingle of all
    words.  Repeated rows: each is returned.  Columns that bear an added name
    are replaced.  Empty input: no rows.
    """
    columns = docs.columns if carry is None else list(carry)
    body = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.col(f"`{key}`").alias("id"),
        fingerprint(F.col(f"`{text}`"), shingle).alias("fp"),
    )
    marked = settle(body, "fingerprints")
    joined = marked.join(fingerprint_groups(marked.select("id", "fp"), distance), "fp")
    return unpacked(joined.withColumn("fingerprint", hex_digits("fp")), ["fingerprint", "component_id"])


def hex_digits(fp: str | Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def fingerprint_groups(printed: DataFrame, distance: int = 4) -> DataFrame:
    """(fp, component_id) for every distinct fingerprint of ``printed`` (id, fp)."""
    prints = settle(printed.groupBy("fp").agg(F.min("id").alias("least")), "prints")
    found = components(links_within(prints.select("fp"), distance))
    labelled = prints.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    lone = labelled.where("component IS NULL").select("fp", F.col("least").alias("component_id"))
    grouped = labelled.where("component IS NOT NULL")
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    return settle(lone.unionAll(grouped.join(least, "component").select("fp", "component_id")), "groups")


def keep_one(
    docs: DataFrame, shingle: int = 4, distance: int = 4, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents with one row of each group left: that of the least key.

    Among rows that share this key one stays, the first by fingerprint and hash
    of the text; rows equal in all three are interchangeable.  Keys that are all
    null count as one key.  The choice is a partial aggregate over narrow rows.
    """
    body = F.coalesce(F.col(f"row.`{text}`"), F.lit(""))
    rows = packed(docs).withColumn("fp", fingerprint(F.col(f"row.`{text}`"), shingle))
    place = F.struct(
        F.col(f"row.`{key}`").isNull(), F.col(f"row.`{key}`"), F.col("fp"), F.xxhash64(body), F.col("file")
    )
    # Rows are told apart by where they come from, so that exact repeats leave one row.
    marked = settle(
        rows.withColumn("file", F.monotonically_increasing_id()).withColumn("place", place), "marked"
    )
    groups = fingerprint_groups(marked.select(F.col(f"row.`{key}`").alias("id"), "fp"), distance)
    placed = groups.join(marked.groupBy("fp").agg(F.min("place").alias("place")), "fp")
    first = placed.groupBy("component_id").agg(F.min("place").alias("place"))
    kept = marked.join(first.select(F.col("place.file").alias("file")), "file", "left_semi")
    return unpacked(kept, [])
