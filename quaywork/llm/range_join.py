"""Embedding near-duplicates: an exact metric range join over pivot cells."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from quaywork.llm.common import settle, unpacked
from quaywork.llm.components import components
from quaywork.llm.vectors import element, units_of, with_packed

CELL_ROWS = 256
#: Points of a block at most, as far as hashing deals a crowded cell out evenly, and bytes of their vectors.
HOME_ROWS = 16384
BLOCK_BYTES = 16 << 20
#: Blocks of a small table, so that all cores have pairs of blocks to compare.
LEAST_BLOCKS = 16
LEAST_ROWS = 2048
STREAM_ROWS = 1024
#: Points of a cell that share the bounds of their angles to the pivot.
RUN_ROWS = 512
MAX_PIVOTS = 16384
PIVOT_BYTES = 16 << 20
#: Slack of the reach test in radians; far above rounding, it only compares a point with a run too many.
SLACK = 1e-6
#: Decoded blocks a task keeps, and links it gathers before it merges groups.
KEPT_BLOCKS = 4
GATHERED = 1 << 20


def _rounding(size: int) -> float:
    """More than the cosine of two unit vectors in four bytes a component is off."""
    return 2e-7 * size + 1e-6


def _pivots(points: DataFrame, count: int, kind: str) -> dict[int, np.ndarray]:
    """Unit pivots by dimension: ``count`` points with the least hash, a bounded number."""
    keys = points.select("digest").distinct().orderBy(F.xxhash64("digest"), "digest").limit(count)
    chosen = points.join(F.broadcast(keys), "digest").groupBy("digest").agg(F.first("vector").alias("vector"))
    found: dict[int, list[bytes]] = {}
    for vector in chosen.orderBy(F.xxhash64("digest"), "digest").select("vector").toArrow().column(0).to_pylist():
        found.setdefault(len(vector) // np.dtype(kind).itemsize, []).append(vector)
    return {size: units_of(b"".join(v), size, kind).astype(np.float32) for size, v in found.items()}


def pivots_of(points: DataFrame, count: int, longest: int | None, cell_rows: int, kind: str) -> dict[int, np.ndarray]:
    """A pivot for every ``cell_rows`` of ``count`` vectors of at most ``longest`` bytes; both their number and bytes are bounded."""
    most = min(MAX_PIVOTS, max(1, PIVOT_BYTES // (longest or 1)))
    return _pivots(points, min(most, max(1, -(-count // cell_rows))), kind)


def block_rows(count: int, most: int, blocks: int = LEAST_BLOCKS) -> int:
    """Points of a block, so that small tables make several."""
    return min(most, max(LEAST_ROWS, -(-count // blocks)))


def assign_cells(points: DataFrame, pivots: dict[int, np.ndarray], kind: str) -> DataFrame:
    """``points`` with size, cell (the nearest pivot) and angle (to that pivot, in radians)."""
    shared = points.sparkSession.sparkContext.broadcast(pivots)
    width = np.dtype(kind).itemsize

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            sizes = (pc.binary_length(vectors).to_numpy() // width).astype(np.int32)
            cells, angles = np.zeros(len(sizes), np.int32), np.zeros(len(sizes))
            for size in np.unique(sizes):
                p = shared.value.get(int(size))
                if p is None:
                    continue
                exact = p.astype(np.float64)
                exact /= np.sqrt((exact * exact).sum(axis=1, keepdims=True))
                at = np.flatnonzero(sizes == size)
                step = max(1, (1 << 22) // len(p))
                for rows in (at[i : i + step] for i in range(0, len(at), step)):
                    raw = b"".join(vectors.take(pa.array(rows)).to_pylist())
                    units = units_of(raw, int(size), kind)
                    best = (units.astype(np.float32) @ p.T).argmax(axis=1)
                    near = np.einsum("ij,ij->i", units, exact[best])
                    cells[rows], angles[rows] = best, np.arccos(np.clip(near, -1, 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes), pa.array(cells), pa.array(angles)],
                [*batch.schema.names, "size", "cell", "angle"],
            )

    added = {"size": IntegerType(), "cell": IntegerType(), "angle": DoubleType()}
    schema = StructType([*points.schema.fields, *[StructField(c, kind) for c, kind in added.items()]])
    return points.mapInArrow(place, schema)


def _deal(counts: list, rows: int, width: int) -> list[tuple[int, int, int, int]]:
    """(size, cell, block, shares): neighbouring cells fill a block, a crowded cell is shared by several."""
    dealt, block, used, last = [], -1, 0, None
    for size, cell, n in counts:
        most = max(1, min(rows, BLOCK_BYTES // (size * width)))
        shares = -(-n // most)
        if size != last or used + n > most:
            block, used = block + 1, 0
        dealt.append((size, cell, block, shares))
        block, used, last = block + shares - 1, used + n, size
    return dealt


def pack_blocks(points: DataFrame, rows: int, kind: str) -> DataFrame:
    """(block, size, cells, starts, least, most, nodes, copies, vectors): the points in blocks of whole cells.

    A block lists its points by cell and angle, in runs of at most ``RUN_ROWS``
    that begin at ``starts`` and lie in the angles from ``least`` to ``most``
    around the pivot of their cell.
    """
    counted = points.groupBy("size", "cell").agg(F.count(F.lit(1)).alias("n"))
    counts = sorted((r["size"], r["cell"], r["n"]) for r in counted.collect())
    dealt = _deal(counts, rows, np.dtype(kind).itemsize)
    if not dealt:
        dealt = [(0, 0, 0, 1)]
    spark = points.sparkSession
    homes = spark.createDataFrame(dealt, "size int, cell int, first int, shares int")
    block = F.col("first") + F.pmod(F.xxhash64("node"), F.col("shares")).cast("int")
    placed = points.join(F.broadcast(homes), ["size", "cell"]).select(
        block.alias("block"), "size", "cell", "angle", "node", "copies", "vector"
    )
    blocks = dealt[-1][2] + dealt[-1][3]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def one() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            cell, angle = table.column("cell").to_numpy(), table.column("angle").to_numpy()
            heads = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            ends = np.r_[heads[1:], len(cell)]
            starts = np.concatenate([np.arange(a, b, RUN_ROWS) for a, b in zip(heads, ends, strict=True)])
            stops = np.r_[starts[1:], len(cell)] - 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([table.column("block")[0].as_py()], pa.int32()),
                    pa.array([table.column("size")[0].as_py()], pa.int32()),
                    *[
                        pa.array([v.tobytes()], pa.binary())
                        for v in (
                            cell[starts].astype(np.int32),
                            starts.astype(np.int32),
                            angle[starts],
                            angle[stops],
                            table.column("node").to_numpy(),
                            table.column("copies").to_numpy(),
                        )
                    ],
                    pa.array([b"".join(table.column("vector").to_pylist())], pa.binary()),
                ],
                ["block", "size", "cells", "starts", "least", "most", "nodes", "copies", "vectors"],
            )

        for batch in batches:
            labels = batch.column("block").to_numpy()
            change = np.flatnonzero(labels[1:] != labels[:-1]) + 1
            for a, b in zip([0, *change], [*change, len(labels)], strict=True):
                if a == b:
                    continue
                if held and held[0].column("block")[0].as_py() != labels[a]:
                    yield one()
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield one()

    schema = (
        "block int, size int, cells binary, starts binary, least binary, most binary,"
        " nodes binary, copies binary, vectors binary"
    )
    return placed.repartition(blocks, "block").sortWithinPartitions("block", "cell", "angle").mapInArrow(pack, schema)


@dataclass
class _Block:
    """A block as arrays; ``units`` in doubles, ``small`` in four bytes a component."""

    nodes: np.ndarray
    copies: np.ndarray
    units: np.ndarray
    small: np.ndarray
    runs: list[tuple[int, int]]
    cells: np.ndarray
    angles: tuple[np.ndarray, np.ndarray]

    @classmethod
    def read(cls, row: dict, kind: str) -> _Block:
        nodes, starts = np.frombuffer(row["nodes"], np.int64), np.frombuffer(row["starts"], np.int32).tolist()
        units = units_of(row["vectors"], row["size"], kind)
        return cls(
            nodes,
            np.frombuffer(row["copies"], np.int64),
            units,
            units.astype(np.float32),
            list(zip(starts, [*starts[1:], len(nodes)], strict=True)),
            np.frombuffer(row["cells"], np.int32),
            (np.frombuffer(row["least"]), np.frombuffer(row["most"])),
        )

    def reached(self, others: np.ndarray, pivots: np.ndarray | None, radius: float) -> np.ndarray:
        """Which of the points ``others`` may link with a point of which run.

        Angles obey the triangle inequality: points at most ``radius`` apart have
        angles to the run's pivot that differ by at most ``radius``.
        """
        if pivots is None:
            return np.ones((len(others), len(self.runs)), bool)
        near = others @ pivots[self.cells].T
        rounding = _rounding(others.shape[1])
        least, most = self.angles
        low = np.cos(np.minimum(most + radius + SLACK, np.pi)) - rounding
        high = np.cos(np.maximum(least - radius - SLACK, 0)) + rounding
        return (near >= low.astype(np.float32)) & (near <= high.astype(np.float32))


class _Groups:
    """Points joined by links; links are gathered and merged many at once."""

    def __init__(self, size: int):
        self.group = np.arange(size)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        apart = self.group[a] != self.group[b]
        self.held.append((a[apart], b[apart]))
        self.waiting += int(apart.sum())
        if self.waiting > GATHERED:
            self.merge()

    def merge(self) -> np.ndarray:
        a, b = (np.concatenate(x) for x in zip(*self.held, strict=True)) if self.held else ([], [])
        self.held, self.waiting = [], 0
        while len(a):
            x, y = self.group[a], self.group[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            relabel = np.arange(len(self.group))
            np.minimum.at(relabel, np.maximum(x, y), np.minimum(x, y))
            while (relabel[relabel] != relabel).any():
                relabel = relabel[relabel]
            self.group = relabel[self.group]
        return self.group


def _links(a: _Block, b: _Block, pivots: np.ndarray | None, least: float, radius: float) -> pa.RecordBatch:
    """(a, b, links): for every point of two blocks with links between them, one of its group and their number."""
    same = a is b
    nodes = a.nodes if same else np.concatenate([a.nodes, b.nodes])
    copies = a.copies if same else np.concatenate([a.copies, b.copies])
    shift = 0 if same else len(a.nodes)
    links, groups = np.zeros(len(nodes), np.int64), _Groups(len(nodes))
    margin = _rounding(a.units.shape[1])
    low, high = np.float32(least - margin), np.float32(least + margin)
    reached = b.reached(a.small, pivots, radius)
    for run, (start, stop) in enumerate(b.runs):
        met = np.flatnonzero(reached[:stop, run] if same else reached[:, run])
        for at in range(0, len(met), STREAM_ROWS):
            rows = met[at : at + STREAM_ROWS]
            near = a.small[rows] @ b.small[start:stop].T
            found = near >= low
            if same and rows[-1] >= start:
                found &= np.arange(start, stop) > rows[:, None]
            i, j = np.nonzero(found)
            if not len(i):
                continue
            close = np.flatnonzero(near[i, j] < high)
            i, j, sure = rows[i], start + j, np.ones(len(i), bool)
            for part in (close[k : k + STREAM_ROWS] for k in range(0, len(close), STREAM_ROWS)):
                sure[part] = np.einsum("ij,ij->i", a.units[i[part]], b.units[j[part]]) >= least
            i, j = i[sure], j[sure] + shift
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            groups.add(i, j)
    group, linked = groups.merge(), np.flatnonzero(links)
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes[linked]), pa.array(nodes[group[linked]]), pa.array(links[linked])], ["a", "b", "links"]
    )


def compare_blocks(blocks: DataFrame, pivots: dict[int, np.ndarray], least: float, kind: str) -> DataFrame:
    """(a, b, links) of each pair of blocks: how many links a point has there, and a point of its group.

    Every two blocks meet once, by a Cartesian product that reads them where they
    are and writes nothing; a task has two of them in memory.  Of the links found
    a pair of blocks returns a spanning forest: as many rows as it has points at
    most, however dense they lie.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(pivots)
    radius = float(np.arccos(np.clip(least, -1, 1)))
    columns = ["cells", "starts", "least", "most", "nodes", "copies", "vectors"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict[int, _Block] = OrderedDict()

        def block(row: dict, name: str) -> _Block:
            number = row[name]["block"]
            if number not in kept:
                kept[number] = _Block.read({**row[name], "size": row["size"]}, kind)
            kept.move_to_end(number)
            if len(kept) > KEPT_BLOCKS:
                kept.popitem(last=False)
            return kept[number]

        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                one = block(row, "one")
                other = one if row["other"] is None else block(row, "other")
                yield _links(one, other, shared.value.get(row["size"]), least, radius)

    one, other = blocks.alias("one"), blocks.alias("other")
    # Blocks of one dimension only; not written as an equality, by which they would be shuffled together.
    meet = ((F.col("one.size") - F.col("other.size")) == 0) & (F.col("one.block") <= F.col("other.block"))

    def whole(name: str):
        return F.struct(*[F.col(f"{name}.{c}") for c in ["block", *columns]])

    pairs = one.join(other.hint("shuffle_replicate_nl"), meet).select(
        F.col("one.size").alias("size"),
        whole("one").alias("one"),
        F.when(F.col("one.block") < F.col("other.block"), whole("other")).alias("other"),
    )
    return pairs.mapInArrow(compare, "a bigint, b bigint, links bigint")


def near_duplicates(
    docs: DataFrame, least: float = 0.95, key: str = "vec_id", vector: str = "embedding", cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Every row with ``n_links``, ``component_id`` and ``kept``.

    Two vectors link if their cosine, in doubles, is at least ``least``;
    ``n_links`` counts the other rows linked directly, ``component_id`` is the
    least key reachable, ``kept`` tells whether it is the row's own.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing, and vectors of different dimension do not link.  Repeated
    rows and equal vectors link with each other; they are compared once.  A null
    key is never the least unless all are null.  Columns that bear an added name
    are replaced.  Empty input: no rows.

    Points lie in the cell of their nearest pivot, cells in blocks.  Every two
    blocks are compared in a task of their own, a point only with the runs of a
    cell that its angle to the pivot lets it reach.  No point is copied to disk
    for the cells it reaches, so disk follows the input.
    """
    # The row is packed before columns are added, so that it may have columns of their names.
    others = [F.col(f"`{c}`") for c in docs.columns if c != vector] or [F.lit(None).alias("none")]
    kind = element(docs, vector)
    body = docs.select(
        F.struct(*others).alias("row"), F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").alias("given")
    )
    marked = with_packed(body, "given", kind).select(
        "row",
        "id",
        "vector",
        F.coalesce("digest", F.unhex(F.md5(F.concat(F.lit("unusable:"), F.uuid())))).alias("digest"),
    )
    marked = settle(marked, "vectors")
    usable = marked.where("vector IS NOT NULL")
    size = usable.agg(F.countDistinct("digest").alias("n"), F.max(F.length("vector")).alias("bytes")).first()
    count = size["n"]
    pivots = pivots_of(usable, count, size["bytes"], cell_rows, kind)
    points = usable.groupBy("digest").agg(
        F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("least")
    )
    points = settle(assign_cells(points.withColumn("node", F.monotonically_increasing_id()), pivots, kind), "points")
    blocks = settle(pack_blocks(points, block_rows(count, HOME_ROWS), kind), "blocks")
    found = settle(compare_blocks(blocks, pivots, least, kind), "found")
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    groups = components(found.where("a <> b").select("a", "b"))
    labelled = points.join(groups, "node", "left").select(
        "digest", "node", "copies", "least", F.coalesce("component", "node").alias("component")
    )
    least_of = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    n_links = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    known = settle(
        labelled.join(least_of, "component")
        .join(links, "node", "left")
        .select("digest", n_links.alias("n_links"), "component_id"),
        "labels",
    )
    joined = marked.join(known, "digest", "left")
    usable = F.col("vector").isNotNull()
    done = joined.select(
        "row",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(usable, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        F.when(usable, F.col("component_id")).otherwise(F.col("id")).eqNullSafe(F.col("id")).alias("kept"),
    )
    return unpacked(done, ["n_links", "component_id", "kept"])
