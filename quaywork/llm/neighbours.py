"""Approximate nearest neighbours: graphs by NN-descent, one a shard of the rows, searched greedily."""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from quaywork.llm import range_join
from quaywork.llm.common import settle
from quaywork.llm.vectors import element, units_of, with_packed

LOG = logging.getLogger(__name__)
#: Shards of a small table, so that all cores have some.
LEAST_SHARDS = 32
#: Offers of neighbours that are gathered before the lists take them, and nodes that a step of a search scores at once.
OFFERS = 1 << 20
SCORED = 1 << 17


@dataclass(frozen=True)
class Options:
    """``degree``: neighbours a node keeps, and reverse ones it is joined with.

    The rows lie in shards of at most ``shard``, neighbouring cells together.
    The descent in a shard takes up to ``rounds`` rounds and ends when a round
    changes less than ``settled`` of all links; it begins from the neighbours
    inside groups of about ``group`` nodes.  A search of a shard keeps the
    ``width`` nearest nodes seen and expands ``expand`` of them a step, from a
    node of every run of its cells, ``entries`` at least, and the query's own
    node.  Queries are taken in blocks of about ``query_block``, and fewer as
    ``expand`` grows, so that a step of a block scores about ``frontier`` nodes
    and their neighbours.  ``sample`` queries are also answered by a scan of all
    vectors: ``width`` and ``expand`` are doubled until the search of all shards
    finds a share of ``recall`` of those answers, and every query then goes to as
    many of the shards nearest to it as that takes.
    """

    degree: int = 24
    rounds: int = 6
    settled: float = 0.02
    group: int = 100
    shard: int = 32768
    width: int = 64
    expand: int = 16
    entries: int = 32
    steps: int = 64
    query_block: int = 4096
    frontier: int = 4096 * 128
    sample: int = 256
    recall: float = 0.95
    seed: int = 3


def blocks_of(queries: int, o: Options) -> int:
    """How many blocks keep both the queries of one and the rows its steps broadcast within their bounds."""
    return -(-queries // max(1, min(o.query_block, o.frontier // o.expand)))


@dataclass(frozen=True)
class Index:
    """``points`` (node, vector): distinct vectors of one dimension; ``members`` (node, id): the least ids
    that bear them; ``shards``: blocks of points with ``around``, the neighbours of each in either direction;
    ``cells``: the shard and the pivot of every cell, by which queries find the shards nearest to them."""

    size: int
    kind: str
    points: DataFrame
    members: DataFrame
    shards: DataFrame
    cells: tuple[np.ndarray, np.ndarray]


def _top(df: DataFrame, by: str, order: list[Column], keep: int) -> DataFrame:
    """The first rows of each key; Spark limits them within tasks before it shuffles."""
    rank = F.row_number().over(W.partitionBy(by).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= keep).drop("rank")


def _listed(owners: np.ndarray, values: np.ndarray, count: int, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``keep`` values of each owner as a row, -1 where there are fewer, and their positions; owners are sorted."""
    starts = np.searchsorted(owners, np.arange(count))
    rank = np.arange(len(owners)) - starts[owners]
    on = np.flatnonzero(rank < keep)
    lists, places = np.full((count, keep), -1, np.int64), np.full((count, keep), -1, np.int64)
    lists[owners[on], rank[on]], places[owners[on], rank[on]] = values[on], on
    return lists, places


def _nearest(a: np.ndarray, b: np.ndarray, near: np.ndarray, fresh: np.ndarray, count: int, keep: int):
    """(lists, near, fresh): the ``keep`` nearest offers to each a; an offer made twice counts once, an old one's mark holds."""
    # One sort by a and nearness brings repeats together, but for rounding; the lists are cleared of the rest.
    order = np.argsort(a + (1 - near) / 8)
    same = np.zeros(len(order), bool)
    same[1:] = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
    order = order[~(same & fresh[order])]
    lists, places = _listed(a[order], b[order], count, 2 * keep)
    at = order[np.maximum(places, 0)]
    real = places >= 0
    near, fresh = np.where(real, near[at], -2.0), real & fresh[at]
    # By node, a node's old offer first; what follows of the same node is a repeat.
    rows = np.argsort(lists * 2 + fresh, axis=1)
    lists, near, fresh = (np.take_along_axis(v, rows, 1) for v in (lists, near, fresh))
    near[:, 1:][(lists[:, 1:] == lists[:, :-1]) & (lists[:, 1:] >= 0)] = -2.0
    rows = np.argsort(-near, axis=1, kind="stable")[:, :keep]
    lists, near, fresh = (np.take_along_axis(v, rows, 1) for v in (lists, near, fresh))
    real = near > -1.5
    return np.where(real, lists, -1), near, fresh & real


def _joined(units: np.ndarray, members: np.ndarray, fresh: np.ndarray, near: np.ndarray):
    """(a, b, near), about ``OFFERS`` at a time: within each group, the members that come nearer to a than its worst
    neighbour by ``near``, as it is by then; pairs of which neither is fresh were compared."""
    offers, waiting, worst = [], 0, near[:, -1]
    step = max(1, (1 << 19) // members.shape[1] ** 2)
    for at in range(0, len(members), step):
        nodes, new = members[at : at + step], fresh[at : at + step]
        real = nodes >= 0
        x = units[np.maximum(nodes, 0)]
        cosines = x @ x.transpose(0, 2, 1)
        wanted = cosines > np.where(real, worst[nodes], np.inf)[:, :, None]
        wanted &= (new[:, :, None] | new[:, None, :]) & real[:, None, :] & (nodes[:, :, None] != nodes[:, None, :])
        k, i, j = np.nonzero(wanted)
        offers.append((nodes[k, i], nodes[k, j], cosines[k, i, j]))
        waiting += len(k)
        if waiting > OFFERS or at + step >= len(members):
            yield tuple(np.concatenate(v) for v in zip(*offers, strict=True))
            offers, waiting = [], 0


def descend(units: np.ndarray, o: Options) -> tuple[np.ndarray, np.ndarray]:
    """The neighbour graph (lists, near), ``degree`` links a node at most, by NN-descent.

    A round joins every node with its neighbours and reverse neighbours; within
    such a group all are neighbours of neighbours of each other, and what comes
    nearer replaces what a node has.  Reverse neighbours are limited as well, at
    random, so that no group grows with how popular a node is.
    """
    count, chance = len(units), np.random.default_rng(o.seed)
    keep = min(o.degree, count - 1)
    if keep < 1:
        return np.zeros((count, 0), np.int64), np.zeros((count, 0))
    lists, near, fresh = np.full((count, keep), -1), np.full((count, keep), -2.0), np.zeros((count, keep), bool)

    def join(members: np.ndarray, marks: np.ndarray) -> None:
        for a, b, cosines in _joined(units, members, marks, near):
            held = np.nonzero(lists >= 0)
            lists[:], near[:], fresh[:] = _nearest(
                np.concatenate([held[0], a]),
                np.concatenate([lists[held], b]),
                np.concatenate([near[held], cosines]),
                np.concatenate([fresh[held], np.ones(len(a), bool)]),
                count,
                keep,
            )

    width = -(-count // max(1, round(count / o.group)))
    for order in (np.arange(count), chance.permutation(count)):
        padded = np.concatenate([order, np.full(-count % width, -1)]).reshape(-1, width)
        join(padded, padded >= 0)
    for _ in range(o.rounds):
        a, place = np.nonzero(lists >= 0)
        b, new = lists[a, place], fresh[a, place]
        order = np.lexsort((chance.random(len(a)), ~new, b))
        back, at = _listed(b[order], a[order], count, keep)
        around = np.concatenate([lists, back], axis=1)
        marks = np.concatenate([fresh, (at >= 0) & new[order][np.maximum(at, 0)]], axis=1)
        fresh[:] = False
        join(around, marks)
        if fresh.sum() <= o.settled * count * o.degree:
            break
    return lists, near


def _places(count: int) -> str:
    """The type of places in a shard; the place for none lies beyond them, -1 becoming 65535 in two bytes."""
    return "<u2" if count < 65535 else "<i4"


def graphs(blocks: DataFrame, kind: str, o: Options) -> DataFrame:
    """``blocks`` with ``around``: for every point the places of its neighbours, and of the nearest it is a neighbour of."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                lists, near = descend(units_of(row.column("vectors")[0].as_py(), row.column("size")[0].as_py(), kind), o)
                a, place = np.nonzero(lists >= 0)
                b = lists[a, place]
                order = np.lexsort((-near[a, place], b))
                back = _listed(b[order], a[order], len(lists), 2 * o.degree)[0]
                around = np.concatenate([lists, back], axis=1).astype(_places(len(lists))).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [*row.columns, pa.array([around], pa.binary())], [*row.schema.names, "around"]
                )

    schema = StructType([*blocks.schema.fields, StructField("around", BinaryType())])
    return blocks.mapInArrow(link, schema)


def build_indexes(
    rows: DataFrame, k: int, o: Options, key: str = "vec_id", vector: str = "embedding"
) -> dict[int, Index]:
    """An index of every usable vector, one for each dimension that occurs.

    Equal vectors are one node; of the keys that bear it the ``k + 1`` least are
    kept, which is all that a list of k nearest can name.
    """
    kind = element(rows, vector)
    body = rows.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").alias("given"))
    marked = with_packed(body, "given", kind).where("vector IS NOT NULL").select("id", "vector", "digest")
    marked = settle(marked, "vectors")
    found = marked.agg(F.countDistinct("digest").alias("n"), F.max(F.length("vector")).alias("bytes")).first()
    pivots = range_join.pivots_of(marked, found["n"], found["bytes"], range_join.CELL_ROWS, kind)
    points = marked.groupBy("digest").agg(F.first("vector").alias("vector"), F.lit(1).cast("bigint").alias("copies"))
    points = range_join.assign_cells(points.withColumn("node", F.monotonically_increasing_id()), pivots, kind)
    points = settle(points, "points")
    ids = _top(marked.select("digest", "id").distinct(), "digest", [F.col("id")], k + 1)
    members = settle(ids.join(points.select("digest", "node"), "digest").select("node", "id"), "members")
    blocks = range_join.pack_blocks(points, range_join.block_rows(found["n"], o.shard, LEAST_SHARDS), kind)
    shards = settle(graphs(blocks, kind, o), "shards")
    homes: dict[int, set[tuple[int, int]]] = {}
    for r in shards.select("block", "size", "cells").toLocalIterator():
        homes.setdefault(r["size"], set()).update((r["block"], c) for c in set(np.frombuffer(r["cells"], np.int32).tolist()))
    out = {}
    for size, cells in sorted(homes.items()):
        held = np.array(sorted(cells))
        at = pivots[size][held[:, 1]] if size in pivots else np.zeros((len(held), size), np.float32)
        mine = F.col("size") == size
        out[size] = Index(size, kind, points.where(mine), members, shards.where(mine), (held[:, 0], at))
    return out


def _query_blocks(index: Index, queries: DataFrame, count: int, o: Options) -> DataFrame:
    """(qs, own, vectors, ranks): queries in blocks, the node each is itself, and the rank of every shard by its nearest cell."""
    shared = queries.sparkSession.sparkContext.broadcast(index.cells)
    size, kind = index.size, index.kind

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not sum(b.num_rows for b in held):
            return
        table = pa.Table.from_batches(held)
        vectors = b"".join(table.column("vector").to_pylist())
        homes, at = shared.value
        starts = np.flatnonzero(np.r_[True, homes[1:] != homes[:-1]])
        near = np.maximum.reduceat(units_of(vectors, size, kind).astype(np.float32) @ at.T, starts, axis=1)
        ranks = np.argsort(np.argsort(-near, axis=1, kind="stable"), axis=1).astype(np.int32)
        packed = [table.column("q").to_numpy().tobytes(), table.column("own").to_numpy().tobytes(), vectors, ranks.tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in packed], ["qs", "own", "vectors", "ranks"])

    nodes = index.points.select("digest", F.col("node").alias("own"))
    known = queries.join(nodes, "digest", "left").select("q", F.coalesce("own", F.lit(-1)).alias("own"), "vector")
    # A partition is a block; by hash one may be larger than another.
    dealt = known.repartition(blocks_of(count, o), "q")
    return settle(dealt.mapInArrow(pack, "qs binary, own binary, vectors binary, ranks binary"), "query-blocks")


def _walk(units: np.ndarray, around: np.ndarray, entries: np.ndarray, own: np.ndarray, asked: np.ndarray, o: Options):
    """(nodes, near): for each query the ``width`` nearest nodes that a greedy walk over the graph of a shard sees."""
    count, n = len(asked), len(units)
    width = min(o.width, n)
    #: Of every query and node: -1, or in which place of a step the node was first reached.
    stamp = np.full(count * n, -1, np.int32)
    pool, near = np.zeros((count, width), np.int64), np.full((count, width), -3.0)
    done = np.ones((count, width), bool)
    q = np.repeat(np.arange(count), len(entries))
    nodes = np.tile(entries, count)
    at_home = np.flatnonzero(own >= 0)
    q, nodes = np.concatenate([q, at_home]), np.concatenate([nodes, own[at_home]])
    while len(q):
        # Each node is scored once a query, also if it is reached twice in a step.
        key = q * n + nodes
        new = np.flatnonzero(stamp[key] < 0)
        key = key[new]
        stamp[key] = new
        new = new[stamp[key] == new]
        q, nodes = q[new], nodes[new]
        score = np.einsum("ij,ij->i", units[nodes], asked[q])
        nearer = np.flatnonzero(score > near[q, -1])
        order = nearer[np.argsort(q[nearer], kind="stable")]
        q, nodes, score = q[order], nodes[order], score[order]
        most = int(np.bincount(q, minlength=count).max()) if len(q) else 0
        found, places = _listed(q, nodes, count, most)
        offers = np.where(places >= 0, score[np.maximum(places, 0)] if len(q) else 0.0, -3.0)
        all_near = np.concatenate([near, offers], axis=1)
        best = np.argsort(-all_near, axis=1, kind="stable")[:, :width]
        near = np.take_along_axis(all_near, best, 1)
        pool = np.take_along_axis(np.concatenate([pool, found], axis=1), best, 1)
        done = np.take_along_axis(np.concatenate([done, found < 0], axis=1), best, 1)
        front = ~done & (np.cumsum(~done, axis=1) <= o.expand)
        done |= front
        q, place = np.nonzero(front)
        reached = around[pool[q, place]].astype(np.int64)
        q, nodes = np.repeat(q, reached.shape[1]), reached.ravel()
        real = np.flatnonzero((nodes >= 0) & (nodes < n))
        q, nodes = q[real], nodes[real]
    return pool, near


def _search(index: Index, blocks: DataFrame, k: int, o: Options, probes: int) -> DataFrame:
    """(q, node, near, place): the nearest nodes in each of the ``probes`` shards nearest to a query, scored in doubles.

    Every shard meets every block of queries by a Cartesian product, which writes
    nothing; a task has one of each in memory.
    """
    size, kind = index.size, index.kind
    names = {b: i for i, b in enumerate(np.unique(index.cells[0]).tolist())}

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, units, around, nodes, entries = None, None, None, None, None
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                asked = np.frombuffer(row["qs"], np.int64)
                place = np.frombuffer(row["ranks"], np.int32).reshape(len(asked), -1)[:, names[row["block"]]]
                near_by = np.flatnonzero(place < probes)
                if not len(near_by):
                    continue
                if number != row["block"]:
                    number, units = row["block"], units_of(row["shard"], size, kind)
                    nodes = np.frombuffer(row["nodes"], np.int64)
                    around = np.frombuffer(row["around"], _places(len(nodes))).reshape(len(nodes), -1)
                    starts = np.frombuffer(row["starts"], np.int32)
                    more = np.random.default_rng(o.seed).permutation(len(nodes))[: max(0, o.entries - len(starts))]
                    entries = np.unique(np.concatenate([starts, more]).astype(np.int64))
                    order = np.argsort(nodes)
                own, wanted = np.frombuffer(row["own"], np.int64), units_of(row["vectors"], size, kind)
                places = order[np.minimum(np.searchsorted(nodes, own, sorter=order), len(nodes) - 1)]
                places = np.where(nodes[places] == own, places, -1)
                step = max(1, min((1 << 20) // len(nodes), SCORED // (o.expand * max(1, around.shape[1]))))
                for part in (near_by[i : i + step] for i in range(0, len(near_by), step)):
                    pool, near = _walk(units, around, entries, places[part], wanted[part], o)
                    # Equal scores go by key, so all that equal the last one needed stay.
                    last = near[:, min(k, near.shape[1] - 1)]
                    i, j = np.nonzero((near > -2.5) & (near >= last[:, None]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v) for v in (asked[part][i], nodes[pool[i, j]], near[i, j], place[part][i])],
                        ["q", "node", "near", "place"],
                    )

    shard = ["block", "starts", "nodes", "around", F.col("vectors").alias("shard")]
    pairs = index.shards.select(*shard).crossJoin(blocks.hint("shuffle_replicate_nl"))
    return settle(pairs.mapInArrow(search, "q bigint, node bigint, near double, place int"), "nearest")


def _scanned(index: Index, block: DataFrame, keep: int) -> DataFrame:
    """(q, node, near): the ``keep`` nearest nodes of each query of one block, by comparing with every vector."""
    local = block.select("q", "vector").orderBy("q").toArrow()
    size, kind = index.size, index.kind
    shared = block.sparkSession.sparkContext.broadcast(
        (local.column("q").to_numpy(), units_of(b"".join(local.column("vector").to_pylist()), size, kind))
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, units = shared.value
        near, node = np.zeros((len(numbers), 0)), np.zeros((len(numbers), 0), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            near = np.hstack([near, units @ units_of(b"".join(batch.column("vector").to_pylist()), size, kind).T])
            node = np.hstack([node, np.broadcast_to(batch.column("node").to_numpy(), (len(numbers), batch.num_rows))])
            at = np.argsort(-near, axis=1, kind="stable")[:, :keep]
            near, node = np.take_along_axis(near, at, 1), np.take_along_axis(node, at, 1)
        q = np.repeat(numbers, near.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(node.ravel()), pa.array(near.ravel())], ["q", "node", "near"])

    offers = index.points.select("node", "vector").mapInArrow(scan, "q bigint, node bigint, near double")
    return settle(_top(offers, "q", [F.col("near").desc(), F.col("node")], keep), "scanned")


def measured_recall(found: DataFrame, scanned: DataFrame, own: DataFrame, k: int) -> list[tuple[int, float]]:
    """(place, share) by place: of the ``k`` nearest nodes of ``scanned``, own nodes left out, the share that ``found``
    names, or equals in score, in shards up to that place."""
    wanted = _top(scanned.join(own, ["q", "node"], "left_anti"), "q", [F.col("near").desc(), F.col("node")], k)
    limits = wanted.groupBy("q").agg(F.min("near").alias("limit"), F.count(F.lit(1)).alias("n"))
    mine = found.join(own, ["q", "node"], "left_anti").join(limits, "q").where(F.col("near") >= F.col("limit") - 1e-12)
    turn = F.row_number().over(W.partitionBy("q").orderBy("place", "node"))
    hits = mine.withColumn("turn", turn).where("turn <= n").groupBy("place").count().orderBy("place").collect()
    total = max(1, limits.agg(F.sum("n").alias("n")).first()["n"] or 0)
    shares = np.cumsum([r["count"] for r in hits]) / total
    return [(r["place"], float(share)) for r, share in zip(hits, shares, strict=True)]


def widened(index: Index, one: DataFrame, k: int, o: Options) -> tuple[Options, int, float]:
    """Options and the number of shards with which the search reaches ``o.recall`` on a sample of the queries, and what it reaches.

    The sample is the queries of least hash.  A pool as large as a shard ends
    the search for more; it then leaves out only what the graphs do not reach.
    """
    chosen = one.orderBy(F.xxhash64(F.lit(o.seed + 1), "digest"), "digest").limit(o.sample)
    block = settle(chosen, "sample")
    own = block.join(index.points.select("digest", "node"), "digest").select("q", "node")
    scanned = _scanned(index, block, k + 1)
    sampled, count, shards = block.count(), index.points.count(), len(np.unique(index.cells[0]))
    asked = _query_blocks(index, block, sampled, o)
    while True:
        shares = measured_recall(_search(index, asked, k, o, shards), scanned, own, k)
        reached = shares[-1][1] if shares else 0.0
        LOG.info("recall %.4f on %d sampled queries of %d vectors, width %d", reached, sampled, count, o.width)
        if reached >= o.recall:
            probes, reached = next((place + 1, share) for place, share in shares if share >= o.recall)
            LOG.info("recall %.4f in %d of %d shards", reached, probes, shards)
            return o, probes, reached
        if o.width >= min(count, 2 * o.shard):
            return o, shards, reached
        o = replace(o, width=2 * o.width, expand=2 * o.expand)


def nearest(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 5,
    options: Options = Options(),
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score, recall): the k nearest rows found for each query, by cosine.

    Every row of ``rows`` is indexed and may be found; a query does not find
    rows of its own key.  Scores are cosines of the original vectors in doubles;
    the nearest comes first, ties go to the smaller key.  The search is
    approximate, but measured: it is widened until it finds ``recall`` of the
    answers of a sample of queries, and what it returns is ranked exactly.
    ``recall`` is the share it reached for vectors of the query's dimension; it
    is below the aim only where a pool as large as the table did not suffice.

    Vectors that are null, empty, zero, or hold null or non-finite components,
    and rows without a key, take no part; vectors of different dimension are not
    compared.  Repeated keys with equal vectors count once.  With fewer than k
    candidates there are fewer rows; no queries or no rows: none.  Other columns
    are left out.
    """
    o, kind = options, element(rows, vector)
    if element(queries, vector) != kind:
        rows, queries = (df.withColumn(vector, F.col(f"`{vector}`").cast("array<double>")) for df in (rows, queries))
        kind = "<f8"
    body = queries.where(F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").alias("query_id"), F.col(f"`{vector}`").alias("given")
    )
    asked = with_packed(body, "given", kind).where("vector IS NOT NULL")
    asked = settle(asked.select("query_id", "vector", "digest").distinct(), "queries")
    spark = rows.sparkSession
    out = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double, recall double")
    width = np.dtype(kind).itemsize
    for size, index in build_indexes(rows, k, o, key, vector).items():
        mine = asked.where(F.length("vector") == size * width)
        one = mine.groupBy("digest").agg(F.first("vector").alias("vector"))
        one = settle(one.withColumn("q", F.monotonically_increasing_id()), "query-vectors")
        if one.isEmpty():
            continue
        wide, probes, reached = widened(index, one, k, o)
        found = _search(index, _query_blocks(index, one, one.count(), wide), k, wide, probes).drop("place")
        # A node bears one key at least, and one node may be the query's own; equal scores go by key, so they stay.
        place = F.rank().over(W.partitionBy("q").orderBy(F.col("near").desc()))
        best = found.withColumn("place", place).where(F.col("place") <= k + 1).drop("place")
        ids = best.join(index.members, "node").select("q", "id", "near").join(one.select("q", "digest"), "q")
        named = ids.join(mine.select("query_id", "digest"), "digest").where(F.col("query_id") != F.col("id"))
        rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id")))
        ranked = (
            named.groupBy("query_id", F.col("id").alias("vec_id"))
            .agg(F.max("near").alias("score"))
            .withColumn("rank", rank)
            .where(F.col("rank") <= k)
        )
        out = out.unionByName(ranked.select("query_id", "rank", "vec_id", "score", F.lit(reached).alias("recall")))
    return out
