"""Nearest neighbours: recall against brute force, exact scores, ties and small inputs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from quaywork.llm import common, neighbours, range_join
from quaywork.llm.neighbours import Options, blocks_of, nearest

SCHEMA = "vec_id bigint, embedding array<double>, node string, rank string"


def found(spark, rows, k=5, **options):
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    out = nearest(docs, docs.where(F.col("vec_id") % 50 == 0), k, Options(**options))
    assert out.columns == ["query_id", "rank", "vec_id", "score", "recall"]
    got: dict = {}
    for r in sorted(out.collect()):
        assert r["recall"] >= options.get("recall", Options().recall)
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


def brute(rows, k=5):
    use = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    want = {}
    for q, x in use:
        if q % 50 == 0:
            scores = {
                i: float(x @ y / np.sqrt((x @ x) * (y @ y))) for i, y in use if i != q and len(x) == len(y)
            }
            want[q] = sorted(scores.items(), key=lambda s: (-round(s[1], 12), s[0]))[:k]
    return want


def test_recall_and_scores(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 24))
    rows = [(i, (centres[i % 40] * (i % 3) + rng.normal(size=24)).tolist()) for i in range(3000)]
    got, want = found(spark, rows, width=200, expand=32), brute(rows)
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    vectors = {i: np.array(v) for i, v in rows}
    for q, near in got.items():
        assert [s for _, s in near] == sorted((s for _, s in near), reverse=True)
        for i, score in near:
            x, y = vectors[q], vectors[i]
            assert abs(score - x @ y / np.sqrt((x @ x) * (y @ y))) < 1e-12


def test_copies_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(3)
    same = rng.normal(size=6).tolist()
    rows = [(i, same) for i in range(0, 400, 3)] + [(i, rng.normal(size=6).tolist()) for i in range(1, 400, 3)]
    rows += [(1000, None), (1050, []), (1100, [0.0] * 6), (1150, [float("nan")] * 6), (1200, [None] + [1.0] * 5)]
    rows += [(None, same), (1, rows[-7][1]), (1250, [1.0, 2.0]), (1251, [2.0, 4.1]), (0, same)]
    got, want = found(spark, rows), brute(rows)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert [i for i, _ in got[150]] == [0, 3, 6, 9, 12]
    assert [i for i, _ in got[1250]] == [1251]


def test_few_or_none(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 1.0]), (7, [0.0, -1.0])]
    assert {q: [i for i, _ in v] for q, v in found(spark, rows).items()} == {0: [50, 7], 50: [0, 7]}
    assert found(spark, rows[:1]) == {}
    docs = spark.createDataFrame([], SCHEMA)
    assert nearest(docs, docs).count() == 0


def test_recall_in_a_group_of_noisy_copies(spark):
    rng = np.random.default_rng(5)
    common = rng.normal(size=64)
    rows = [(i, (common + 0.001 * rng.normal(size=64)).tolist()) for i in range(3000)]
    got, want = found(spark, rows), brute(rows)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_search_widens_until_the_sample_is_found(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=32).tolist()) for i in range(2000)]
    got, want = found(spark, rows, width=16, expand=8, entries=4, frontier=2048), brute(rows)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_blocks_shrink_as_the_search_widens():
    for expand in (1, 128, 1000, 10**7):
        o = Options(expand=expand)
        blocks = blocks_of(100_000, o)
        a_block = -(-100_000 // blocks)
        assert a_block <= o.query_block and (a_block == 1 or a_block * expand <= 1.01 * o.frontier)


def test_what_is_written_follows_the_rows(spark, monkeypatch):
    written = {}

    def settle(df, label):
        out = common.settle(df, label)
        written[label] = written.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(neighbours, "settle", settle)
    monkeypatch.setattr(range_join, "LEAST_ROWS", 300, raising=False)
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(3000)]
    got, want = found(spark, rows), brute(rows)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    # Neither the graph, 24 neighbours a row and more, nor the nodes a search sees are written row by row.
    assert sum(written.values()) <= 8 * len(rows)
