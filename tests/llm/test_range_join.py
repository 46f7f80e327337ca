"""The range join against comparing every pair."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaywork.llm import common, range_join
from quaywork.llm.range_join import near_duplicates

SCHEMA = "vec_id bigint, embedding array<double>, n_links string, node string"


def vectors(size=8):
    rng = np.random.default_rng(1)
    out = [(i, (rng.normal(size=size) * rng.choice([1e-3, 1, 1e5])).tolist()) for i in range(300)]
    centre = rng.normal(size=size)
    out += [(1000 + i, (centre + rng.normal(size=size) * 0.12).tolist()) for i in range(150)]
    walk = rng.normal(size=size)
    for i in range(60):
        out.append((2000 - i, walk.tolist()))
        walk = walk / np.linalg.norm(walk) + rng.normal(size=size) * 0.08
    out += [(3000 + i, out[0][1]) for i in range(40)] + [(2, out[2][1]), (None, out[1][1])]
    out += [(4000, None), (4001, []), (4002, [0.0] * size), (4003, [float("nan")] * size)]
    out += [(4004, [float("inf")] + [1.0] * (size - 1)), (4005, [None] + [1.0] * (size - 1)), (4006, [1.0, 2.0])]
    out += [(4007, [1.0, 2.0]), (4008, [3e200] * size), (4009, [2e200] * size), (4010, None)]
    return out


def brute(rows, least=0.95):
    def unit(v):
        if v is None or not v or None in v or not np.isfinite(v).all() or not np.any(v):
            return None
        x = np.array(v) / np.abs(v).max()
        return x / np.linalg.norm(x)

    units = [unit(v) for _, v in rows]
    n, label = len(rows), list(range(len(rows)))
    linked = np.zeros((n, n), bool)
    for size in {len(u) for u in units if u is not None}:
        at = [i for i, u in enumerate(units) if u is not None and len(u) == size]
        m = np.stack([units[i] for i in at])
        linked[np.ix_(at, at)] = m @ m.T >= least
    np.fill_diagonal(linked, False)
    changed = True
    while changed:
        changed = False
        for i, j in zip(*np.nonzero(linked), strict=True):
            if label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                changed = True
    least_of = {}
    for (key, _), group in zip(rows, label, strict=True):
        known = [k for k in (least_of.get(group), key) if k is not None]
        least_of[group] = min(known) if known else None
    return sorted(
        str((key, int(linked[i].sum()), least_of[label[i]], least_of[label[i]] == key))
        for i, (key, _) in enumerate(rows)
    )


@pytest.mark.parametrize(("cell", "homes", "stream"), [(2000, 4096, 1024), (40, 4096, 1024), (500, 30, 16)])
def test_links_and_components(spark, monkeypatch, cell, homes, stream):
    monkeypatch.setattr(range_join, "HOME_ROWS", homes)
    monkeypatch.setattr(range_join, "STREAM_ROWS", stream)
    rows = vectors()
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    found = near_duplicates(docs, cell_rows=cell)
    assert found.columns == ["vec_id", "node", "n_links", "component_id", "kept"]
    got = sorted(
        str((r["vec_id"], r["n_links"], r["component_id"], r["kept"])) for r in found.collect()
    )
    assert got == brute(rows)


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert near_duplicates(docs).count() == 0
    assert near_duplicates(spark.createDataFrame([(1, None, "", "")], SCHEMA)).collect()[0]["component_id"] == 1


def test_columns_named_like_added_ones_stay(spark):
    rows = [(1, [1.0, 0.0], "d1", "v1", "g1"), (2, [1.0, 0.01], "d2", "v2", "g2"), (3, None, "d3", "v3", "g3")]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, digest string, vector string, given string")
    got = {r["vec_id"]: r for r in near_duplicates(docs).collect()}
    assert [(got[i]["digest"], got[i]["vector"], got[i]["given"]) for i in (1, 2, 3)] == [r[2:] for r in rows]
    assert [got[i]["component_id"] for i in (1, 2, 3)] == [1, 1, 3]


def test_points_are_not_written_for_every_cell_they_reach(spark, monkeypatch):
    written = {}

    def settle(df, label):
        out = common.settle(df, label)
        vectors = [c for c in ("vector", "vectors") if c in out.columns]
        if vectors:
            size = out.select(F.sum(F.length(F.to_json(F.struct(*vectors))))).first()[0]
            written[label] = written.get(label, 0) + size
        return out

    monkeypatch.setattr(range_join, "settle", settle)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16).tolist(), "x", "y") for i in range(1500)]
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA), cell_rows=30)
    assert found.count() == 1500
    # Every settled table holds a vector once; 50 cells, nearly all of which a random point reaches.
    assert written and max(written.values()) <= 1.5 * written["vectors"]
