"""Mixing against a plain computation, and its edge cases."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from quaywork.llm.mixing import mix, plan_mix

SCHEMA = "doc_id bigint, text string, source string, size string, row string"


def shared_out(sizes: dict, weights: dict, cap: float = 3.0) -> dict:
    """Shares by weight; what passes a cap is shared again until none does."""
    total, fixed, free = float(sum(sizes.values())), {}, set(sizes)
    while free:
        rest = total - sum(fixed.values())
        unit = rest / sum(weights[s] for s in free)
        above = {s for s in free if weights[s] * unit > cap * sizes[s]}
        if not above:
            return fixed | {s: weights[s] * unit for s in free}
        fixed |= {s: cap * sizes[s] for s in above}
        free -= above
    return fixed


def rows(spark):
    out = [(i, "w " * (1 + i % 7), "a", "x", "y") for i in range(400)]
    out += [(1000 + i, "one two", "b", None, None) for i in range(30)]
    out += [(2000 + i, "z", "c", None, None) for i in range(3)]
    out += [(3000, None, None, None, None), (3001, "null source", None, None, None), (None, "no key", "a", "", "")]
    out += [(5, "w w", "a", "x", "y")] * 2 + [(4000, "", "empty", None, None), (4001, "long " * 50_000, "b", "", "")]
    return spark.createDataFrame(out, SCHEMA)


def test_targets_copies_and_columns(spark):
    docs = rows(spark)
    plan = plan_mix(docs)
    got = plan.collect()
    assert plan.columns == ["doc_id", "text", "source", "row", "size", "source_size", "target", "rate", "copies"]
    assert len(got) == docs.count()
    sizes: dict = {}
    for r in docs.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len((r["text"] or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = shared_out(sizes, {s: i % 3 + 1 for i, s in enumerate(order)})
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9, abs_tol=1e-9)
        assert r["size"] == len((r["text"] or "").split())
        assert math.floor(r["rate"]) <= r["copies"] <= math.ceil(r["rate"]) <= 3
    assert sorted(map(str, plan.collect())) == sorted(map(str, got))


def test_taken_words_come_near_the_targets(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.expr("repeat('w ', 1 + cast(id % 11 as int))").alias("text"),
        F.concat(F.lit("s"), F.col("id") % 4).alias("source"),
    )
    for r in (
        plan_mix(docs)
        .groupBy("source")
        .agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.max("target").alias("target"))
        .collect()
    ):
        assert abs(r["taken"] - r["target"]) < 0.08 * r["target"]


def test_mix_emits_each_copy_with_its_own_columns(spark):
    docs = rows(spark)
    counts = {}
    for r in plan_mix(docs).collect():
        counts[r["doc_id"], r["text"]] = counts.get((r["doc_id"], r["text"]), 0) + r["copies"]
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    assert {r["size"] for r in mixed.collect()} <= {"x", "", None}
    seen: dict = {}
    for r in mixed.collect():
        seen[r["doc_id"], r["text"]] = seen.get((r["doc_id"], r["text"]), 0) + 1
    assert seen == {k: n for k, n in counts.items() if n}


def test_given_weights_and_budget(spark):
    docs = spark.createDataFrame([(i, "a b c d", "x" if i % 2 else "y") for i in range(100)], "doc_id bigint, text string, source string")
    weights = spark.createDataFrame([("x", 1.0)], "source string, weight double")
    plan = {r["source"]: r["target"] for r in plan_mix(docs, weights, budget=50.0).collect()}
    assert plan == {"x": 50.0, "y": 0.0}


def test_empty(spark):
    assert plan_mix(rows(spark).limit(0)).count() == 0
    assert mix(rows(spark).where("false")).count() == 0
