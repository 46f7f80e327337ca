"""The factorization machine: its formula, what it learns, and edge cases."""

from __future__ import annotations

import random

import numpy as np
import pytest

from quaywork.llm.toxicity import Machine, Options, fit_machine, hashed_terms, held_out, score_toxicity
from quaywork.llm.toxicity_queries import op9_toxicity

DOCS, LABELS = "doc_id bigint, text string, score string, label string", "doc_id bigint, toxic int"


def test_margins_sum_all_pairs():
    rng = np.random.default_rng(0)
    machine = Machine(np.arange(9), 0.3, rng.normal(size=9), rng.normal(size=(9, 4)), 20)
    for row in ([], [2], [0, 3, 8], list(range(9))):
        pairs = sum(machine.pairs[a] @ machine.pairs[b] for a in row for b in row if a < b)
        assert abs(machine.margins([row])[0] - (0.3 + machine.weights[row].sum() + pairs)) < 1e-9


def test_pairs_are_learned_where_no_single_term_tells(spark):
    """Toxic if exactly both or neither of two words occur: no additive weights separate that."""
    r = random.Random(0)
    rows = []
    for i in range(1200):
        a, b = r.random() < 0.5, r.random() < 0.5
        words = ["insult"] * a + ["group"] * b + r.choices(["plain", "filler", "words"], k=8)
        rows.append((i, " ".join(r.sample(words, len(words))), int(a == b)))
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 900], LABELS)
    scored = {r["doc_id"]: r["predicted"] for r in score_toxicity(docs, fit_machine(docs, labels)).collect()}
    assert sum(scored[i] == y for i, _, y in rows[900:]) >= 295


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in op9_toxicity(spark, folder).collect() if r["held_out"] and r["doc_id"] in truth]
    toxic = [r for r in rows if truth[r["doc_id"]] == 1]
    clean = [r for r in rows if truth[r["doc_id"]] == 0]
    assert sum(r["predicted"] for r in toxic) >= 0.7 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)


def test_scores_equal_the_formula_on_whole_texts(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    machine = fit_machine(docs, labels)
    found = {r["doc_id"]: r["score"] for r in score_toxicity(docs, machine).collect()}
    place = {int(b): i for b, i in machine.places.items()}
    for r in docs.collect():
        held = sorted(place[b] for b in hashed_terms(r["text"] or "", 20) if b in place)
        margin = machine.bias + sum(machine.weights[i] for i in held)
        margin += sum(machine.pairs[a] @ machine.pairs[b] for a in held for b in held if a < b)
        assert abs(found[r["doc_id"]] - 1 / (1 + np.exp(-margin))) < 1e-9


def test_nothing_telling_leaves_the_bias(spark):
    docs = spark.createDataFrame([(i, f"word{i}", "", "") for i in range(10)], DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], LABELS)
    machine = fit_machine(docs, labels)
    assert not machine.places and {r["score"] for r in score_toxicity(docs, machine).collect()} == {0.5}


@pytest.mark.parametrize("labels", [[], [(0, 1), (1, 1)], [(0, 0)], [(None, 1), (0, None)]])
def test_labels_of_one_kind_or_none(spark, labels):
    docs = spark.createDataFrame([(0, "a", "", ""), (1, None, None, None), (None, "", "", "")], DOCS)
    machine = fit_machine(docs, spark.createDataFrame(labels, LABELS))
    out = score_toxicity(docs, machine)
    assert out.columns == ["doc_id", "text", "label", "score", "predicted"]
    assert {r["predicted"] for r in out.collect()} == {int(labels[:1] == [(0, 1)])}
    assert all(0 <= r["score"] <= 1 for r in out.collect())


def test_repeated_rows_long_texts_and_empty_tables(spark):
    rows = [(i, "awful idiot" if i % 2 else "kind words " * (20_000 if i == 4 else 1), "", "") for i in range(40)] * 2
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 0), (1, 1)], LABELS)
    machine = fit_machine(docs, labels, Options(ratios=(3.0,)))
    got = score_toxicity(docs, machine).collect()
    assert len(got) == 80 and all(r["predicted"] == r["doc_id"] % 2 for r in got)
    assert score_toxicity(docs.where("false"), machine).count() == 0
    fit_machine(docs.where("false"), labels)


def test_terms_and_folds(spark):
    assert hashed_terms("Idiot, idiot! IDIOT_x", 20) == hashed_terms("idiot x", 20)
    got = spark.createDataFrame([(None,), (1,)], "k bigint").select(held_out("k", 1, 0).alias("h")).collect()
    assert [r["h"] for r in got] == [False, True]
