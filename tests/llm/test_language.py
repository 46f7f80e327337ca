"""The random field: exact marginals, held-out accuracy, switching texts, edge cases."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from quaywork.llm.language import Chain, Options, emissions, features, fit_chain, identify, words_of
from quaywork.llm.language_queries import op10_language

SCHEMA = "doc_id bigint, text string, lang string, score string, row string"


def plain_marginals(model, scores):
    """Forward-backward over one chain in log space."""

    def total(x):
        top = x.max(axis=0)
        return np.log(np.exp(x - top).sum(axis=0)) + top

    n, size = scores.shape
    a, b = np.zeros((n, size)), np.zeros((n, size))
    a[0] = model.start + scores[0]
    for t in range(1, n):
        a[t] = total(a[t - 1][:, None] + model.steps) + scores[t]
    for t in range(n - 2, -1, -1):
        b[t] = total((model.steps + (scores[t + 1] + b[t + 1])[None, :]).T)
    return np.exp(a + b - total((a + b).T)[:, None])


def test_blocks_give_the_marginals_of_whole_chains():
    rng = np.random.default_rng(0)
    for steps in (rng.normal(size=(3, 3)) * 2, np.zeros((3, 3))):
        model = Chain(list("abc"), np.zeros((4, 3)), rng.normal(size=3), steps, 2)
        lengths = [1, 5, 32, 33, 100, 64, 700]
        scores = rng.normal(size=(sum(lengths), 3)) * 4
        got, at = model.marginals(scores, lengths), 0
        for n in lengths:
            assert np.abs(got[at : at + n] - plain_marginals(model, scores[at : at + n])).max() < 1e-9
            at += n


def test_features_of_a_word_do_not_depend_on_its_neighbours():
    words = ["the", "añadir", "x", "日本", "the"]
    weights = np.random.default_rng(1).normal(size=(1 << 10, 3))
    together = emissions(words, weights, 10)
    for i, word in enumerate(words):
        assert np.allclose(together[i], emissions([word], weights, 10)[0])
    buckets, owners = features(["abc"], 10)
    assert len(buckets) == 4 + 3 + 2 + 1 and set(owners) == {0}
    assert features([], 10)[0].size == 0 and words_of("A b-C1d_é") == ["a", "b", "c", "d", "é"]


def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.1/documents.parquet")


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in documents(spark).select("doc_id", "lang").collect()}
    rows = op10_language(spark, "/root/testdata/sf0.1").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth) and len(held) > 2000
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.99 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_switching_texts_and_edges(spark):
    docs = documents(spark)
    model = fit_chain(docs.where("doc_id % 4 <> 2"), Options(runs_per_label=600))
    assert model.labels == ["de", "en", "es", "fr"]
    texts = {
        r["lang"]: r["text"]
        for r in docs.where("doc_id % 4 = 2 AND n_chars BETWEEN 1500 AND 2500").groupBy("lang").agg(F.min("text").alias("text")).collect()
    }
    mixed = " ".join(words_of(texts["en"])[:100] + words_of(texts["de"])[:200])
    rows = [None, "", " .,;", "123 456", "²", mixed, texts["fr"] * 60, texts["es"], texts["es"], "a"]
    frame = spark.createDataFrame([(i, t, None, "s", "r") for i, t in enumerate(rows)], SCHEMA)
    out = identify(frame, model)
    assert out.columns == ["doc_id", "text", "lang", "row", "lang_pred", "score", "shares"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert [got[i]["lang_pred"] for i in range(5)] == ["und"] * 5 and got[0]["score"] == 0.0
    assert got[5]["lang_pred"] == "de" and 0.6 < got[5]["score"] < 0.73 and 0.27 < got[5]["shares"]["en"] < 0.4
    assert [got[i]["lang_pred"] for i in (6, 7, 8)] == ["fr", "es", "es"] and got[9]["lang_pred"] in model.labels
    assert identify(frame.where("false"), model).count() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words", None, "", ""), (2, None, "en", "", "")], SCHEMA)
    assert {r["lang_pred"] for r in identify(docs, fit_chain(docs)).collect()} == {"und"}
    one = spark.createDataFrame([(1, "some words", "en", "", "")], SCHEMA)
    assert identify(one, fit_chain(one)).collect()[0]["lang_pred"] == "en"


def test_every_language_is_learned(spark):
    """Seventy languages of distinct letters, one of them rare."""
    rows = []
    for n in range(70):
        words = [chr(0x4E00 + 10 * n + i) + chr(0x4E00 + 10 * n + (i * 3) % 10) for i in range(10)]
        rows += [(100 * n + d, " ".join(words[(d + k) % 10] for k in range(40)), f"l{n:02}", "", "") for d in range(2 if n == 7 else 12)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = fit_chain(docs, Options(runs_per_label=20))
    assert len(model.labels) == 70
    found = identify(docs, model).collect()
    assert sum(r["lang_pred"] != f"l{r['doc_id'] // 100:02}" for r in found) <= 0.01 * len(found)
