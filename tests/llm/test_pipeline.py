"""The pipeline: each stage against what its operator decides alone."""

from __future__ import annotations

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from quaywork.llm.common import settle
from quaywork.llm.mixing import plan_mix
from quaywork.llm.pieces import MODEL
from tests.llm.test_privacy import brute as base_spans
from tests.llm.test_simhash import groups_of, plain_fingerprint

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(settle(stage(spark, out[-1], FOLDER), name))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "private_data", "mixing", "piece_ids"]
    for df in stages[:-1]:
        assert df.columns == stages[0].columns


def test_toxicity_keeps_clean_documents(spark, stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert after.items() <= before.items()
    gone = set(before) - set(after)
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    clean = {d for d, toxic in labels.items() if toxic == 0}
    assert len(gone & clean) <= 0.02 * len(clean) and len(gone) < 0.15 * len(before)


def test_one_of_each_group_stays(stages):
    before, after = texts(stages[1]), texts(stages[2])
    label = groups_of([(d, plain_fingerprint(t)) for d, t in before.items()])
    assert set(after) == set(label.values()) and after.items() <= before.items()


def test_personal_data_is_gone_and_other_texts_are_untouched(stages):
    before, after = texts(stages[2]), texts(stages[3])
    assert set(before) == set(after)
    for key, text in before.items():
        if base_spans(text):
            assert not base_spans(after[key])
        else:
            assert after[key] == text
    for r in stages[3].collect():
        assert r["n_chars"] == len(r["text"])


def test_mixing_repeats_as_planned(stages):
    plan = {r["doc_id"]: r["copies"] for r in plan_mix(stages[3]).collect()}
    counts = {r["doc_id"]: r["n"] for r in stages[4].groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {d: n for d, n in plan.items() if n}


def test_piece_ids(stages):
    library, known = sentencepiece.SentencePieceProcessor(model_file=MODEL), texts(stages[4])
    rows = stages[5].collect()
    assert len(rows) == stages[4].count()
    for r in rows:
        assert r["ids"] == library.encode(known[r["doc_id"]]) and r["round_trip"]
