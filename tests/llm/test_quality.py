"""Quality rules: counts against plain loops, learned lists against planted rules and held-out labels."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np

from quaywork.llm.quality import COUNTS, DecisionList, Options, cover, counts_of, fit_rules, judge, repeated_words
from quaywork.llm.quality_queries import op12_quality

SCHEMA = "doc_id bigint, text string, n_words string, rule string, row string, counts string"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = (text or "").split("\n")
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    n = len(words)
    return n, sum(map(len, words)), symbols, dup, len(covered), n < 10 or 100 * len(covered) > 20 * n


def texts(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        words = rng.choices(["a", "b", "Ü#x", "über", "12", " ", "|", "漢字", "end."], k=rng.randrange(40))
        yield "".join(w + rng.choice([" ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b"]) for w in words)


def test_counts_equal_plain_loops(spark):
    rows = [(i, t, "x", "y", "z", "c") for i, t in enumerate(texts(1, 300))]
    rows += [(1000, None, None, None, None, None), (1001, "", None, None, None, None), (None, "a " * 9, "", "", "", "")]
    rows += [(1002, "long word " * 60_000, "", "", "", "")] + [(5, "twice", "", "", "", "")] * 2
    found = judge(spark.createDataFrame(rows, SCHEMA), DecisionList(())).collect()
    assert len(found) == len(rows) and found[0].asDict()["counts"] == "c"
    got = sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, *(r[c] for c in COUNTS[:5]), r["base_failed"]) for r in found if r["doc_id"] != 1002
    )
    assert got == sorted((d is None, d or 0, *plain(t)) for d, t, *_ in rows if d != 1002)
    assert all(r["kept"] == (not r["base_failed"]) for r in found)
    assert counts_of("long word " * 60_000)[:5] == (120_000, 480_000, 0, 0, 120_000)
    assert judge(spark.createDataFrame([], SCHEMA), DecisionList(())).count() == 0


def test_repeats_of_many_different_words():
    words = [str(i) for i in range(50_000)] * 2
    assert repeated_words(words) == 100_000
    assert repeated_words(words[:50_004]) == 4 or repeated_words(words[:50_005]) == 10


def test_covering_finds_planted_conjunctions():
    rng = np.random.default_rng(3)
    values = rng.random((6000, 4))
    bad = ((values[:, 0] >= 0.8) & (values[:, 1] <= 0.3)) | (values[:, 2] >= 0.9)
    names = ["words", "word length", "symbols a character", "words a line"]
    found = cover(values, bad, rng.random(6000) < 1 / 3, names, Options())
    held = np.zeros(6000, bool)
    for rule in found.rules:
        inside = np.ones(6000, bool)
        for c in rule:
            inside &= c.holds(values, names)
        held |= inside
    assert (held == bad).mean() > 0.995 and len(found.rules) <= 5


def test_noise_gives_no_rules():
    rng = np.random.default_rng(4)
    values = rng.random((3000, 3))
    found = cover(values, rng.random(3000) < 0.1, rng.random(3000) < 1 / 3, ["words", "word length", "words a line"], Options())
    assert found.rules == ()


def test_expressions_equal_the_rules(spark):
    rows = [(i, t + " ".join(f"w{n}" for n in range(12)), "", "", "", "") for i, t in enumerate(texts(2, 900))]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame(
        [(i, int("|" not in t)) for i, t, *_ in rows] + [(None, 0), (3, None)], "doc_id bigint, quality int"
    )
    rules = fit_rules(docs.select("doc_id", "text"), labels)
    assert rules.rules and "symbols" in str(rules)
    again = fit_rules(docs.select("doc_id", "text").repartition(7), labels)
    assert str(again) == str(rules)
    for r in judge(docs, rules).collect():
        assert r["kept"] == (not r["base_failed"] and r["rule"] == 0)


def test_no_labels_keep_all(spark):
    docs = spark.createDataFrame([(1, "w " * 20)], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert fit_rules(docs, none).rules == ()
    one = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    assert fit_rules(docs, one).rules == ()


def test_query_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    found = {r["doc_id"]: r for r in op12_quality(spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        row = found[r["doc_id"]]
        assert (*(row[c] for c in COUNTS[:5]), row["base_failed"]) == plain(r["text"])
        assert row["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    held = [(found[r["doc_id"]], r["quality"]) for r in labels if r["doc_id"] in found and found[r["doc_id"]]["held_out"]]
    right = sum(row["kept"] == bool(q) for row, q in held if not row["base_failed"])
    assert len(held) > 40 and right >= 0.95 * sum(not row["base_failed"] for row, _ in held)
