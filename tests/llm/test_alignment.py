"""Tokenizer alignment against byte positions of whole texts."""

from __future__ import annotations

import hashlib
import json
import random
from bisect import bisect_right
from collections import Counter
from functools import lru_cache

import pytest

from quaywork.llm import alignment
from quaywork.llm.alignment import align, link_scores, load, pair_counts
from quaywork.llm.alignment_queries import op13_alignment
from quaywork.llm.common import settle

SCHEMA = "doc_id bigint, text string, row string, pairs string, n_a string, body string"


@pytest.fixture(scope="module")
def both():
    return load(None)


@lru_cache
def names():
    """The bytes of every token of the byte-level vocabulary, read from the file anew."""
    with open(alignment.BYTE_MODEL) as file:
        vocabulary = json.load(file)["model"]["vocab"]
    back = alignment.byte_alphabet()
    return {i: bytes(back[c] for c in name) for name, i in vocabulary.items() if all(c in back for c in name)}


def tokens_of(both, text):
    a = both.first.encode(" " + text, add_special_tokens=False).ids
    b = both.second.encode(text)
    first = [names()[i] for i in a]
    second = []
    for i in b:
        piece = both.second.id_to_piece(i)
        second.append(bytes([int(piece[3:5], 16)]) if both.second.is_byte(i) else piece.replace("▁", " ").encode())
    whole = (" " + text).encode()
    return (a, b, first, second) if text and b"".join(first) == whole == b"".join(second) else ([], [], [], [])


def plain(both, text):
    """(n_a, n_b, groups, links) by sets of end positions."""
    a, b, first, second = tokens_of(both, text or "")
    ends = []
    for tokens in (first, second):
        at, found = 0, []
        for t in tokens:
            at += len(t)
            found.append(at)
        ends.append(found)
    shared = sorted(set(ends[0]) & set(ends[1]))
    groups, links, since = [], [], 0
    for end in shared:
        one, two = (
            i[bisect_right(e, since) : bisect_right(e, end)] for i, e in ((a, ends[0]), (b, ends[1]))
        )
        groups.append(f"{','.join(map(str, one))}|{','.join(map(str, two))}")
        links.append((one[-1], two[-1]))
        since = end
    return len(a), len(b), ";".join(groups), links


def expected(both, texts):
    rows = [plain(both, t) for t in texts]
    count = Counter(link for r in rows for link in r[3])
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    return [
        (n_a, n_b, len(links), groups, len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links))
        for n_a, n_b, groups, links in rows
    ]


TEXTS = [
    "Hello world, this is text.",
    "  two  spaces   and\ttabs\n\nlines \r\n",
    "<|endoftext|> </s> <s> <unk> <0x41> literally",
    "漢字かな交じり 文章 😀😀 naïve café Ünï",
    "mark ▁ inside",
    "x",
    " ",
    "0123456789 3.14159 http://a.b/c?d=e&f=g",
    "",
    None,
    "Hello world, this is text.",
    "é combining ​ zero \x00 null",
]


def check(spark, both, texts, **options):
    rows = [(i, t, "r", "p", "n", "b") for i, t in enumerate(texts)]
    from pyspark.sql import functions as F

    aligned = align(spark.createDataFrame(rows, SCHEMA)).withColumn("place", F.monotonically_increasing_id())
    found = link_scores(settle(aligned, "aligned"), **options).collect()
    got = {
        r["row"]["doc_id"]: (r["n_a"], r["n_b"], r["n_groups"], r["groups"], r["n_links"], r["n_best"], r["count_sum"]) for r in found
    }
    assert len(found) == len(texts) and all(r["row"]["pairs"] == "p" for r in found)
    for i, value in enumerate(expected(both, texts)):
        assert got[i] == value, texts[i][:80]
    return got


def test_equals_positions(spark, both):
    got = check(spark, both, TEXTS)
    assert got[4][0] == 0 and got[4][3] == "" and got[8][0] == got[9][0] == 0 and got[2][0] > 0


def test_join_by_shuffle_gives_the_same(spark, both):
    check(spark, both, TEXTS, broadcast_pairs=0)


def test_random_and_long_texts(spark, both, monkeypatch):
    rng = random.Random(9)
    parts = ["the", "ing", " ", "  ", "\n", "日本", "ß", "A", "zz", "1", ".", "-", " ", "word", "é"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(150)]
    texts += ["no" * 2_000, " many words" * 3_000, "あ" * 900]
    check(spark, both, texts)


def test_forgotten_windows_change_nothing(both, monkeypatch):
    text = "some words that come again, some words that come again " * 5
    a, b = next(iter(both.encode([text])))
    whole = list(both.windows(a, b))
    monkeypatch.setattr(alignment, "REMEMBERED", 1)
    assert list(both.windows(a, b)) == whole and len(whole) > 20


def test_no_documents(spark):
    aligned = align(spark.createDataFrame([], SCHEMA))
    assert aligned.count() == 0 and pair_counts(aligned).count() == 0


def test_query(spark, both):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = expected(both, [r["text"] for r in docs])
    found = {r["doc_id"]: r for r in op13_alignment(spark, folder).collect()}
    for doc, (n_a, n_b, n_groups, groups, n_links, n_best, count_sum) in zip(docs, rows, strict=True):
        r = found[doc["doc_id"]]
        digest = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
        assert tuple(r)[1:] == (n_a, n_b, n_groups, digest, n_links, n_best, count_sum)


def test_both_byte_encoders_agree(both):
    """On every character, on random texts, and on words too long for the quick one."""
    assert both.quick is not None
    rng, letters = random.Random(3), " \n\t\r\u00a0\u3000'strvelmd.,!19éaZ漢😀_-"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(3000)]
    texts += [f" a{chr(c)}b 1{chr(c)} {chr(c)}{chr(c)}." for c in range(0, 0x11000) if not 0xD800 <= c < 0xE000]
    texts += ["x" * 2_500, " " * 5_000, "<|endoftext|> 's <|endoftext|>"]
    for text in texts:
        assert both.byte_ids(text) == both.first.encode(text, add_special_tokens=False).ids, text[:40]
