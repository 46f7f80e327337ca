"""Piece ids against the public library, unigram paths against all segmentations."""

from __future__ import annotations

import random
import struct

import pytest
import sentencepiece

from quaywork.llm.pieces import MODEL, SPACE, Tokenizer, Transducer, tokenize

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def fst():
    with open(MODEL, "rb") as file:
        return Transducer(file.read(), remember=5000)


TEXTS = ["", " ", "  a", "a  ", "▁", "x²)._(", "Hello\tworld\n\n 123,456 ¼½ ǆ", "日本語 ñandú 😀́\x00", "a" * 3000, "-" * 999, " " * 777]


def test_encoding_and_decoding_agree_with_the_library(fst, library):
    r = random.Random(1)
    texts = TEXTS + ["".join(r.choice("ab cde  ▁x²³).,_(-\n日本ñéÀ019😀") for _ in range(r.randint(0, 40))) for _ in range(4000)]
    texts += ["".join(r.choice("aeinrstlomdh ") for _ in range(60)) for _ in range(2000)]
    for text in texts:
        ids = fst.encode(text).tolist()
        assert ids == library.encode(text), text[:80]
        assert fst.decode(ids) == text.replace(SPACE, " ")
    for _ in range(300):
        ids = [r.randrange(259, 32000) for _ in range(12)]
        assert fst.decode(ids) == library.decode(ids)


def message(*fields):
    """Wire format of (number, bytes) or (number, int) pairs."""

    def number(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    out = b""
    for field, value in fields:
        if isinstance(value, bytes):
            out += number(field << 3 | 2) + number(len(value)) + value
        elif isinstance(value, float):
            out += number(field << 3 | 5) + struct.pack("<f", value)
        else:
            out += number(field << 3) + number(value)
    return out


def model(pieces, kind=1, extra=0):
    rows = [(1, message((1, p.encode()), (2, score), (3, t))) for p, score, t in pieces]
    return message(*rows, (2, message((3, kind))), (3, message((1, b"identity"), (4, extra))))


def test_unigram_paths_are_the_cheapest():
    r = random.Random(4)
    words = {"".join(r.choice("ab▁c") for _ in range(r.randint(1, 4))) for _ in range(40)} - {"c"}
    pieces = [("<unk>", 0.0, 2)] + [(w, -r.random() * 5, 1) for w in sorted(words)]
    fst = Transducer(model(pieces))
    scores = {p: struct.unpack("f", struct.pack("f", s))[0] for p, s, t in pieces if t == 1}
    worst = min(scores.values()) - 10

    def best(text):
        cost = [0.0]
        for end in range(1, len(text) + 1):
            options = [cost[i] + scores.get(text[i:end], worst if end - i == 1 else -1e9) for i in range(end)]
            cost.append(max(options))
        return cost[-1]

    for _ in range(300):
        text = "".join(r.choice("ab c") for _ in range(r.randint(1, 25)))
        ids = fst.encode(text)
        normal = SPACE + text.replace(" ", SPACE)
        taken = [fst.pieces[i] for i in ids if i]
        unknown = len(normal) - sum(map(len, taken))
        assert abs(sum(scores[p] for p in taken) + worst * unknown - best(normal)) < 1e-6


def test_what_is_not_supported_is_refused():
    with pytest.raises(ValueError):
        Transducer(model([("a", 0.0, 4)]))
    with pytest.raises(ValueError):
        Transducer(model([("a", 0.0, 1)], kind=3))
    with pytest.raises(ValueError):
        Transducer(model([("a", 0.0, 1)], extra=1))


def test_columns(spark, library):
    rows = [(i, t, "x", "y") for i, t in enumerate([None, *TEXTS, TEXTS[5]])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, row string")
    out = tokenize(docs)
    assert out.columns == ["doc_id", "row", "n_pieces", "round_trip", "ids"]
    for r in out.collect():
        want = library.encode(rows[r["doc_id"]][1] or "")
        assert r["ids"] == want and r["n_pieces"] == len(want) and r["round_trip"]
    tokens = Tokenizer(spark)
    back = docs.select("text", tokens.encode(docs["text"]).alias("ids")).withColumn("back", tokens.decode("ids"))
    for r in back.collect():
        assert r["back"] == (r["text"] or "").replace(SPACE, " ")
    assert tokenize(docs.where("false")).count() == 0


def test_documents(spark, library):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in tokenize(docs).collect():
        assert r["round_trip"] and r["ids"] == library.encode(texts[r["doc_id"]] or "")
