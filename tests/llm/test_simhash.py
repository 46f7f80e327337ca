"""SimHash groups against comparing every pair."""

from __future__ import annotations

import random

import pytest
import xxhash

from quaywork.llm.simhash import fingerprint_of, keep_one, links_within, segment_plan, simhash_groups


def plain_fingerprint(text):
    """One bit at a time, by the definition."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\v\f\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [words[i : i + 4] for i in range(len(words) - 3)] or [words]
    hashes = [xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


TEXTS = [None, "", " \t\n", "One", "one", "a b", "A  b", "ÀÉ É a b c d e", "x y z w v u t"] + [
    " ".join(random.Random(i).choices(["alpha", "beta", "gamma", "Delta"], k=60 + i % 3)) for i in range(20)
]


def test_fingerprint():
    for text in TEXTS + ["word " * 70_000]:
        assert fingerprint_of(text) == plain_fingerprint(text)


def groups_of(prints):
    """Least id of each id's group, by comparing all pairs."""
    label = {i: i for i, _ in prints}
    changed = True
    while changed:
        changed = False
        for i, f in prints:
            for j, g in prints:
                if (f ^ g).bit_count() <= 4 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def test_groups(spark):
    base = " ".join(f"w{i}" for i in range(800)).split()
    near = [" ".join(base[:k] + ["changed"] + base[k:]) for k in (10, 400, 790)]
    texts = TEXTS + [" ".join(base)] * 3 + near
    docs = spark.createDataFrame(
        [(i, t, f"fp{i}", "c") for i, t in enumerate(texts)], "doc_id bigint, text string, fp string, component_id string"
    )
    found = simhash_groups(docs)
    assert found.columns == ["doc_id", "text", "fp", "fingerprint", "component_id"]
    prints = [(i, plain_fingerprint(t)) for i, t in enumerate(texts)]
    label = groups_of(prints)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found.collect()}
    assert got == {i: (f"{f:016x}", label[i]) for i, f in prints}
    kept = keep_one(docs.unionAll(docs))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(label.values()))


def test_null_keys_and_empty(spark):
    docs = spark.createDataFrame([(None, "a"), (None, "a"), (3, "a"), (None, "b")], "doc_id bigint, text string")
    got = sorted((r["component_id"] is None, r["component_id"]) for r in simhash_groups(docs).collect())
    assert got == [(False, 3)] * 3 + [(True, None)]
    assert keep_one(docs).count() == 2
    assert simhash_groups(docs.where("false")).count() == 0
    assert keep_one(docs.where("false")).count() == 0


@pytest.mark.parametrize("parts", [1, 2, 3, 4, 5])
def test_every_plan_finds_all_links(spark, parts):
    widths = [64 // parts + (i < 64 % parts) for i in range(parts)]
    radii = [5 // parts - 1 + (i < 5 % parts) for i in range(parts)]
    if parts == 1:
        widths, radii = [64], [2]
    plan = [(sum(widths[:i]), w, r) for i, (w, r) in enumerate(zip(widths, radii, strict=True))]
    rng = random.Random(parts)
    values = {rng.getrandbits(64) for _ in range(20)}
    for v in list(values):
        for _ in range(8):
            values.add(v ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))))
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    limit = 2 if parts == 1 else 4
    want = {
        (a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= limit
    }
    prints = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    assert {tuple(r) for r in links_within(prints, limit, plan).collect()} == want


def test_plan_covers_the_distance():
    for count in (1, 10**5, 10**8, 10**11):
        plan = segment_plan(count)
        assert sum(w for _, w, _ in plan) == 64
        assert sum(r + 1 for _, _, r in plan) == 5
