"""Conversation repair against a search over grammar states that keeps whole audits."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from quaywork.llm.repair import joined_digests, repair, repairs
from quaywork.llm.repair_queries import damaged, op11_repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, name string, place string, id string"
BLANKS = " \t\n\x0b\f\r"


def cheapest(rows):
    """(cost, audit) of rows (initial, fault) by trying every edit from every grammar state."""
    step = {"": "us", "s": "u", "u": "a", "a": "u"}

    def closed(states):
        """Insertions, until nothing gets cheaper."""
        changed = True
        while changed:
            changed = False
            for state, (cost, audit) in list(states.items()):
                for new in step[state].replace("s", ""):
                    if new not in states or (cost + 2, audit + "I") < states[new]:
                        states[new] = (cost + 2, audit + "I")
                        changed = True
        return states

    states = closed({"": (0, "")})
    for initial, fault in rows:
        after = {}

        def offer(state, value, after=after):
            if state not in after or value < after[state]:
                after[state] = value

        for state, (cost, audit) in states.items():
            offer(state, (cost + 3, audit + "D"))
            if fault not in ("blank", "duplicate"):
                extra = int(fault == "truncated")
                for new in step[state]:
                    if new == initial:
                        offer(new, (cost + extra, audit + "K"))
                    if new != "s":
                        offer(new, (cost + extra + 2, audit + "R"))
        states = closed(after)
    return min(states[s] for s in ("", "a") if s in states)


def brute(rows):
    """Digest columns for rows (conv_id, turn, role, text) after damage."""
    talks = {}
    for c, t, role, text, *_ in rows:
        talks.setdefault(c, []).append((t is not None, t or 0, " " if role is None else role, " " if text is None else text))
    out = {}
    for c, turns in talks.items():
        turns.sort()
        seen, faults = set(), []
        for _, _, role, text in turns:
            trimmed = text.strip(BLANKS)
            fault = "blank" if not trimmed else "duplicate" if (role, text) in seen else ""
            faults.append(fault or ("" if trimmed[-1] in ".!?" else "truncated"))
            seen.add((role, text))
        initials = [r[:1] if r[:1] in ("s", "u", "a") else "o" for _, _, r, _ in turns]
        cost, audit = cheapest(list(zip(initials, faults, strict=True)))
        left, at, last = [], 0, "s" if (len(audit) - audit.count("D")) % 2 else "a"
        first = True
        for edit in audit:
            role, text = "", ""
            if edit != "I":
                role, text = turns[at][2:]
                at += 1
            if edit == "D":
                continue
            if first and last == "s":
                want = "s"
            else:
                last = want = "a" if last == "u" else "u"
            first = False
            if edit in "RI":
                role = {"u": "user", "a": "assistant"}[want]
            assert role[:1] == want
            left.append(f"{role}:{text}")
        known = [t for has, t, *_ in turns if has]
        out[c] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost,
            audit,
            hashlib.sha256("\n".join(left).encode()).hexdigest(),
        )
    return out


def check(spark, rows):
    audits, turns = repair(spark.createDataFrame(rows, SCHEMA))
    lines = turns.selectExpr("name", "position", "concat(role, ':', text) AS line")
    digests = {r["name"]: r["digest"] for r in joined_digests(lines).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    found = {
        r["conv_id"]: (
            *(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")),
            digests.get(r["name"], empty),
        )
        for r in audits.collect()
    }
    expected = brute(rows)
    assert found.keys() == expected.keys()
    for key, value in expected.items():
        assert found[key] == value, key
    return found


def talk(rng, n, turns=None):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User", "usher"]
    texts = ["Yes.", "No!", "why", "", " \n", "a b?", "same.", None, "end. \t"]
    return [(turns(i) if turns else i, rng.choice(roles), rng.choice(texts) if rng.random() < 0.4 else f"t{i}.") for i in range(n)]


def test_alignment_equals_search():
    rng = random.Random(5)
    kinds = {"x": ("o", "blank")} | {c: (c, "") for c in "suao"} | {c.upper(): (c, "truncated") for c in "suao"}
    for _ in range(3000):
        letters = "".join(rng.choice("suaoSUAOxxuaua") for _ in range(rng.randrange(13)))
        assert min(repairs(letters).values()) == cheapest([kinds[c] for c in letters]), letters


def test_conversations_ties_nulls_and_copies(spark):
    rng, rows = random.Random(1), []
    for c in range(150):
        rows += [(c, *r, "n", "p", "i") for r in talk(rng, rng.randrange(1, 9))]
    for c in range(150, 180):  # few and null turn numbers
        rows += [(c, *r, "n", "p", "i") for r in talk(rng, 7, lambda i: rng.choice([None, 3, 9]))]
    rows += [(200, 0, "user", "hi.", "", "", "")] * 3 + [(201, None, None, None, None, None, None)]
    rows += [(None, 0, "user", "lost.", "", "", ""), (None, 9, "assistant", "x" * 300_000, "", "", "")]
    found = check(spark, rows)
    assert found[201][6] == "D" and found[200][1:3] == (0, 2) and None in found


def test_long_conversations_are_combined(spark):
    rng = random.Random(2)
    rows = [(1, *r, None, None, None) for r in talk(rng, 700)] + [(2, *r, None, None, None) for r in talk(rng, 64)]
    rows += [(3, *r, None, None, None) for r in talk(rng, 65)]
    rows += [(4, i, "system", f"{i}.", None, None, None) for i in range(130)]
    check(spark, rows)


def test_several_rounds_of_combining(spark, monkeypatch):
    monkeypatch.setattr("quaywork.llm.repair.SLICE", 4)
    monkeypatch.setattr("quaywork.llm.repair.FAN", 3)
    rng = random.Random(3)
    check(spark, [(c, *r, None, None, None) for c in range(3) for r in talk(rng, 90 + c)])


def test_empty(spark):
    audits, turns = repair(spark.createDataFrame([], SCHEMA))
    assert audits.count() == 0 and turns.count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    hurt = []
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(x for x in text if x not in ".!?")
        if fault == 4:
            role = "user"
        hurt += [(c, t, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    expected = brute(hurt)
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    found = {r["conv_id"]: tuple(r)[1:] for r in op11_repair(spark, folder).collect()}
    assert found == {c: expected.get(c, empty) for c in {r[0] for r in rows}}


def test_damage_of_nulls(spark):
    rows = [(c, t, None, None) for c in (None, 1, 2) for t in (None, *range(20))]
    found = damaged(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()
    faults = [zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 for c, t, *_ in rows]
    assert len(found) == len(rows) - faults.count(0) + faults.count(3)
    assert {r["text"] for r in found} <= {" ", ""} and {r["role"] for r in found} <= {" ", "user"}
