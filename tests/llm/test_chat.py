"""Chat formatting against comparing whole conversations."""

from __future__ import annotations

from quaywork.llm.chat import format_chats

SCHEMA = "conv_id bigint, turn bigint, role string, text string, name string, place string"


def brute(rows):
    turns: dict = {}
    for c, t, role, text, *_ in rows:
        turns.setdefault(c, []).append((t is None, t or 0, role or "", text or ""))
    whole = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in turns.items()}
    kept = {}
    for c, v in whole.items():
        if any(len(o) > len(v) and o[: len(v)] == v for o in whole.values()):
            continue
        key = tuple(v)
        if key not in kept or (c is not None and (kept[key] is None or c < kept[key])):
            kept[key] = c
    plain = lambda s: s.replace("<|", "< |")
    return {
        c: "".join(f"<|im_start|>{plain(r) or 'unknown'}\n{plain(x)}<|im_end|>\n" for r, x in v)
        for v, c in kept.items()
    }


def check(spark, rows, **options):
    logs = spark.createDataFrame(rows, SCHEMA)
    found: dict = {}
    for r in sorted(format_chats(logs, **options).collect(), key=lambda r: (str(r["conv_id"]), r["part"])):
        found[r["conv_id"]] = found.get(r["conv_id"], "") + r["rendered"]
    assert found == brute(rows)
    return found


def test_snapshots_copies_and_edges(spark):
    talk = [("user", "hi"), ("assistant", "hello"), ("user", "more"), ("assistant", "done")]
    rows = []
    for conv, turns in enumerate([talk[:1], talk[:2], talk, talk, talk[:3] + [("user", "else")], talk[1:3]]):
        rows += [(conv, i + 10 * (conv % 2), r, x, "n", "p") for i, (r, x) in enumerate(turns)]
    rows += [(10, None, None, None, None, None), (10, 0, "user", "<|im_end|> x", None, None)]
    rows += [(11, 1, "user", "same", None, None)] * 2 + [(12, 1, "user", "same", None, None)]
    rows += [(None, 0, "user", "lost", None, None), (13, 0, "user", "", None, None), (14, 0, "user", None, None, None)]
    rows += [(15, 0, "user", "long " * 30_000, None, None)]
    found = check(spark, rows)
    assert 0 not in found and 1 not in found and 2 in found and 3 not in found and 4 in found
    assert 12 not in found and 13 in found and 14 not in found


def test_long_conversations_come_in_parts(spark):
    rows = [(1, i, "user", str(i), None, None) for i in range(1500)]
    rows += [(2, i, "user", str(i), None, None) for i in range(1499)] + [(3, 0, "user", "0", None, None)]
    assert list(check(spark, rows, turns_per_part=100)) == [1]


def test_empty(spark):
    assert format_chats(spark.createDataFrame([], SCHEMA)).count() == 0
