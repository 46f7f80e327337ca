"""Personal data against Python's patterns, and disclosure against plain counts."""

from __future__ import annotations

import math
import random
import re

from quaywork.llm.privacy import Options, find_private, sanitise, span_list

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def brute(text):
    text, out = text or "", []
    out += [(m.start(), 0, m.end(), "email") for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end(), "ip") for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for rank, kind, pattern, low, high in ((2, "card", CARD, 12, 19), (3, "phone", PHONE, 9, 15)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == "phone" or luhn(digits)):
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


CARD_NUMBER = "4111 1111 1111 1111"
TEXTS = [
    None,
    "",
    "no data, 12 apples and a+b",
    "a@b.c_d@e.f and x@y..z @q.r me@host",
    "é😀 mail jo.81@mail7.example.com, 1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.255",
    f"{CARD_NUMBER} 4111-1111-1111-1112 {CARD_NUMBER}1111 411111111111",
    "+1 (555) 010-9999 +49 30 12345678 901234567 ++1 234567890+1 23 +12345678(9",
    "+4111111111111111 " + CARD_NUMBER + ".1.2.3",
    "a" * 60_000 + "@",
    "1" * 60_000,
    "1." * 30_000,
    "1 " * 30_000 + "x@y.z",
    "+1" * 20_000,
    ("x" + str(7) + "@y.zz 10.0.0.1 ") * 700,
    "%" * 5000 + "@a.b" + "." * 5000,
    "\n+1\t234567890 \r\n10.0.0.1\n",
]


def random_texts(count):
    r = random.Random(5)
    return ["".join(r.choice("01234567899..@+- ()ab%_\né") for _ in range(r.randint(0, 80))) for _ in range(count)]


def test_base_spans(spark):
    texts = TEXTS + random_texts(1500)
    docs = spark.createDataFrame(
        [(i, t, "spans", "k") for i, t in enumerate(texts)], "doc_id bigint, text string, spans string, key string"
    )
    found = find_private(docs, Options(support=10**6))
    assert found.columns == ["doc_id", "key", "spans"]
    got = {r["doc_id"]: r["s"] for r in found.select("doc_id", span_list("spans").alias("s")).collect()}
    for i, text in enumerate(texts):
        assert got[i] == brute(text), (i, text and text[:90])


def corpus():
    """An address that Zanzibar and pilot give away, a common word that does not, and copies."""
    filler = ["quick brown words without meaning repeated here"] * 30
    told = [f"note {i} the pilot from Zanzibar wrote to secret.name@mail.example today again" for i in range(6)]
    other = [f"number {i} somebody wrote to public{i}@mail.example today again" for i in range(6)]
    copies = ["unique surroundings beside twin@mail.example everywhere"] * 9
    return told + other + filler + copies


def entities_of(text):
    out = set()
    for span in filter(None, brute(text).split(",")):
        kind, a, b = span.split(":")
        value = text[int(a) : int(b)]
        out.add((kind, re.sub("[^0-9]", "", value) if kind in ("card", "phone") else value.lower()))
    return out


def blanked(text):
    for span in filter(None, brute(text).split(",")):
        _, a, b = span.split(":")
        text = text[: int(a)] + " " * (int(b) - int(a)) + text[int(b) :]
    return text


WORD = re.compile(r"(?<![^\W\d_])(?<![\d_])[^\W\d_]++(?![\d_])")


def brute_terms(texts, o=Options()):
    """{text: {(start, end): disclosure}} by plain counts over whole documents."""
    texts = [t or "" for t in texts]
    n = len(texts)
    with_term, with_entity, both, support = {}, {}, {}, {}
    for t in texts:
        for w in {w.lower() for w in WORD.findall(t)}:
            with_term[w] = with_term.get(w, 0) + 1
        for e in entities_of(t):
            with_entity[e] = with_entity.get(e, 0) + 1
            for w in {w.lower() for w in WORD.findall(blanked(t))}:
                both[e, w] = both.get((e, w), 0) + 1
                support.setdefault((e, w), set()).add(t)
    told = {}
    for (e, w), count in both.items():
        if len(support[e, w]) >= o.support and with_entity[e] < n:
            share = math.log(count * n / (with_entity[e] * with_term[w])) / math.log(n / with_entity[e])
            if share >= o.generalise_at:
                told[e, w] = share
    out = {}
    for t in set(texts):
        held = entities_of(t)
        for m in WORD.finditer(blanked(t)):
            shares = [told[e, m[0].lower()] for e in held if (e, m[0].lower()) in told]
            if shares:
                out.setdefault(t, {})[m.span()] = max(shares)
    return out


def terms_match(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    want = brute_terms(texts)
    for r in find_private(docs).collect():
        got = {(s["start"], s["end"]): s["disclosure"] for s in r["spans"] if s["kind"] == "term"}
        expected = want.get(texts[r["doc_id"]] or "", {})
        assert got.keys() == expected.keys(), texts[r["doc_id"]]
        assert all(math.isclose(got[p], expected[p], abs_tol=1e-9) for p in got)
    return want


def test_disclosing_terms(spark):
    want = terms_match(spark, corpus())
    assert not any("unique" in t for t in want)  # copies are no evidence
    assert all("secret" in t for t in want)  # entities seen once say nothing


def test_terms_of_random_documents(spark):
    r = random.Random(8)
    names = ["Zo\u00eb", "Li", "Ana", "Bo", "Kai", "Mirek", "Odile", "\u5f20\u4e09"]
    data = ["p.one@mail.example", "10.0.0.7", CARD_NUMBER, "+1 555 010 9999", "q@w.example"]

    def document():
        words = [r.choice("so then they went there and came back with it".split()) for _ in range(r.randint(0, 40))]
        for k in r.sample(range(5), r.choice((0, 0, 0, 1, 2))):
            words.insert(r.randint(0, len(words)), data[k])
            words.insert(r.randint(0, len(words)), names[k] if r.random() < 0.8 else r.choice(names))
            words += [names[k]] * r.randint(0, 2)
        return " ".join(words)

    texts = [document() for _ in range(400)]
    want = terms_match(spark, texts + texts[:60] + [None, ""])
    assert len(want) > 50


def test_a_far_name_and_all_its_places(spark):
    words = "some plain words that everybody writes in every letter without a second thought at all"
    told = [f"Zanzibar {words} {words} no {i} a.b@mail.example {words} Zanzibar again" for i in range(5)]
    rest = [f"{words} number {i} a second letter again" for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(told + rest)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["text"] for r in sanitise(docs).collect()}
    for i in range(5):
        assert "Zanzibar" not in got[i] and got[i].count(words) == 3 and "[EMAIL]" in got[i]
    assert all(got[5 + i] == t for i, t in enumerate(rest))


def test_one_entity_in_a_third_of_the_rows(spark):
    told = [f"the desk helps you at help@desk.example call{i} Vera is there" for i in range(100)]
    rest = [f"the other {i} is there or not" for i in range(200)]
    long = ["x@y.example " + " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(30_000))] * 2
    want = terms_match(spark, told + rest + long)
    assert all(any(t[a:b] == "Vera" for a, b in want[t]) for t in told)


def test_sanitise(spark):
    texts = corpus() + [f"Pay {CARD_NUMBER} or call +1 555 010 9999 at 10.0.0.1!", None, ""]
    docs = spark.createDataFrame(
        [(i if i % 5 else None, t, "r", "s") for i, t in enumerate(texts)],
        "doc_id bigint, text string, row string, spans string",
    )
    done = sanitise(docs)
    assert done.columns == docs.columns
    got = [r["text"] for r in done.collect()]
    assert len(got) == len(texts) and None in got and "" in got
    joined = "\n".join(t for t in got if t)
    assert "@" not in joined and "Zanzibar" not in joined and CARD_NUMBER not in joined
    assert "Pay [CARD] or call [PHONE] at [IP]!" in got
    assert sum(t == corpus()[12] for t in got) == 30
    assert sum((t or "").startswith("unique surroundings beside [EMAIL] everywhere") for t in got) == 9


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert find_private(docs).count() == 0 and sanitise(docs).count() == 0
