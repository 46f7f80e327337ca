from __future__ import annotations

import hashlib
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quaywork import schemas as S
from quaywork.operators import access as Acc
from quaywork.operators import lookup as L
from quaywork.sources.files import locate_files

NOW = datetime(2026, 8, 1, 12, 0)
ISA = "ISA*00*          *00*          *ZZ*SENDER*ZZ*RECEIVER*250101*1200*U*00401*000012345*0*P*>~"


@pytest.mark.parametrize(
    "text, intent, entity",
    [
        ("Where is PO ORDER1001?", "po_lookup", ("PoNumber", "ORDER1001")),
        ("p.o.12 please", "po_lookup", ("PoNumber", "12")),
        ("warehouse order #: W-7", "po_lookup", ("PoNumber", "W-7")),
        ("What happened with ISA 123?", "isa_lookup", ("IsaNumber", "123")),
        ("control number 000012345", "isa_lookup", ("IsaNumber", "000012345")),
        ("isa 1234567890", "isa_lookup", ("IsaNumber", "123456789")),
        ("send me my-file_1.EDI", "file_by_name", ("FileName", "my-file_1.EDI")),
        ("download the failed files for customer LOW", "failed_files", ("Customer", "LOW")),
        ("can i get files with errors", "failed_files", ("Customer", None)),
        ("give me isa 5", "file_by_isa", ("IsaNumber", "5")),
        ("give me order 77", "po_lookup", ("PoNumber", "77")),
        ("give me a joke", "unknown", ("PoNumber", None)),
        ("épo 5 reorder 7", "unknown", ("PoNumber", None)),
        (None, "unknown", ("PoNumber", None)),
    ],
)
def test_intents(spark, text, intent, entity):
    df = spark.createDataFrame([(1, text)], "QuestionId int, Text string")
    row = L.classify_intent(df).first()
    assert row["Intent"] == intent and row[entity[0]] == entity[1]


def test_control_numbers(spark):
    df = spark.createDataFrame([(ISA,), ("GS*1~\r\n isa*" + "*".join("x" * 12) + "*42*~",), ("ISA*1~",), (None,)], "t string")
    assert [r[0] for r in df.select(L.control_number_of(F.col("t"))).collect()] == ["000012345", "42", None, None]
    keys = spark.createDataFrame([("000012345",), ("000",), ("7",), (None,)], "n string")
    assert [r[0] for r in keys.select(L.isa_key(F.col("n"))).collect()] == ["12345", "0", "7", None]


def files(spark):
    rows = [
        (1, "a.edi", None, NOW, "PARSE_FAILED", None, "W01 quantity bad", "LOW", "R", "000000005", None, None),
        (2, "b.edi", None, NOW, "PARSED", None, None, "LOW", "R", "5", None, None),
        (3, "c.edi", None, NOW, "PARSE_FAILED", None, None, "HD", "R", "000000006", None, None),
        (4, "d.edi", None, None, "STAGED", None, None, "HD", "R", "7", None, None),
    ]
    return spark.createDataFrame(rows, S.schema("files"))


def kb(spark):
    rows = [(1, "QUANTITY", "Bad amount.", "Fix it."), (2, "w01%bad", "Other.", None), (3, "empty", "Nothing.", "")]
    return spark.createDataFrame(rows, S.schema("error_kb"))


def test_isa_lookup_takes_the_newest(spark):
    asked = spark.createDataFrame([(1, "5"), (2, "0006"), (3, "99")], "QuestionId int, IsaNumber string")
    got = {r["QuestionId"]: r["RawId"] for r in L.isa_lookup(asked, files(spark)).collect()}
    assert got == {1: 2, 2: 3, 3: None}


def test_po_lookup(spark):
    rows = [(i, "S", i, "f", "ORDER1001" if i < 8 else "O8", None, None, None, None, None, s, i, None, e, NOW, None)
            for i, s, e in [(1, "READY", None), (2, "SENT", None), (3, "SUCCESS", None), (4, "FAILED", "boom"), (5, "FAILED", None), (6, "HELD", None), (7, "READY", None), (8, "FAILED", "boom")]]
    orders = spark.createDataFrame(rows, S.schema("wms_orders"))
    asked = spark.createDataFrame([(1, "order1001"), (2, "nope"), (3, "O8")], "QuestionId int, PoNumber string")
    got = L.po_lookup(asked, orders).orderBy("QuestionId", "Rank").collect()
    assert [r["Rank"] for r in got] == [1, 2, 3, 4, 5, 0, 1]
    assert got[0]["Reply"] == "PO/order ORDER1001 is parsed and waiting to be sent to WMS (attempts: 1)."
    assert got[4]["Reply"] == "PO/order ORDER1001 is picked up by WMS but failed: no error message recorded (attempts: 5)."
    assert got[5]["Reply"].startswith("I couldn't find PO/order nope in the WMS staging queue yet.")
    assert "picked up by WMS but failed: boom" in got[6]["Reply"]


def test_alias_and_failed_files(spark):
    aliases = spark.createDataFrame([(1, "Lowes", "LOW"), (2, "Lowe's", "LOW")], S.schema("aliases"))
    terms = spark.createDataFrame([("lowes ",), ("LOW",), ("other",)], "Customer string")
    assert [r["CustomerCode"] for r in L.resolve_alias(terms, aliases).orderBy("Customer").collect()] == ["LOW", "LOW", "other"]
    assert [r["rawId"] for r in L.failed_files(files(spark)).collect()] == [3, 1]
    assert [r["rawId"] for r in L.failed_files(files(spark), "low").collect()] == [1]


def test_like_patterns(spark):
    patterns = ["C:\\temp", "line [0-9]", "[^a-c]x", "50%off", "a_b", "[", "q]", "\\E.", "[\\]d", "zz"]
    notes = spark.createDataFrame([(i, p, str(i), "") for i, p in enumerate(patterns)], S.schema("error_kb"))
    cases = {
        "at c:\\TEMP\\x": 0, "Line 7": 1, "line x": 2, "ax": None, "zx": 2, "50 percent off": 3, "a-b": 4, "ab": None,
        "open [": 5, "Q]": 6, "\\e.": 7, "\\eX": 2, "\\eb": None, "\\d": 8, "fuzzy": 9, "ZZ top": 9, "z": None,
    }
    rows = spark.createDataFrame([(m,) for m in cases], "ErrorMessage string")
    got = {r["ErrorMessage"]: r["Note"] for r in L.explain_error(rows, notes).collect()}
    assert got == {m: None if i is None else str(i) for m, i in cases.items()}


def test_explain_and_describe(spark):
    noted = L.explain_error(files(spark), kb(spark))
    got = {r["RawId"]: r["Narrative"] for r in L.describe_status(noted).collect()}
    assert got[1] == "File a.edi (ISA 000000005) was received at 2026-08-01 12:00:00 but failed to parse: W01 quantity bad (Bad amount. Fix it.)"
    assert got[2] == "File b.edi (ISA 5) was received and parsed successfully at 2026-08-01 12:00:00."
    assert got[3].endswith("failed to parse: no error message was recorded")
    assert got[4] == "File d.edi (ISA 7) was received at an unknown time. Current status: STAGED."


def test_locate(spark):
    listing = spark.createDataFrame(
        [("inbound", "a.edi"), ("archive", "a.edi.txt"), ("archive", "b.edi"), ("archive", "b.edi.0"), ("inbound", "c.edi.9"), ("inbound", "c.edi.1"), ("archive", "xd.edi")],
        "Container string, BlobName string",
    )
    names = spark.createDataFrame([("a.edi",), ("b.edi",), ("c.edi",), ("d.edi",)], "FileName string")
    got = {r["FileName"]: (r["Container"], r["BlobName"]) for r in locate_files(names, listing).collect()}
    assert got == {"a.edi": ("archive", "a.edi.txt"), "b.edi": ("archive", "b.edi"), "c.edi": ("inbound", "c.edi.1"), "d.edi": (None, None)}
    assert [r["FileName"] for r in L.failed_downloads(files(spark), listing).collect()] in (["a.edi", "c.edi"], ["c.edi", "a.edi"])


def test_history(spark):
    turns = [(1, i, "user", f"msg {i}") for i in range(7)] + [(1, 7, "system", "no"), (1, 8, "assistant", "  \n")]
    df = spark.createDataFrame(turns, "conv_id int, turn int, role string, text string")
    assert [r["text"] for r in L.history_tail(df).orderBy("turn").collect()] == [f"msg {i}" for i in range(2, 7)]


def test_feedback(spark):
    rows = [
        (1, "u", None, "support", None, " q ", "a", 1, " ", NOW),
        (2, "u", None, "web", "ai", "q", " a", -1, " too long ", NOW + timedelta(minutes=1)),
        (3, "u", None, "intake", "ai", "q", "a", 0, None, NOW),
        (4, "u", None, "intake", "ai", " ", "a", 1, None, NOW),
        (5, "u", None, "intake", "ai", "q", "a", -1, "x" * 1001, NOW),
        (6, "u", None, "intake", "ai", "q2", "a", -1, "", NOW + timedelta(minutes=2)),
    ]
    raw = spark.createDataFrame(rows, S.schema("feedback"))
    good = {r["FeedbackId"]: r for r in L.capture_feedback(raw).collect()}
    assert sorted(good) == [1, 2, 6]
    assert good[1]["Comment"] is None and good[1]["Source"] == "unknown" and good[2]["Channel"] == "support"
    assert good[1]["MessageHash"] == hashlib.sha256(b"q\x1fa").hexdigest() == good[2]["MessageHash"]
    assert {r["FeedbackId"]: r["Problem"].split()[0] for r in L.feedback_rejects(raw).collect()} == {3: "rating", 4: "question", 5: "comment"}
    assert L.repeat_complaints(L.capture_feedback(raw)).first()["n"] == 2
    context = L.negative_feedback_context(L.capture_feedback(raw)).first()["Context"]
    assert context == '- A user disliked a past reply to "q" because: "too long"'


def test_search_lines(spark):
    corpus = spark.createDataFrame([(1, "one\r\n  Two needle\x0bNEEDLE"), (2, "hay"), (3, "x" * 150 + "needle" + "y" * 150)], "Id int, Text string")
    got = [(r["Id"], r["LineNo"], r["Snippet"]) for r in L.search_lines(corpus, " Needle ").collect()]
    assert got[:2] == [(1, 2, "Two needle"), (1, 3, "NEEDLE")] and len(got[2][2]) == 200


def brute_limit(events, seconds, limit):
    state, out = {}, {}
    for key, when, i in sorted(events, key=lambda e: (e[1], e[2])):
        start, count = state.get(key, (when, 0))
        if (when - start).total_seconds() > seconds:
            start, count = when, 0
        state[key] = (start, count + 1)
        out[i] = count + 1 > limit
    return out


def test_rate_limit_matches_brute_force(spark):
    rng = random.Random(11)
    events = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.5 else f"k{rng.randint(1, 30)}"
        events.append((key, NOW + timedelta(seconds=rng.randint(0, 40_000), microseconds=rng.choice([0, 1, 500_000])), i))
    events += [("edge", NOW, 9001), ("edge", NOW + timedelta(seconds=3600), 9002), ("edge", NOW + timedelta(seconds=7200), 9003)]
    df = spark.createDataFrame(events, "Key string, EventTime timestamp_ntz, EventId bigint")
    for seconds, limit, fits in ((3600, 20, 500), (300, 2, 0), (3600, 1, 50_000)):
        got = {r["EventId"]: r["Denied"] for r in L.rate_limit(df, seconds, limit, fits).collect()}
        assert got == brute_limit(events, seconds, limit)


def test_rate_limit_of_a_key_that_never_pauses(spark):
    rng, at, events = random.Random(4), NOW, []
    for i in range(4000):
        at += timedelta(seconds=rng.choice([0, 1, 5, 60]))
        events.append(("busy" if i % 5 else None, at, i))
    df = spark.createDataFrame(events, "Key string, EventTime timestamp_ntz, EventId bigint")
    plan = L.rate_limit(df, 100, 3, fits=1000)
    got = {r["EventId"]: r["Denied"] for r in plan.collect()}
    assert got == brute_limit([(str(k), t, i) for k, t, i in events], 100, 3)
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seconds, limit", [(1, 1), (10**7, 2)])
def test_rate_limit_of_short_and_endless_windows(spark, seconds, limit):
    events = [("k", NOW + timedelta(seconds=s), s) for s in (0, 0, 1, 2, 2, 5, 9, 9)]
    events = [(k, t, i) for i, (k, t, _) in enumerate(events)]
    df = spark.createDataFrame(events, "Key string, EventTime timestamp_ntz, EventId bigint")
    assert {r["EventId"]: r["Denied"] for r in L.rate_limit(df, seconds, limit).collect()} == brute_limit(events, seconds, limit)
    assert L.rate_limit(df.where("false"), seconds, limit).count() == 0


def test_locate_files_equals_trying_every_pair(spark):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("ab.é") for _ in range(rng.randrange(n)))
    stored = sorted({(rng.choice(["archive", "inbound"]), word(7)) for _ in range(400)})
    asked = [word(6) for _ in range(200)] + ["", "zz", None, "a", "a"]
    listing = spark.createDataFrame(stored, "Container string, BlobName string").repartition(5)
    names = spark.createDataFrame([(i, n) for i, n in enumerate(asked)], "Id int, FileName string")
    got = {r["Id"]: (r["Container"], r["BlobName"]) for r in locate_files(names, listing).collect()}
    for i, name in enumerate(asked):
        fits = [(c != "archive", b != name, b.encode(), c, b) for c, b in stored if name is not None and b.startswith(name)]
        assert got[i] == (min(fits)[3:] if fits else (None, None)), name


def test_permissions(spark):
    ur = spark.createDataFrame([("u1", 1)], "UserOid string, RoleId int")
    ug = spark.createDataFrame([("u1", 5), ("u2", 5)], "UserOid string, GroupId int")
    gr = spark.createDataFrame([(5, 1), (5, 2)], "GroupId int, RoleId int")
    rp = spark.createDataFrame([(1, 100), (2, 200)], "RoleId int, PermissionId int")
    p = spark.createDataFrame([(100, "files.download"), (200, "cr.admin")], "PermissionId int, PermissionName string")
    held = Acc.effective_permissions(ur, ug, gr, rp, p)
    assert sorted(map(tuple, held.collect())) == [(u, n) for u in ("u1", "u2") for n in ("cr.admin", "files.download")]
    assert Acc.effective_permissions(ur, ug, gr, rp, p, "u2").count() == 2
    users = spark.createDataFrame([("u1",), ("u9",)], "UserOid string")
    assert {r["UserOid"]: r["Allowed"] for r in Acc.check_permission(users, held, ["cr.admin", "x"]).collect()} == {"u1": True, "u9": False}
