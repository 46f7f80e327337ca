"""Parsing against hand-written interchanges and a brute-force reading of random ones."""

from __future__ import annotations

import random

import pytest

from quaywork import schemas as S
from quaywork.operators import interchange as I

SKELETON = (
    "ISA*00*          *00*          *ZZ*SENDER*ZZ*RECEIVER*250101*1200*U*00401*000000001*0*P*>~"
    "GS*OW*S*R*20260730*1200*1*X*004010~{body}GE*{sets}*1~IEA*1*000000001~"
)
ORDER = "ST*940*{n:04d}~W05*N*ORDER{n}**20260801~N1*ST*NAME*9*ID1~W01*10*EA*VN*SKU1~SE*5*{n:04d}~"


def whole(body: str, sets: int = 1) -> str:
    return SKELETON.format(body=body, sets=sets)


def files(spark, *texts: str):
    rows = [(i + 1, f"f{i + 1}.edi", t, "RAW_LOADED") for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, "RawId bigint, FileName string, RawEDIText string, ProcessStatus string"
    )


def parse(spark, *texts: str, strict: bool = False):
    return I.parse_files(files(spark, *texts), strict)


def problem(spark, text: str, strict: bool = False):
    return parse(spark, text, strict=strict).first()["Problem"]


def test_one_two_and_two_groups(spark):
    one = whole(ORDER.format(n=1))
    two = whole(ORDER.format(n=1) + ORDER.format(n=2), 2)
    groups = whole(ORDER.format(n=1) + "GE*1*1~GS*OW*S*R*20260730*1200*2*X*004010~" + ORDER.format(n=2))
    counts = {r["RawId"]: r["count"] for r in I.headers(parse(spark, one, two, groups)).groupBy("RawId").count().collect()}
    assert counts == {1: 1, 2: 2, 3: 2}


def test_header_fields(spark):
    row = I.headers(parse(spark, whole(ORDER.format(n=7)))).first()
    assert row["ISAControlNumber"] == "000000001" and row["GSControlNumber"] == "1"
    assert (row["STControlNumber"], row["TransactionSetCode"]) == ("0007", "940")
    assert (row["WarehouseOrderNumber"], row["ShipDate"]) == ("ORDER7", "20260801")
    assert (row["STSegmentSeq"], row["SESegmentSeq"]) == (3, 7)
    detail = I.details(parse(spark, whole(ORDER.format(n=7)))).first()
    assert (detail["LineNumber"], float(detail["QuantityOrdered"]), detail["ProductId"]) == ("6", 10.0, "SKU1")


def test_line_breaks_blanks_and_padding_do_not_matter(spark):
    clean = whole(ORDER.format(n=1))
    messy = clean.replace("~", " ~\r\n ~~").replace("*NAME*", "*  NAME *")
    results = [
        sorted(map(tuple, table(parse(spark, text)).collect()))
        for text in (clean, messy)
        for table in (I.headers, I.addresses, I.details, I.controls)
    ]
    assert results[:4] == results[4:]


@pytest.mark.parametrize("quantity", ["0", "-1", "", "  ", "ten", "1e3", "."])
def test_bad_quantity_fails_the_whole_file(spark, quantity):
    body = ORDER.format(n=1) + ORDER.format(n=2).replace("W01*10*", f"W01*{quantity}*")
    parsed = parse(spark, whole(body, 2))
    assert parsed.first()["Problem"] == S.BAD_QUANTITY
    assert I.headers(parsed).count() == 0 and I.details(parsed).count() == 0
    assert [r["Reason"] for r in I.rejects(parsed).collect()] == [S.BAD_QUANTITY]


@pytest.mark.parametrize("quantity", ["10", "+2", "3.", ".5", "0.0001"])
def test_good_quantities(spark, quantity):
    assert problem(spark, whole(ORDER.format(n=1).replace("W01*10*", f"W01*{quantity}*"))) is None


def test_no_order_sets(spark):
    other = whole(ORDER.format(n=1).replace("ST*940", "ST*945"))
    for text in (whole(""), other):
        assert problem(spark, text) is None
        assert problem(spark, text, strict=True) == S.NO_TRANSACTIONS
        assert I.headers(parse(spark, text)).count() == 0


def test_unterminated_sets(spark):
    first = whole("ST*940*0009~W05*N*LOST**20260801~" + ORDER.format(n=1))
    last = whole(ORDER.format(n=1) + "ST*940*0009~W05*N*LOST**20260801~")
    parsed = parse(spark, last)
    assert I.headers(parsed).count() == 1
    reject = I.rejects(parsed).first()
    assert (reject["STSegmentSeq"], reject["Reason"]) == (8, S.UNTERMINATED_ST)
    # An ST before another one shares the next SE.
    assert sorted(r["SESegmentSeq"] for r in I.headers(parse(spark, first)).collect()) == [9, 9]


def test_nested_sets_share_segments(spark):
    nested = whole("ST*940*0001~W01*1*EA*VN*A~ST*940*0002~W01*2*EA*VN*B~SE*4*0002~")
    rows = I.details(parse(spark, nested)).collect()
    assert sorted((r["HeaderId"] % I.ID_SPAN, r["ProductId"]) for r in rows) == [(3, "A"), (3, "B"), (5, "B")]


def test_missing_parts_and_case(spark):
    bare = whole("ST*940*0001~W01*5*EA~SE*3*0001~")
    row = I.headers(parse(spark, bare)).first()
    assert row["WarehouseOrderNumber"] is None and row["ShipDate"] is None
    lower = whole(ORDER.format(n=1).replace("ST*940", "st*940").replace("W05", "w05").replace("SE*", "se*"))
    assert I.headers(parse(spark, lower)).first()["WarehouseOrderNumber"] == "ORDER1"


def test_overlong_value(spark):
    text = whole(ORDER.format(n=1).replace("*EA*", f"*{'U' * 21}*"))
    parsed = parse(spark, text)
    assert parsed.first()["Problem"] == S.TOO_LONG
    row = I.overlong_values(parsed).first()
    assert (row["ColumnName"], row["ValueLength"], row["MaxLength"]) == ("UOM", 21, 20)


def test_envelope_reasons(spark):
    good = whole(ORDER.format(n=1))
    texts = {
        good: None,
        "": "empty",
        good.replace("NAME", "ÑAME"): "encoding",
        good.replace("IEA*1*000000001", "IEA*1*000000002"): "isa",
        good.replace("GS*OW*S*R*20260730*1200*1*X*004010~", "").replace("000000001", "000000011"): "no_gs",
        good.replace("ST*940", "ST*945").replace("000000001", "000000012"): "no_st",
        good.replace("SE*5*0001~", "").replace("000000001", "000000013"): "truncated",
        good.replace("SE*5*", "SE*6*").replace("000000001", "000000014"): "st_se",
        good.replace("SE*5*0001", "SE*5*0002").replace("000000001", "000000015"): "st_se",
        good.replace("GE*1*1", "GE*2*1").replace("000000001", "000000016"): "gs_ge",
        good.replace("GE*1*1", "GE*1*3").replace("000000001", "000000017"): "gs_ge",
        good.replace("IEA*1*", "IEA*3*").replace("000000001", "000000018"): "gs_ge",
        good.replace("000000001", "000000020"): "duplicate",
        good.replace("000000001", "000000020") + "~": "duplicate",
    }
    # Control number 1 is shared by three of them.
    got = {r["RawId"]: r["Reason"] for r in I.envelope_check(files(spark, *texts)).collect()}
    wanted = [S.ENVELOPE_REASONS.get(k) for k in texts.values()]
    wanted[0] = S.ENVELOPE_REASONS["duplicate"]
    assert [got[i + 1] for i in range(len(texts))] == wanted


def test_newest_unparsed(spark):
    rows = [(1, "a", "RAW_LOADED"), (2, "a", "RAW_LOADED"), (3, "a", "PARSED"), (4, "b", "RAW_LOADED"), (5, "c", "PARSED")]
    df = spark.createDataFrame(rows, "RawId bigint, FileName string, ProcessStatus string")
    assert sorted(r["RawId"] for r in I.newest_unparsed(df).collect()) == [2, 4]


def brute(text: str):
    """Plain reading of the rules: each ST*940 runs to the first SE after it."""
    segments = [s.strip(" ") for s in text.replace("\r", "").replace("\n", "").split("~")]
    segments = [s.split("*") for s in segments if s]
    found = []
    for i, s in enumerate(segments):
        if s[0] == "ST" and len(s) > 1 and s[1] == "940":
            end = next((j for j in range(i + 1, len(segments)) if segments[j][0] == "SE"), None)
            if end is None:
                continue
            inside = segments[i : end + 1]
            first = next((x for x in inside if x[0] == "W05"), [])
            order = first[2] if len(first) > 2 and first[2] else None
            lines = sorted(i + k + 1 for k, x in enumerate(inside) if x[0] == "W01")
            found.append((i + 1, end + 1, order, tuple(lines)))
    return sorted(found, key=lambda t: t[0])


def test_random_sequences_match_brute_force(spark):
    rng = random.Random(3)
    choices = ["ST*940*1", "ST*945*1", "SE*3*1", "W05*N*O{}", "W05*N*", "W01*1*EA*VN*X", "N1*ST*A", "ZZ", ""]
    texts = []
    for _ in range(400):
        texts.append("~".join(rng.choice(choices).format(rng.randint(1, 9)) for _ in range(rng.randint(0, 25))))
    parsed = parse(spark, *texts).cache()
    heads = {(r["RawId"], r["STSegmentSeq"]): (r["SESegmentSeq"], r["WarehouseOrderNumber"]) for r in I.headers(parsed).collect()}
    lines: dict = {}
    for r in I.details(parsed).collect():
        lines.setdefault((r["RawId"], r["HeaderId"] - r["RawId"] * I.ID_SPAN), []).append(int(r["LineNumber"]))
    for i, text in enumerate(texts):
        for st, se, order, wanted in brute(text):
            assert heads.pop((i + 1, st)) == (se, order), text
            assert tuple(sorted(lines.pop((i + 1, st), []))) == wanted, text
    assert not heads and not lines


def test_render_splits_large_orders_without_loss(spark):
    orders = spark.createDataFrame(
        [(1, 10, "S", "R", "000000001", "20260101", "BIG", "20260102", "N", "I"),
         (1, 11, "S", "R", "000000001", "20260101", "SMALL", "20260102", "N", "I"),
         (2, 12, "S", "R", "000000002", "20260101", "EMPTY", "20260102", "N", "I")],
        "RawId bigint, OrderId bigint, Sender string, Receiver string, ControlNumber string, DateText string, "
        "OrderNumber string, ShipDate string, ShipToName string, ShipToId string",
    )
    rows = [(10, (i,), "1", "EA", "VN", f"P{i}") for i in range(60)] + [(10, (99,), "2", "EA", "VN", "COPY")] * 45
    rows += [(11, (i,), "3", "EA", "VN", "Q") for i in range(3)]
    lines = spark.createDataFrame(
        rows, "OrderId bigint, SortKey struct<k:int>, Quantity string, UOM string, Qualifier string, Sku string"
    )
    texts = I.render_940(orders, lines, max_lines=10, max_transactions=4).collect()
    assert {r["RawId"] for r in texts} == {1, 2} and max(r["FilePart"] for r in texts) >= 2
    parsed = parse(spark, *[r["RawEDIText"] for r in texts])
    assert parsed.where("Problem is not null").count() == 0
    got: dict = {}
    for order, sku in (
        I.details(parsed).join(I.headers(parsed).select("HeaderId", "WarehouseOrderNumber"), "HeaderId")
        .select("WarehouseOrderNumber", "ProductId").collect()
    ):
        got.setdefault(order, []).append(sku)
    assert sorted(got["BIG"]) == sorted([f"P{i}" for i in range(60)] + ["COPY"] * 45)
    assert got["SMALL"] == ["Q"] * 3 and "EMPTY" not in got
    reasons = {r["Reason"] for r in I.envelope_check(files(spark, *[t["RawEDIText"] for t in texts])).collect()}
    assert reasons == {None}


@pytest.mark.parametrize(("lines_of", "sets"), [({1: 1000, 2: 10, 3: 11, 4: 0}, 104), ({i: 1 for i in range(250)}, 250)])
def test_rendering_cuts_in_order(spark, lines_of, sets):
    """Sets are full runs of ten lines in order, files hold seven sets, all control numbers differ."""
    orders = spark.createDataFrame(
        [(5, i, "S", "R", "000000007", "20260801", f"O{i}", "20260802", "N", "I") for i in lines_of],
        "RawId bigint, OrderId bigint, Sender string, Receiver string, ControlNumber string, DateText string, "
        "OrderNumber string, ShipDate string, ShipToName string, ShipToId string",
    )
    rows = [(i, (k,), "1", "EA", "VN", f"{i}-{k}") for i, n in lines_of.items() for k in range(n)]
    lines = spark.createDataFrame(
        rows, "OrderId bigint, SortKey struct<k:int>, Quantity string, UOM string, Qualifier string, Sku string"
    )
    texts = {r["FilePart"]: r["RawEDIText"] for r in I.render_940(orders, lines, max_lines=10, max_transactions=7).collect()}
    assert sorted(texts) == list(range(-(-sets // 7)))
    controls = [next(s.split("*")[13] for s in t.split("~") if s.startswith("ISA")) for t in texts.values()]
    assert len(set(controls)) == len(controls) and "000000007" in controls
    found, count = [], 0
    for part in sorted(texts):
        held = []
        for segment in texts[part].split("~"):
            if segment.startswith("ST*"):
                held.append(0)
            if segment.startswith("W01"):
                held[-1] += 1
                found.append(segment.split("*")[4])
        assert len(held) == 7 or part == max(texts)
        assert max(held) <= 10
        count += len(held)
    assert count == sets and found == [f"{i}-{k}" for i, n in sorted(lines_of.items()) for k in range(n)]
    checked = I.envelope_check(files(spark, *texts.values())).collect()
    assert {r["Reason"] for r in checked} == {None}
