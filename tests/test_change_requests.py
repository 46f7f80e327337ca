from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quaywork.operators import capacity as K
from quaywork.operators import change_requests as H

NOW = datetime(2026, 8, 1, 9, 30)
STATUSES = {
    1: H.PENDING,
    2: "Pending Build Approval -- Gate 1 approved by a on b",
    3: "Pending Build Approval -- previous attempt failed (x), retry below",
    4: "Approved (Gate 1) by a on b",
    5: "Implemented -- pushed",
    6: "Merged (Gate 2) by a on b",
    7: "Rolled back (Gate 2) by a on b",
    8: "Closed",
    9: "Rejected (Gate 1) by a on b",
    10: H.AUTO_DENIED,
}


def requests(spark):
    rows = [(i, s, "A", "b" if i == 5 else None, "c" if i == 6 else None, "Conflicts detected" if i == 5 else None) for i, s in STATUSES.items()]
    return spark.createDataFrame(rows, "CRNumber int, Status string, Tier string, Branch string, MergeCommit string, MergeReadiness string")


def test_listing_and_badges(spark):
    df = requests(spark)
    assert sorted(r[0] for r in H.list_requests(df, "closed").select("CRNumber").collect()) == [6, 7, 8, 9, 10]
    assert sorted(r[0] for r in H.list_requests(df, "active").select("CRNumber").collect()) == [1, 2, 3, 4, 5]
    rows = {r["CRNumber"]: r for r in H.with_badges(df).collect()}
    assert [rows[i]["Badge"] for i in range(1, 11)] == ["neutral", "ready", "bad", "ready", "ready", "good", "bad", "neutral", "bad", "bad"]
    assert rows[5]["NeedsAttention"] and not rows[6]["NeedsAttention"] and rows[7]["Code"] == "CR-007"


def test_transitions(spark):
    legal = {1: "approve", 2: "start-build", 3: "reject", 4: "build-failed", 5: "merge", 6: "rollback", 7: "merge", 9: "approve"}
    rows = [(i, 1, a, "bob", True, NOW, None) for i, a in legal.items()]
    events = spark.createDataFrame(rows, "CRNumber int, EventId int, Action string, Actor string, IsAdmin boolean, EventTime timestamp_ntz, Detail string")
    got = {r["CRNumber"]: r["Status"] for r in H.transition_requests(requests(spark), events).collect()}
    tail = " by bob on 2026-08-01 09:30 UTC"
    assert got[1] == "Pending Build Approval -- Gate 1 approved" + tail
    assert got[2] == "Approved (Gate 1)" + tail and got[3] == "Rejected (Pre-Build)" + tail
    assert got[4] == "Pending Build Approval -- previous attempt failed (see logs), retry below"
    assert got[5] == "Merged (Gate 2)" + tail and got[6] == "Rolled back (Gate 2)" + tail
    assert got[7] == STATUSES[7] and got[8] == "Closed"
    assert sorted(r["CRNumber"] for r in H.transition_rejects(requests(spark), events).collect()) == [7, 9]
    for action in ("start-build", "merge", "rollback"):
        mine = events.where(F.col("Action") == action).where("CRNumber <> 7").withColumn("IsAdmin", F.lit(False))
        assert H.transition_rejects(requests(spark), mine).count() == 1
    both = events.where("CRNumber = 1")
    both = both.union(both.withColumn("EventId", F.lit(2)).withColumn("Action", F.lit("start-build")))
    after = [r["Status"] for r in H.transition_requests(requests(spark), both).where("CRNumber = 1").collect()]
    assert after == ["Approved (Gate 1)" + tail] and H.transition_rejects(requests(spark), both).count() == 0
    lost = events.limit(1).withColumn("CRNumber", F.lit(99))
    assert [r["Reason"] for r in H.transition_rejects(requests(spark), lost).collect()] == ["unknown request"]
    other = events.where("CRNumber = 3").withColumn("IsAdmin", F.lit(False))
    assert H.transition_rejects(requests(spark), other).count() == 1


def test_tier_cost_and_numbers(spark):
    df = spark.createDataFrame([(1, "A", "touch the AUTH code", "n"), (2, "C", "auth", ""), (3, "B", "nothing", "")], "id int, Tier string, text string, RiskNotes string")
    rows = {r["id"]: r for r in H.force_tier(df, F.col("text"), ["payment", "Auth"]).collect()}
    assert (rows[1]["Tier"], rows[1]["RiskNotes"]) == ("C", "n (force-escalated to Tier C: matched keyword 'Auth')")
    assert rows[2]["RiskNotes"] == "" and rows[2]["Status"] == H.AUTO_DENIED and rows[3]["Status"] == H.PENDING
    cost = H.cost_ratio(spark.createDataFrame([(6000,)], "EstimatedTokens int")).first()
    assert cost["EstimatedCostUsd"] == pytest.approx(0.036) and cost["CostRatioPct"] == pytest.approx(0.18)
    new = spark.createDataFrame([(i * 3000,) for i in range(10)], "id bigint")
    for existing, first in (([(41,)], 42), ([], 1)):
        old = spark.createDataFrame(existing, "CRNumber int")
        assert sorted(r["CRNumber"] for r in H.assign_numbers(new, old, "id").collect()) == list(range(first, first + 10))


def test_progress(spark):
    rows = [
        (1, NOW, 1, "system", "init", "s1", None, None, None, None),
        (1, NOW + timedelta(seconds=1), 2, "assistant", None, None, 10, 5, None, None),
        (1, NOW + timedelta(seconds=2), 3, "system", "post_turn_summary", None, None, None, "did it", None),
        (1, NOW + timedelta(seconds=3), 4, "assistant", None, "s2", 1, None, None, None),
        (1, NOW + timedelta(seconds=4), 5, "system", "post_turn_summary", None, None, None, None, None),
        (1, NOW + timedelta(seconds=5), 6, "result", "success", None, None, None, None, 1.5),
    ]
    schema = (
        "CRNumber bigint, EventTime timestamp_ntz, EventId bigint, EventType string, Subtype string, SessionId string, "
        "InputTokens bigint, OutputTokens bigint, StatusDetail string, TotalCostUsd double"
    )
    events = spark.createDataFrame(rows, schema)
    row = H.progress_fold(events).first()
    assert (row["SessionId"], row["TokensSoFar"], row["LastAction"], row["CostUsd"], row["ResultSubtype"]) == ("s2", 16, "", 1.5, "success")
    assert [r["TokensSoFar"] for r in H.progress_trail(events).orderBy("EventId").collect()] == [0, 15, 15, 16, 16, 16]


@pytest.mark.parametrize(
    "body, problems",
    [
        ('{"title":"t","tier":"A","risk_notes":"","requirements":[],"touch_points":[],"out_of_scope":[],"estimated_tokens":5}', []),
        ('{"title":"t","tier":"A","risk_notes":"","requirements":[],"touch_points":[],"out_of_scope":[],"estimated_tokens":1.5}', ["estimated_tokens: expected int, got float"]),
        ('{"title":true,"tier":null,"risk_notes":"","requirements":[],"touch_points":[],"out_of_scope":[],"estimated_tokens":-1}',
         ["title: expected str, got bool", "tier: expected str, got NoneType", "tier: expected one of A/B/C, got None", "estimated_tokens: expected a realistic non-zero estimate, got <= 0"]),
    ],
)
def test_records(spark, body, problems):
    text = f"Sure.\n```json\n{body}\n```"
    df = H.extract_json_block(spark.createDataFrame([(text,)], "Text string"))
    assert sorted(H.validate_record(df).first()["Problems"]) == sorted(problems)


def test_json_blocks(spark):
    texts = ["no block", "```json {bad} ```", '```json {"title": "a"} ``` and ```json {"title": "b"} ```', None]
    df = H.extract_json_block(spark.createDataFrame([(t,) for t in texts], "Text string"))
    assert [r["JsonText"] for r in df.collect()] == [None, None, '{"title": "a"}', None]
    assert df.collect()[2]["Record"]["title"] == "a"


def test_pairs_scores_mappings(spark):
    turns = [(1, 0, "make it"), (1, 1, "QUESTION: which?"), (1, 2, "that"), (1, 3, " how? "), (1, 4, "so"), (1, 5, "dangling")]
    df = spark.createDataFrame(turns, "conv_id int, turn int, text string")
    assert [(r["Question"], r["Answer"]) for r in H.transcript_pairs(df).orderBy("turn").collect()] == [("which?", "that"), ("how?", "so")]
    scores = spark.createDataFrame(
        [(NOW, 2048, "baseline", "synthetic", t, True, s) for t, s in [(True, 2.0), (False, 3.0)]],
        "run_date timestamp_ntz, context_length int, prompt_variant string, case_set string, tier_match boolean, schema_valid boolean, latency_sec double",
    )
    row = H.score_runs(scores).first()
    assert (row["cases"], row["tier_matches"], row["schema_valid_cases"], row["avg_latency_sec"]) == (2, 1, 2, 2.5)
    maps = spark.createDataFrame([("c", "a", "x"), ("c", "b", "x"), ("c", "d", "y"), ("c", "d", "y"), ("d", "a", "x")], "Customer string, SourceColumn string, TargetColumn string")
    assert {(r["TargetColumn"], r["Kind"]) for r in H.mapping_conflicts(maps).collect()} == {("x", "conflict"), ("y", "duplicate")}
    assert H.apply_mapping(maps, {"SourceColumn": "src"}).columns == ["src"]


@pytest.mark.parametrize(
    "heads, forecast, predicted, low, high, status",
    [(5, 280, 262, 246, 279, "AT RISK"), (8, 280, 415, 399, 432, "ON TRACK"), (5, 200, 262, 246, 279, "ON TRACK"), (5, 260, 262, 246, 279, "TIGHT — WATCH CLOSELY")],
)
def test_capacity_estimates(spark, heads, forecast, predicted, low, high, status):
    df = spark.createDataFrame([(heads, 9.0, 0.0, 2.3, forecast)], "heads int, hours double, receiving double, complexity double, forecast int")
    df = df.withColumn("packer_hours", K.packer_hours(F.col("heads"), F.col("hours"), F.col("receiving")))
    row = K.assess_capacity(K.predict_capacity(df)).first()
    assert [round(row[c]) for c in ("predicted", "low", "high")] == [predicted, low, high] and row["status"] == status


def test_capacity_fit_recovers_a_plane(spark):
    rows = [(datetime(2026, 1, 1).date() + timedelta(days=i), 100.0 + 5 * (i % 11) - 30 * (i % 7), float(i % 11), float(i % 7)) for i in range(60)]
    days = spark.createDataFrame(rows, "day date, orders_shipped double, packer_hours double, complexity double")
    model = K.fit_capacity(days)
    assert (model.intercept, model.per_packer_hour, model.per_complexity) == (pytest.approx(100), pytest.approx(5), pytest.approx(-30))
    assert model.residual_sd == pytest.approx(0, abs=1e-6)
    scores = {r["model"]: r for r in K.cross_validate(days).collect()}
    assert scores["linear regression"]["r2"] == pytest.approx(1) and scores["random forest"]["r2"] < 1
