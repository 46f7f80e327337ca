"""Numbers and carried values against sorting everything in one place."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quaywork.functions.skew import carried, globally_numbered, numbered


def rows(count, seed=0):
    rng = random.Random(seed)
    # Ids are sparse and lie far apart; a third of the rows has one key, some have none.
    return [
        (rng.choice(["hot", "hot", "a", "b", None]), rng.randrange(-(2**62), 2**62), rng.choice([None, i]))
        for i in range(count)
    ]


@pytest.mark.parametrize("fits", [10_000, 100, 0])
def test_numbers_by_key(spark, fits):
    data = rows(3000)
    df = spark.createDataFrame(data, "k string, at bigint, v bigint").repartition(7)
    out = numbered(df, ["k"], [F.col("at")], F.floor(F.col("at") / 2.0**55), "n", fits)
    assert out.columns == ["k", "at", "v", "n"]
    got = {(r["k"], r["at"]): r["n"] for r in out.collect()}
    for key in {r[0] for r in data}:
        for n, at in enumerate(sorted(r[1] for r in data if r[0] == key), 1):
            assert got[key, at] == n


def test_fitting_keys_cost_one_exchange(spark):
    df = spark.createDataFrame(rows(100), "k string, at bigint, v bigint")
    plan = numbered(df, ["k"], [F.col("at")], F.lit(0), "n")._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan


@pytest.mark.parametrize("after", [0, 41])
def test_numbers_over_all_rows(spark, after):
    data = rows(5000, 1)
    df = spark.createDataFrame(data, "k string, at bigint, v bigint").repartition(9)
    got = {r["at"]: r["n"] for r in globally_numbered(df, [F.col("at")], "n", after).collect()}
    assert got == {at: n for n, at in enumerate(sorted(r[1] for r in data), after + 1)}
    assert globally_numbered(df.where("false"), [F.col("at")], "n").count() == 0


def test_values_are_carried_over_ranges(spark):
    data = rows(4000, 2)
    df = spark.createDataFrame(data, "k string, at bigint, v bigint").repartition(9)
    out = carried(df, [F.desc("at")], {"seen": F.col("v"), "name": F.when(F.col("k") == "a", F.col("k"))})
    got = {r["at"]: (r["seen"], r["name"]) for r in out.collect()}
    seen = name = None
    for key, at, value in sorted(data, key=lambda r: -r[1]):
        seen = seen if value is None else value
        name = "a" if key == "a" else name
        assert got[at] == (seen, name)
