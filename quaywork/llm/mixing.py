"""Mixing sources to target weights by repeating documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quaywork.llm.common import WORD, packed, settle, uniform, unpacked, whole_text


def word_count(text: Column | str = "text") -> Column:
    """Words of a text; 0 for null."""
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("bigint")


def source_targets(
    stats: DataFrame, weights: DataFrame, budget: float | None = None, max_rate: float = 3.0
) -> DataFrame:
    """Share a budget of words among sources by weight.

    ``stats`` has (source, source_size), ``weights`` has (source, weight); a
    source without a weight gets 0.  ``budget`` defaults to all words.  No
    target passes ``max_rate`` times its source; what is cut off is shared among
    the others by weight until none is above.  The point where that ends is
    found in closed form: with sources in order of cap over weight, the capped
    ones come first, and the level of the rest follows from running sums.

    The window runs over one row per source, each of which was given a weight;
    documents never pass through it.
    """
    joined = (
        stats.alias("s")
        .join(weights.alias("w"), F.col("s.source").eqNullSafe(F.col("w.source")), "left")
        .select(
            "s.source",
            "s.source_size",
            F.greatest(F.coalesce(F.col("w.weight").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("weight"),
        )
        .withColumn("cap", F.col("source_size") * F.lit(float(max_rate)))
        .withColumn("at", F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")))
    )
    everything = W.partitionBy(F.lit(0))
    before = (
        W.partitionBy(F.lit(0))
        .orderBy(F.col("at").asc_nulls_last(), F.col("source").asc_nulls_last())
        .rowsBetween(W.unboundedPreceding, -1)
    )
    total = (
        F.sum("source_size").over(everything).cast("double") if budget is None else F.lit(float(budget))
    )
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.when(rest > 0, rest)
    order = F.struct(F.col("at"), F.col("source").isNull(), F.col("source"))
    levelled = joined.withColumn("here", level).withColumn(
        "level",
        F.min_by("here", F.when(F.col("here") <= F.col("at"), order)).over(everything),
    )
    target = (
        F.when(F.col("weight") <= 0, 0.0)
        .when(F.col("level").isNull(), F.col("cap"))
        .otherwise(F.least(F.col("cap"), F.col("weight") * F.col("level")))
    )
    return levelled.select("source", "source_size", "weight", target.alias("target"))


PLANNED = ["size", "source_size", "target", "rate", "copies"]


def plan_mix(docs: DataFrame, weights: DataFrame | None = None, **options) -> DataFrame:
    """Every document with its size and the number of copies that the mix takes.

    Adds ``size`` (words), ``source_size``, ``target`` (words wanted from the
    source), ``rate`` (target over source size) and ``copies``: floor(rate) plus
    one more where a number drawn by hashing seed and key is below the fraction
    of the rate.  Without ``weights`` the sources in code point order, null
    last, weigh 1, 2, 3, 1, 2, 3 ...

    Null source: a source of its own.  Null or empty text: size 0; its copies
    follow the rate and add no words.  A source without words: rate 0.  Rows
    that share a key share the draw.  Columns that bear one of the added names
    are replaced.  Empty input: no rows.

    Sizes are summed per source before the shuffle; documents join the result,
    one row per source, by its real size.  Options are those of :func:`_planned`.
    """
    return unpacked(_planned(docs, weights, **options), PLANNED)


def _planned(
    docs: DataFrame,
    weights: DataFrame | None = None,
    budget: float | None = None,
    max_rate: float = 3.0,
    seed: int = 42,
    key: str = "doc_id",
) -> DataFrame:
    """The plan with each document as ``row``; ``weights`` has (source, weight), ``budget`` is in words."""
    sized = packed(docs).withColumn("size", word_count(F.col("row.text")))
    stats = settle(
        sized.groupBy(F.col("row.source").alias("source")).agg(F.sum("size").alias("source_size")),
        "source-sizes",
    )
    if weights is None:
        place = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last()))
        weights = stats.select("source", ((place - 1) % 3 + 1).alias("weight"))
    targets = settle(source_targets(stats, weights, budget, max_rate), "targets")
    joined = sized.join(targets.drop("weight"), F.col("row.source").eqNullSafe(targets["source"]), "left")
    rate = F.when(
        F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(max_rate)))
    ).otherwise(0.0)
    draw = uniform(F.col(f"row.`{key}`").cast("string"), seed=seed)
    return joined.withColumn("rate", rate).withColumn(
        "copies",
        (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("bigint")).cast("bigint"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each document as often as :func:`plan_mix` says, with its own columns."""
    taken = _planned(docs, **options).where("copies > 0")
    return unpacked(taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))), [])
