"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaywork.llm.common import settle


def components(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, component) for every node with a link; ``links`` has columns a and b.

    Each round, every label moves to whichever label in its neighbourhood
    (itself included) has the least hash of that round; links between labels
    that now agree vanish and the rest are made distinct.  The number of labels
    that still have links falls by a constant factor a round whatever the shape
    of the graph, so chains and stars alike take a logarithm of rounds.  The
    component is one of its labels; which one is not defined.  No group is
    gathered: every step is a partial aggregate or a join by label.

    Links with a null end are left out; repeated links and loops count once.
    """
    spark = links.sparkSession
    both = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    left = settle(both.distinct(), "links")
    moves = []
    for turn in range(max_rounds):
        if left.isEmpty():
            break
        sides = left.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
            left.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        hashed = F.xxhash64(F.lit(turn), "other")
        nearest = sides.groupBy("node").agg(F.min(F.struct(hashed.alias("h"), F.col("other"))).alias("best"))
        own = F.struct(F.xxhash64(F.lit(turn), "node").alias("h"), F.col("node").alias("other"))
        move = settle(nearest.select("node", F.least(F.col("best"), own)["other"].alias("label")), "moves")
        moves.append(move)
        moved = (
            left.join(move.select(F.col("node").alias("a"), F.col("label").alias("la")), "a")
            .join(move.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b")
            .where("la <> lb")
            .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b"))
        )
        left = settle(moved.distinct(), "links")
    else:
        raise RuntimeError(f"links remain after {max_rounds} rounds")
    if not moves:
        return spark.createDataFrame([], "node bigint, component bigint")
    # Later moves concern ever fewer labels, so they are composed from the last to the first.
    final = moves[-1].select(F.col("node"), F.col("label").alias("component"))
    for move in reversed(moves[:-1]):
        step = move.join(final.select(F.col("node").alias("label"), "component"), "label", "left")
        final = settle(
            step.select("node", F.coalesce("component", "label").alias("component")), "composed"
        )
    return final
