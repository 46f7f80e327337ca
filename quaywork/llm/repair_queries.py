"""The conversation repair query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywork.llm.common import table
from quaywork.llm.registry import query
from quaywork.llm.repair import joined_digests, repair


def damaged(logs: DataFrame) -> DataFrame:
    """The turns with a fault each in five of twenty classes of crc32(conv_id:turn); nulls are one space.

    0 drops the turn, 1 empties its text, 2 takes its sentence ends, 3 repeats
    it, 4 makes it the user's.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    fault, text, role = F.col("fault"), F.coalesce("text", space), F.coalesce("role", space)
    ended = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = logs.withColumn("fault", F.crc32(key) % 20).where("fault <> 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        ended.alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


@query("op11_repair")
def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Audit and repaired digest of every conversation, after the damage."""
    logs = table(spark, folder, "conversations")
    audits, turns = repair(damaged(logs))
    lines = turns.select("name", "position", F.concat_ws(":", "role", "text").alias("line"))
    found = audits.join(joined_digests(lines), "name", "left").withColumnRenamed("conv_id", "found_id")
    every = logs.select("conv_id").distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
