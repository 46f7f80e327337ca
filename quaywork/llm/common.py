"""Reading tables, carrying whole rows through an operator, and cutting lineage."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywork.session import scratch_path

#: What separates words: the ASCII white space of the operators' contracts.  Fixed value.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it again.

    The plan starts anew from files that survive a lost executor, and Spark
    knows their size when it chooses how to join them.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def packed(df: DataFrame) -> DataFrame:
    """The rows as one struct column ``row``, so that no column name can clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def unpacked(df: DataFrame, outputs: Iterable[str], without: Iterable[str] = ()) -> DataFrame:
    """The columns of ``row``, then ``outputs``, which replace columns of the same name."""
    outputs = list(outputs)
    hidden = {c.lower() for c in [*outputs, *without]}
    kept = [c for c in df.schema["row"].dataType.fieldNames() if c.lower() not in hidden]
    return df.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], *outputs)


def uniform(*parts: Column | str, seed: int) -> Column:
    """A number in [0, 1) that depends on the seed and the parts alone."""
    texts = [F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p, F.lit("")) for p in parts]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *texts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))
