"""Building blocks that stay balanced when one key owns a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaywork.session import scratch_path

BROADCAST_ROWS = 100_000
#: Rows of one key that a task may sort; Spark spills beyond its memory.
TASK_ROWS = 200_000


def _slice_windows(keys: Sequence[str], order: Sequence[Column]):
    inside = W.partitionBy(*keys, "_slice").orderBy(*order)
    across = W.partitionBy(*keys).orderBy("_slice")
    return inside, across


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    slice_by: Column,
    name: str,
    fits: int = TASK_ROWS,
) -> DataFrame:
    """Exact ``row_number`` per key without gathering a crowded key in one task.

    Rows per key are counted first.  Keys of up to ``fits`` rows are numbered by
    one plain window.  Only a crowded key is cut into slices by ``slice_by``,
    which must not decrease along ``order`` inside a key; its rows are numbered
    inside a slice, and the counts of the slices supply the offsets.
    """
    plain = W.partitionBy(*keys).orderBy(*order)
    crowded = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > fits).drop("_rows")
    many = crowded.count()
    if not many:
        return df.withColumn(name, F.row_number().over(plain).cast("bigint"))
    crowded = crowded.toDF(*[f"_{i}" for i in range(len(keys))])
    crowded = F.broadcast(crowded) if many <= BROADCAST_ROWS else crowded
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)])
    rest = df.join(crowded, same, "left_anti").withColumn(name, F.row_number().over(plain).cast("bigint"))
    return rest.unionByName(_sliced_numbers(df.join(crowded, same, "left_semi"), keys, order, slice_by, name))


def _sliced_numbers(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], slice_by: Column, name: str
) -> DataFrame:
    inside, across = _slice_windows(keys, order)
    sliced = df.withColumn("_slice", slice_by)
    before = F.sum("_rows").over(across.rowsBetween(W.unboundedPreceding, -1))
    offsets = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(before, F.lit(0)))
        .select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)], F.col("_slice").alias("_part"), "_before")
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)]
    return (
        sliced.withColumn("_local", F.row_number().over(inside))
        .join(offsets, reduce(and_, [*same, F.col("_slice").eqNullSafe(F.col("_part"))]))
        .withColumn(name, (F.col("_before") + F.col("_local")).cast("bigint"))
        .select(*df.columns, name)
    )


def _in_ranges(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` dealt by ranges of ``order`` and sorted, with the range ``_part`` and the growing place ``_at``; written."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id counts from zero in every partition, whose number stands in its upper bits.
    ranged = ranged.withColumn("_at", F.monotonically_increasing_id())
    path = scratch_path(df.sparkSession, "ranges")
    ranged.write.parquet(path)
    written = df.sparkSession.read.schema(ranged.schema).parquet(path)
    return written.withColumn("_part", F.shiftrightunsigned("_at", 33))


def globally_numbered(df: DataFrame, order: Sequence[Column], name: str, after: int = 0) -> DataFrame:
    """All rows numbered without gaps in ``order``, from ``after`` + 1 on.

    A prefix sum over range partitions: rows are dealt by ranges of ``order``
    and sorted, each notes its range and its place in it, and the result is
    written, so that the counts and the rows speak of the same ranges.  The
    counts come to the driver, one number a range, and go back as offsets.
    Rows that are equal in ``order`` are numbered in any order.
    """
    spark = df.sparkSession
    written = _in_ranges(df, order)
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = written.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")).collect()
    offsets, total = [], after
    for part_id, rows in sorted(map(tuple, counts)):
        offsets.append((part_id, total))
        total += rows
    table = F.broadcast(spark.createDataFrame(offsets, "_part bigint, _before bigint"))
    numbers = written.join(table, "_part")
    return numbers.withColumn(name, F.col("_before") + place + 1).select(*df.columns, name)


def carried(df: DataFrame, order: Sequence[Column], values: dict[str, Column]) -> DataFrame:
    """Adds for each of ``values`` the last one that is not NULL at or before a row in ``order`` over all rows.

    Rows are sorted in ranges; inside a range the values are carried along by a
    window, and the last values of each range come to the driver, one row a
    range, and go back to the ranges after it.  ``order`` must be unique where
    it matters which of two rows comes first.
    """
    spark, names = df.sparkSession, list(values)
    written = _in_ranges(df.select("*", *[v.alias(n) for n, v in values.items()]), order)
    last = [F.max_by(n, F.when(F.col(n).isNotNull(), F.col("_at"))).alias(n) for n in names]
    known, ends = dict.fromkeys(names), []
    for row in sorted(written.groupBy("_part").agg(*last).collect(), key=lambda r: r["_part"]):
        ends.append((row["_part"], *(known[n] for n in names)))
        known = {n: known[n] if row[n] is None else row[n] for n in names}
    kinds = {f.name: f.dataType for f in written.schema.fields}
    schema = T.StructType(
        [T.StructField("_part", T.LongType()), *[T.StructField(f"_{n}", kinds[n]) for n in names]]
    )
    inside = W.partitionBy("_part").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    seen = written.select("*", *[F.last(n, ignorenulls=True).over(inside).alias(f"_own_{n}") for n in names])
    joined = seen.join(F.broadcast(spark.createDataFrame(ends, schema)), "_part")
    return joined.select(*df.columns, *[F.coalesce(f"_own_{n}", f"_{n}").alias(n) for n in names])


def previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    slice_by: Column,
    value: Column,
    name: str,
) -> DataFrame:
    """Exact ``lag(value)`` per key, carried over slice borders.

    Same contract for ``slice_by`` as in :func:`numbered`; ``value`` must not
    be NULL.
    """
    inside, across = _slice_windows(keys, order)
    sliced = df.withColumn("_slice", slice_by).withColumn("_value", value)
    carried = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.max_by("_value", F.struct(*order)).alias("_last"))
        .withColumn("_carry", F.lag("_last").over(across))
        .drop("_last")
    )
    return (
        sliced.withColumn("_local", F.lag("_value").over(inside))
        .join(carried, [*keys, "_slice"])
        .withColumn(name, F.coalesce("_local", "_carry"))
        .drop("_slice", "_value", "_local", "_carry")
    )


def latest_before(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    slice_by: Column,
    value: Column,
    name: str,
) -> DataFrame:
    """The last ``value`` that is not NULL on an earlier row of the key, carried over slice borders.

    Same contract for ``slice_by`` as in :func:`numbered`; rows with equal
    ``order`` must not exist inside a key.
    """
    inside, across = _slice_windows(keys, order)
    earlier = W.unboundedPreceding, -1
    sliced = df.withColumn("_slice", slice_by).withColumn("_value", value)
    carried = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.struct(*order))).alias("_last"))
        .withColumn("_carry", F.last("_last", ignorenulls=True).over(across.rowsBetween(*earlier)))
        .drop("_last")
    )
    return (
        sliced.withColumn("_local", F.last("_value", ignorenulls=True).over(inside.rowsBetween(*earlier)))
        .join(carried, [*keys, "_slice"])
        .withColumn(name, F.coalesce("_local", "_carry"))
        .drop("_slice", "_value", "_local", "_carry")
    )


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    slice_by: Column,
    value: Column,
    name: str,
) -> DataFrame:
    """Exact running total per key under the same slicing contract."""
    inside, across = _slice_windows(keys, order)
    sliced = df.withColumn("_slice", slice_by).withColumn("_value", value)
    offsets = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.sum("_value").alias("_total"))
        .withColumn(
            "_before",
            F.coalesce(
                F.sum("_total").over(across.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
            ),
        )
        .drop("_total")
    )
    return (
        sliced.withColumn(
            "_local", F.sum("_value").over(inside.rowsBetween(W.unboundedPreceding, 0))
        )
        .join(offsets, [*keys, "_slice"])
        .withColumn(name, F.col("_before") + F.col("_local"))
        .drop("_slice", "_value", "_local", "_before")
    )


def bounded_pieces(df: DataFrame, key: str, limit: int = BROADCAST_ROWS) -> list[DataFrame]:
    """Cut a lookup table into pieces that are each small enough to broadcast.

    The table is counted, not assumed small: up to ``limit`` rows it is one
    piece, beyond that several passes of roughly ``limit`` rows each.
    """
    rows = df.count()
    if rows <= limit:
        return [df]
    pieces = math.ceil(rows / limit)
    slot = F.pmod(F.xxhash64(key), F.lit(pieces))
    return [df.where(slot == i) for i in range(pieces)]


def join_checked(
    big: DataFrame, small: DataFrame, on: str, how: str, limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Join that leaves ``big`` unshuffled when the other side is counted to be small."""
    return big.join(F.broadcast(small) if small.count() <= limit else small, on, how)
