"""Snapshot upserts: the functions return the new content of the target table.

Plain parquet tables know no UPDATE, so a job writes the result to a new path
and swaps it in.  Each upsert is a left join plus an anti join rather than a
full outer join, because both of those may be split when a key is skewed.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaywork.functions.columns import clock

MERGED_COLUMNS = ("CustomerName", "OrderDate", "sku", "quantity", "UnitPrice", "ShipToState")
BATCH_COLUMNS = ("CustomerID", "OrderDate", "OrderAmount", "Status")


def latest_versions(staging: DataFrame, values: Sequence[str], version: Sequence[str]) -> DataFrame:
    """One row per OrderID, the last under ``version``; keyless rows are only de-duplicated."""
    keyed = (
        staging.where(F.col("OrderID").isNotNull())
        .groupBy("OrderID")
        .agg(F.max_by(F.struct(*values), F.struct(*version, *values)).alias("_row"))
        .select("OrderID", "_row.*")
    )
    keyless = staging.where(F.col("OrderID").isNull()).select("OrderID", *values).distinct()
    return keyed.unionByName(keyless)


def version_conflicts(staging: DataFrame, values: Sequence[str] = MERGED_COLUMNS) -> DataFrame:
    """OrderIDs staged with more than one distinct content."""
    return (
        staging.select("OrderID", *values)
        .distinct()
        .groupBy("OrderID")
        .agg(F.count(F.lit(1)).alias("versions"))
        .where((F.col("versions") > 1) & F.col("OrderID").isNotNull())
    )


def _upsert(
    target: DataFrame, source: DataFrame, values: Sequence[str], stamps: dict, action: bool
) -> DataFrame:
    marked = source.select(
        "OrderID", F.struct(*values).alias("_new"), F.lit(True).alias("_hit")
    )
    hit = F.col("_hit").isNotNull()
    updated = target.join(marked, "OrderID", "left")
    for name in values:
        updated = updated.withColumn(name, F.when(hit, F.col(f"_new.{name}")).otherwise(F.col(name)))
    if "ModifiedDate" in stamps:
        updated = updated.withColumn(
            "ModifiedDate", F.when(hit, stamps["ModifiedDate"]).otherwise(F.col("ModifiedDate"))
        )
    kinds = {f.name: f.dataType for f in target.schema.fields}
    present = {"OrderID", *values}
    new = source.join(target.select("OrderID"), "OrderID", "left_anti")
    inserted = new.select(
        *[
            F.col(c).cast(kinds[c]).alias(c)
            if c in present
            else stamps.get(c, F.lit(None)).cast(kinds[c]).alias(c)
            for c in target.columns
        ]
    )
    if action:
        updated = updated.withColumn("_action", F.when(hit, "update"))
        inserted = inserted.withColumn("_action", F.lit("insert"))
        return updated.select(*target.columns, "_action").unionByName(inserted)
    return updated.select(*target.columns).unionByName(inserted)


def merge_orders(
    target: DataFrame, staging: DataFrame, version: Sequence[str] = ("LoadBatchID",)
) -> DataFrame:
    """Target after merging all staged orders; staging is to be cleared afterwards."""
    source = latest_versions(staging, MERGED_COLUMNS, version)
    return _upsert(target, source, MERGED_COLUMNS, {}, action=False)


def merge_batch(
    target: DataFrame, staging: DataFrame, batch: int, as_of: datetime | None = None
) -> DataFrame:
    """Target after merging one batch, with ``_action`` naming what happened to a row."""
    source = latest_versions(
        staging.where(F.col("LoadBatchID") == batch), BATCH_COLUMNS, ("LoadBatchID",)
    )
    now = clock(as_of)
    return _upsert(
        target, source, BATCH_COLUMNS, {"ModifiedDate": now, "CreatedDate": now}, action=True
    )


def affected_rows(merged: DataFrame) -> DataFrame:
    return (
        merged.where(F.col("_action").isNotNull())
        .groupBy("_action")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def clear_staging(staging: DataFrame, batch: int | None = None) -> DataFrame:
    """What stays in staging; rows without a batch survive a batch delete."""
    if batch is None:
        return staging.where(F.lit(False))
    return staging.where(~F.col("LoadBatchID").eqNullSafe(F.lit(batch)))


def insert_if_absent(target: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    fresh = candidates.dropDuplicates(list(keys)).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def delete_join(target: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(doomed.select(*keys), list(keys), "left_anti").select(*target.columns)
