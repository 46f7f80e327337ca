"""Declared keys as checks: Spark tables do not enforce them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Primary keys and foreign keys of the domain tables.
PRIMARY_KEYS = {
    "files": ("RawId",),
    "headers": ("HeaderId",),
    "addresses": ("HeaderId", "AddressId"),
    "details": ("HeaderId", "DetailId"),
    "controls": ("HeaderId",),
    "wms_orders": ("WMSOrderHeaderStagingId",),
    "wms_lines": ("WMSOrderHeaderStagingId", "SourceDetailId"),
}
FOREIGN_KEYS = {
    "addresses": ("HeaderId", "headers"),
    "details": ("HeaderId", "headers"),
    "controls": ("HeaderId", "headers"),
    "wms_lines": ("WMSOrderHeaderStagingId", "wms_orders"),
}


def duplicate_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return (
        table.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
    )


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child keys without a parent, with the number of child rows.

    The child is reduced to its distinct keys before the join.
    """
    counted = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(parent.select(key), key, "left_anti")


def check_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per declared key of the given tables with its number of violations."""
    parts = []
    for name, keys in PRIMARY_KEYS.items():
        if name in tables:
            bad = duplicate_keys(tables[name], keys)
            parts.append(("primary key", name, ", ".join(keys), bad))
    for name, (key, parent) in FOREIGN_KEYS.items():
        if name in tables and parent in tables:
            parts.append(("foreign key", name, key, orphans(tables[name], tables[parent], key)))
    rows = [
        bad.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(kind).alias("kind"), F.lit(name).alias("table"), F.lit(keys).alias("key"), "violations"
        )
        for kind, name, keys, bad in parts
    ]
    result = rows[0]
    for row in rows[1:]:
        result = result.unionByName(row)
    return result
