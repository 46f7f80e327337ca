"""Registration of queries with their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaywork.plans.domain import Domain
from quaywork.plans.oracle import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Simple column types, so that two engines' results can be compared as values."""

    def cell(field: T.StructField):
        value = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            value = F.substring(value.cast("string"), 1, 19)
        elif isinstance(kind, T.DateType):
            value = value.cast("string")
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            value = value.cast("double")
        elif isinstance(kind, T.IntegralType):
            value = value.cast("bigint")
        return value.alias(field.name)

    return df.select(*[cell(f) for f in df.schema.fields])


def query(name: str, needs: str = "", sql: str | None = None):
    def register(fn: Callable[[Domain], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(fn(Domain(spark, folder)))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(needs, sql)
        return fn

    return register
