"""Writers: lake export, tabular export, logs, parse results and JSON columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaywork.functions.columns import clock, join_text, round_binary, seconds_between
from quaywork.operators import interchange

CLARIFICATION = "array<struct<question:string,answer:string>>"
JSON_COLUMNS = {
    "ClarificationJson": ("clarification", CLARIFICATION),
    "RequirementsJson": ("requirements", "array<string>"),
    "TouchPointsJson": ("touchPoints", "array<string>"),
    "OutOfScopeJson": ("outOfScope", "array<string>"),
}
# Decimal places of the money columns when read back.
MONEY_PLACES = {"EstimatedCostUsd": 2, "CostRatioPct": 1, "ActualCostUsd": 4}


def with_day_parts(df: DataFrame, column: str) -> DataFrame:
    ts = F.col(column)
    return df.withColumns(
        {
            "year": F.date_format(ts.cast("date"), "yyyy"),
            "month": F.date_format(ts.cast("date"), "MM"),
            "day": F.date_format(ts.cast("date"), "dd"),
        }
    )


def export_lake(df: DataFrame, path: str, column: str) -> None:
    """Parquet under year/month/day; only the days in ``df`` are rewritten.

    Rebalancing gives a day few files and spreads a day that is very large.
    """
    (
        with_day_parts(df, column)
        .hint("rebalance", "year", "month", "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month", "day")
        .parquet(path)
    )


def sheet_safe(df: DataFrame) -> DataFrame:
    """Every column as export text: NULL is empty, times are ISO, decimals are floats."""

    def cell(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            text = F.replace(value.cast("timestamp_ntz").cast("string"), F.lit(" "), F.lit("T"))
            # Fractions are written in full, six digits or none.
            dot = F.instr(text, ".")
            value = F.when(dot == 0, text).otherwise(F.rpad(text, 26, "0"))
        elif isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, T.BinaryType):
            value = F.make_valid_utf8(value.cast("string"))
        return F.coalesce(value.cast("string"), F.lit("")).alias(field.name)

    return df.select(*[cell(f) for f in df.schema.fields])


def export_tabular(df: DataFrame, path: str) -> None:
    """Replace a CSV export with header; empty cells stay empty."""
    (
        sheet_safe(df)
        .write.mode("overwrite")
        .option("header", "true")
        .option("emptyValue", "")
        .option("nullValue", "")
        .csv(path)
    )


def write_customer_reports(detail: DataFrame, path: str) -> None:
    """One folder per customer, so no file mixes two customers' exceptions."""
    balanced = detail.hint("rebalance", "isaSender")
    balanced.write.mode("overwrite").partitionBy("isaSender").option("header", "true").csv(path)


def processing_entries(activity: DataFrame) -> DataFrame:
    return activity.select(
        "FileName", "ProcessStatus", "ProcessDateTime", "ErrorMessage", "RecordsProcessed"
    )


def audit_entries(activity: DataFrame) -> DataFrame:
    return activity.select(
        "FileName",
        F.col("ProcessStatus").alias("Action"),
        F.col("ProcessDateTime").alias("ActionDateTime"),
        join_text("Records Processed: ", F.col("RecordsProcessed")).alias("Details"),
    )


def load_entries(activity: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Load log rows; a duration exists only where an end time was given."""
    duration = seconds_between(F.col("LoadStartTime"), F.col("LoadEndTime")).cast("int")
    return activity.withColumns(
        {
            "LoadDurationSeconds": duration,
            "LoadEndTime": F.coalesce(F.col("LoadEndTime"), clock(as_of)),
            "RowsCopied": F.coalesce("RowsCopied", F.lit(0)),
            "RowsAffected": F.coalesce("RowsAffected", F.lit(0)),
        }
    )


def run_entries(runs: DataFrame) -> DataFrame:
    """Run log rows with the minute precision of their time column.

    From 29.999 seconds on, a time counts as the next minute.
    """
    minute = F.col("RunDateTime") - F.make_dt_interval(
        secs=F.date_part(F.lit("SECOND"), F.col("RunDateTime")).cast("decimal(18,6)")
    )
    half = F.date_part(F.lit("SECOND"), F.col("RunDateTime")) >= 29.999
    rounded = F.when(half, minute + F.expr("INTERVAL '1' MINUTE")).otherwise(minute)
    return runs.withColumn("RunDateTime", rounded)


def append_log(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").parquet(path)


def append_processing(activity: DataFrame, log_path: str, audit_path: str) -> None:
    append_log(processing_entries(activity), log_path)
    append_log(audit_entries(activity), audit_path)


def read_json_columns(requests: DataFrame) -> DataFrame:
    """JSON text columns as arrays (empty text is an empty array), money rounded."""
    columns = {
        target: F.coalesce(
            F.from_json(F.nullif(F.col(source), F.lit("")), kind),
            F.array().cast(kind),
        )
        for source, (target, kind) in JSON_COLUMNS.items()
        if source in requests.columns
    }
    for name, places in MONEY_PLACES.items():
        if name in requests.columns:
            columns[name] = round_binary(F.col(name), places)
    return requests.withColumns(columns).drop(*[c for c in JSON_COLUMNS if c in requests.columns])


def write_json_columns(requests: DataFrame) -> DataFrame:
    """Arrays back to JSON text; NULL becomes the empty list."""
    columns = {
        source: F.to_json(F.coalesce(F.col(target), F.array().cast(kind)))
        for source, (target, kind) in JSON_COLUMNS.items()
        if target in requests.columns
    }
    return requests.withColumns(columns).drop(
        *[target for target, _ in JSON_COLUMNS.values() if target in requests.columns]
    )


def write_parse(files: DataFrame, path: str, strict: bool = False) -> dict[str, str]:
    """Parse once, keep the nested result, and write the flat tables from it.

    The nested table is the only step that reads file text, so each text is
    tokenised a single time however many tables are written.
    """
    places = {"parsed": f"{path}/parsed"}
    spark = files.sparkSession
    interchange.parse_files(files, strict).write.mode("overwrite").parquet(places["parsed"])
    parsed = spark.read.parquet(places["parsed"])
    tables = {
        "headers": interchange.headers,
        "addresses": interchange.addresses,
        "details": interchange.details,
        "controls": interchange.controls,
        "rejects": interchange.rejects,
    }
    for name, view in tables.items():
        places[name] = f"{path}/{name}"
        view(parsed).write.mode("overwrite").parquet(places[name])
    return places
