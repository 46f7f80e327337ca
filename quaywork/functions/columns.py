"""Column expressions shared by every operator.

All of them are compositions of built-in functions, so they stay inside the
JVM.  Date arithmetic reads calendar fields instead of going through the session
time zone, which keeps ``timestamp_ntz`` columns zone-free.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMAL_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"
INTEGER_TEXT = r"^[+-]?[0-9]+$"


def clock(as_of: datetime | Column | None) -> Column:
    """The "now" of a time-relative operator; the wall clock only by default."""
    if as_of is None:
        return from_micros(F.unix_micros(F.current_timestamp()))
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def _days(ts: Column) -> Column:
    return F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")


def hour_index(ts: Column) -> Column:
    return _days(ts) * 24 + F.hour(ts)


def minute_index(ts: Column) -> Column:
    return hour_index(ts) * 60 + F.minute(ts)


def second_index(ts: Column) -> Column:
    return minute_index(ts) * 60 + F.second(ts)


def hours_between(start: Column, end: Column) -> Column:
    """Hour boundaries crossed, not hours elapsed (00:59 to 01:00 is one)."""
    return (hour_index(end) - hour_index(start)).cast("bigint")


def minutes_between(start: Column, end: Column) -> Column:
    return (minute_index(end) - minute_index(start)).cast("bigint")


def seconds_between(start: Column, end: Column) -> Column:
    return (second_index(end) - second_index(start)).cast("bigint")


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-free timestamp."""
    second = F.date_part(F.lit("SECOND"), ts).cast("decimal(8,6)")
    return minute_index(ts) * 60_000_000 + (second * 1_000_000).cast("bigint")


def from_micros(value: Column) -> Column:
    """UTC wall-clock time of a microsecond count, whatever the session zone."""
    day = 86_400_000_000
    seconds = F.pmod(value, F.lit(day)).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        days=F.floor(value / F.lit(day)).cast("int"), secs=seconds.cast("decimal(18,6)")
    )


def floor_hour(ts: Column) -> Column:
    """Start of the hour, still ``timestamp_ntz`` (``date_trunc`` is not)."""
    return ts - F.make_dt_interval(
        mins=F.minute(ts), secs=F.date_part(F.lit("SECOND"), ts).cast("decimal(18,6)")
    )


def timestamp_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text."""
    return F.substring(ts.cast("string"), 1, 19)


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def strip(value: Column) -> Column:
    """Without white space of any kind at both ends (``trim`` knows blanks only)."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def edi_element(segment: Column, position: int) -> Column:
    """Element ``position`` of a segment; 0 is the segment id, blank is NULL."""
    return blank_to_null(F.get(F.split(segment, r"\*", -1), F.lit(position)))


def safe_decimal(text: Column, precision: int = 18, scale: int = 4) -> Column:
    """Plain decimal text to a decimal; anything else, exponents included, is NULL."""
    return F.when(text.rlike(DECIMAL_TEXT), text.try_cast(f"decimal({precision},{scale})"))


def safe_int(text: Column) -> Column:
    return F.when(F.trim(text).rlike(INTEGER_TEXT), F.trim(text).try_cast("int"))


def compact_date(text: Column) -> Column:
    """Strict ``yyyyMMdd`` text to a date, NULL when it is not one."""
    return F.when(text.rlike("^[0-9]{8}$"), F.try_to_date(text, "yyyyMMdd"))


def ci_key(value: Column) -> Column:
    """Join key under case- and trailing-space-insensitive equality."""
    return F.upper(F.rtrim(value))


def join_text(*parts: Column | str | int) -> Column:
    """Concatenation in which NULL counts as the empty string."""
    columns = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def count_where(condition: Column) -> Column:
    """Conditional sum; NULL over zero rows, as a plain SUM(CASE) is."""
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def first_where(array: Column, predicate) -> Column:
    """First array element satisfying ``predicate`` or NULL."""
    return F.get(F.filter(array, predicate), F.lit(0))


def round_binary(value: Column, places: int) -> Column:
    """Rounding of a double by its exact binary value, ties to even.

    1.265 is a little below the tie in binary and rounds to 1.26, which decimal
    rounding of its printed form would miss.  The double is scaled to its
    53-bit integer and rounded there in exact decimal arithmetic.
    """
    x = value.cast("double")
    size = F.abs(x)
    shift = F.lit(52) - F.floor(F.log2(size))
    mantissa = (size * F.pow(F.lit(2.0), shift)).cast("bigint").cast("decimal(20,0)")
    scaled = (mantissa * F.lit(10**places).cast("decimal(8,0)")).cast("decimal(38,0)")
    unit = F.pow(F.lit(2.0), shift).cast("decimal(38,0)")
    rest = (scaled % unit).cast("decimal(38,0)")
    whole = ((scaled - rest) / unit).cast("bigint")
    twice = (rest * F.lit(2).cast("decimal(1,0)")).cast("decimal(38,0)")
    up = (twice > unit) | ((twice == unit) & (whole % 2 == 1))
    rounded = (whole + F.when(up, 1).otherwise(0)).cast("double") / F.lit(float(10**places))
    # Beyond these sizes a double has no digits to round, or rounds to zero.
    return (
        F.when(x.isNull() | F.isnan(x), x)
        .when(size >= F.lit(2.0**52), x)
        .when(size < F.lit(10.0 ** -(places + 2)), F.lit(0.0))
        .otherwise(F.signum(x) * rounded)
    )
