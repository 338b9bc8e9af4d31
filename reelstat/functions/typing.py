"""Typing of bronze text. A value that does not fit its type becomes NULL, never an error, with ANSI on or off."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_count(value: Column) -> Column:
    """Whole number from `21`, `"21"` or `21.0`. The BIGINT cast goes first so that large counts stay exact."""
    return F.coalesce(value.try_cast("bigint"), value.try_cast("double").try_cast("bigint"))


def as_double(value: Column) -> Column:
    return value.try_cast("double")


def as_boolean(value: Column) -> Column:
    return value.try_cast("boolean")


def as_timestamp(value: Column) -> Column:
    """ISO-8601 text, with or without an offset."""
    return value.try_cast("timestamp")


def as_day(value: Column) -> Column:
    return value.try_cast("date")


def day_literal(day: str | date) -> Column:
    return F.lit(parse_day(day))


def parse_day(day: str | date) -> date:
    if isinstance(day, datetime):
        return day.date()
    return day if isinstance(day, date) else datetime.strptime(day, "%Y-%m-%d").date()


def col_or_null(df: DataFrame, name: str, dtype: str) -> Column:
    """The named column as `dtype`, or a typed NULL when the frame lacks it."""
    if name in df.columns:
        return F.col(f"`{name}`").try_cast(dtype)
    return F.lit(None).cast(dtype)


def stamp(df: DataFrame, name: str, ts: datetime | None = None) -> DataFrame:
    """Add a processing time: now, or a given time in tests and reruns."""
    return df.withColumn(name, F.current_timestamp() if ts is None else F.lit(ts).cast("timestamp"))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double, 0.0 where the denominator is not positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator).otherwise(F.lit(0.0))
