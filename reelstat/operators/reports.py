"""Reporting over the daily fact and the media dimension."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.functions.typing import day_literal, guarded_ratio, parse_day


def today_utc() -> date:
    return datetime.now(timezone.utc).date()


def on_day(df: DataFrame, day: str | date, col: str = "dt") -> DataFrame:
    return df.where(F.col(col) == day_literal(day))


def between(df: DataFrame, start: str | date, end: str | date, col: str = "dt") -> DataFrame:
    """Days from `start` to `end`, both included. The bounds are literals, so partitions are pruned at plan time."""
    return df.where(F.col(col).between(day_literal(start), day_literal(end)))


def trailing(df: DataFrame, as_of: str | date | None, days: int, col: str = "dt") -> DataFrame:
    """From `days` days before `as_of` (default: today, UTC) to `as_of`, both included, that is days + 1 dates."""
    end = today_utc() if as_of is None else parse_day(as_of)
    return between(df, end - timedelta(days=days), end, col)


def having(groups: DataFrame, predicate: Column) -> DataFrame:
    return groups.where(predicate)


def with_range(df: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """Every row beside a one-row date window, as `start_dt` and `end_dt`."""
    return df.withColumns({"start_dt": day_literal(start), "end_dt": day_literal(end)})


def top_k(df: DataFrame, metric: str, tie: str, k: int) -> DataFrame:
    """The k highest rows, ties broken by `tie`. Each task keeps k rows; there is no global sort."""
    return df.orderBy(F.col(metric).desc_nulls_last(), F.col(tie).asc()).limit(k)


def by_day(df: DataFrame, descending: bool = False, col: str = "dt") -> DataFrame:
    return df.orderBy(F.col(col).desc() if descending else F.col(col).asc())


def with_media(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Fact rows with title and project; rows of unknown media keep NULLs.

    The join carries no hint: the dimension is broadcast where its size is known to be small, and otherwise
    shuffled with skewed media split.
    """
    return fact.join(dim.select("media_id", "title", "project_name"), "media_id", "left")


def media_perf(fact: DataFrame, dim: DataFrame) -> DataFrame:
    return with_media(fact, dim).select(
        "dt", "media_id", "title", "project_name", "unique_visitors", "loads", "plays", "play_rate"
    )


def _totals(fact: DataFrame, dim: DataFrame, labels: list[str], sums: dict[str, str]) -> DataFrame:
    """Sums per media and labels. The fact is reduced to one row per media before it meets the dimension, and the
    second grouping runs on the same distribution, so the join and both groupings share one shuffle of the fact."""
    per_media = fact.groupBy("media_id").agg(*[F.sum(src).alias(out) for out, src in sums.items()])
    return with_media(per_media, dim).groupBy(*labels, "media_id").agg(*[F.sum(out).alias(out) for out in sums])


def top_by_play_rate(
    fact: DataFrame, dim: DataFrame, as_of: str | date | None = None, days: int = 7, n: int = 20
) -> DataFrame:
    """Best videos by the mean of their daily play rates, among those with loads."""
    window = trailing(fact, as_of, days).withColumn("_rated", F.col("play_rate").isNotNull().cast("bigint"))
    sums = {
        "_rates": "play_rate",
        "_days": "_rated",
        "total_plays": "plays",
        "total_loads": "loads",
        "total_unique_visitors": "unique_visitors",
    }
    groups = having(_totals(window, dim, ["title", "project_name"], sums), F.col("total_loads") > 0)
    rated = groups.select(
        "title",
        "project_name",
        "media_id",
        F.try_divide(F.col("_rates"), F.col("_days")).alias("avg_play_rate"),
        "total_plays",
        "total_loads",
        "total_unique_visitors",
    )
    return top_k(rated, "avg_play_rate", "media_id", n)


def daily_trend(fact: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """Plays, loads and their ratio per day, in day order."""
    days = between(fact, start, end).groupBy("dt").agg(F.sum("plays").alias("plays"), F.sum("loads").alias("loads"))
    return by_day(days.withColumn("play_rate", guarded_ratio(F.col("plays"), F.col("loads"))))


def most_viewed(
    fact: DataFrame, dim: DataFrame, as_of: str | date | None = None, days: int = 7, n: int = 20
) -> DataFrame:
    sums = {"total_plays": "plays", "total_unique_visitors": "unique_visitors"}
    groups = _totals(trailing(fact, as_of, days), dim, ["title", "project_name"], sums)
    return top_k(groups, "total_plays", "media_id", n)


def plays_per_visitor(
    fact: DataFrame, dim: DataFrame, as_of: str | date | None = None, days: int = 14, n: int = 20
) -> DataFrame:
    """Plays per visitor-day. `visitors` adds up daily counts; see `distinct_visitors` for people."""
    groups = _totals(trailing(fact, as_of, days), dim, ["title"], {"visitors": "unique_visitors", "plays": "plays"})
    rated = groups.withColumn("plays_per_visitor", guarded_ratio(F.col("plays"), F.col("visitors")))
    return top_k(rated, "plays_per_visitor", "media_id", n)


def top_media_of_day(fact: DataFrame, day: str | date, n: int = 10) -> DataFrame:
    rows = on_day(fact, day).select("media_id", "play_rate", "plays", "unique_visitors")
    return top_k(rows, "play_rate", "media_id", n)


def latest_day(fact: DataFrame) -> DataFrame:
    return fact.agg(F.max("dt").alias("latest_dt"))


def rows_on_day(fact: DataFrame, day: str | date) -> DataFrame:
    return on_day(fact, day).groupBy("dt").agg(F.count(F.lit(1)).alias("rows"))


def rows_per_day(fact: DataFrame) -> DataFrame:
    return by_day(fact.groupBy("dt").agg(F.count(F.lit(1)).alias("rows")), descending=True)
