"""Per-day media statistics: bronze to silver, and their comparison with the daily fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.functions.typing import as_count, as_day, as_double, col_or_null
from reelstat.operators.keyed import latest_per_key

_COUNTS = ("load_count", "play_count")
_RATES = ("play_rate", "hours_watched", "engagement")


def type_by_date(df: DataFrame) -> DataFrame:
    """Typed KPIs in a fixed column order; a column the frame lacks becomes a typed NULL."""

    def text(name: str):
        return col_or_null(df, name, "string")

    return df.select(
        as_day(text("date")).alias("day"),
        *[as_count(text(name)).alias(name) for name in _COUNTS],
        *[as_double(text(name)).alias(name) for name in _RATES],
        as_count(text("visitors")).alias("visitors"),
        "dt",
        "media_id",
    )


def derived_rates(stats: DataFrame) -> DataFrame:
    """Both ways to derive a play rate from reported counts; a reported play_rate need not equal either."""
    return stats.withColumns(
        {
            "plays_per_load": F.try_divide(F.col("play_count"), F.col("load_count")),
            "plays_per_visitor": F.try_divide(F.col("play_count"), F.col("visitors")),
        }
    )


def reconcile(by_date: DataFrame, fact: DataFrame) -> DataFrame:
    """Reported statistics beside the daily fact, with the play rate derived in both usual ways.

    Days or media that only one side has are kept. Of a day that was delivered more than once the last delivery counts.
    """
    last = latest_per_key(by_date, ["day", "media_id"], ["dt"]) if "dt" in by_date.columns else by_date
    reported = derived_rates(last).select(
        F.col("day").alias("dt"),
        "media_id",
        F.col("load_count").alias("reported_loads"),
        F.col("play_count").alias("reported_plays"),
        F.col("visitors").alias("reported_visitors"),
        F.col("play_rate").alias("reported_play_rate"),
        "plays_per_load",
        "plays_per_visitor",
    )
    counted = fact.select("dt", "media_id", "loads", "plays", "unique_visitors", "play_rate")
    return reported.join(counted, ["dt", "media_id"], "full").withColumns(
        {
            "loads_gap": F.col("reported_loads") - F.col("loads"),
            "plays_gap": F.col("reported_plays") - F.col("plays"),
        }
    )
