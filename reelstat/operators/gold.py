"""The daily media fact."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.functions.typing import guarded_ratio


def daily_fact(visitors: DataFrame) -> DataFrame:
    """Loads, plays, exact unique visitors and play rate per day and media. A NULL visitor key is not counted."""
    return (
        visitors.groupBy("dt", "media_id")
        .agg(
            F.sum("load_count").alias("loads"),
            F.sum("play_count").alias("plays"),
            F.countDistinct("visitor_key").alias("unique_visitors"),
        )
        .withColumn("play_rate", guarded_ratio(F.col("plays"), F.col("loads")))
    )


def distinct_visitors(visitors: DataFrame, by: Iterable[str] = ("media_id",)) -> DataFrame:
    """Exact distinct visitors over all days of the frame, which a sum of daily counts overstates."""
    return visitors.groupBy(*by).agg(F.countDistinct("visitor_key").alias("distinct_visitors"))


def visitor_sketches(visitors: DataFrame) -> DataFrame:
    """A mergeable sketch of the visitors of each day and media, to be kept beside the fact."""
    return visitors.groupBy("dt", "media_id").agg(F.hll_sketch_agg("visitor_key").alias("visitor_sketch"))


def merge_sketches(sketches: DataFrame, by: Iterable[str] = ("media_id",)) -> DataFrame:
    """Approximate distinct visitors over the days of the frame, from the daily sketches alone."""
    merged = F.hll_sketch_estimate(F.hll_union_agg("visitor_sketch"))
    return sketches.groupBy(*by).agg(merged.alias("approx_distinct_visitors"))
