"""Data-quality checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstat.schemas import EVENT_PII


def duplicate_event_keys(df: DataFrame) -> DataFrame:
    """Event keys that occur more than once, with their counts. Empty for a sound silver table."""
    counts = df.where(F.col("event_key").isNotNull()).groupBy("event_key").agg(F.count(F.lit(1)).alias("copies"))
    return counts.where(F.col("copies") > 1)


def pii_columns(schema: T.DataType, keys: Iterable[str] = EVENT_PII, prefix: str = "") -> list[str]:
    """Dotted names of the fields, at any depth, that carry personal data."""
    if isinstance(schema, T.ArrayType):
        return pii_columns(schema.elementType, keys, prefix)
    if isinstance(schema, T.MapType):
        return pii_columns(schema.valueType, keys, prefix)
    if not isinstance(schema, T.StructType):
        return []
    found = []
    for field in schema.fields:
        name = prefix + field.name
        found += [name] if field.name in set(keys) else pii_columns(field.dataType, keys, name + ".")
    return found


def assert_no_pii(df: DataFrame, keys: Iterable[str] = EVENT_PII) -> DataFrame:
    found = pii_columns(df.schema, tuple(keys))
    if found:
        raise ValueError(f"personal data in the output: {', '.join(found)}")
    return df


def visitor_spread(visitors: DataFrame) -> DataFrame:
    """Per day, how many visitors are reported under every media of that day.

    A share near 1 means the source reports account-wide visitors under each media. Visitors are first reduced to
    a histogram of media per visitor, so only day-level rows meet in the join.
    """
    pairs = visitors.where(F.col("visitor_key").isNotNull()).select("dt", "visitor_key", "media_id").distinct()
    spread = pairs.groupBy("dt", "visitor_key").agg(F.count("media_id").alias("n_media"))
    histogram = spread.groupBy("dt", "n_media").agg(F.count(F.lit(1)).alias("visitors"))
    media = visitors.groupBy("dt").agg(F.countDistinct("media_id").alias("media"))
    everywhere = F.when(F.col("n_media") == F.col("media"), F.col("visitors")).otherwise(0)
    days = (
        histogram.join(media, "dt")
        .groupBy("dt", "media")
        .agg(
            F.sum("visitors").alias("visitors"),
            F.sum(everywhere).alias("visitors_under_every_media"),
            F.max("n_media").alias("widest_visitor"),
        )
    )
    return days.withColumn("share", F.col("visitors_under_every_media") / F.col("visitors"))
