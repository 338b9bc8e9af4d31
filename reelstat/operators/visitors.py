"""Visitor records: bronze to silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.functions.privacy import hmac_column
from reelstat.functions.typing import as_count

# The visitor leads: string maxima are grouped by sorting, and a sort is fastest when its first key tells rows apart.
VISITOR_KEYS = ("visitor_key", "media_id", "dt")


def flatten_visitors(df: DataFrame) -> DataFrame:
    """Typed visitor rows: counts default to 0, name and email come out of the identity object."""
    return df.select(
        "dt",
        "media_id",
        F.col("visitor_key").cast("string").alias("visitor_key"),
        F.coalesce(as_count(F.col("load_count")), F.lit(0)).alias("load_count"),
        F.coalesce(as_count(F.col("play_count")), F.lit(0)).alias("play_count"),
        F.col("visitor_identity.name").cast("string").alias("name"),
        F.col("visitor_identity.email").cast("string").alias("email"),
    )


def dedup_visitors(df: DataFrame) -> DataFrame:
    """One row per day, media and visitor, each column at its own maximum over the pages."""
    maxima = ("load_count", "play_count", "name", "email")
    rows = df.groupBy(*VISITOR_KEYS).agg(*[F.max(name).alias(name) for name in maxima])
    return rows.select("dt", "media_id", "visitor_key", *maxima)


def pseudonymise_email(df: DataFrame, key: str | bytes | None) -> DataFrame:
    """Option: silver visitors with the email replaced by its keyed hash."""
    return hmac_column(df.withColumnRenamed("email", "_email"), "_email", key, "email").select(*df.columns)
