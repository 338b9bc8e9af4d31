"""Playback events: bronze to silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.functions.privacy import drop_pii, hmac_column, redact_json
from reelstat.functions.typing import as_double, as_timestamp
from reelstat.operators.keyed import earliest_per_key
from reelstat.schemas import EVENT_PII

_TYPES = {
    "at": as_timestamp,
    "received_at": as_timestamp,
    "position_s": as_double,
    "percent_viewed": as_double,
}


def type_events(df: DataFrame) -> DataFrame:
    """Type the time and number columns the frame has; everything else passes through."""
    return df.withColumns({name: convert(F.col(name)) for name, convert in _TYPES.items() if name in df.columns})


def protect_events(df: DataFrame, ip_key: str | bytes | None = None) -> DataFrame:
    """Replace `ip` by `ip_hmac`, drop the other personal columns and redact the free-form payload."""
    df = hmac_column(df, "ip", ip_key if "ip" in df.columns else None, "ip_hmac")
    if "conversion_data" in df.columns:
        df = df.withColumn("conversion_data", redact_json(F.col("conversion_data"), EVENT_PII))
    return drop_pii(df)


def first_of_each_key(df: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """The earliest received record of every event_key that `seen` does not hold. Records without a key are left out.

    Both steps run on one distribution by event_key.
    """
    keyed = earliest_per_key(df.where(F.col("event_key").isNotNull()), ["event_key"], ["received_at"])
    return keyed if seen is None else exclude_seen(keyed, seen)


def without_key(df: DataFrame) -> DataFrame:
    return df.where(F.col("event_key").isNull())


def dedup_events(df: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """One row per event_key, none of those in `seen`. Records without a key cannot be copies and are all kept.

    The input is read once, with no filter that a JSON reader could apply to broken lines. Keyless records are grouped
    by their whole content, which spreads them over all tasks, and come out as often as they went in.
    """
    if df.isStreaming:
        raise ValueError("dedup_events takes batches")
    rest = [name for name in df.columns if name != "event_key"]
    order = [F.col("received_at").isNull().alias("_no_received_at"), "received_at"]
    order += [F.col(f"`{name}`") for name in rest if name != "received_at"]
    whole = F.when(F.col("event_key").isNull(), F.struct(*[F.col(f"`{name}`") for name in rest]))
    grouped = df.groupBy("event_key", whole.alias("_whole")).agg(F.min(F.struct(*order)).alias("_row"), F.count("*").alias("_n"))
    if seen is not None:
        keys = seen.select("event_key").where(F.col("event_key").isNotNull())
        grouped = grouped.join(keys, "event_key", "left_anti")
    copies = F.when(F.col("event_key").isNull(), F.col("_n")).otherwise(1).cast("int")
    repeated = grouped.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    return repeated.select(*[F.col("event_key") if name == "event_key" else F.col("_row")[name].alias(name) for name in df.columns])


def exclude_seen(df: DataFrame, seen: DataFrame) -> DataFrame:
    """Drop events whose key is already stored, such as those of the overlap day."""
    keys = seen.select("event_key").where(F.col("event_key").isNotNull())
    return df.join(keys, "event_key", "left_anti").select(*df.columns)
