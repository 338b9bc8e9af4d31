"""One row per key, chosen by a total order so that the winner never depends on partitioning or arrival."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, keys: Iterable[str], order: Iterable[str], pick, nulls_last: bool) -> DataFrame:
    # A min/max of one struct is combined map-side, so a key with very many copies shuffles one row per task.
    keys, order = list(keys), list(order)
    ranked = []
    for name in order:
        if nulls_last:
            ranked.append(F.col(f"`{name}`").isNull().alias(f"_no_{name}"))
        ranked.append(F.col(f"`{name}`"))
    ranked += [F.col(f"`{name}`") for name in df.columns if name not in keys and name not in order]
    chosen = df.groupBy(*keys).agg(pick(F.struct(*ranked)).alias("_row"))
    return chosen.select(*[F.col(name) if name in keys else F.col("_row")[name].alias(name) for name in df.columns])


def latest_per_key(df: DataFrame, keys: Iterable[str], order: Iterable[str]) -> DataFrame:
    """The row with the highest `order` columns per key, NULL lowest; ties go to the highest remaining columns."""
    return _one_per_key(df, keys, order, F.max, nulls_last=False)


def earliest_per_key(df: DataFrame, keys: Iterable[str], order: Iterable[str]) -> DataFrame:
    """The row with the lowest `order` columns per key, NULL last; ties go to the lowest remaining columns."""
    return _one_per_key(df, keys, order, F.min, nulls_last=True)
