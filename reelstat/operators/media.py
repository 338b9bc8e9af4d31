"""Media metadata: bronze to history, snapshot and dimension."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.functions.typing import as_boolean, as_count, as_double, as_timestamp, stamp
from reelstat.operators.keyed import latest_per_key
from reelstat.schemas import DELIVERED


def flatten_media(df: DataFrame) -> DataFrame:
    """Typed media rows with the project and thumbnail objects flattened."""
    return df.select(
        "media_id",
        "name",
        as_double(F.col("duration")).alias("duration_s"),
        as_timestamp(F.col("created")).alias("created_at"),
        as_timestamp(F.col("updated")).alias("updated_at"),
        "status",
        as_boolean(F.col("archived")).alias("archived"),
        "section",
        as_count(F.col("project.id")).alias("project_id"),
        F.col("project.name").alias("project_name"),
        F.col("thumbnail.url").alias("thumbnail_url"),
        as_double(F.col("progress")).alias("progress"),
        "dt",
    )


#: What ranks the versions of a media: its own time, then the day that delivered it, then the time it was stored. Columns
#: that a frame lacks are left out.
_RANK = ("updated_at", DELIVERED, "ingested_at")


def _latest(rows: DataFrame) -> DataFrame:
    return latest_per_key(rows, ["media_id"], [name for name in _RANK if name in rows.columns])


def media_versions(history: DataFrame) -> DataFrame:
    """The latest version of every media, with the day that delivered it. Of versions of one time the last delivery counts."""
    return _latest(history.withColumnRenamed("dt", DELIVERED))


def media_snapshot(history: DataFrame) -> DataFrame:
    """The latest version of every media."""
    return media_versions(history).drop(DELIVERED)


def upsert_dim(existing: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Type-1 upsert: media absent from the batch stay, the others move to their latest version.

    With the days of delivery on both sides the outcome does not depend on the order in which days are run: a day run again
    does not take back what a later day brought under the same time. A stored row without a day gives way.
    """
    rows = batch if existing is None else existing.unionByName(batch, allowMissingColumns=True)
    return _latest(rows).select(*batch.columns)


def to_dim_media(snapshot: DataFrame, ts: datetime | None = None) -> DataFrame:
    dim = snapshot.select(
        "media_id",
        F.col("name").alias("title"),
        "duration_s",
        "created_at",
        "updated_at",
        "status",
        "archived",
        "section",
        "project_id",
        "project_name",
        "thumbnail_url",
        "progress",
        F.col("ingested_at").alias("silver_ingested_at"),
    )
    return stamp(dim, "gold_ingested_at", ts)
