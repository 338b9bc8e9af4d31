"""Parquet sinks whose reruns leave the same files' content behind."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reelstat.sources.files import complete_versions, day_path, join, remove_dir, replace_dir

COMPRESSION = "snappy"

# Upper bound of one file, so that a large table is read by many tasks.
RECORDS_PER_FILE = 10_000_000
KEPT_DAYS = 7


def cluster(df: DataFrame, *cols: str) -> DataFrame:
    """Bring the rows of one output partition together. AQE splits a hot one over tasks and merges small ones."""
    return df.hint("rebalance", *cols)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written in the block leaves no shuffle files behind. Otherwise they stay on the executors' disks until the
    driver happens to collect its garbage, those of all steps of a run together."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows on their way into the writer instead of in a second job."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_day(df: DataFrame, path: str, day: str | date, media_dirs: bool = True) -> int:
    """Replace one day of a table and return the rows written.

    The day is written beside the table and then put in its place as a whole: media that are gone from the batch
    leave nothing behind, other days are untouched, and a job that fails leaves the day as it was.
    `media_dirs=False` keeps media_id as a sorted data column instead of one directory per media, for days with
    many thousand media.
    """
    rows, seen = _counted(cluster(df.drop("dt"), "media_id"))
    if not media_dirs:
        rows = rows.sortWithinPartitions("media_id")
    writer = rows.write.option("compression", COMPRESSION).option("maxRecordsPerFile", RECORDS_PER_FILE)
    if media_dirs:
        writer = writer.partitionBy("media_id")
    staged = join(path, f"_staged-{uuid.uuid4()}")  # a name that readers of the table ignore
    try:
        with shuffles_removed(df.sparkSession):
            writer.parquet(staged)
    except Exception:
        remove_dir(df.sparkSession, staged)
        raise
    replace_dir(df.sparkSession, staged, day_path(path, day))
    return seen.get["rows"]


def write_days(df: DataFrame, path: str) -> int:
    """Replace every `dt` present in the frame, in one job, and return the rows written. `dt` is the only partition
    level, so a replaced day keeps no stale rows."""
    rows, seen = _counted(cluster(df, "dt"))
    with shuffles_removed(df.sparkSession):
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", COMPRESSION)
            .option("maxRecordsPerFile", RECORDS_PER_FILE)
            .partitionBy("dt")
            .parquet(path)
        )
    return seen.get["rows"]


def write_replace(
    df: DataFrame, path: str, version: str | None = None, files: int | None = None, keep: int | None = None
) -> int:
    """Replace a whole table by writing a new version beside the old ones, and return the rows written.

    The frame may read the version it replaces. Readers take the newest version with a `_SUCCESS` marker, so a
    job that dies half-way changes nothing. `files` bounds the number of files without a shuffle; it must leave
    no more rows to one of them than a task can write, as `rows / RECORDS_PER_FILE` does. `keep` removes all but
    that many of the newest complete versions once the new one is complete, and never one younger than KEPT_DAYS: a
    backfill of many days writes many versions within minutes, while readers and the catalog still use an older one.
    """
    version = version or datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    rows, seen = _counted(df if files is None else df.coalesce(files))
    with shuffles_removed(df.sparkSession):
        (
            rows.write.mode("overwrite")
            .option("compression", COMPRESSION)
            .option("maxRecordsPerFile", RECORDS_PER_FILE)
            .parquet(join(path, f"version={version}"))
        )
    if keep is not None:
        oldest = (datetime.now(timezone.utc) - timedelta(days=KEPT_DAYS)).strftime("%Y%m%dT%H%M%S%f")
        for old in complete_versions(df.sparkSession, path)[max(keep, 1) :]:
            version = old.rpartition("version=")[2]
            if "T" not in version or version < oldest:  # a version that is no time has no age
                remove_dir(df.sparkSession, old)
    return seen.get["rows"]
