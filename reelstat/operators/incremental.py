"""What has been loaded, what to load next, and the run-status log."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstat.functions.typing import day_literal, parse_day
from reelstat.operators.keyed import latest_per_key

WATERMARK_SCHEMA = "dataset string, media_id string, last_date date, updated_at timestamp"
STATUS_SCHEMA = "run_date string, data_in_process string, status string, updated_at timestamp"
STARTED, SUCCEEDED, FAILED = "STARTED", "SUCCEEDED", "FAILED"


def watermarks(loaded: DataFrame, dataset: str | None = None) -> DataFrame:
    """Last loaded day per dataset and media. `dataset` names a frame that has no such column."""
    if dataset is not None:
        loaded = loaded.withColumn("dataset", F.lit(dataset))
    return loaded.groupBy("dataset", "media_id").agg(F.max("dt").alias("last_date"))


def next_window(marks: DataFrame, yesterday: str | date, overlap: int = 1) -> DataFrame:
    """The next days to load per watermark: from `overlap` days before the last loaded day to yesterday.

    A mark beyond yesterday gives the overlap days before yesterday, never a window that runs backwards.
    """
    end = day_literal(yesterday)
    return marks.withColumns(
        {"start_date": F.date_sub(F.least("last_date", end), overlap), "end_date": end}
    )


def windows_due(
    tracked: DataFrame, marks: DataFrame, yesterday: str | date, overlap: int = 1, first_days: int = 7
) -> DataFrame:
    """(dataset, media_id, start_date, end_date) for each tracked (dataset, media_id), once.

    Media with a stored mark load on from it, as `next_window` says; media without one start `first_days` days back. Media
    that are no longer tracked have no window and keep their mark. Rows without a dataset or a media_id are left out.
    """
    key = ["dataset", "media_id"]
    end = day_literal(yesterday)
    known = next_window(marks.select(*key, "last_date"), yesterday, overlap).select(*key, "start_date")
    wanted = tracked.select(*key).dropna().distinct().join(known, key, "left")
    start = F.coalesce("start_date", F.date_sub(end, first_days - 1))
    return wanted.select(*key, start.alias("start_date"), end.alias("end_date"))


def days_due(windows: DataFrame) -> list[date]:
    """The days that any window names. All windows end on one day, so one row tells them."""
    first, end = windows.agg(F.min("start_date"), F.max("end_date")).first()
    return [] if first is None else [first + timedelta(days=n) for n in range((end - first).days + 1)]


def advance(marks: DataFrame, windows: DataFrame, ts: datetime | None = None) -> DataFrame:
    """The marks after the windows were loaded. A mark never goes back, whatever order runs are made in."""
    loaded = windows.select(
        "dataset", "media_id", F.col("end_date").alias("last_date"), F.lit(ts or datetime.now(timezone.utc)).alias("updated_at")
    )
    return latest_per_key(marks.unionByName(loaded), ["dataset", "media_id"], ["last_date", "updated_at"])


def run_key(day: str | date) -> str:
    return f"day#{parse_day(day).isoformat()}"


def status_row(spark, day: str | date, step: str, status: str, ts: datetime | None = None) -> DataFrame:
    row = (run_key(day), step, status, ts or datetime.now(timezone.utc))
    names = T.StructType.fromDDL(STATUS_SCHEMA).names
    # Literals, as rows from Python would start a job's workers for each entry.
    return spark.range(0, 1, 1, 1).select(*[F.lit(value).alias(name) for name, value in zip(names, row)])


def log_status(log: DataFrame, day: str | date, step: str, status: str, ts: datetime | None = None) -> DataFrame:
    """The log with one more entry. Entries are only ever added; `latest_status` gives the current state."""
    return log.unionByName(status_row(log.sparkSession, day, step, status, ts))


def latest_status(log: DataFrame) -> DataFrame:
    """The last entry per run and step. At equal times the later state of a step counts, and a failure above success."""
    rank = F.array_position(F.array(F.lit(STARTED), F.lit(SUCCEEDED), F.lit(FAILED)), F.col("status"))
    ranked = log.withColumn("_rank", rank)
    return latest_per_key(ranked, ["run_date", "data_in_process"], ["updated_at", "_rank"]).drop("_rank")
