"""The day jobs: each reads one day of one dataset, and returns the rows written (0 when there is no input).

Only these functions touch paths; everything they apply is DataFrame in, DataFrame out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.functions.privacy import redact_nested
from reelstat.functions.typing import parse_day, stamp
from reelstat.operators.by_date import type_by_date
from reelstat.operators.events import dedup_events, protect_events, type_events
from reelstat.operators.gold import daily_fact, visitor_sketches
from reelstat.operators.incremental import FAILED, STARTED, SUCCEEDED, advance, days_due, status_row, windows_due
from reelstat.operators.media import flatten_media, media_versions, to_dim_media, upsert_dim
from reelstat.operators.quality import assert_no_pii
from reelstat.operators.quarantine import file_counts, quarantined, sound
from reelstat.operators.reports import today_utc
from reelstat.operators.visitors import dedup_visitors, flatten_visitors, pseudonymise_email
from reelstat.schemas import DELIVERED, FILE_COUNTS, QUARANTINE, SKETCHES, TABLE_DIRS, TABLES
from reelstat.sinks.catalog import publish
from reelstat.sinks.tables import RECORDS_PER_FILE, write_day, write_days, write_replace
from reelstat.sources.bronze import read_bronze
from reelstat.sources.files import join
from reelstat.sources.tables import read_current, read_days, read_file_counts, read_watermarks

# A week of daily runs; a reader that started on an older version has long finished.
VERSIONS_KEPT = 7

# The datasets that are loaded by watermark.
INCREMENTAL = ("events", "media_by_date")


def yesterday_utc() -> date:
    return today_utc() - timedelta(days=1)


def _skip(job: str, day: str | date, where: str) -> int:
    print(f"[{job}] No input found for day={parse_day(day)} at {where}")
    return 0


def _in_order(df: DataFrame, table: str, extra: Iterable[str] = ()) -> DataFrame:
    """The contract's columns in its order, with any further ones before the partition columns."""
    data, partitions = TABLES[table]
    return df.select(*data.names, *extra, *partitions.names)


@contextmanager
def _sound_records(
    spark: SparkSession, job: str, input_uri: str, output_uri: str, dataset: str, day: str | date, extra: Iterable[str] = ()
) -> Iterator[DataFrame | None]:
    """The records of a day, for as long as the block lasts; None, with a message, if there are none.

    The files are read once as far as the parsed day fits into memory; what does not fit is parsed again for each output,
    as a copy of a large day would fill the executors' disks. Lines
    that could not be read whole go to `quarantine/lines` under the silver root as they are, and the counts of every file
    to `quarantine/files`, both by dataset and day, and replaced when the day runs again. Keep that folder as closely as
    bronze: the lines are not redacted.
    """
    raw = read_bronze(spark, input_uri, dataset, [day], extra, lossless=True)
    raw = None if raw is None else raw.persist(StorageLevel.MEMORY_ONLY)
    try:
        if raw is None or raw.isEmpty():
            _skip(job, day, input_uri)
            yield None
        else:
            write_day(file_counts(raw), join(output_uri, FILE_COUNTS, f"dataset={dataset}"), day, media_dirs=False)
            lines, counts = quarantined(raw), read_file_counts(spark, output_uri, dataset, [day])
            if counts.where("broken > 0 OR partial > 0").isEmpty():
                lines = lines.limit(0)
            write_day(lines, join(output_uri, QUARANTINE, f"dataset={dataset}"), day, media_dirs=False)
            yield sound(raw)
    finally:
        if raw is not None:
            raw.unpersist()


def silver_visitors(
    spark: SparkSession,
    input_uri: str,
    output_uri: str,
    day: str | date,
    email_key: str | None = None,
    media_dirs: bool = True,
    ts: datetime | None = None,
) -> int:
    with _sound_records(spark, "silver_visitors", input_uri, output_uri, "visitors", day) as raw:
        if raw is None:
            return 0
        rows = dedup_visitors(flatten_visitors(raw))
        if email_key:
            rows = pseudonymise_email(rows, email_key)
        rows = _in_order(stamp(rows, "ingested_at", ts), "silver_visitors")
        return write_day(rows, join(output_uri, TABLE_DIRS["silver_visitors"]), day, media_dirs)


def silver_media(
    spark: SparkSession,
    input_uri: str,
    output_uri: str,
    day: str | date,
    snapshot: bool = True,
    media_dirs: bool = True,
    ts: datetime | None = None,
) -> int:
    """Write the day's history, then carry its latest versions into the snapshot."""
    with _sound_records(spark, "silver_media", input_uri, output_uri, "media", day) as raw:
        if raw is None:
            return 0
        rows = _in_order(stamp(flatten_media(raw), "ingested_at", ts), "silver_media_history")
        written = write_day(rows, join(output_uri, TABLE_DIRS["silver_media_history"]), day, media_dirs)
    if snapshot:
        # From the Parquet just written, so the JSON is parsed once.
        batch = media_versions(read_days(spark, output_uri, "silver_media_history", [day]))
        current = upsert_dim(read_current(spark, output_uri, "silver_media_snapshot", f"{DELIVERED} date"), batch)
        current = _in_order(current, "silver_media_snapshot", [DELIVERED])
        write_replace(current, join(output_uri, TABLE_DIRS["silver_media_snapshot"]), keep=VERSIONS_KEPT)
    return written


def silver_events(
    spark: SparkSession,
    input_uri: str,
    output_uri: str,
    day: str | date,
    ip_hash_key: str | None = None,
    overlap: int = 1,
    media_dirs: bool = True,
    extra: Iterable[str] = (),
    ts: datetime | None = None,
) -> int:
    """Typed, protected and deduplicated events of one batch day. `extra` names further fields to keep, as text.

    The source is re-read with `overlap` days, so an event may arrive under several batch days. It is kept under
    the one that stored it first: keys in the neighbouring days' tables are left out here.
    """
    extra = list(extra)
    with _sound_records(spark, "silver_events", input_uri, output_uri, "events", day, extra) as raw:
        if raw is None:
            return 0
        this = parse_day(day)
        near = [this + timedelta(days=n) for n in range(-overlap, overlap + 1) if n]
        seen = read_days(spark, output_uri, "silver_events", near)
        rows = protect_events(type_events(raw), ip_hash_key)
        rows = rows.withColumns({name: redact_nested(F.col(name)) for name in extra})
        rows = stamp(dedup_events(rows, seen), "processed_at", ts)
        rows = assert_no_pii(_in_order(rows, "silver_events", extra))
        return write_day(rows, join(output_uri, TABLE_DIRS["silver_events"]), day, media_dirs)


def silver_media_by_date(
    spark: SparkSession,
    input_uri: str,
    output_uri: str,
    day: str | date,
    media_dirs: bool = True,
    ts: datetime | None = None,
) -> int:
    with _sound_records(spark, "silver_media_by_date", input_uri, output_uri, "media_by_date", day) as raw:
        if raw is None:
            return 0
        rows = _in_order(stamp(type_by_date(raw), "processed_at", ts), "silver_media_by_date")
        return write_day(rows, join(output_uri, TABLE_DIRS["silver_media_by_date"]), day, media_dirs)


def gold_dim_media(spark: SparkSession, silver_uri: str, gold_uri: str, ts: datetime | None = None) -> int:
    snapshot = read_current(spark, silver_uri, "silver_media_snapshot")
    rows = 0 if snapshot is None else snapshot.count()  # from the file footers
    if not rows:
        print("[gold_dim_media] Snapshot is empty, nothing to write.")
        return 0
    files = -(-rows // RECORDS_PER_FILE)
    path = join(gold_uri, TABLE_DIRS["gold_dim_media"])
    return write_replace(to_dim_media(snapshot, ts), path, files=files, keep=VERSIONS_KEPT)


def gold_fact_media_daily(
    spark: SparkSession,
    silver_uri: str,
    gold_uri: str,
    days: str | date | Iterable[str | date],
    ts: datetime | None = None,
) -> int:
    """The fact of one day, or of many days in one pass."""
    days = [days] if isinstance(days, (str, date)) else list(days)
    visitors = read_days(spark, silver_uri, "silver_visitors", days)
    if visitors is None or visitors.isEmpty():
        return _skip("gold_fact_media_daily", days[0], silver_uri)
    rows = _in_order(stamp(daily_fact(visitors), "gold_ingested_at", ts), "gold_fact_media_daily")
    return write_days(rows, join(gold_uri, TABLE_DIRS["gold_fact_media_daily"]))


def gold_visitor_sketches(spark: SparkSession, silver_uri: str, gold_uri: str, days: str | date | Iterable[str | date]) -> int:
    """The visitor sketches of one day, or of many days in one pass. A window is answered from the stored sketches of its
    days, so a new day costs that day's visitors only."""
    days = [days] if isinstance(days, (str, date)) else list(days)
    visitors = read_days(spark, silver_uri, "silver_visitors", days)
    if visitors is None or visitors.isEmpty():
        return _skip("gold_visitor_sketches", days[0], silver_uri)
    return write_days(visitor_sketches(visitors), join(gold_uri, SKETCHES))


@dataclass(frozen=True)
class Roots:
    bronze: str
    silver: str
    gold: str
    status: str | None = None
    catalog: str | None = None  # database whose tables and view each run brings up to date


def run_day(
    spark: SparkSession,
    day: str | date | None,
    roots: Roots,
    ip_hash_key: str | None = None,
    media_dirs: bool = True,
    email_key: str | None = None,
    extra: Iterable[str] = (),
) -> dict[str, int]:
    """All steps of one day (default: yesterday, UTC): rows written per step. `extra` names further event fields to keep.
    With a catalog named in `roots`, the last step brings its tables, the day's partitions and the view up to date.

    Each step logs STARTED and then SUCCEEDED or FAILED. A failed step fails the day and is raised.
    """
    day = yesterday_utc() if day is None else parse_day(day)
    steps: dict[str, Callable[[], int]] = {
        "silver_media": lambda: silver_media(spark, roots.bronze, roots.silver, day, media_dirs=media_dirs),
        "silver_visitors": lambda: silver_visitors(
            spark, roots.bronze, roots.silver, day, email_key, media_dirs=media_dirs
        ),
        "silver_events": lambda: silver_events(
            spark, roots.bronze, roots.silver, day, ip_hash_key, media_dirs=media_dirs, extra=extra
        ),
        "silver_media_by_date": lambda: silver_media_by_date(
            spark, roots.bronze, roots.silver, day, media_dirs=media_dirs
        ),
        "gold_dim_media": lambda: gold_dim_media(spark, roots.silver, roots.gold),
        "gold_fact_media_daily": lambda: gold_fact_media_daily(spark, roots.silver, roots.gold, day),
    }

    if roots.catalog:
        steps["catalog"] = lambda: len(publish(spark, roots.catalog, roots.silver, roots.gold, day))

    def log(step: str, status: str) -> None:
        if roots.status:
            status_row(spark, day, step, status).coalesce(1).write.mode("append").parquet(roots.status)

    written = {}
    log("PIPELINE", STARTED)
    for step, run in steps.items():
        log(step, STARTED)
        try:
            written[step] = run()
        except Exception:
            log(step, FAILED)
            log("PIPELINE", FAILED)
            raise
        log(step, SUCCEEDED)
    log("PIPELINE", SUCCEEDED)
    return written


def run_days(
    spark: SparkSession,
    days: Iterable[str | date],
    roots: Roots,
    ip_hash_key: str | None = None,
    media_dirs: bool = True,
    email_key: str | None = None,
    extra: Iterable[str] = (),
) -> dict[date, dict[str, int]]:
    """Rerun or backfill chosen days, oldest first. Running a day again leaves the same content."""
    ordered = sorted(set(map(parse_day, days)))
    extra = list(extra)
    return {day: run_day(spark, day, roots, ip_hash_key, media_dirs, email_key, extra) for day in ordered}


def run_due(
    spark: SparkSession,
    tracked: DataFrame,
    roots: Roots,
    watermarks_uri: str,
    yesterday: str | date | None = None,
    overlap: int = 1,
    first_days: int = 7,
    ts: datetime | None = None,
    **options,
) -> dict[date, dict[str, int]]:
    """Load what the tracked (dataset, media_id) still lack up to yesterday, by the stored watermarks.

    The days of all windows are run whole, as a day is replaced whole, so what lies in the overlap stays the same. Marks
    advance to yesterday once every day has succeeded; a run that fails leaves them, and the next one loads the same days.
    `options` are those of `run_days`.
    """
    end = yesterday_utc() if yesterday is None else parse_day(yesterday)
    marks = read_watermarks(spark, watermarks_uri)
    windows = windows_due(tracked, marks, end, overlap, first_days)
    days = days_due(windows)
    written = run_days(spark, days, roots, **options)
    if days:
        write_replace(advance(marks, windows, ts), watermarks_uri, keep=VERSIONS_KEPT)
    return written
