"""One query per operator over the star-schema test tables. Each runs over the whole tables.

Results carry no processing times; timestamps leave as TIMESTAMP_NTZ (UTC) and ratios rounded to 9 digits.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstat.functions.privacy import drop_pii, hmac_column, redact, redact_json
from reelstat.functions.typing import day_literal, parse_day
from reelstat.operators import by_date, events, gold, incremental, media, profiling, quality, reports, visitors
from reelstat.plans import jobs
from reelstat.schemas import CATALOG_PII, DELIVERED, EVENT_PII
from reelstat.session import shared_dir
from reelstat.sinks.landing import as_json_lines, land_bronze
from reelstat.sinks.catalog import VIEW
from reelstat.sinks.tables import cluster
from reelstat.sources import bronze
from reelstat.sources import star_tables as star
from reelstat.sources.files import join
from reelstat.sources.tables import read_current, read_days, read_file_counts, read_quarantine, read_sketches, read_table, read_watermarks
from reelstat.streaming.events import stream_events

AS_OF = "2024-01-30"
DAY, NEXT_DAY = "2024-01-10", "2024-01-11"
HMAC_KEY = "fixed key of the registered queries"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def tidy(df: DataFrame, *ratios: str) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if field.name in ratios:
            value = F.round(value, 9)
        elif isinstance(field.dataType, T.TimestampType):
            value = value.cast("timestamp_ntz")
        columns.append(value.alias(field.name))
    return df.select(*columns)


def silver_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visitors.dedup_visitors(visitors.flatten_visitors(star.visitors_raw(spark, sf_dir)))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_fact(silver_visitors(spark, sf_dir))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.flatten_media(star.media_raw(spark, sf_dir))


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_snapshot(history(spark, sf_dir))


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = snapshot(spark, sf_dir).withColumn("ingested_at", F.lit(None).cast("timestamp"))
    return media.to_dim_media(stamped).drop("silver_ingested_at", "gold_ingested_at")


def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.type_events(star.events_raw(spark, sf_dir))


# Visitors and the daily fact


@query
def visitors_flatten(spark, sf_dir):
    return visitors.flatten_visitors(star.visitors_raw(spark, sf_dir))


@query
def visitors_dedup(spark, sf_dir):
    return silver_visitors(spark, sf_dir)


@query
def visitors_email_hmac(spark, sf_dir):
    return visitors.pseudonymise_email(silver_visitors(spark, sf_dir), HMAC_KEY)


@query
def fact_media_daily(spark, sf_dir):
    return tidy(fact(spark, sf_dir), "play_rate")


@query
def fact_one_day(spark, sf_dir):
    return tidy(gold.daily_fact(reports.on_day(silver_visitors(spark, sf_dir), DAY)), "play_rate")


@query
def distinct_visitors_window(spark, sf_dir):
    return gold.distinct_visitors(reports.trailing(silver_visitors(spark, sf_dir), AS_OF, 7))


@query
def visitor_spread(spark, sf_dir):
    return tidy(quality.visitor_spread(silver_visitors(spark, sf_dir)), "share")


# Media


@query
def media_flatten(spark, sf_dir):
    return tidy(history(spark, sf_dir), "progress")


@query
def media_snapshot_latest(spark, sf_dir):
    return tidy(snapshot(spark, sf_dir), "progress")


@query
def media_snapshot_upsert(spark, sf_dir):
    rows, current = history(spark, sf_dir), None
    early, late = F.col("dt") < day_literal("1994-01-15"), F.col("dt") >= day_literal("1997-01-15")
    for part in (late, early, ~early & ~late):  # days are not run in their order
        current = media.upsert_dim(current, media.media_versions(rows.where(part)))
    return tidy(current.drop(DELIVERED), "progress")


@query
def dim_media(spark, sf_dir):
    return tidy(dim(spark, sf_dir), "progress")


@query
def catalog_sweep(spark, sf_dir):
    rows = profiling.catalog_sweep(
        snapshot(spark, sf_dir),
        search="RING",
        media_type="ECONOMY",
        sort_by="updated_at",
        descending=True,
        page=2,
        per_page=10,
    )
    return tidy(rows, "progress")


@query
def catalog_summary(spark, sf_dir):
    row = profiling.catalog_summary(snapshot(spark, sf_dir))
    return row.select("count", F.concat_ws("|", "top_titles").alias("top_titles"))


@query
def catalog_redacted(spark, sf_dir):
    owner = F.struct(F.col("visitor_identity.email").alias("email"), F.col("visitor_key").alias("id"))
    raw = star.visitors_raw(spark, sf_dir).select(
        "dt", "media_id", F.struct(owner.alias("owner"), F.array(owner).alias("editors")).alias("project")
    )
    clean = redact(raw, CATALOG_PII, null_too=True)
    return clean.select(
        "dt",
        "media_id",
        F.col("project.owner.email").alias("owner_email"),
        F.col("project.owner.id").alias("owner_id"),
        F.col("project.editors")[0]["email"].alias("editor_email"),
        F.col("project.editors")[0]["id"].alias("editor_id"),
    )


# Reports


@query
def media_perf_view(spark, sf_dir):
    return tidy(reports.media_perf(fact(spark, sf_dir), dim(spark, sf_dir)), "play_rate")


@query
def top_by_play_rate_7d(spark, sf_dir):
    return tidy(reports.top_by_play_rate(fact(spark, sf_dir), dim(spark, sf_dir), AS_OF), "avg_play_rate")


@query
def daily_trend(spark, sf_dir):
    return tidy(reports.daily_trend(fact(spark, sf_dir), "2024-01-08", "2024-01-18"), "play_rate")


@query
def fact_with_range(spark, sf_dir):
    rows = reports.with_range(fact(spark, sf_dir), "2024-01-08", "2024-01-18")
    return tidy(rows.where(F.col("dt").between(F.col("start_dt"), F.col("end_dt"))), "play_rate")


@query
def most_viewed_7d(spark, sf_dir):
    return reports.most_viewed(fact(spark, sf_dir), dim(spark, sf_dir), AS_OF)


@query
def plays_per_visitor_14d(spark, sf_dir):
    rows = reports.plays_per_visitor(fact(spark, sf_dir), dim(spark, sf_dir), AS_OF)
    return tidy(rows, "plays_per_visitor")


@query
def latest_day(spark, sf_dir):
    return reports.latest_day(fact(spark, sf_dir))


@query
def rows_on_day(spark, sf_dir):
    return reports.rows_on_day(fact(spark, sf_dir), DAY)


@query
def rows_per_day(spark, sf_dir):
    return reports.rows_per_day(fact(spark, sf_dir))


@query
def top_media_of_day(spark, sf_dir):
    return tidy(reports.top_media_of_day(fact(spark, sf_dir), DAY), "play_rate")


# Events


@query
def events_typed(spark, sf_dir):
    rows = typed_events(spark, sf_dir)
    columns = ["event_key", "received_at", "at", "event_type", "media_id", "position_s", "percent_viewed", "visitor_key"]
    return tidy(rows.select("dt", *columns), "percent_viewed")


@query
def events_ip_hmac(spark, sf_dir):
    rows = star.events_raw(spark, sf_dir).select("event_key", "received_at", "visitor_key", "ip")
    return hmac_column(rows, "ip", HMAC_KEY, "ip_hmac").drop("ip")


@query
def events_pii_dropped(spark, sf_dir):
    rows = quality.assert_no_pii(drop_pii(star.events_raw(spark, sf_dir)))
    return rows.drop("conversion_data", "position_s", "percent_viewed")


@query
def events_redacted(spark, sf_dir):
    rows = redact(star.events_raw(spark, sf_dir), EVENT_PII)
    return rows.select("event_key", "received_at", "country", "region", *EVENT_PII)


@query
def events_redacted_nulls(spark, sf_dir):
    rows = redact(star.events_raw(spark, sf_dir), EVENT_PII, null_too=True)
    return rows.select("event_key", "received_at", "country", "region", *EVENT_PII)


@query
def events_payload_redacted(spark, sf_dir):
    rows = star.events_raw(spark, sf_dir)
    clean = redact_json(F.col("conversion_data"), EVENT_PII)
    return rows.select("event_key", "received_at", clean.alias("conversion_data"))


@query
def events_dedup(spark, sf_dir):
    rows = events.dedup_events(events.protect_events(typed_events(spark, sf_dir), HMAC_KEY))
    return tidy(rows.drop("conversion_data"), "percent_viewed")


@query
def events_overlap_excluded(spark, sf_dir):
    seen = reports.on_day(typed_events(spark, sf_dir), "2024-01-09")
    rows = events.dedup_events(typed_events(spark, sf_dir), seen)
    return tidy(rows.select("dt", "event_key", "received_at", "media_id"))


@query
def event_key_duplicates(spark, sf_dir):
    return quality.duplicate_event_keys(star.events_raw(spark, sf_dir))


@query
def events_window(spark, sf_dir):
    rows = profiling.filter_events(
        star.events_raw(spark, sf_dir), media_id="7", since="2024-01-05T00:00:00Z", until="2024-01-20T12:00:00Z"
    )
    return rows.select("event_key", "received_at", "media_id", "event_type")


@query
def events_min_percent(spark, sf_dir):
    rows = profiling.filter_events(star.events_raw(spark, sf_dir), min_percent=0.05)
    return rows.select("event_key", "received_at", "event_type")


@query
def top_media_by_events(spark, sf_dir):
    return profiling.top_media(star.events_raw(spark, sf_dir))


@query
def media_id_from_path(spark, sf_dir):
    rows = star.events_raw(spark, sf_dir)
    path = F.concat_ws(
        "/",
        F.lit("file:/bronze/events"),
        F.concat(F.lit("dt="), "dt"),
        F.concat(F.lit("media_id=m%20"), "visitor_key"),
        F.lit("page=0001.jsonl"),
    )
    rows = rows.select("event_key", "received_at", "media_id", path.alias("path"))
    path_first = bronze.with_media_id(rows.withColumn("body_id", F.col("media_id")), "path", F.col("path"))
    both = path_first.withColumns({"path_first": F.col("media_id"), "media_id": F.col("body_id")})
    both = bronze.with_media_id(both, "body", F.col("path"))
    return bronze.with_day(both, path=F.col("path")).select(
        "event_key", "received_at", "dt", "path_first", F.col("media_id").alias("body_first")
    )


# Statistics by date


@query
def by_date_typed(spark, sf_dir):
    return tidy(by_date.type_by_date(star.by_date_raw(spark, sf_dir)), "play_rate", "engagement")


@query
def by_date_reconcile(spark, sf_dir):
    rows = by_date.reconcile(by_date.type_by_date(star.by_date_raw(spark, sf_dir)), fact(spark, sf_dir))
    return tidy(rows, "reported_play_rate", "plays_per_load", "plays_per_visitor", "play_rate")


# Landing, profiles, increments


@query
def landing_summary(spark, sf_dir):
    lines = as_json_lines(star.by_date_raw(spark, sf_dir).drop("play_rate", "engagement"))
    parts = star.table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("media_id"))
    return profiling.with_requested(profiling.landing_summary(lines), parts)


@query
def payload_profile(spark, sf_dir):
    return _flat_profile(profiling.payload_profile(star.event_payloads(spark, sf_dir)))


@query
def payload_profile_sample(spark, sf_dir):
    raw = star.event_payloads(spark, sf_dir)
    return _flat_profile(profiling.payload_profile(raw, sample_size=100, min_percent=0.25))


def _flat_profile(profile: DataFrame) -> DataFrame:
    types = F.transform(F.map_entries("types"), lambda e: F.concat(e["key"], F.lit(":"), e["value"]))
    return profile.select("key", "observed_in", F.array_join(F.array_sort(types), ",").alias("types"), "null_frac")


@query
def payload_examples(spark, sf_dir):
    return profiling.payload_examples(star.event_payloads(spark, sf_dir))


@query
def payload_summary(spark, sf_dir):
    row = profiling.payload_summary(star.event_payloads(spark, sf_dir), min_percent=0.25)
    return row.withColumn("top_keys", F.array_join("top_keys", ","))


@query
def watermark_probe(spark, sf_dir):
    return tidy(profiling.watermark_probe(star.probe_payloads(spark, sf_dir)))


@query
def watermark_probe_by_media(spark, sf_dir):
    return tidy(profiling.watermark_probe(star.probe_payloads(spark, sf_dir), by=["media_id"]))


@query
def watermarks(spark, sf_dir):
    marks = incremental.watermarks(fact(spark, sf_dir), "fact").unionByName(
        incremental.watermarks(star.media_raw(spark, sf_dir), "media")
    )
    return incremental.next_window(marks, "2024-01-29")


@query
def run_status_latest(spark, sf_dir):
    return tidy(incremental.latest_status(star.run_status_raw(spark, sf_dir)))


# By way of files: the whole table landed in bronze as one batch day, through the day's jobs, and read again


def _landed(spark: SparkSession, raw: DataFrame, dataset: str) -> jobs.Roots:
    root = join(shared_dir(spark), f"registered-{uuid.uuid4()}")
    roots = jobs.Roots(*[join(root, name) for name in ("bronze", "silver", "gold")])
    land_bronze(raw, roots.bronze, dataset, DAY)
    return roots


@query
def fact_through_files(spark, sf_dir):
    roots = _landed(spark, star.visitors_raw(spark, sf_dir), "visitors")
    jobs.silver_visitors(spark, roots.bronze, roots.silver, DAY)
    jobs.gold_fact_media_daily(spark, roots.silver, roots.gold, DAY)
    return tidy(read_days(spark, roots.gold, "gold_fact_media_daily", [DAY]).drop("gold_ingested_at"), "play_rate")


@query
def by_date_through_files(spark, sf_dir):
    roots = _landed(spark, star.by_date_raw(spark, sf_dir), "media_by_date")
    jobs.silver_media_by_date(spark, roots.bronze, roots.silver, DAY)
    rows = read_days(spark, roots.silver, "silver_media_by_date", [DAY])
    return tidy(rows.drop("processed_at"), "play_rate", "engagement")


@query
def visitors_by_sketch(spark, sf_dir):
    """Four batch days with shared visitors, each sketched on its own, one of them twice; the window's people from the stored
    sketches alone, held against the exact count. Four standard errors of a sketch of 4,096 buckets are 6.5 %."""
    days = [parse_day(DAY) + timedelta(days=n) for n in range(4)]
    raw = star.visitors_raw(spark, sf_dir)
    raw = raw.withColumn("dt", F.date_add(day_literal(DAY), F.pmod(F.dayofmonth("dt"), F.lit(len(days)))))
    root = join(shared_dir(spark), f"registered-{uuid.uuid4()}")
    roots = jobs.Roots(*[join(root, name) for name in ("bronze", "silver", "gold")])
    land_bronze(raw, roots.bronze, "visitors")
    for day in days:
        jobs.silver_visitors(spark, roots.bronze, roots.silver, day, media_dirs=False)
    for day in (*days, days[0]):
        jobs.gold_visitor_sketches(spark, roots.silver, roots.gold, day)
    merged = gold.merge_sketches(read_sketches(spark, roots.gold, days))
    exact = gold.distinct_visitors(read_days(spark, roots.silver, "silver_visitors", days))
    off = F.abs(F.col("approx_distinct_visitors") - F.col("distinct_visitors"))
    within = (off <= F.ceil(F.col("distinct_visitors") * 0.065)).alias("within_four_errors")
    return exact.join(merged, "media_id", "left").select("media_id", "distinct_visitors", within)


_EVENT_COLUMNS = ["dt", "event_key", "received_at", "at", "event_type", "media_id", "position_s", "percent_viewed"]
_EVENT_COLUMNS += ["country", "region", "visitor_key", "ip_hmac", "conversion_data"]


@query
def events_through_files(spark, sf_dir):
    roots = _landed(spark, star.events_raw(spark, sf_dir), "events")
    jobs.silver_events(spark, roots.bronze, roots.silver, DAY, HMAC_KEY)
    return tidy(read_days(spark, roots.silver, "silver_events", [DAY]).select(*_EVENT_COLUMNS), "percent_viewed")


@query
def events_through_stream(spark, sf_dir):
    roots = _landed(spark, star.events_raw(spark, sf_dir), "events")
    stream_events(spark, roots.bronze, roots.silver, join(roots.bronze, "_checkpoint"), HMAC_KEY).awaitTermination()
    return tidy(read_days(spark, roots.silver, "silver_events", [DAY]).select(*_EVENT_COLUMNS), "percent_viewed")


@query
def dim_through_files(spark, sf_dir):
    """Two batch days through the media jobs, the later one first."""
    raw = star.media_raw(spark, sf_dir)
    early = F.col("dt") < day_literal("1995-06-15")
    raw = raw.withColumn("dt", F.when(early, day_literal(DAY)).otherwise(day_literal(NEXT_DAY)))
    root = join(shared_dir(spark), f"registered-{uuid.uuid4()}")
    roots = jobs.Roots(*[join(root, name) for name in ("bronze", "silver", "gold")])
    land_bronze(raw, roots.bronze, "media", media_dirs=False, compression="gzip")
    for day in (NEXT_DAY, DAY):
        jobs.silver_media(spark, roots.bronze, roots.silver, day, media_dirs=False)
    jobs.gold_dim_media(spark, roots.silver, roots.gold)
    return tidy(read_current(spark, roots.gold, "gold_dim_media").drop("silver_ingested_at", "gold_ingested_at"), "progress")


@query
def media_perf_through_catalog(spark, sf_dir):
    """Two batch days run whole, the later one first; datasets that never came are no-ops. The view is read by name."""
    root = join(shared_dir(spark), f"registered-{uuid.uuid4()}")
    names = [join(root, name) for name in ("bronze", "silver", "gold", "status")]
    roots = jobs.Roots(*names, catalog=f"registered_{uuid.uuid4().hex}")
    for dataset, raw, until in (
        ("visitors", star.visitors_raw(spark, sf_dir), "2024-01-15"),
        ("media", star.media_raw(spark, sf_dir), "1995-06-15"),
    ):
        early = F.col("dt") < day_literal(until)
        raw = raw.withColumn("dt", F.when(early, day_literal(DAY)).otherwise(day_literal(NEXT_DAY)))
        land_bronze(raw, roots.bronze, dataset, media_dirs=False, compression="gzip")
    for day in (NEXT_DAY, DAY):
        jobs.run_day(spark, day, roots, media_dirs=False)
    return tidy(read_table(spark, roots.catalog, VIEW), "play_rate")


@query
def loaded_by_watermark(spark, sf_dir):
    """Three runs of one day more each, a day of overlap: a third of the media is given up after the second run, another
    third is tracked from the third run on."""
    days = F.date_add(day_literal(DAY), F.pmod(F.dayofmonth("dt"), F.lit(4)))
    raw = star.visitors_raw(spark, sf_dir).withColumn("dt", days)
    root = join(shared_dir(spark), f"registered-{uuid.uuid4()}")
    roots = jobs.Roots(*[join(root, name) for name in ("bronze", "silver", "gold")])
    land_bronze(raw, roots.bronze, "visitors")
    media = raw.select(F.lit("visitors").alias("dataset"), "media_id").distinct()
    third = F.ascii(F.right("media_id", F.lit(1))) % 3
    marks = join(root, "watermarks")
    for run, groups in enumerate([(0, 1), (0, 1), (1, 2)]):
        day, ts = parse_day(DAY) + timedelta(days=run), datetime(2024, 2, 1 + run, tzinfo=timezone.utc)
        tracked = media.where(third.isin(*groups))
        jobs.run_due(spark, tracked, roots, marks, day, first_days=1, ts=ts, media_dirs=False)
    stored = read_days(spark, roots.silver, "silver_visitors")
    counts = stored.groupBy("media_id").agg(F.countDistinct("dt").alias("days"), F.count("*").alias("visitors"))
    return read_watermarks(spark, marks).join(counts, "media_id", "left")


def _with_broken_lines(spark: SparkSession, sf_dir: str) -> jobs.Roots:
    root = join(shared_dir(spark), f"registered-{uuid.uuid4()}")
    roots = jobs.Roots(*[join(root, name) for name in ("bronze", "silver", "gold")])
    lines = star.event_lines(spark, sf_dir).withColumn("dt", day_literal(DAY))
    cluster(lines, "dt", "media_id").write.partitionBy("dt", "media_id").text(join(roots.bronze, "events"))
    jobs.silver_events(spark, roots.bronze, roots.silver, DAY)
    return roots


@query
def events_beside_broken_lines(spark, sf_dir):
    roots = _with_broken_lines(spark, sf_dir)
    rows = read_days(spark, roots.silver, "silver_events", [DAY])
    return tidy(rows.select("event_key", "received_at", "event_type", "media_id"))


@query
def events_quarantined(spark, sf_dir):
    roots = _with_broken_lines(spark, sf_dir)
    return read_quarantine(spark, roots.silver, "events", [DAY]).select("dt", "media_id", "kind", "text")


@query
def bronze_file_counts(spark, sf_dir):
    roots = _with_broken_lines(spark, sf_dir)
    files = read_file_counts(spark, roots.silver, "events", [DAY])
    media = bronze.path_value(F.col("source_file"), "media_id").alias("media_id")
    sums = [F.sum(name).alias(name) for name in ("records", "broken", "partial")]
    return files.groupBy("dt", media).agg(*sums)
