"""Command lines of the jobs, for spark-submit. Arguments a scheduler adds of its own are ignored."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from reelstat.plans import jobs
from reelstat.session import session


def _arguments(name: str, argv: Sequence[str] | None, *required: str, **options: dict) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog=name)
    for flag in required:
        parser.add_argument(flag, required=True)
    for flag, settings in options.items():
        parser.add_argument("--" + flag.replace("_", "-"), **settings)
    args, unknown = parser.parse_known_args(argv)
    if unknown:
        # Only the names: a value may be a secret.
        print(f"[{name}] Ignoring unknown arguments: {[u.split('=')[0] for u in unknown if u.startswith('-')]}")
    return args


_SILVER = ("--input-uri", "--output-uri", "--day")
_GOLD = ("--silver-uri", "--gold-uri", "--day")
_ONE_LEVEL = {"flat_days": {"action": "store_true", "help": "keep media_id as a column, not one directory per media"}}


_EXTRA = {"extra_fields": {"default": "", "help": "further event fields to keep, comma-separated"}}


def _names(text: str) -> list[str]:
    return [name.strip() for name in text.split(",") if name.strip()]


def silver_visitors(argv: Sequence[str] | None = None) -> int:
    args = _arguments("silver_visitors", argv, *_SILVER, email_hash_key={}, **_ONE_LEVEL)
    spark = session("silver-visitors")
    return jobs.silver_visitors(
        spark, args.input_uri, args.output_uri, args.day, args.email_hash_key, media_dirs=not args.flat_days
    )


def silver_media(argv: Sequence[str] | None = None) -> int:
    skip = {"action": "store_true", "help": "leave the snapshot as it is"}
    args = _arguments("silver_media", argv, *_SILVER, no_snapshot=skip, **_ONE_LEVEL)
    spark = session("silver-media")
    return jobs.silver_media(spark, args.input_uri, args.output_uri, args.day, not args.no_snapshot, not args.flat_days)


def silver_events(argv: Sequence[str] | None = None) -> int:
    args = _arguments("silver_events", argv, *_SILVER, ip_hash_key={}, **_EXTRA, **_ONE_LEVEL)
    spark = session("silver-events")
    where = (args.input_uri, args.output_uri, args.day, args.ip_hash_key)
    return jobs.silver_events(spark, *where, media_dirs=not args.flat_days, extra=_names(args.extra_fields))


def silver_media_by_date(argv: Sequence[str] | None = None) -> int:
    args = _arguments("silver_media_by_date", argv, *_SILVER, **_ONE_LEVEL)
    spark = session("silver-media-by-date")
    return jobs.silver_media_by_date(spark, args.input_uri, args.output_uri, args.day, not args.flat_days)


def gold_dim_media(argv: Sequence[str] | None = None) -> int:
    args = _arguments("gold_dim_media", argv, *_GOLD)
    return jobs.gold_dim_media(session("gold-dim-media"), args.silver_uri, args.gold_uri)


def gold_fact_media_daily(argv: Sequence[str] | None = None) -> int:
    args = _arguments("gold_fact_media_daily", argv, *_GOLD)
    return jobs.gold_fact_media_daily(session("gold-fact-media-daily"), args.silver_uri, args.gold_uri, args.day)


def gold_visitor_sketches(argv: Sequence[str] | None = None) -> int:
    args = _arguments("gold_visitor_sketches", argv, *_GOLD)
    return jobs.gold_visitor_sketches(session("gold-visitor-sketches"), args.silver_uri, args.gold_uri, args.day)


def run_days(argv: Sequence[str] | None = None) -> dict:
    """All steps of the days of `--day` (comma-separated; default: yesterday, UTC).

    With `--watermarks-uri` and `--media` (comma-separated) the days are those that the stored watermarks of these media
    name, up to `--day` or yesterday.
    """
    args = _arguments(
        "run_days",
        argv,
        "--bronze-uri",
        "--silver-uri",
        "--gold-uri",
        status_uri={},
        catalog_db={},
        watermarks_uri={},
        media={"default": ""},
        day={},
        ip_hash_key={},
        email_hash_key={},
        **_EXTRA,
        **_ONE_LEVEL,
    )
    roots = jobs.Roots(args.bronze_uri, args.silver_uri, args.gold_uri, args.status_uri, args.catalog_db)
    options = {"ip_hash_key": args.ip_hash_key, "media_dirs": not args.flat_days, "email_key": args.email_hash_key}
    options["extra"] = _names(args.extra_fields)
    spark = session("media-days")
    if args.watermarks_uri:
        media = [(dataset, name) for dataset in jobs.INCREMENTAL for name in _names(args.media)]
        tracked = spark.createDataFrame(media, "dataset string, media_id string")
        return jobs.run_due(spark, tracked, roots, args.watermarks_uri, args.day, **options)
    days = args.day.split(",") if args.day else [jobs.yesterday_utc()]
    return jobs.run_days(spark, days, roots, **options)
