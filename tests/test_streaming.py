from __future__ import annotations

from conftest import values

from reelstat.operators.quality import duplicate_event_keys, pii_columns
from reelstat.sources.tables import read_days
from reelstat.streaming.events import append_new, read_event_stream, stream_events

DAY, NEXT, OLD = "2025-03-04", "2025-03-05", "2025-01-01"


def event(key, **extra):
    return {"event_key": key, "received_at": f"{DAY}T10:00:00Z", "ip": "10.0.0.1", **extra}


def run(spark, roots, tmp_path, **options):
    query = stream_events(spark, roots.bronze, roots.silver, str(tmp_path / "checkpoint"), "key", **options)
    query.awaitTermination()
    return values(read_days(spark, roots.silver, "silver_events"), "dt", "event_key")


def keys(rows):
    return sorted((k for _, k in rows), key=repr)


def test_runs_take_new_files_and_leave_out_known_events(spark, roots, land, tmp_path):
    land("events", DAY, "m1", [event("a"), event("b"), event("a")])
    assert keys(run(spark, roots, tmp_path)) == ["a", "b"]
    assert keys(run(spark, roots, tmp_path)) == ["a", "b"]
    land("events", NEXT, "m1", [event("b"), event("c")])
    assert keys(run(spark, roots, tmp_path)) == ["a", "b", "c"]
    stored = spark.read.parquet(f"{roots.silver}/events")
    assert not pii_columns(stored.schema) and stored.where("length(ip_hmac) = 64").count() == 3


def test_an_old_day_is_not_too_late(spark, roots, land, tmp_path):
    land("events", NEXT, "m1", [event("a")])
    run(spark, roots, tmp_path)
    land("events", OLD, "m1", [event("old")])
    assert keys(run(spark, roots, tmp_path)) == ["a", "old"]


def test_many_small_batches_equal_one(spark, roots, land, tmp_path):
    for n in range(5):
        land("events", DAY, "m1", [event(f"k{n}"), event(f"k{n + 1}")], f"page={n:04d}.jsonl")
    rows = run(spark, roots, tmp_path, max_files=1)
    assert keys(rows) == [f"k{n}" for n in range(6)]


def test_a_batch_that_runs_again_adds_nothing(spark, roots, land, tmp_path):
    land("events", DAY, "m1", [event("a"), {"event_type": "play"}, {"event_type": "play"}])
    path = f"{roots.silver}/events"
    schema = read_event_stream(spark, roots.bronze).schema
    batch = spark.read.schema(schema).json(f"{roots.bronze}/events/dt={DAY}/media_id=m1/page=0001.jsonl")
    from pyspark.sql import functions as F

    batch = batch.withColumns({"source_file": F.lit("page-1"), "dt": F.lit(DAY).cast("date"), "media_id": F.lit("m1")})
    for _ in range(2):
        append_new(batch, path, "key")
        stored = spark.read.parquet(path)
        assert stored.count() == 3 and duplicate_event_keys(stored).isEmpty()
    append_new(batch.withColumn("source_file", F.lit("page-2")), path, "key")
    assert spark.read.parquet(path).where("event_key IS NULL").count() == 4
