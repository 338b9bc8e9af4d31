"""What the physical plans must and must not contain."""

from __future__ import annotations

import io
import re
from contextlib import contextmanager, redirect_stdout
from datetime import date
from pathlib import Path

import pytest
from conftest import SMALL, values
from pyspark.sql import functions as F

import __spark_entry__ as registered
from reelstat.plans import registry
from reelstat.operators import events, gold, reports, visitors
from reelstat.sinks.tables import write_day, write_days
from reelstat.sources.tables import read_days

OTHERS = ("events_beside_broken_lines", "events_quarantined", "bronze_file_counts")
THROUGH_FILES = [name for name in registered.queries() if "_through_" in name or name in OTHERS]


def plan(df) -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain()
    return text.getvalue()


@contextmanager
def conf(spark, **settings):
    settings = {key.replace("__", "."): value for key, value in settings.items()}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in THROUGH_FILES])
def test_no_python_and_no_cross_join(spark, name):
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(registered.queries()[name](spark, SMALL))
    assert not re.search(r"EvalPython|InPandas|MapInArrow|CartesianProduct|NestedLoop", text)


@pytest.fixture
def silver(spark, tmp_path):
    rows = [(date(2025, 3, d), f"m{m}", f"v{v}", v, v % 2, None, None) for d in range(1, 13) for m in range(3) for v in range(5)]
    columns = "dt date, media_id string, visitor_key string, load_count bigint, play_count bigint, name string, email string"
    write_days(spark.createDataFrame(rows, columns), str(tmp_path / "visitors"))
    return str(tmp_path)


def test_fact_of_a_window_prunes_days_and_columns(spark, silver):
    text = plan(gold.daily_fact(reports.trailing(read_days(spark, silver, "silver_visitors"), "2025-03-10", 7)))
    pruned = re.search(r"PartitionFilters: \[([^]]*)\]", text).group(1)
    assert "2025-03-03" in pruned and "2025-03-10" in pruned
    assert "ReadSchema: struct<visitor_key:string,load_count:bigint,play_count:bigint,media_id:string>" in text


def test_dedup_and_fact_share_the_shuffle_of_the_visitors(spark, silver):
    df = read_days(spark, silver, "silver_visitors")
    text = plan(gold.daily_fact(visitors.dedup_visitors(df)))
    assert text.count("Exchange hashpartitioning(visitor_key") == 1
    assert text.count("Exchange") == 2


def test_report_shuffles_the_fact_once_after_reducing_it(spark, tmp_path):
    fact = spark.range(100).selectExpr(
        "date'2025-03-10' - int(id % 9) dt", "string(id % 7) media_id", "id loads", "id plays", "id unique_visitors", "0.5D play_rate"
    )
    dim = spark.range(7).selectExpr("string(id) media_id", "'t' title", "'p' project_name")
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(reports.top_by_play_rate(fact, dim, "2025-03-10"))
    assert "TakeOrderedAndProject" in text and text.count("Exchange") == 2


def test_event_dedup_and_overlap_share_the_shuffle_of_the_events(spark):
    df = spark.range(10).selectExpr("string(id) event_key", "timestamp'2025-01-01' received_at", "id n")
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(events.dedup_events(df, df.select("event_key")))
    # One for the events, which also spreads those without a key, and one for either side of the overlap check.
    assert text.count("Exchange hashpartitioning(event_key") == 3 and text.count("Exchange") == 3
    assert plan(events.dedup_events(df)).count("Range (") == 1  # a single scan


def test_joins_follow_the_measured_size(spark):
    """No forced broadcast: above the threshold the dimension is shuffled."""
    fact = spark.range(100).selectExpr("current_date() dt", "string(id) media_id", "id loads")
    dim = spark.range(1000).selectExpr("string(id) media_id", "'t' title", "'p' project_name")
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert "Broadcast" not in plan(reports.with_media(fact, dim))


def test_a_hot_media_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(300_000).selectExpr(
        "date'2025-03-04' dt", "if(id % 3 = 0, 'hot', string(id % 50)) media_id", "sha2(string(id), 256) visitor_key", "id load_count"
    )
    with conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="1MB"):
        assert write_day(rows.repartition(8), str(tmp_path / "visitors"), "2025-03-04") == 300_000
    hot = list(Path(tmp_path).rglob("media_id=hot/*.parquet"))
    assert len(hot) > 1
    assert read_days(spark, str(tmp_path), "silver_visitors").where("media_id = 'hot'").count() == 100_000


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    """A third of all rows under one event_key, a third under none: each task shuffles one row for the hot key."""
    rows = spark.range(0, 90_000, 1, 6).selectExpr(
        "case id % 3 when 0 then 'hot' when 1 then string(id) end event_key",
        "timestamp'2025-01-01' + make_dt_interval(0, 0, 0, id) received_at",
        "id n",
    )
    out = events.dedup_events(rows)
    assert out.count() == 1 + 30_000 + 30_000
    assert values(out.where("event_key = 'hot'"), "n") == [(0,)]
    text = plan(out)
    assert text.index("partial_min") > text.index("Exchange")
    visitors_hot = rows.select(
        F.lit(date(2025, 1, 1)).alias("dt"), F.lit("m").alias("media_id"), F.col("event_key").alias("visitor_key"),
        F.col("n").alias("load_count"), F.col("n").alias("play_count"), F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("email"),
    )
    fact = gold.daily_fact(visitors.dedup_visitors(visitors_hot)).first()
    assert fact.unique_visitors == 30_001
