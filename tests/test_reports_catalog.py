"""The reports over catalog tables, against rows worked out by hand."""

from __future__ import annotations

from datetime import date

import pytest

from reelstat.operators import reports
from reelstat.sinks.catalog import create_tables, create_views, repair
from reelstat.sinks.tables import write_days, write_replace
from reelstat.sources.tables import read_table

DB = "reports_test"
FACT = [  # dt, media_id, loads, plays, unique_visitors
    ("2024-03-10", "a", 10, 5, 4),
    ("2024-03-10", "b", 4, 4, 2),
    ("2024-03-03", "a", 10, 1, 1),  # first day of the trailing window of 2024-03-10
    ("2024-03-02", "b", 100, 0, 9),  # the day before it
    ("2024-03-09", "c", 0, 3, 0),  # plays without loads or visitors; not in the dimension
]


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("gold"))
    rows = [(date.fromisoformat(d), m, n, p, v, p / n if n else 0.0) for d, m, n, p, v in FACT]
    schema = "dt date, media_id string, loads bigint, plays bigint, unique_visitors bigint, play_rate double"
    create_tables(spark, DB, root, root)
    for table, df, write in (
        ("gold_fact_media_daily", spark.createDataFrame(rows, schema), write_days),
        ("gold_dim_media", spark.createDataFrame([("a", "A", "P"), ("b", "B", None)], "media_id string, title string, project_name string"), write_replace),
    ):
        full = spark.table(f"{DB}.{table}").schema
        missing = {f.name: f.dataType for f in full.fields if f.name not in df.columns}
        from pyspark.sql import functions as F

        df = df.withColumns({name: F.lit(None).cast(kind) for name, kind in missing.items()}).select(*full.names)
        write(df, f"{root}/{'fact_media_daily' if 'fact' in table else 'dim_media'}")
        repair(spark, DB, table, root, root)
    create_views(spark, DB)
    yield read_table(spark, DB, "gold_fact_media_daily"), read_table(spark, DB, "gold_dim_media")
    spark.sql(f"DROP DATABASE {DB} CASCADE")


def test_best_videos_need_loads(gold):
    got = [(r.media_id, r.title, r.avg_play_rate, r.total_plays) for r in reports.top_by_play_rate(*gold, "2024-03-10").collect()]
    assert got == [("b", "B", 1.0, 4), ("a", "A", pytest.approx(0.3), 6)]


def test_most_viewed_keeps_media_without_a_title(gold):
    got = [(r.media_id, r.title, r.total_plays, r.total_unique_visitors) for r in reports.most_viewed(*gold, "2024-03-10").collect()]
    assert got == [("a", "A", 6, 5), ("b", "B", 4, 2), ("c", None, 3, 0)]


def test_plays_per_visitor_of_two_weeks(gold):
    got = [(r.media_id, r.plays_per_visitor) for r in reports.plays_per_visitor(*gold, "2024-03-10").collect()]
    assert got == [("a", pytest.approx(6 / 5)), ("b", pytest.approx(4 / 11)), ("c", 0.0)]


def test_trend_and_days(gold):
    fact, _ = gold
    got = [(str(r.dt), r.plays, r.loads, r.play_rate) for r in reports.daily_trend(fact, "2024-03-03", "2024-03-10").collect()]
    assert got == [("2024-03-03", 1, 10, 0.1), ("2024-03-09", 3, 0, 0.0), ("2024-03-10", 9, 14, pytest.approx(9 / 14))]
    assert str(reports.latest_day(fact).first().latest_dt) == "2024-03-10"
    assert [r.rows for r in reports.rows_per_day(fact).collect()] == [2, 1, 1, 1]
    assert [r.media_id for r in reports.top_media_of_day(fact, "2024-03-10").collect()] == ["b", "a"]


def test_view_has_every_fact_row(spark, gold):
    rows = {(str(r.dt), r.media_id): r.title for r in spark.table(f"{DB}.vw_media_perf").collect()}
    assert len(rows) == 5 and rows["2024-03-09", "c"] is None and rows["2024-03-02", "b"] == "B"
