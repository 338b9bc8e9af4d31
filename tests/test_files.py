from __future__ import annotations

import gzip
import json
import time
from datetime import date, datetime
from pathlib import Path

import pytest
from conftest import values
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from reelstat.operators.reports import top_by_play_rate
from reelstat.operators.visitors import flatten_visitors
from reelstat.plans import jobs, registry
from reelstat.sinks import landing
from reelstat.sinks.catalog import create_tables, create_views, repair
from reelstat.sinks.landing import land_bronze
from reelstat.sinks.tables import write_day, write_days, write_replace
from reelstat.sources.bronze import path_value, read_bronze
from reelstat.sources.files import complete_versions, read_or_none
from reelstat.sources.tables import current_version, read_current, read_days, read_table

DAY = "2025-03-04"


def test_media_id_of_the_path_stays_text_and_wins_for_visitors(spark, roots, land):
    land("visitors", DAY, "0123", [{"visitor_key": "v", "media_id": "other", "load_count": 1}])
    df = read_bronze(spark, roots.bronze, "visitors", [DAY])
    assert values(df, "media_id", "dt", "visitor_key") == [("0123", date(2025, 3, 4), "v")]


def test_media_id_of_the_body_wins_for_events(spark, roots, land):
    land("events", DAY, "0123", [{"event_key": "a", "media_id": "own"}, {"event_key": "b"}])
    df = read_bronze(spark, roots.bronze, "events", [DAY])
    assert values(df, "event_key", "media_id", "dt") == [("a", "own", date(2025, 3, 4)), ("b", "0123", date(2025, 3, 4))]


@pytest.mark.parametrize("media_id", ["plain", "with space", "a+b", "50%", "a:b", "ü"])
def test_media_id_survives_the_file_system(spark, roots, media_id):
    rows = spark.createDataFrame([(media_id, "k")], "media_id string, event_key string")
    land_bronze(rows, roots.bronze, "visitors", DAY)
    land_bronze(rows.select("media_id", "event_key"), roots.bronze, "events", DAY)
    assert values(read_bronze(spark, roots.bronze, "visitors", [DAY]), "media_id") == [(media_id,)]
    path = F.col("_metadata.file_path")
    lines = spark.read.option("recursiveFileLookup", "true").text(f"{roots.bronze}/events/dt={DAY}")
    assert values(lines.select(path_value(path, "media_id").alias("m")), "m") == [(media_id,)]


def test_only_asked_days_are_read(spark, roots, land):
    for n in (3, 4, 5):
        land("media_by_date", f"2025-03-0{n}", "m", [{"date": f"2025-03-0{n}", "load_count": n}])
    df = read_bronze(spark, roots.bronze, "media_by_date", ["2025-03-04", "2025-03-05", "2025-03-09"])
    assert values(df, "load_count") == [("4",), ("5",)]
    assert len(df.inputFiles()) == 2
    assert read_bronze(spark, roots.bronze, "media_by_date").count() == 3


def test_missing_days_give_none_and_zero_byte_files_no_rows(spark, roots, land):
    assert read_bronze(spark, roots.bronze, "events", [DAY]) is None
    land("media_by_date", DAY, "m", [])
    assert read_bronze(spark, roots.bronze, "media_by_date", [DAY]).isEmpty()


def test_only_a_missing_path_is_forgiven(spark, tmp_path):
    assert read_or_none(lambda: spark.read.parquet(str(tmp_path / "none"))) is None
    with pytest.raises(AnalysisException):
        read_or_none(lambda: spark.range(1).select("no_such_column"))


def test_identity_null_in_every_row(spark, roots, land):
    land("visitors", DAY, "m", [{"visitor_key": "v", "visitor_identity": None}])
    df = flatten_visitors(read_bronze(spark, roots.bronze, "visitors", [DAY]))
    assert values(df, "name", "email", "load_count") == [(None, None, 0)]


def visitors(spark, *rows):
    columns = "dt date, media_id string, visitor_key string, load_count bigint"
    return spark.createDataFrame([(date.fromisoformat(d), m, v, n) for d, m, v, n in rows], columns)


@pytest.mark.parametrize("media_dirs", [True, False])
def test_day_rerun_leaves_no_stale_rows(spark, tmp_path, media_dirs):
    root = str(tmp_path)
    path = f"{root}/visitors"
    first = visitors(spark, ("2025-03-04", "a", "v", 1), ("2025-03-04", "b", "v", 2))
    assert write_day(first, path, "2025-03-04", media_dirs) == 2
    assert write_day(visitors(spark, ("2025-03-05", "b", "v", 3)), path, "2025-03-05", media_dirs) == 1
    for _ in range(2):
        write_day(visitors(spark, ("2025-03-04", "a", "v", 9)), path, "2025-03-04", media_dirs)
        kept = values(read_days(spark, root, "silver_visitors"), "dt", "media_id", "load_count")
        assert kept == [(date(2025, 3, 4), "a", 9), (date(2025, 3, 5), "b", 3)]


@pytest.mark.parametrize("media_dirs", [True, False])
def test_a_failed_write_leaves_the_day_as_it_was(spark, tmp_path, media_dirs):
    path = str(tmp_path / "visitors")
    rows = visitors(spark, ("2025-03-04", "a", "v", 1))
    write_day(rows, path, "2025-03-04", media_dirs)
    with pytest.raises(Exception, match="broken"):
        write_day(rows.withColumn("load_count", F.raise_error(F.lit("broken"))), path, "2025-03-04", media_dirs)
    assert values(read_days(spark, str(tmp_path), "silver_visitors"), "media_id", "load_count") == [("a", 1)]
    assert sorted(p.name for p in Path(path).iterdir()) == ["dt=2025-03-04"]


def test_read_days_lists_only_its_days(spark, tmp_path):
    root = str(tmp_path)
    for n in (3, 4):
        write_day(visitors(spark, (f"2025-03-0{n}", "007", "v", n)), f"{root}/visitors", f"2025-03-0{n}")
    df = read_days(spark, root, "silver_visitors", ["2025-03-04"])
    assert values(df, "dt", "media_id", "load_count") == [(date(2025, 3, 4), "007", 4)]
    assert len(df.inputFiles()) == 1
    assert read_days(spark, root, "silver_visitors", ["2025-04-01"]) is None


def test_write_days_replaces_only_the_days_present(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_days(visitors(spark, ("2025-03-03", "a", "v", 1), ("2025-03-04", "a", "v", 1), ("2025-03-04", "b", "v", 1)), path)
    write_days(visitors(spark, ("2025-03-04", "a", "v", 7)), path)
    assert values(spark.read.parquet(path), "media_id", "load_count") == [("a", 1), ("a", 7)]


def test_write_replace_may_read_what_it_replaces(spark, tmp_path):
    path = f"{tmp_path}/media_snapshot"
    columns = "media_id string, name string"
    write_replace(spark.createDataFrame([("a", "one")], columns), path)
    before = read_current(spark, str(tmp_path), "silver_media_snapshot").select("media_id", "name")
    write_replace(before.unionByName(spark.createDataFrame([("b", "two")], columns)), path)
    assert values(read_current(spark, str(tmp_path), "silver_media_snapshot"), "media_id", "name") == [("a", "one"), ("b", "two")]


def test_unfinished_version_is_not_read(spark, tmp_path):
    path = tmp_path / "media_snapshot"
    write_replace(spark.createDataFrame([("a", "one")], "media_id string, name string"), str(path), "1")
    (path / "version=2").mkdir()
    assert current_version(spark, str(path)).endswith("version=1")
    (path / "version=1" / "_SUCCESS").unlink()
    assert read_current(spark, str(tmp_path), "silver_media_snapshot") is None


def test_old_versions_go_only_when_a_newer_one_is_complete(spark, tmp_path):
    df = spark.createDataFrame([("a", "one")], "media_id string, name string")
    for n in range(1, 5):
        write_replace(df, str(tmp_path), str(n), keep=2)
    (tmp_path / "version=9").mkdir()
    with pytest.raises(Exception, match="broken"):
        write_replace(df.select(F.raise_error(F.lit("broken")).alias("name")), str(tmp_path), "5", keep=1)
    assert [v[-9:] for v in complete_versions(spark, str(tmp_path))] == ["version=4", "version=3"]


def test_a_flat_table_is_read_too(spark, tmp_path):
    spark.createDataFrame([("a",)], "media_id string").write.parquet(f"{tmp_path}/media_snapshot")
    assert values(read_current(spark, str(tmp_path), "silver_media_snapshot"), "media_id", "name") == [("a", None)]


def test_landing_keeps_nulls_and_reports_silent_media(spark, roots):
    rows = spark.createDataFrame([("m1", "Zoë", None), ("m1", "b", 2)], "media_id string, name string, n int")
    summary = land_bronze(rows, roots.bronze, "media", DAY, ["m1", "m2"])
    lines = [line for f in Path(roots.bronze).rglob("part-*") for line in f.read_text("utf-8").splitlines()]
    assert sorted(lines) == ['{"media_id":"m1","name":"Zoë","n":null}', '{"media_id":"m1","name":"b","n":2}']
    assert values(summary, "media_id", "rows", "bytes") == [("m1", 2, sum(len(x.encode()) for x in lines)), ("m2", 0, 0)]


def test_landing_in_pages(spark, roots):
    rows = spark.range(0, 25, 1, 1).selectExpr("'m' media_id", "id")
    land_bronze(rows, roots.bronze, "events", DAY, page_rows=10)
    assert len(list(Path(roots.bronze).rglob("part-*"))) == 3
    assert read_bronze(spark, roots.bronze, "events", [DAY]).count() == 25


def test_landing_again_replaces_the_media_day(spark, roots):
    rows = spark.createDataFrame([("a", 1), ("b", 1)], "media_id string, load_count int")
    land_bronze(rows, roots.bronze, "visitors", DAY)
    names = {f.name for f in Path(roots.bronze).rglob("part-*")}
    land_bronze(rows.where("media_id = 'a'"), roots.bronze, "visitors", DAY)
    assert values(read_bronze(spark, roots.bronze, "visitors", [DAY]), "media_id") == [("a",), ("b",)]
    assert {f.name for f in Path(roots.bronze).rglob("part-*")} != names
    assert json.loads(next(Path(roots.bronze).rglob("part-*")).read_text())["media_id"] in "ab"


def test_landing_many_media_in_files_of_many(spark, roots, tmp_path):
    ids = [None, "", "0123", *[f"m {n}" for n in range(60)]]
    rows = spark.createDataFrame([(m, f"k{n}", str(n)) for n, m in enumerate(ids)], "media_id string, event_key string, load_count string")
    for dataset in ("visitors", "media", "media_by_date", "events"):
        read = []
        for media_dirs in (True, False):
            root = str(tmp_path / f"{dataset}-{media_dirs}")
            assert land_bronze(rows, root, dataset, DAY, media_dirs=media_dirs).count() == len(ids)
            df = read_bronze(spark, root, dataset, [DAY])
            read.append(values(df, *sorted(df.columns)))
        assert read[0] == read[1] and len(read[1]) == len(ids)
        assert len(list(Path(root).rglob("part-*"))) <= 4  # a shuffle partition's records are one file
    land_bronze(rows.where("media_id = '0123'"), root, "events", DAY, media_dirs=False)
    assert values(read_bronze(spark, root, "events", [DAY]), "media_id") == [("0123",)]  # the day as a whole is replaced


@pytest.fixture
def star(spark, tmp_path):
    """Tables of the registered queries: 40 media of two days each, three visitors."""
    day = lambda text: datetime.fromisoformat(text)
    parts = [(n, f"name {n}", "Brand#1", "TYPE", n) for n in range(40)]
    lines = [(n, n, 1, 0.1, "R", "O", day(d)) for n in range(40) for d in ("1995-01-02", "1996-01-02")]
    events = [(n, day(f"2024-01-{10 + n % 9}"), n % 3, "view", 4.0, f'{{"k": {n % 40}}}') for n in range(80)]
    for name, made, schema in (
        ("part", parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        ("lineitem", lines, "l_orderkey long, l_partkey long, l_linenumber int, l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        ("events", events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
        ("customer", [(0, "a", "X"), (1, "b", "Y")], "c_custkey long, c_name string, c_mktsegment string"),
    ):
        spark.createDataFrame(made, schema).write.parquet(f"{tmp_path}/star/{name}.parquet")
    return f"{tmp_path}/star"


@pytest.mark.parametrize("name, rows", [("dim_through_files", 40), ("media_perf_through_catalog", 75)])
def test_through_files_lands_few_files_however_many_media(spark, star, tmp_path, monkeypatch, name, rows):
    monkeypatch.setattr(registry, "shared_dir", lambda _: str(tmp_path))
    df = registry.QUERIES[name](spark, star)
    assert df.count() == rows and df.where("title = concat('name ', media_id)").count() == rows
    for dataset in tmp_path.glob("registered-*/bronze/*"):
        assert len(list(dataset.rglob("part-*"))) <= 8  # two days of four shuffle partitions, not a file for each media


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {str(files.apply(n).getName()) for n in range(files.size()) if files.apply(n).getName().startswith("shuffle_")}


def _left_beyond(spark, before, seconds=20):
    """The shuffle files that are still there beside those of before; Spark removes them in the background."""
    until = time.monotonic() + seconds
    while (left := _shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)
    return left


def test_written_tables_leave_no_shuffle_files(spark, roots, tmp_path):
    before, conf = _shuffle_files(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept = spark.conf.get(conf)
    rows = spark.range(0, 1000, 1, 4).selectExpr(f"DATE'{DAY}' dt", "cast(id % 7 as string) media_id", "id load_count")
    sums = rows.groupBy("dt", "media_id").agg(F.sum("load_count").alias("load_count"))
    land_bronze(sums, roots.bronze, "visitors")
    write_day(sums, str(tmp_path / "day"), DAY)
    write_days(sums, str(tmp_path / "days"))
    write_replace(sums, str(tmp_path / "whole"))
    assert not _left_beyond(spark, before)
    assert spark.conf.get(conf) == kept
    assert sums.count() == 7 and sums.agg(F.sum("load_count")).first()[0] == 499_500  # the frame can be used again


def test_landing_compressed_in_files_one_task_can_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "PAGE_ROWS", 10)
    ids = [None, "", "0123", "Zoë", *[f"m {n}" for n in range(60)]]
    rows = spark.createDataFrame([(m, f"k{n}", str(n)) for n, m in enumerate(ids)], "media_id string, event_key string, load_count string")
    for dataset in ("visitors", "media", "media_by_date", "events"):
        read = []
        for media_dirs, compression in ((True, "none"), (True, "gzip"), (False, "gzip")):
            root = str(tmp_path / f"{dataset}-{media_dirs}-{compression}")
            assert land_bronze(rows, root, dataset, DAY, media_dirs=media_dirs, compression=compression).count() == len(ids)
            df = read_bronze(spark, root, dataset, [DAY])
            read.append(values(df, *sorted(df.columns)))
        assert read[0] == read[1] == read[2] and len(read[2]) == len(ids)
        pages = [gzip.decompress(f.read_bytes()).splitlines() for f in Path(root).rglob("part-*.gz")]
        assert sum(map(len, pages)) == len(ids) and max(map(len, pages)) <= 10
        for page in pages:
            media = [json.loads(line)["media_id"] or "" for line in page]
            assert media == sorted(media)


@pytest.mark.parametrize("name", ["media_perf_through_catalog", "dim_through_files"])
def test_through_files_keeps_no_second_copy_of_the_records(spark, star, tmp_path, monkeypatch, name):
    monkeypatch.setattr(registry, "shared_dir", lambda _: str(tmp_path))
    levels, write = [], jobs.write_day
    held = lambda: [str(r.getStorageLevel().description()) for r in spark.sparkContext._jsc.getPersistentRDDs().values()]
    monkeypatch.setattr(jobs, "write_day", lambda *a, **b: levels.extend(held()) or write(*a, **b))
    before = _shuffle_files(spark)
    df = registry.QUERIES[name](spark, star)
    assert levels and not [level for level in levels if "Disk" in level]  # no parsed day lies on disk
    left = {file.split("_")[1] for file in _left_beyond(spark, before, seconds=5)}
    assert len(left) <= 2  # a row for each file's count of the snapshot, one shuffle for each day run
    for dataset in tmp_path.glob("registered-*/bronze/*"):
        assert all(f.name.endswith(".gz") for f in dataset.rglob("part-*"))
    assert df.count() > 0


def test_catalog_tables_and_view(spark, tmp_path):
    silver, gold, db = str(tmp_path / "silver"), str(tmp_path / "gold"), "reel_test"
    fact = "dt date, media_id string, unique_visitors bigint, loads bigint, plays bigint, play_rate double, gold_ingested_at timestamp"
    write_days(spark.createDataFrame([(date(2025, 3, 4), "a", 1, 2, 1, 0.5, None)], fact), f"{gold}/fact_media_daily")
    dim = spark.createDataFrame([("a", "old")], "media_id string, title string")
    write_replace(dim, f"{gold}/dim_media", "1")
    names = create_tables(spark, db, silver, gold)
    assert len(names) == 7 and create_tables(spark, db, silver, gold) == names
    view = create_views(spark, db)
    assert spark.table(view).count() == 0
    write_replace(dim.withColumn("title", F.lit("new")), f"{gold}/dim_media", "2")
    for table in ("gold_fact_media_daily", "gold_dim_media", "silver_visitors"):
        repair(spark, db, table, silver, gold)
    assert spark.table(view).columns == [
        "dt", "media_id", "title", "project_name", "unique_visitors", "loads", "plays", "play_rate"
    ]
    assert values(spark.table(view), "dt", "media_id", "title", "plays") == [(date(2025, 3, 4), "a", "new", 1)]
    top = top_by_play_rate(read_table(spark, db, "gold_fact_media_daily"), read_table(spark, db, "gold_dim_media"), "2025-03-05")
    assert values(top, "title", "avg_play_rate") == [("new", 0.5)]
    spark.sql(f"DROP DATABASE {db} CASCADE")
