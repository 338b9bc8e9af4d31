from __future__ import annotations

import shutil
from dataclasses import replace
from datetime import date, datetime, timedelta
from urllib.parse import quote

import pytest
from conftest import values

from reelstat.operators.gold import merge_sketches
from reelstat.operators.incremental import latest_status
from reelstat.operators.quality import duplicate_event_keys, pii_columns
from reelstat.plans import jobs
from reelstat.schemas import TABLES, table_schema
from reelstat.sinks.catalog import VIEW
from reelstat.sources.tables import read_current, read_days, read_file_counts, read_quarantine, read_sketches, read_table, read_watermarks

DAY, NEXT = "2025-03-04", "2025-03-05"


def visitor(key, loads, plays, **identity):
    return {"visitor_key": key, "load_count": loads, "play_count": plays, "visitor_identity": identity or None}


def media_object(name, updated, **extra):
    return {
        "id": 5,
        "hashed_id": "h5",
        "name": name,
        "duration": 61.5,
        "created": "2025-01-01T08:00:00+02:00",
        "updated": updated,
        "status": "ready",
        "archived": False,
        "section": "Demos",
        "thumbnail": {"url": "https://img.example/5", "width": 10, "height": 10},
        "project": {"id": 77, "name": "Launch"},
        "progress": 1,
        **extra,
    }


def event(key, hour=10, **extra):
    return {"event_key": key, "received_at": f"2025-03-04T{hour:02d}:00:00.000Z", "percent_viewed": 0.5, **extra}


def test_visitors_job(spark, roots, land):
    land("visitors", DAY, "m1", [visitor("a", 1, 0), visitor("b", "2", 1.0, name="Bo", email="b@x")])
    land("visitors", DAY, "m1", [visitor("a", 4, 3)], "page=0002.jsonl")
    assert jobs.silver_visitors(spark, roots.bronze, roots.silver, DAY) == 2
    df = read_days(spark, roots.silver, "silver_visitors", [DAY])
    assert dict(df.dtypes)["dt"] == "date"
    assert values(df, "visitor_key", "load_count", "play_count", "name") == [("a", 4, 3, None), ("b", 2, 1, "Bo")]
    assert df.where("ingested_at IS NULL").isEmpty()
    jobs.silver_visitors(spark, roots.bronze, roots.silver, DAY, email_key="k")
    hashed = read_days(spark, roots.silver, "silver_visitors", [DAY]).where("email IS NOT NULL")
    assert [len(e) for (e,) in values(hashed, "email")] == [64]


def test_media_job_keeps_the_latest_and_the_absent(spark, roots, land):
    land("media", DAY, "m1", [media_object("First", "2025-03-04T00:00:00+00:00")], "object.json")
    land("media", DAY, "m2", [media_object("Other", "not a time", duration="?", progress=None, project=None)], "object.json")
    assert jobs.silver_media(spark, roots.bronze, roots.silver, DAY) == 2
    land("media", NEXT, "m1", [media_object("Second", "2025-03-05T00:00:00+00:00")], "object.json")
    assert jobs.silver_media(spark, roots.bronze, roots.silver, NEXT) == 1
    history = read_days(spark, roots.silver, "silver_media_history")
    assert values(history, "dt", "media_id", "name") == [
        (date(2025, 3, 4), "m1", "First"),
        (date(2025, 3, 4), "m2", "Other"),
        (date(2025, 3, 5), "m1", "Second"),
    ]
    snapshot = read_current(spark, roots.silver, "silver_media_snapshot")
    assert values(snapshot, "media_id", "name", "duration_s", "project_id", "archived", "progress") == [
        ("m1", "Second", 61.5, 77, False, 1.0),
        ("m2", "Other", None, None, False, None),
    ]
    assert str(snapshot.where("media_id = 'm1'").first().created_at) == "2025-01-01 06:00:00"
    # An older day run again does not take the snapshot back.
    jobs.silver_media(spark, roots.bronze, roots.silver, DAY)
    assert values(read_current(spark, roots.silver, "silver_media_snapshot"), "name") == [("Other",), ("Second",)]


def test_media_job_without_snapshot(spark, roots, land):
    land("media", DAY, "m1", [media_object("First", None)], "object.json")
    jobs.silver_media(spark, roots.bronze, roots.silver, DAY, snapshot=False)
    assert read_current(spark, roots.silver, "silver_media_snapshot") is None
    assert jobs.gold_dim_media(spark, roots.silver, roots.gold) == 0


def test_events_job(spark, roots, land):
    old_shape = {"at": "2025-03-04T10:00:00Z", "event_type": "play", "media_id": "own", "ip": "10.0.0.9", "position_s": 1}
    land("events", DAY, "m1", [old_shape, {**old_shape, "event_type": "pause", "at": "?"}])
    land("events", DAY, "m2", [event("k1", ip="10.0.0.9", email="a@x", lat=1.5, conversion_data={"email": "a@x", "n": 1})])
    land("events", DAY, "m2", [event("k1"), event("k2", 9)], "page=0002.jsonl")
    assert jobs.silver_events(spark, roots.bronze, roots.silver, DAY, "key") == 4
    stored = spark.read.parquet(f"{roots.silver}/events")
    assert not pii_columns(stored.schema)
    df = read_days(spark, roots.silver, "silver_events", [DAY])
    assert df.schema.names == table_schema("silver_events").names
    assert values(df, "media_id", "event_key", "event_type") == [
        ("m2", "k1", None), ("m2", "k2", None), ("own", None, "pause"), ("own", None, "play")
    ]
    hashes = [row.ip_hmac for row in df.where("ip_hmac IS NOT NULL").collect()]
    assert len(set(hashes)) == 1 and all(len(h) == 64 for h in hashes)
    texts = {row.conversion_data for row in df.collect()}
    assert texts <= {None, '{"email":"<redacted>","n":1}'}


def test_further_event_fields_can_be_kept(spark, roots, land):
    land("events", DAY, "m1", [event("k1", player="p9", owner={"id": 7, "email": "a@x"}), event("k2")])
    assert jobs.silver_events(spark, roots.bronze, roots.silver, DAY, extra=["player", "owner"]) == 2
    stored = spark.read.parquet(f"{roots.silver}/events")
    owner = '{"email":"<redacted>","id":7}'
    assert values(stored, "event_key", "player", "owner") == [("k1", "p9", owner), ("k2", None, None)]


def test_overlap_days_hold_no_event_twice(spark, roots, land):
    land("events", DAY, "m1", [event("k1"), event("k2")])
    land("events", NEXT, "m1", [event("k2"), event("k3")])
    for days in ([DAY, NEXT], [NEXT, DAY], [DAY, DAY], [NEXT, NEXT]):
        for day in days:
            jobs.silver_events(spark, roots.bronze, roots.silver, day)
            table = read_days(spark, roots.silver, "silver_events")
            assert duplicate_event_keys(table).isEmpty()
        assert {k for (k,) in values(table, "event_key")} == {"k1", "k2", "k3"}


def test_a_late_first_day_adds_only_new_events(spark, roots, land):
    land("events", DAY, "m1", [event("k1"), event("k2")])
    land("events", NEXT, "m1", [event("k2"), event("k3")])
    jobs.silver_events(spark, roots.bronze, roots.silver, NEXT)
    jobs.silver_events(spark, roots.bronze, roots.silver, DAY)
    out = values(read_days(spark, roots.silver, "silver_events"), "dt", "event_key")
    assert out == [(date(2025, 3, 4), "k1"), (date(2025, 3, 5), "k2"), (date(2025, 3, 5), "k3")]


def test_by_date_job(spark, roots, land):
    row = {"date": DAY, "load_count": 21, "play_count": 4.0, "play_rate": 0.19, "hours_watched": 1.5, "engagement": 0.4, "visitors": "9"}
    land("media_by_date", DAY, "m1", [{**row, "media_id": "m1"}, {"date": "?", "load_count": "n/a"}])
    land("media_by_date", DAY, "m2", [])
    assert jobs.silver_media_by_date(spark, roots.bronze, roots.silver, DAY) == 2
    df = read_days(spark, roots.silver, "silver_media_by_date", [DAY])
    assert values(df, "day", "media_id", "load_count", "play_count", "play_rate", "visitors") == [
        (date(2025, 3, 4), "m1", 21, 4, 0.19, 9),
        (None, "m1", None, None, None, None),
    ][::-1]


def test_no_input_is_no_failure_and_clears_nothing(spark, roots, land, capsys):
    for job in (jobs.silver_visitors, jobs.silver_media, jobs.silver_events, jobs.silver_media_by_date):
        assert job(spark, roots.bronze, roots.silver, DAY) == 0
    assert jobs.gold_fact_media_daily(spark, roots.silver, roots.gold, DAY) == 0
    assert capsys.readouterr().out.count("No input found for day=2025-03-04") == 5
    page = land("visitors", DAY, "m1", [visitor("a", 1, 1)])
    jobs.silver_visitors(spark, roots.bronze, roots.silver, DAY)
    page.write_text("")
    assert jobs.silver_visitors(spark, roots.bronze, roots.silver, DAY) == 0
    assert read_days(spark, roots.silver, "silver_visitors").count() == 1


def everything(land, day, *media_ids):
    for media_id in media_ids:
        land("visitors", day, media_id, [visitor("a", 2, 1), visitor("b", 2, 2)])
        land("media", day, media_id, [media_object(f"Title {media_id}", f"{day}T00:00:00Z")], "object.json")
        land("events", day, media_id, [event(f"{day}{media_id}")])
        land("media_by_date", day, media_id, [{"date": day, "load_count": 4}])


def snapshot_of(spark, roots):
    out = {}
    for table, (data, _) in TABLES.items():
        root = roots.gold if table.startswith("gold") else roots.silver
        replaced = table in ("silver_media_snapshot", "gold_dim_media")
        df = read_current(spark, root, table) if replaced else read_days(spark, root, table)
        columns = [n for n in table_schema(table).names if not n.endswith(("ingested_at", "processed_at"))]
        out[table] = values(df, *columns)
    return out


@pytest.mark.parametrize("media_dirs", [True, False])
def test_run_days_twice_equals_once(spark, roots, land, media_dirs):
    everything(land, DAY, "01", "02")
    everything(land, NEXT, "02")
    written = jobs.run_days(spark, [NEXT, DAY], roots, "key", media_dirs)
    assert list(written) == [date(2025, 3, 4), date(2025, 3, 5)]
    assert written[date(2025, 3, 5)] == {
        "silver_media": 1,
        "silver_visitors": 2,
        "silver_events": 1,
        "silver_media_by_date": 1,
        "gold_dim_media": 2,
        "gold_fact_media_daily": 1,
    }
    once = snapshot_of(spark, roots)
    assert len(once["gold_fact_media_daily"]) == 3
    jobs.run_days(spark, [DAY, NEXT], roots, "key", media_dirs)
    assert snapshot_of(spark, roots) == once
    assert latest_status(spark.read.parquet(roots.status)).where("status <> 'SUCCEEDED'").isEmpty()


@pytest.mark.parametrize("media_dirs", [True, False])
def test_runs_keep_the_catalog(spark, roots, land, media_dirs):
    """Tables and view by name after each run: odd media names, a rerun with one media less, more runs than versions kept."""
    db, odd = "runs_test", "it's a=b %41"
    named = replace(roots, catalog=db)
    for day in (DAY, NEXT):
        everything(land, day, "m1", "m2")
    land("visitors", DAY, quote(odd, safe="' "), [{"visitor_key": "v", "load_count": 1}])
    try:
        jobs.run_days(spark, [DAY, NEXT], named, "key", media_dirs)
        everything(land, DAY, "m1")
        for dataset in ("visitors", "events", "media_by_date", "media"):
            shutil.rmtree(f"{roots.bronze}/{dataset}/dt={DAY}/media_id=m2")
        for _ in range(3):
            written = jobs.run_day(spark, DAY, named, "key", media_dirs)
        assert written["catalog"] == 8
        first, second = date(2025, 3, 4), date(2025, 3, 5)
        facts = values(read_table(spark, db, VIEW), "dt", "media_id")
        assert facts == sorted([(first, odd), (first, "m1"), (second, "m1"), (second, "m2")], key=repr)
        if media_dirs:
            for table in ("silver_visitors", "silver_events"):
                rows = read_table(spark, db, table).select("dt", "media_id").distinct()
                stored = read_days(spark, roots.silver, table).select("dt", "media_id").distinct()
                assert values(rows, "dt", "media_id") == values(stored, "dt", "media_id")
        assert "bytes" in {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {db}.gold_dim_media").collect()}["Statistics"]
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_media_gone_from_a_rerun_day_leave_no_rows(spark, roots, land):
    everything(land, DAY, "m1", "m2")
    everything(land, NEXT, "m1", "m2")
    jobs.run_days(spark, [DAY, NEXT], roots)
    for dataset in ("visitors", "events", "media_by_date", "media"):
        shutil.rmtree(f"{roots.bronze}/{dataset}/dt={DAY}/media_id=m2")
    jobs.run_day(spark, DAY, roots)
    for table in ("silver_visitors", "silver_events", "silver_media_by_date", "silver_media_history"):
        rows = values(read_days(spark, roots.silver, table).select("dt", "media_id").distinct(), "dt", "media_id")
        assert rows == [(date(2025, 3, 4), "m1"), (date(2025, 3, 5), "m1"), (date(2025, 3, 5), "m2")]
    assert values(read_days(spark, roots.gold, "gold_fact_media_daily"), "dt", "media_id") == rows
    assert values(read_current(spark, roots.gold, "gold_dim_media"), "media_id") == [("m1",), ("m2",)]


def test_fact_of_many_days_in_one_pass(spark, roots, land):
    for day in (DAY, NEXT):
        land("visitors", day, "m1", [visitor("a", 2, 1)])
        jobs.silver_visitors(spark, roots.bronze, roots.silver, day)
    assert jobs.gold_fact_media_daily(spark, roots.silver, roots.gold, [DAY, NEXT, "2025-03-06"]) == 2


def test_a_failed_step_fails_the_day(spark, roots, land, monkeypatch):
    def broken(*_, **__):
        raise RuntimeError("disk full")

    monkeypatch.setattr(jobs, "silver_visitors", broken)
    with pytest.raises(RuntimeError, match="disk full"):
        jobs.run_day(spark, DAY, roots)
    states = dict(values(latest_status(spark.read.parquet(roots.status)), "data_in_process", "status"))
    assert states == {"silver_media": "SUCCEEDED", "silver_visitors": "FAILED", "PIPELINE": "FAILED"}


def test_default_day_is_yesterday(spark, roots, land):
    yesterday = (jobs.today_utc() - timedelta(days=1)).isoformat()
    land("visitors", yesterday, "m1", [visitor("a", 1, 1)])
    assert jobs.run_day(spark, None, roots)["gold_fact_media_daily"] == 1


def test_command_lines(spark, roots, land, capsys):
    from reelstat.plans import cli

    everything(land, DAY, "m1")
    silver = ["--input-uri", roots.bronze, "--output-uri", roots.silver, "--day", DAY, "--job-bookmark=secret", "x"]
    gold = ["--silver-uri", roots.silver, "--gold-uri", roots.gold, "--day", DAY]
    assert cli.silver_visitors(silver) == 2
    assert cli.silver_media([*silver, "--no-snapshot"]) == 1
    assert cli.gold_dim_media(gold) == 0
    assert cli.silver_media(silver) == 1
    assert cli.silver_events([*silver, "--ip-hash-key", "k"]) == 1
    assert cli.silver_media_by_date(silver) == 1
    assert cli.gold_dim_media(gold) == 1
    assert cli.gold_fact_media_daily(gold) == 1
    out = capsys.readouterr().out
    assert "Ignoring unknown arguments: ['--job-bookmark']" in out and "secret" not in out
    roots_args = ["--bronze-uri", roots.bronze, "--silver-uri", roots.silver, "--gold-uri", roots.gold]
    assert list(cli.run_days([*roots_args, "--day", f"{NEXT},{DAY}"])) == [date(2025, 3, 4), date(2025, 3, 5)]


def broken_page(land, dataset, media, rows, *lines):
    path = land(dataset, DAY, media, rows)
    path.write_text("\n".join([path.read_text(encoding="utf-8"), *lines]), encoding="utf-8")
    return path


@pytest.mark.parametrize("dataset", ["visitors", "media", "events", "media_by_date"])
def test_broken_lines_are_kept_apart_from_the_records(spark, roots, land, dataset):
    row = {"visitor_key": "v", "name": "n", "event_key": "e", "date": DAY, "load_count": 1}
    odd = {"visitors": "user_agent_details", "media": "project", "events": "user_agent_details"}.get(dataset)
    lines = ['{"cut":', "junk", "7"]
    partial = [] if odd is None else [f'{{"visitor_key":"w","name":"o","event_key":"f","{odd}":"text"}}']
    broken_page(land, dataset, "m1", [row], *lines, *partial)
    land(dataset, DAY, "m2", [row])
    table = {"visitors": "silver_visitors", "media": "silver_media_history", "events": "silver_events", "media_by_date": "silver_media_by_date"}[dataset]
    job = {"visitors": jobs.silver_visitors, "media": jobs.silver_media, "events": jobs.silver_events, "media_by_date": jobs.silver_media_by_date}[dataset]
    once = 1 if dataset == "events" else 2  # the two events are copies
    for _ in range(2):
        assert job(spark, roots.bronze, roots.silver, DAY) == once + len(partial)
        assert read_days(spark, roots.silver, table, [DAY]).count() == once + len(partial)
        kept = values(read_quarantine(spark, roots.silver, dataset, [DAY]), "media_id", "kind", "text")
        assert kept == sorted([("m1", "broken", x) for x in lines] + [("m1", "partial", x) for x in partial])
        counts = values(read_file_counts(spark, roots.silver, dataset), "media_id", "records", "broken", "partial")
        assert counts == [("m1", 4 + len(partial), 3, len(partial)), ("m2", 1, 0, 0)]
    land(dataset, DAY, "m1", [row])
    job(spark, roots.bronze, roots.silver, DAY)
    assert read_quarantine(spark, roots.silver, dataset, [DAY]).count() == 0
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_files_of_a_day_are_parsed_once(spark, roots, land):
    path = broken_page(land, "events", "m1", [event("a"), event("b")], "junk")
    seen = spark.sparkContext.statusTracker()
    assert seen is not None and path.exists()
    with jobs._sound_records(spark, "t", roots.bronze, roots.silver, "events", DAY) as raw:
        text = raw._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryTableScan" in text and text.count("FileScan json") == 1
        assert raw.count() == 2


def test_of_equal_versions_the_last_delivery_counts_in_any_order(spark, roots, land):
    same = "2025-03-01T00:00:00+00:00"
    land("media", DAY, "m1", [media_object("Zed old", same)], "object.json")
    land("media", NEXT, "m1", [media_object("Alpha new", same)], "object.json")
    for days in ([DAY, NEXT], [NEXT, DAY], [DAY], [NEXT], [DAY]):
        for day in days:
            jobs.silver_media(spark, roots.bronze, roots.silver, day)
        snapshot = read_current(spark, roots.silver, "silver_media_snapshot") if len(days) > 1 or day == DAY else None
        if snapshot is not None:
            assert values(snapshot, "media_id", "name") == [("m1", "Alpha new")]
            assert snapshot.columns == table_schema("silver_media_snapshot").names


def test_further_fields_and_email_keys_reach_a_run(spark, roots, land):
    land("events", DAY, "m1", [event("k1", player="p9")])
    land("visitors", DAY, "m1", [visitor("a", 1, 0, email="a@x")])
    jobs.run_days(spark, [DAY], roots, "key", email_key="k", extra=["player"])
    assert values(spark.read.parquet(f"{roots.silver}/events"), "event_key", "player") == [("k1", "p9")]
    assert [len(e) for (e,) in values(read_days(spark, roots.silver, "silver_visitors"), "email")] == [64]


def test_command_lines_take_further_fields(spark, roots, land, monkeypatch):
    from reelstat.plans import cli

    monkeypatch.setattr(cli, "session", lambda _: spark)
    land("events", DAY, "m1", [event("k1", player="p9", speed=2)])
    where = ["--input-uri", roots.bronze, "--output-uri", roots.silver, "--day", DAY]
    assert cli.silver_events([*where, "--extra-fields", "player, speed"]) == 1
    assert values(spark.read.parquet(f"{roots.silver}/events"), "player", "speed") == [("p9", "2")]
    land("visitors", DAY, "m1", [visitor("a", 1, 0, email="a@x")])
    roots_of = ["--bronze-uri", roots.bronze, "--silver-uri", roots.silver, "--gold-uri", roots.gold, "--day", DAY]
    cli.run_days([*roots_of, "--email-hash-key", "k", "--extra-fields", "player"])
    assert [len(e) for (e,) in values(read_days(spark, roots.silver, "silver_visitors"), "email")] == [64]


def test_runs_load_by_stored_watermarks(spark, roots, land, monkeypatch):
    marks = f"{roots.silver}/watermarks"
    ran = []
    monkeypatch.setattr(jobs, "run_day", lambda spark, day, *options: ran.append(day) or {})

    def tracked(*media):
        return spark.createDataFrame([("events", m) for m in media], "dataset string, media_id string")

    def stored():
        return {r.media_id: (r.last_date, r.updated_at.day) for r in read_watermarks(spark, marks).collect()}

    run = lambda media, day, at: jobs.run_due(spark, tracked(*media), roots, marks, day, ts=datetime(2025, 4, at))
    assert jobs.run_due(spark, tracked(), roots, marks, "2025-03-04") == {} and stored() == {}
    run(["a", "a", None], "2025-03-07", 1)
    assert ran == [date(2025, 3, n) for n in range(1, 8)] and stored() == {"a": (date(2025, 3, 7), 1)}
    ran.clear()
    run(["a"], "2025-03-09", 2)
    assert ran == [date(2025, 3, n) for n in (6, 7, 8, 9)] and stored() == {"a": (date(2025, 3, 9), 2)}
    ran.clear()
    run(["b"], "2025-03-08", 3)  # newly tracked; the other is given up and keeps its mark
    assert ran == [date(2025, 3, n) for n in range(2, 9)]
    assert stored() == {"a": (date(2025, 3, 9), 2), "b": (date(2025, 3, 8), 3)}
    ran.clear()
    run(["a"], "2025-03-05", 4)  # an earlier run moves no mark back
    assert ran == [date(2025, 3, n) for n in (4, 5)] and stored()["a"] == (date(2025, 3, 9), 2)

    def fails(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(jobs, "run_day", fails)
    with pytest.raises(RuntimeError):
        run(["a", "b"], "2025-03-10", 5)
    assert stored() == {"a": (date(2025, 3, 9), 2), "b": (date(2025, 3, 8), 3)}


def test_command_line_loads_by_watermark(spark, roots, monkeypatch):
    from reelstat.plans import cli

    calls = []
    monkeypatch.setattr(cli, "session", lambda name: spark)
    monkeypatch.setattr(jobs, "run_due", lambda spark, tracked, *where, **options: calls.append((tracked, where, options)))
    argv = ["--bronze-uri", "b", "--silver-uri", "s", "--gold-uri", "g", "--watermarks-uri", "w", "--media", "m, n", "--flat-days"]
    cli.run_days(argv)
    (tracked, where, options), = calls
    assert values(tracked, "dataset", "media_id") == [(d, m) for d in ("events", "media_by_date") for m in ("m", "n")]
    assert where == (jobs.Roots("b", "s", "g"), "w", None)
    assert options == {"ip_hash_key": None, "media_dirs": False, "email_key": None, "extra": []}


def test_windows_are_answered_from_stored_sketches(spark, roots, land):
    land("visitors", DAY, "m1", [visitor(f"v{i}", 1, 0) for i in range(30)])
    land("visitors", DAY, "m2", [visitor("only", 1, 0)])
    land("visitors", NEXT, "m1", [visitor(f"v{i}", 1, 0) for i in range(20, 50)])
    assert read_sketches(spark, roots.gold) is None
    assert jobs.gold_visitor_sketches(spark, roots.silver, roots.gold, DAY) == 0
    for day in (DAY, NEXT):
        jobs.silver_visitors(spark, roots.bronze, roots.silver, day)
    assert jobs.gold_visitor_sketches(spark, roots.silver, roots.gold, [DAY, NEXT]) == 3
    assert jobs.gold_visitor_sketches(spark, roots.silver, roots.gold, DAY) == 2  # a rerun replaces its day
    counted = lambda days: values(merge_sketches(read_sketches(spark, roots.gold, days)), "media_id", "approx_distinct_visitors")
    assert counted([DAY, NEXT, "2025-03-06"]) == [("m1", 50), ("m2", 1)]
    assert counted([NEXT]) == [("m1", 30)] and read_sketches(spark, roots.gold, ["2025-03-06"]) is None
