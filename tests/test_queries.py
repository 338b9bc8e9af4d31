"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest
from check_oracle import compare, connect
from conftest import SMALL

import __spark_entry__ as registered
from reelstat.plans import registry
from reelstat.plans.registry_sql import ORACLES

NAMES = list(registry.QUERIES)


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(ORACLES) == set(NAMES) <= set(registered.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = registered.queries()[name](spark, SMALL)
    assert compare(duck, df, registered.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["visitors_dedup", "media_snapshot_latest", "events_dedup", "top_by_play_rate_7d", "visitor_spread"])
@pytest.mark.parametrize("partitions", ["1", "7", "64"])
def test_result_does_not_depend_on_partitioning(spark, duck, name, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = registered.queries()[name](spark, SMALL)
        assert compare(duck, df, registered.oracle_sql()[name]) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_results_hold_in_another_session_time_zone(spark, duck):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("events_typed", "media_flatten", "watermark_probe", "events_window"):
            df = registered.queries()[name](spark, SMALL)
            assert compare(duck, df, registered.oracle_sql()[name]) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns[0] == "title" and 0 < df.count() <= 20
