"""Catalog tables over the silver and gold files, and the performance view."""

from __future__ import annotations

from datetime import date
from itertools import batched
from urllib.parse import unquote

from pyspark.sql import SparkSession

from reelstat.schemas import TABLE_DIRS, TABLES
from reelstat.sinks.tables import COMPRESSION
from reelstat.sources.files import exists, join, list_names
from reelstat.sources.tables import current_version

VIEW = "vw_media_perf"


def create_tables(spark: SparkSession, db: str, silver_root: str, gold_root: str) -> list[str]:
    """Create the seven external tables if absent. Partitioned tables show rows after `repair`."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    names = []
    for table, (data, partitions) in TABLES.items():
        location = _location(spark, table, silver_root, gold_root)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in data.fields + partitions.fields)
        by = f"PARTITIONED BY ({', '.join(partitions.names)})" if partitions.names else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {db}.{table} ({columns}) USING PARQUET "
            f"OPTIONS ('compression' = '{COMPRESSION}') {by} LOCATION '{location}'"
        )
        names.append(f"{db}.{table}")
    return names


def _location(spark: SparkSession, table: str, silver_root: str, gold_root: str) -> str:
    root = gold_root if table.startswith("gold_") else silver_root
    path = join(root, TABLE_DIRS[table])
    return path if TABLES[table][1].names else current_version(spark, path) or path


def repair(spark: SparkSession, db: str, table: str, silver_root: str, gold_root: str) -> None:
    """Bring the catalog up to date: discover partitions, or point to the newest version of a replaced table.

    Nothing to do before the table's first write.
    """
    location = _location(spark, table, silver_root, gold_root)
    if not exists(spark, location):
        return
    if TABLES[table][1].names:
        spark.sql(f"MSCK REPAIR TABLE {db}.{table} SYNC PARTITIONS")
    else:
        spark.sql(f"ALTER TABLE {db}.{table} SET LOCATION '{location}'")
    spark.sql(f"REFRESH TABLE {db}.{table}")


def _quoted(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sync_day(spark: SparkSession, db: str, table: str, day: date, silver_root: str, gold_root: str) -> None:
    """The partitions of one day of a partitioned table, as they lie in the store: new ones are added, gone ones dropped.

    Only that day's directory is listed, unlike `repair`. A day whose media_id is a column has no partition to add.
    """
    by = TABLES[table][1].names
    base = join(_location(spark, table, silver_root, gold_root), f"dt={day}")
    stored = {""} if len(by) == 1 and exists(spark, base) else set()
    if len(by) > 1:
        stored = {name for name in list_names(spark, base) if name.startswith("media_id=")}
    known = {row[0].partition("/")[2] for row in spark.sql(f"SHOW PARTITIONS {db}.{table} PARTITION (dt = '{day}')").collect()}

    def spec(name: str) -> str:
        value = unquote(name.partition("=")[2])
        media = _quoted(None if value == "__HIVE_DEFAULT_PARTITION__" else value)
        return f"PARTITION (dt = '{day}'" + (f", media_id = {media})" if name else ")")

    for some in batched(sorted(stored - known), 200):
        places = [f"{spec(name)} LOCATION {_quoted(join(base, name) if name else base)}" for name in some]
        spark.sql(f"ALTER TABLE {db}.{table} ADD IF NOT EXISTS {' '.join(places)}")
    for some in batched(sorted(known - stored), 200):
        spark.sql(f"ALTER TABLE {db}.{table} DROP IF EXISTS {', '.join(map(spec, some))}")
    if stored and by == ["dt"]:
        spark.sql(f"ANALYZE TABLE {db}.{table} PARTITION (dt = '{day}') COMPUTE STATISTICS NOSCAN")
    spark.sql(f"REFRESH TABLE {db}.{table}")


def publish(spark: SparkSession, db: str, silver_root: str, gold_root: str, day: date) -> list[str]:
    """What a run of the day leaves for readers by name: tables, the day's partitions, newest versions, sizes, the view.

    Sizes come from the store's listing, so that the planner knows a small dimension without a scan.
    """
    names = create_tables(spark, db, silver_root, gold_root)
    for table, (_, partitions) in TABLES.items():
        if partitions.names:
            sync_day(spark, db, table, day, silver_root, gold_root)
        elif exists(spark, _location(spark, table, silver_root, gold_root)):
            repair(spark, db, table, silver_root, gold_root)
            spark.sql(f"ANALYZE TABLE {db}.{table} COMPUTE STATISTICS NOSCAN")
    return [*names, create_views(spark, db)]


def create_views(spark: SparkSession, db: str) -> str:
    spark.sql(
        f"""
        CREATE OR REPLACE VIEW {db}.{VIEW} AS
        SELECT fact.dt, fact.media_id, dim.title, dim.project_name,
               fact.unique_visitors, fact.loads, fact.plays, fact.play_rate
        FROM {db}.gold_fact_media_daily AS fact
        LEFT JOIN {db}.gold_dim_media AS dim ON fact.media_id = dim.media_id
        """
    )
    return f"{db}.{VIEW}"
