"""Scans of silver and gold Parquet tables, always with their contract schema."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reelstat.operators.incremental import WATERMARK_SCHEMA
from reelstat.schemas import FILE_COUNTS, QUARANTINE, SKETCH_SCHEMA, SKETCHES, TABLE_DIRS, table_schema
from reelstat.sources.files import complete_versions, day_paths, exists, join, list_names, read_or_none


def read_days(
    spark: SparkSession, root: str, table: str, days: Iterable[str | date] | None = None
) -> DataFrame | None:
    """A day-partitioned table on the given days. Only those directories are listed, and `dt` is kept."""
    base = join(root, TABLE_DIRS[table])
    paths = day_paths(spark, base, days)
    if not paths:
        return None
    return read_or_none(lambda: spark.read.schema(table_schema(table)).option("basePath", base).parquet(*paths))


def read_sketches(spark: SparkSession, root: str, days: Iterable[str | date] | None = None) -> DataFrame | None:
    """(media_id, visitor_sketch, dt) of the given days; None if none of them was run."""
    base = join(root, SKETCHES)
    paths = day_paths(spark, base, days)
    if not paths:
        return None
    return read_or_none(lambda: spark.read.schema(SKETCH_SCHEMA).option("basePath", base).parquet(*paths))


def read_table(spark: SparkSession, db: str, table: str) -> DataFrame:
    """A table or view of the catalog by name."""
    return spark.table(f"{db}.{table}")


def current_version(spark: SparkSession, path: str) -> str | None:
    """Directory of the newest complete version written by `write_replace`, or None."""
    return next(iter(complete_versions(spark, path)), None)


def read_current(spark: SparkSession, root: str, table: str, further: str = "") -> DataFrame | None:
    """A table that is replaced as a whole: the media snapshot or the media dimension.

    `further` names columns beyond the contract's, as a schema text; files that lack them give NULL.
    """
    schema = T.StructType(table_schema(table).fields + T.StructType.fromDDL(further).fields)
    path = join(root, TABLE_DIRS[table])
    location = current_version(spark, path)
    if location is None:
        if any(name.startswith("version=") for name in list_names(spark, path)):
            return None
        if not exists(spark, path):
            return None
        location = path  # a table written flat, without versions
    return read_or_none(lambda: spark.read.schema(schema).parquet(location))


def read_watermarks(spark: SparkSession, path: str) -> DataFrame:
    """The stored watermarks; none before the first run has succeeded."""
    location = current_version(spark, path)
    if location is None:
        return spark.createDataFrame([], WATERMARK_SCHEMA)
    return spark.read.schema(WATERMARK_SCHEMA).parquet(location)


def _beside(spark: SparkSession, root: str, table: str, dataset: str, columns: str, days) -> DataFrame | None:
    base = join(root, table, f"dataset={dataset}")
    paths = day_paths(spark, base, days)
    if not paths:
        return None
    return read_or_none(lambda: spark.read.schema(f"media_id string, {columns}, dt date").option("basePath", base).parquet(*paths))


def read_quarantine(spark: SparkSession, root: str, dataset: str, days: Iterable[str | date] | None = None) -> DataFrame | None:
    """(media_id, source_file, kind, text, dt) of the bronze lines that could not be read whole; None if no day was run."""
    return _beside(spark, root, QUARANTINE, dataset, "source_file string, kind string, text string", days)


def read_file_counts(spark: SparkSession, root: str, dataset: str, days: Iterable[str | date] | None = None) -> DataFrame | None:
    """(media_id, source_file, records, broken, partial, dt) of each bronze file; None if no day was run."""
    return _beside(spark, root, FILE_COUNTS, dataset, "source_file string, records long, broken long, partial long", days)
