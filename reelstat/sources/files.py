"""Paths and existence checks. Only directory names pass through the driver, never data."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from reelstat.functions.typing import parse_day


def join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def day_path(root: str, day: str | date) -> str:
    return join(root, f"dt={parse_day(day).isoformat()}")


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _filesystem(spark, path)
    return fs.exists(hadoop_path)


def replace_dir(spark: SparkSession, staged: str, target: str) -> None:
    """Put a finished directory in the place of another, which is moved aside first and deleted last.

    If the new one cannot be moved in, the old one is put back.
    """
    fs, source = _filesystem(spark, staged)
    _, goal = _filesystem(spark, target)
    aside = None
    if fs.exists(goal):
        _, aside = _filesystem(spark, f"{staged.rstrip('/')}-replaced")
        if not fs.rename(goal, aside):
            raise OSError(f"could not move {target} aside")
    fs.mkdirs(goal.getParent())
    try:
        if not fs.rename(source, goal):
            raise OSError(f"could not move {staged} to {target}")
    except Exception:
        if aside is not None and not fs.exists(goal):
            fs.rename(aside, goal)
        raise
    if aside is not None:
        fs.delete(aside, True)


def remove_dir(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _filesystem(spark, path)
    fs.delete(hadoop_path, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a directory; none if it does not exist."""
    fs, hadoop_path = _filesystem(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def complete_versions(spark: SparkSession, path: str) -> list[str]:
    """The `version=` directories whose write has finished, newest first."""
    versions = [join(path, name) for name in reversed(list_names(spark, path)) if name.startswith("version=")]
    return [version for version in versions if exists(spark, join(version, "_SUCCESS"))]


def day_paths(spark: SparkSession, root: str, days: Iterable[str | date] | None) -> list[str]:
    """The day directories that exist. Naming them keeps the listing to those days, however long the history."""
    if days is None:
        return [join(root, name) for name in list_names(spark, root) if name.startswith("dt=")]
    return [path for path in (day_path(root, d) for d in sorted(set(map(parse_day, days)))) if exists(spark, path)]


def read_or_none(reader: Callable[[], DataFrame]) -> DataFrame | None:
    """None when the path is missing. Every other read error is raised."""
    try:
        return reader()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
