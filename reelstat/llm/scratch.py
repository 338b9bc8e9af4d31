"""Intermediate tables: Parquet in the shared folder, which every executor can reach. They cut lineage, so a lost executor
costs at most the step in hand, and their size is known to the planner, which broadcasts only what it measured small."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from reelstat.session import shared_dir
from reelstat.sources.files import join, remove_dir


#: Folders that this process made and has not deleted.
_MADE: list[str] = []
ROWS = 1_000  # of a batch on its way to a task's Python: bounds the memory of a batch of texts


def folder(spark: SparkSession) -> str:
    """A folder of this application that nothing else uses."""
    path = join(shared_dir(spark), f"llm-{spark.sparkContext.applicationId}", uuid.uuid4().hex)
    _MADE.append(path)
    return path


@contextmanager
def batches_of(spark: SparkSession, rows: int = ROWS) -> Iterator[None]:
    """What is run inside sends so many rows at once to Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def save(df: DataFrame) -> DataFrame:
    """Write a table and read it back. The files stay until `clear`, as results may still depend on them."""
    spark = df.sparkSession
    path = folder(spark)
    with batches_of(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_but(docs: DataFrame) -> None:
    """Delete the intermediate tables that were made before, but for those that `docs` is read from.

    For a chain of stages whose results are written and read again: what a stage left behind goes when the next begins.
    """
    spark = docs.sparkSession
    needed = [name for name in docs.inputFiles() if "/llm-" in name]
    for path in list(_MADE):
        if not any(path.rpartition("/llm-")[2] in name for name in needed):
            remove_dir(spark, path)
            _MADE.remove(path)


def clear(spark: SparkSession) -> None:
    """Delete every intermediate table of this application. Call it when its results are written."""
    remove_dir(spark, join(shared_dir(spark), f"llm-{spark.sparkContext.applicationId}"))
    _MADE.clear()
