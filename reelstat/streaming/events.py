"""Incremental events: new bronze files to silver, each event once."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reelstat.functions.typing import stamp
from reelstat.operators.events import first_of_each_key, protect_events, type_events, without_key
from reelstat.operators.quality import assert_no_pii
from reelstat.schemas import BRONZE, TABLE_DIRS, TABLES, table_schema
from reelstat.sinks.tables import COMPRESSION, cluster
from reelstat.sources.bronze import with_day, with_media_id
from reelstat.sources.files import day_paths, join

SOURCE_FILE = T.StructField("source_file", T.StringType())


def read_event_stream(spark: SparkSession, root: str, max_files: int | None = None) -> DataFrame:
    """New event files as they are landed, with the batch day and media of their directory, and their path."""
    reader = spark.readStream.schema(BRONZE["events"]).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.json(join(root, "events")).withColumn("source_file", F.col("_metadata.file_path"))
    return with_day(with_media_id(raw, prefer="body", path=F.col("source_file")), path=F.col("source_file"))


def _stored(spark: SparkSession, path: str, days: Iterable[date]) -> DataFrame | None:
    paths = day_paths(spark, path, days)
    if not paths:
        return None
    schema = T.StructType([*table_schema("silver_events").fields, SOURCE_FILE])
    return spark.read.schema(schema).option("basePath", path).parquet(*paths)


def append_new(batch: DataFrame, path: str, ip_hash_key: str | bytes | None = None, overlap: int = 1) -> None:
    """Append the events of one micro-batch that silver does not hold yet.

    Known events are looked up in the batch's own days and `overlap` days around them. A batch that runs again
    finds its events stored and adds only what is missing. Nothing is too late: there is no watermark to fall
    behind and no state to grow, since an old day is compared with that day's table.
    """
    batch = batch.persist()  # parsed once for its days, its keyed and its keyless events
    try:
        _append(batch, path, ip_hash_key, overlap)
    finally:
        batch.unpersist()


def _append(batch: DataFrame, path: str, ip_hash_key: str | bytes | None, overlap: int) -> None:
    spark = batch.sparkSession
    days = [row.dt for row in batch.select("dt").distinct().collect() if row.dt is not None]
    near = {day + timedelta(days=n) for day in days for n in range(-overlap, overlap + 1)}
    rows = protect_events(type_events(batch), ip_hash_key)
    stored = _stored(spark, path, near)
    keyed, keyless = first_of_each_key(rows, stored), without_key(rows)
    if stored is not None:
        # A record without a key is known by the file that brought it: a file belongs to one batch only.
        files = without_key(stored).select(SOURCE_FILE.name).distinct()
        keyless = keyless.join(files, SOURCE_FILE.name, "left_anti")
    columns = [*TABLES["silver_events"][0].names, SOURCE_FILE.name, "dt", "media_id"]
    out = assert_no_pii(stamp(keyed.unionByName(keyless), "processed_at").select(*columns))
    (
        cluster(out, "dt", "media_id")
        .write.mode("append")
        .option("compression", COMPRESSION)
        .partitionBy("dt", "media_id")
        .parquet(path)
    )


def stream_events(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    checkpoint: str,
    ip_hash_key: str | bytes | None = None,
    overlap: int = 1,
    max_files: int | None = None,
) -> StreamingQuery:
    """Take every file landed since the last run into silver, then stop. Start it again for the next files."""
    path = join(silver_root, TABLE_DIRS["silver_events"])
    return (
        read_event_stream(spark, bronze_root, max_files)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, _: append_new(batch, path, ip_hash_key, overlap))
        .start()
    )
