"""Scans of the bronze JSON lines laid out as `<dataset>/dt=<day>/media_id=<id>/<any file>` or `<dataset>/dt=<day>/<any file>`."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstat.functions.typing import day_literal
from reelstat.schemas import BRONZE, LINE_TEXT, MEDIA_ID_FROM_PATH, SOURCE_FILE
from reelstat.sources.files import day_paths, join, read_or_none

# Fixed value: the directory name Spark gives to rows whose partition value is NULL or empty.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

_PARTITIONS = [T.StructField("dt", T.DateType()), T.StructField("media_id", T.StringType())]


def path_value(path: Column, key: str) -> Column:
    """The value of a `key=value` directory in a file path; NULL when the path has none.

    Paths are percent-encoded once as a URI and once more by the writer for characters a directory may not
    hold, hence the two decodings. A plus sign is not an encoding in a path and is kept.
    """
    raw = F.regexp_extract(path, rf"[/\\]{key}=([^/\\]+)[/\\]", 1)
    return F.when(~raw.isin("", _NO_VALUE), _percent_decode(_percent_decode(raw)))


def _percent_decode(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def with_media_id(df: DataFrame, prefer: str, path: Column | None = None) -> DataFrame:
    """Set media_id from the file path: always (`prefer="path"`), or where the record has none (`"body"`)."""
    path = F.col("_metadata.file_path") if path is None else path
    found = path_value(path, "media_id")
    if prefer == "body" and "media_id" in df.columns:
        found = F.coalesce(F.col("media_id"), found)
    return df.withColumn("media_id", found)


def with_day(df: DataFrame, day: str | date | None = None, path: Column | None = None) -> DataFrame:
    """Stamp the batch day as DATE: a given day, or the `dt` directory each record was read from."""
    if day is not None:
        return df.withColumn("dt", day_literal(day))
    path = F.col("_metadata.file_path") if path is None else path
    return df.withColumn("dt", path_value(path, "dt").try_cast("date"))


def bronze_schema(dataset: str, extra: Iterable[str] = (), lossless: bool = False) -> T.StructType:
    further = [*extra, LINE_TEXT] if lossless else list(extra)
    return T.StructType(BRONZE[dataset].fields + [T.StructField(name, T.StringType()) for name in further])


def read_bronze(
    spark: SparkSession,
    root: str,
    dataset: str,
    days: Iterable[str | date] | None = None,
    extra: Iterable[str] = (),
    lossless: bool = False,
) -> DataFrame | None:
    """All records of a dataset on the given days (all days if None), with `dt` and `media_id`.

    None if no day directory exists. Days read together are all laid out in one of the two ways. Zero-byte files give no rows. The schema is explicit, so there is no
    inference pass over the files; `extra` names further fields to read, as text. `lossless` adds the text of every line
    that could not be read whole and the file of each record (`operators/quarantine.py` tells them apart).
    """
    base = join(root, dataset)
    paths = day_paths(spark, base, days)
    if not paths:
        return None
    schema = bronze_schema(dataset, extra, lossless)
    reader = spark.read.option("columnNameOfCorruptRecord", LINE_TEXT) if lossless else spark.read
    named = (lambda df: df.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))) if lossless else (lambda df: df)
    if dataset in MEDIA_ID_FROM_PATH:
        # Partition columns in the read schema keep `0123` a string and override the record's own media_id. On a day that
        # was landed without directories for media it is the record's, of which an empty one is NULL, as in a directory.
        full = T.StructType(schema.fields + _PARTITIONS)
        media = F.nullif(F.col("media_id"), F.lit(""))
        return read_or_none(lambda: named(reader.schema(full).option("basePath", base).json(paths)).withColumn("media_id", media))
    # A media_id partition column would replace the record's value, so partition discovery is off here.
    df = read_or_none(lambda: named(reader.schema(schema).option("recursiveFileLookup", "true").json(paths)))
    if df is None:
        return None
    # The path is searched per row, so only where the day is not known beforehand.
    day = paths[0].rpartition("dt=")[2] if len(paths) == 1 else None
    return with_day(with_media_id(df, prefer="body"), day)
