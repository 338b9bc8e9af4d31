"""Bronze lines that could not be read: kept as text beside the records, with counts for each file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.schemas import LINE_TEXT, SOURCE_FILE

#: Columns of a record that come from where it lies, not from its text.
_PLACE = ("dt", "media_id", LINE_TEXT, SOURCE_FILE)


def _kind(df: DataFrame) -> Column:
    """`broken`: no field of the line could be read; `partial`: some could; NULL: all could."""
    fields = [F.col(f"`{name}`") for name in df.columns if name not in _PLACE]
    found = F.coalesce(*[F.when(field.isNotNull(), F.lit(True)) for field in fields], F.lit(False))
    return F.when(F.col(LINE_TEXT).isNotNull(), F.when(found, F.lit("partial")).otherwise(F.lit("broken")))


def sound(df: DataFrame) -> DataFrame:
    """The records of a lossless read without the lines of which nothing could be read."""
    return df.where(~_kind(df).eqNullSafe(F.lit("broken"))).drop(LINE_TEXT, SOURCE_FILE)


def quarantined(df: DataFrame) -> DataFrame:
    """(dt, media_id, source_file, kind, text) of every line that could not be read whole. A partial one is a record too."""
    media = F.col("media_id")
    return df.where(F.col(LINE_TEXT).isNotNull()).select(
        "dt", media, SOURCE_FILE, _kind(df).alias("kind"), F.col(LINE_TEXT).alias("text")
    )


def file_counts(df: DataFrame) -> DataFrame:
    """(dt, media_id, source_file, records, broken, partial) per file; media_id is that of the directory or of the records."""
    kind = _kind(df)
    return df.groupBy("dt", SOURCE_FILE).agg(
        F.min("media_id").alias("media_id"),
        F.count(F.lit(1)).alias("records"),
        F.count_if(kind == "broken").alias("broken"),
        F.count_if(kind == "partial").alias("partial"),
    )
