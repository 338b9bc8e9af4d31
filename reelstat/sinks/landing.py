"""Bronze landing: records as JSON lines under `dt` and, unless a day has too many of them, `media_id`."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.functions.typing import day_literal
from reelstat.operators.profiling import landing_summary
from reelstat.sinks.tables import cluster, shuffles_removed
from reelstat.sources.files import join

# Upper bound of one compressed file, which a single task reads: some 150 MB of text.
PAGE_ROWS = 500_000


def as_json_lines(df: DataFrame) -> DataFrame:
    """(dt, media_id, value): the record with its media_id as one JSON text, NULLs and non-ASCII text kept."""
    body = F.struct(*[F.col(f"`{name}`") for name in df.columns if name != "dt"])
    return df.select("dt", "media_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def land_bronze(
    df: DataFrame,
    root: str,
    dataset: str,
    day: str | date | None = None,
    media_ids: Iterable[str] | None = None,
    page_rows: int = 0,
    media_dirs: bool = True,
    compression: str = "none",
) -> DataFrame:
    """Replace the (dt, media_id) directories present in the frame; return the landing summary (rows, bytes per media).

    Each run writes files of new names, so a stream over the folder sees re-landed days. `day` stamps the batch
    day when the frame has no `dt`. Media that were asked for and have no records are in the summary with 0 rows.
    `page_rows` limits the records of one file; 0 leaves the size to the write, or to PAGE_ROWS where files are compressed.
    `media_dirs=False` replaces whole `dt` directories, whose files hold many media each, for days with many thousand
    media: media_id is then that of the record. `read_bronze` gives the same rows either way. Do not land single media
    into a day that was landed so. Each task writes what it holds, by day and media: the records are not shuffled, and as
    text they exist in the files only.
    `compression` is a codec of Spark's text files, such as `gzip`; readers know it by the files' names.
    """
    df = df if day is None else df.withColumn("dt", day_literal(day))
    lines = as_json_lines(df)
    by = ["dt", "media_id"] if media_dirs else ["dt"]
    placed = cluster(lines, "dt", "media_id") if media_dirs else as_json_lines(df.sortWithinPartitions("dt", "media_id"))
    with shuffles_removed(df.sparkSession):
        (
            placed.select(*by, "value")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", page_rows or (0 if compression == "none" else PAGE_ROWS))
            .option("compression", compression)
            .partitionBy(*by)
            .text(join(root, dataset))
        )
    return landing_summary(lines, media_ids)
