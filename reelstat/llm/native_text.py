"""Text columns from built-in functions only, and names for helper columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = "[\\x20\\x09-\\x0D]+"
NOT_ALNUM = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def unused(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of the table has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and nothing else. `lower` does that for pure ASCII, and much faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column, between: str = SPACE) -> Column:
    """What stands between the separators; null text: no words."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), between), "")
