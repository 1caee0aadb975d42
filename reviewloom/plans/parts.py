"""Rows dealt over tasks by the amount of text, so that the memory of a task does not grow with the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHARS = 1 << 21


def parts_by_text(df: DataFrame, text_col: str, chars: int = CHARS) -> int:
    """How many partitions of about ``chars`` characters the texts make; one a core at least."""
    total = df.agg(F.sum(F.length(text_col).cast("long")).alias("n")).first()["n"] or 0
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-total // chars))


def together(df: DataFrame, key: str, text_col: str, chars: int = CHARS) -> DataFrame:
    """The rows of a key in one partition, about ``chars`` characters of text in each.

    Aggregates and windows by the key, or by the key and more, then need no further shuffle. The number is
    given, so it is not lowered to what would be few large tasks once the texts are exploded.
    """
    return df.repartition(parts_by_text(df, text_col, chars), key)
