"""What several operators share: tables, word patterns, digests."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that end a word: space and \x09-\x0D (all ASCII, so bytes and characters agree).
SPACES = bytes([0x20, *range(0x09, 0x0E)])
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sha256(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def let(value: Column, body) -> Column:
    """``body(value)`` with value computed once per row, whatever the number of its uses."""
    return F.transform(F.array(value), body)[0]


def arrow_rows(batch, *names: str):
    """The named columns of an Arrow batch as Python rows."""
    return zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names), strict=True)
