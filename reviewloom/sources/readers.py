"""Reading review tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import PREDICTIONS


def scan_reviews(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = PREDICTIONS
) -> DataFrame:
    """Read a review table with its schema declared, so no inference pass is needed."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    return reader.format(fmt).load(path)


def parse_review_date(df: DataFrame, col: str = "review_date") -> DataFrame:
    """Turn a textual date into a timestamp; what is no date becomes null."""
    if isinstance(df.schema[col].dataType, T.StringType):
        return df.withColumn(col, F.try_to_timestamp(F.col(col)).cast("timestamp_ntz"))
    return df.withColumn(col, F.col(col).cast("timestamp_ntz"))
