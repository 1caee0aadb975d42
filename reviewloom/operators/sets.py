"""Unions, distinct values and keyword set differences."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_rules(*rules: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, rules)


def union_hierarchy(df: DataFrame) -> DataFrame:
    """All reviews, categories, and sentiments in categories as (label, parent, n) rows.

    The table is aggregated once, to the finest level; the others add that up.
    """
    fine = df.groupBy("category", "predicted_sentiment").agg(F.count(F.lit(1)).alias("n"))
    root = fine.agg(F.sum("n").alias("n")).select(
        F.lit("All Reviews").alias("label"), F.lit("").alias("parent"), "n"
    )
    categories = fine.groupBy("category").agg(F.sum("n").alias("n")).select(
        F.col("category").alias("label"), F.lit("All Reviews").alias("parent"), "n"
    )
    leaves = fine.select(
        F.initcap("predicted_sentiment").alias("label"), F.col("category").alias("parent"), "n"
    )
    return union_rules(root, categories, leaves)


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The values of each column as (column, value) rows."""
    cells = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                for c in cols
            ]
        )
    )
    return df.select(cells.alias("r")).select("r.*").where(F.col("value").isNotNull()).distinct()


def new_vs_old_terms(recent_kw: DataFrame, older_kw: DataFrame) -> DataFrame:
    """Recent terms, marked as new or common to both periods."""
    recent, older = recent_kw.select("term"), older_kw.select("term")
    new = recent.join(older, "term", "left_anti").withColumn("kind", F.lit("new"))
    common = recent.intersect(older).withColumn("kind", F.lit("common"))
    return new.unionByName(common)


def concat_keyword_lists(category_kw: DataFrame, sentiment: str = "negative") -> DataFrame:
    """The keyword lists of all categories one after the other."""
    return category_kw.where(F.col("sentiment") == sentiment).select("category", "rank", "term")
