"""Sorted and limited results. Every order ends in a unique column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from .filters import keyword_search
from .timeseries import monthly_positive


def review_explorer(
    df: DataFrame,
    term: str | None = None,
    sort_by: str = "review_date",
    ascending: bool = False,
    n: int = 20,
    cols=("review_text", "cleaned_text"),
) -> DataFrame:
    """The first n matching reviews by one column."""
    found = keyword_search(df, term, cols) if term else df
    order = F.asc(sort_by) if ascending else F.desc(sort_by)
    return found.orderBy(order, "review_id").limit(n)


def topk_keywords(kw: DataFrame, k: int) -> DataFrame:
    return kw.orderBy(F.desc("score"), "term").limit(k)


def topk_trending(kw: DataFrame, t: float = 0.5, k: int = 20) -> DataFrame:
    return kw.where(F.col("trend_score") > t).orderBy(F.desc("trend_score"), "term").limit(k)


def peak_low_months(df: DataFrame, n: int = 3) -> DataFrame:
    months = monthly_positive(df)
    peak = months.orderBy(F.desc("positive_rate"), "month").limit(n)
    low = months.orderBy("positive_rate", "month").limit(n)
    return peak.select(F.lit("peak").alias("kind"), "month", "positive_rate").unionByName(
        low.select(F.lit("low").alias("kind"), "month", "positive_rate")
    )


def worst3_categories(df: DataFrame, t: float = 0.3) -> DataFrame:
    """The three most negative categories, with advice for those above the threshold."""
    worst = (
        df.groupBy("category")
        .agg(L.share(L.sentiment_is("negative")).alias("negative_rate"))
        .orderBy(F.desc("negative_rate"), "category")
        .limit(3)
    )
    advice = F.format_string(
        "**%s**: %.1f%% negative reviews - Immediate quality review recommended",
        F.col("category"),
        F.bround(F.col("negative_rate") * 100, 1),
    )
    return worst.where(F.col("negative_rate") > t).withColumn("recommendation", advice)


def top_features(importances: DataFrame, n: int = 20) -> DataFrame:
    return importances.orderBy(F.desc("score"), "feature").limit(n)


def top5_recommendations(recommendations: DataFrame) -> DataFrame:
    return recommendations.orderBy("rule_order").limit(5)
