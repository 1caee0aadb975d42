"""Filters, predicates and row-level labels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.text import text_or_empty
from ..functions.wordlists import HIGH_VALUE_CATEGORIES, URGENT_WORDS
from ..plans.ordered import split_by_hash

BANDS = ((0.0, 0.2), (0.2, 0.4), (0.4, 0.6), (0.6, 0.8), (0.8, 1.0))


def panel_condition(
    date_range=None,
    categories=None,
    sentiments=None,
    rating_range=None,
    min_confidence=None,
    verified_only=False,
) -> Column:
    """The conjunction of the conditions that are set; dates count as whole days."""
    conditions = []
    if date_range is not None:
        first, last = (F.lit(d).cast("date") for d in date_range)
        # A half-open range on the raw column, so that it reaches the scan.
        conditions += [
            F.col("review_date") >= first.cast("timestamp_ntz"),
            F.col("review_date") < F.date_add(last, 1).cast("timestamp_ntz"),
        ]
    if categories is not None:
        conditions.append(F.col("category").isin(list(categories)))
    if sentiments is not None:
        conditions.append(F.col("predicted_sentiment").isin(list(sentiments)))
    if rating_range is not None:
        conditions.append(F.col("rating").between(*rating_range))
    if min_confidence is not None:
        conditions.append(F.col("confidence_score") >= min_confidence)
    if verified_only:
        conditions.append(F.col("verified_purchase"))
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def filter_panel(df: DataFrame, **spec) -> DataFrame:
    return df.where(panel_condition(**spec))


def filter_share(df: DataFrame, **spec) -> DataFrame:
    """How many rows the panel keeps, in one pass over the table."""
    kept = F.count_if(F.coalesce(panel_condition(**spec), F.lit(False)))
    return df.agg(
        kept.alias("filtered"),
        F.count(F.lit(1)).alias("total"),
        F.try_divide(kept * F.lit(100.0), F.count(F.lit(1))).alias("shown_pct"),
    )


def length_filter(df: DataFrame, lo: int = 5, hi: int = 1500) -> DataFrame:
    return df.where(F.col("word_count").between(lo, hi))


def keyword_search(
    df: DataFrame, pattern: str, cols: Sequence[str] = ("review_text", "cleaned_text")
) -> DataFrame:
    """Case-insensitive regex search in any of the columns; null does not match."""
    hit = reduce(
        lambda a, b: a | b,
        [F.coalesce(F.col(c).rlike(f"(?i){pattern}"), F.lit(False)) for c in cols],
    )
    return df.where(hit)


def urgent_reviews(df: DataFrame, t: float = 0.8) -> DataFrame:
    return df.where(L.sentiment_is("negative") & (F.col("confidence_score") > t))


def misaligned_reviews(df: DataFrame) -> DataFrame:
    return df.where(L.misaligned(F.col("rating"), F.col("predicted_sentiment")))


def confidence_band(df: DataFrame, lo: float, hi: float) -> DataFrame:
    return df.where((F.col("confidence_score") >= lo) & (F.col("confidence_score") < hi))


def confidence_bands(df: DataFrame) -> DataFrame:
    """Rows per band of a fifth each; a confidence of exactly 1 is in none."""
    c = F.col("confidence_score")
    index = F.when((c >= BANDS[0][0]) & (c < BANDS[0][1]), 0)
    for i, (lo, hi) in enumerate(BANDS[1:], 1):
        index = index.when((c >= lo) & (c < hi), i)
    return df.groupBy(index.alias("band")).agg(F.count(F.lit(1)).alias("n"))


def trend_start(df: DataFrame, days: int = 30) -> Column:
    """The newest review date less some days, as a scalar subquery."""
    newest = df.agg(F.max("review_date") - F.make_dt_interval(F.lit(days)))
    return newest.scalar()


def recent_split(df: DataFrame, days: int = 30) -> DataFrame:
    """Mark each review as in the recent period (the limit belongs to it) or older."""
    return df.withColumn("is_recent", F.col("review_date") >= trend_start(df, days))


def recent_negative_alert(df: DataFrame, days: int = 30, factor: float = 1.2) -> DataFrame:
    negative = L.sentiment_is("negative")
    recent = F.col("review_date") > trend_start(df, days)
    rates = df.agg(
        F.avg(F.when(recent, F.when(negative, 1.0).otherwise(0.0))).alias("recent_negative"),
        L.share(negative).alias("overall_negative"),
    )
    return rates.withColumn(
        "alert",
        F.coalesce(F.col("recent_negative") > F.col("overall_negative") * factor, F.lit(False)),
    )


def derive_sentiment(df: DataFrame) -> DataFrame:
    return df.withColumn("sentiment", L.from_rating(F.col("rating")))


def encode_labels(df: DataFrame, col: str = "true_sentiment", out: str = "label") -> DataFrame:
    return df.withColumn(out, L.encode(F.col(col)))


def decode_labels(df: DataFrame, col: str = "label", out: str = "sentiment") -> DataFrame:
    return df.withColumn(out, L.decode(F.col(col)))


def sentiment_score(df: DataFrame, scale: str = "unit") -> DataFrame:
    return df.withColumn("sentiment_score", L.score(F.col("predicted_sentiment"), scale))


def rating_sentiment_aligned(df: DataFrame) -> DataFrame:
    flag = L.aligned(F.col("rating"), F.col("predicted_sentiment")).cast("int")
    return df.withColumn("rating_sentiment_aligned", flag)


def stratified_split(
    df: DataFrame, label: str = "true_sentiment", test: float = 0.2, seed: int = 42,
    key: str = "review_id",
) -> DataFrame:
    """Mark an exact share of every label as training rows, the same on every run."""
    return split_by_hash(df, label, key, 1.0 - test, seed)


def sample_rows(df: DataFrame, n: int = 5, seed: int = 42, key: str = "review_id") -> DataFrame:
    """n rows in hash order; all of them when there are no more."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def verified_only(df: DataFrame, verified: bool = True) -> DataFrame:
    return df.where(F.col("verified_purchase") if verified else ~F.col("verified_purchase"))


def null_text_guard(df: DataFrame, col: str = "review_text") -> DataFrame:
    return df.withColumn(col, text_or_empty(F.col(col)))


def urgent_keyword_flag(
    df: DataFrame,
    keywords: Sequence[str] = URGENT_WORDS,
    high_value: Sequence[str] = HIGH_VALUE_CATEGORIES,
    col: str = "review_text",
) -> DataFrame:
    lowered = F.lower(text_or_empty(F.col(col)))
    urgent = reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(k)) for k in keywords])
    return df.withColumns(
        {"is_urgent": urgent, "is_high_value": F.col("category").isin(list(high_value))}
    )


def critical_category(df: DataFrame, t: float = 0.3) -> DataFrame:
    rates = df.groupBy("category").agg(
        L.share(L.sentiment_is("positive")).alias("positive_rate"),
        F.count(F.lit(1)).alias("review_count"),
    )
    return rates.where(F.col("positive_rate") < t)
