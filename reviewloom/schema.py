"""Table schemas, label codes and settings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Sentiment labels and their numeric codes.
SENTIMENTS = ("negative", "neutral", "positive")
LABEL_CODES = {"negative": 0, "neutral": 1, "positive": 2}

RAW = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("rating", T.IntegerType()),
        T.StructField("review_text", T.StringType()),
        T.StructField("review_date", T.TimestampNTZType()),
        T.StructField("verified_purchase", T.BooleanType()),
        T.StructField("helpful_count", T.IntegerType()),
        T.StructField("review_length", T.IntegerType()),
        T.StructField("true_sentiment", T.StringType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("is_holiday_season", T.BooleanType()),
    ]
)

PROCESSED = T.StructType(
    RAW.fields
    + [T.StructField("cleaned_text", T.StringType())]
    + [
        T.StructField(name, T.IntegerType())
        for name in (
            "char_count",
            "word_count",
            "exclamation_count",
            "question_count",
            "positive_word_count",
            "negative_word_count",
        )
    ]
    + [
        T.StructField(name, T.DoubleType())
        for name in ("avg_word_length", "caps_ratio", "textblob_polarity", "textblob_subjectivity")
    ]
    + [
        T.StructField(name, T.IntegerType())
        for name in ("review_hour", "review_dayofweek", "review_month", "is_weekend")
    ]
)

PREDICTIONS = T.StructType(
    PROCESSED.fields
    + [
        T.StructField("predicted_sentiment", T.StringType()),
        T.StructField("confidence_score", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class Settings:
    """Thresholds and weights used by the report operators."""

    min_words: int = 5
    max_words: int = 1500
    rating_weight: float = 0.3
    text_weight: float = 0.7
    satisfaction_goal: float = 0.8
    critical_positive_rate: float = 0.3
    confidence_threshold: float = 0.8
    trend_days: int = 30
    order_value: float = 75.0
    lifetime_value: float = 500.0
    negative_multiplier: float = 2.5
    uplift: float = 0.1
    churn_share: float = 0.3
    programme_cost: float = 50000.0
    max_features: int = 17000
    topics: int = 12
    min_topic_size: int = 50


DEFAULTS = Settings()
