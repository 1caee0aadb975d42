"""Sentiment labels, scores and bands as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import LABEL_CODES


def share(condition: Column) -> Column:
    """Aggregate: the fraction of rows where the condition holds (null counts as false)."""
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)))


def sentiment_is(label: str, column: str = "predicted_sentiment") -> Column:
    return F.col(column) == label


def from_rating(rating: Column) -> Column:
    return (
        F.when(rating >= 4, "positive").when(rating <= 2, "negative").otherwise("neutral")
    )


def encode(label: Column) -> Column:
    expr = None
    for name, code in LABEL_CODES.items():
        expr = F.when(label == name, code) if expr is None else expr.when(label == name, code)
    return expr


def decode(code: Column) -> Column:
    expr = None
    for name, number in LABEL_CODES.items():
        expr = F.when(code == number, name) if expr is None else expr.when(code == number, name)
    return expr


def score(label: Column, scale: str = "unit") -> Column:
    """Numeric sentiment: 1, 0.5, 0 on the unit scale and 1, 0, -1 on the signed one."""
    low, mid = {"unit": (0.0, 0.5), "signed": (-1.0, 0.0)}[scale]
    return (
        F.when(label == "positive", F.lit(1.0))
        .when(label == "neutral", F.lit(mid))
        .when(label == "negative", F.lit(low))
    )


def aligned(rating: Column, label: Column) -> Column:
    """The sentiment agrees with the star rating."""
    return F.coalesce(from_rating(rating) == label, F.lit(False))


def misaligned(rating: Column, label: Column) -> Column:
    """High stars with negative text, or low stars with positive text."""
    return ((rating >= 4) & (label == "negative")) | ((rating <= 2) & (label == "positive"))


def traffic_light(value: Column, good: float, fair: float) -> Column:
    return F.when(value > good, "🟢").when(value > fair, "🟡").otherwise("🔴")


def csi_band(csi: Column) -> Column:
    return F.when(csi < 70, "critical").when(csi > 85, "strong").otherwise("normal")


def kpi_status(value: Column, good: float, fair: float) -> Column:
    return F.when(value >= good, "✅").when(value >= fair, "⚠️").otherwise("❌")


def gauge_band(value: Column, low: float, high: float) -> Column:
    return F.when(value < low, "red").when(value < high, "amber").otherwise("green")


def growth_mark(percentage: Column) -> Column:
    return F.when(percentage > 100, "🔥").otherwise("📈")
