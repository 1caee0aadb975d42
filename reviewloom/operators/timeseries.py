"""Time buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import labels as L
from .joins import topic_mentions


def _spine(df: DataFrame, first: str, last: str, step: int, name: str) -> DataFrame:
    """Every date from the first to the last bucket of an aggregated series."""
    ends = df.agg(F.min(first).alias("lo"), F.max(last).alias("hi"))
    dates = F.sequence("lo", "hi", F.make_dt_interval(F.lit(step)))
    return ends.select(F.explode(dates).alias(name))


def weekly_sentiment(df: DataFrame, text_col: str = "review_text") -> DataFrame:
    """Weeks ending on Sunday, those without reviews included."""
    weeks = df.groupBy(D.week_end(F.col("review_date")).alias("week_end")).agg(
        L.share(L.sentiment_is("positive")).alias("positive_rate"),
        F.avg("rating").alias("avg_rating"),
        F.count(text_col).alias("review_count"),
    )
    return (
        _spine(weeks, "week_end", "week_end", 7, "week_end")
        .join(weeks, "week_end", "left")
        .na.fill({"positive_rate": 0.0, "review_count": 0})
    )


def weekly_share_monday(df: DataFrame) -> DataFrame:
    """Weekly counts and shares labelled by Monday, gaps left out."""
    week = Window.partitionBy("week")
    return (
        df.groupBy(D.week_start(F.col("review_date")).alias("week"), "predicted_sentiment")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("share", F.col("n") / F.sum("n").over(week))
    )


def weekly_share_filled(df: DataFrame) -> DataFrame:
    """Weekly shares labelled by Sunday, gaps filled with 0 inside each sentiment's span."""
    counts = df.groupBy(
        "predicted_sentiment", D.week_end(F.col("review_date")).alias("week_end")
    ).agg(F.count(F.lit(1)).alias("n"))
    spans = counts.groupBy("predicted_sentiment").agg(
        F.min("week_end").alias("lo"), F.max("week_end").alias("hi")
    )
    spine = spans.select(
        "predicted_sentiment",
        F.explode(F.sequence("lo", "hi", F.make_dt_interval(F.lit(7)))).alias("week_end"),
    )
    week = Window.partitionBy("week_end")
    return (
        spine.join(counts, ["predicted_sentiment", "week_end"], "left")
        .na.fill({"n": 0})
        .withColumn("percentage", F.try_divide(F.col("n") * F.lit(100.0), F.sum("n").over(week)))
    )


def daily_volume(df: DataFrame) -> DataFrame:
    return df.groupBy(D.day(F.col("review_date")).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def daily_sentiment(df: DataFrame) -> DataFrame:
    return df.groupBy(D.day(F.col("review_date")).alias("day"), "predicted_sentiment").agg(
        F.count(F.lit(1)).alias("n")
    )


def monthly_positive(df: DataFrame) -> DataFrame:
    """Positive rate per month of the year, all years together."""
    return df.groupBy(F.month("review_date").alias("month")).agg(
        L.share(L.sentiment_is("positive")).alias("positive_rate")
    )


def dow_hour_cells(df: DataFrame, measure: str = "pct") -> DataFrame:
    """Positive percentage or mean signed score per weekday (Monday 0) and hour."""
    value = (
        L.share(L.sentiment_is("positive")) * 100
        if measure == "pct"
        else F.avg(L.score(F.col("predicted_sentiment"), "signed"))
    )
    return df.groupBy(
        F.weekday("review_date").alias("dow"), F.hour("review_date").alias("hour")
    ).agg(value.alias("value"))


def dow_hour_heatmap(df: DataFrame, measure: str = "pct") -> DataFrame:
    """The cells as one row per weekday and one column per hour."""
    cells = dow_hour_cells(df, measure)
    return cells.groupBy("dow").agg(
        *[F.max(F.when(F.col("hour") == h, F.col("value"))).alias(f"h{h:02d}") for h in range(24)]
    )


# Day names in calendar order, Monday first.
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def dayofweek_counts(df: DataFrame) -> DataFrame:
    """Counts for all seven days; null for a day without reviews."""
    counts = df.groupBy(F.weekday("review_date").alias("dow")).agg(F.count(F.lit(1)).alias("n"))
    days = df.sparkSession.createDataFrame(list(enumerate(DAY_NAMES)), "dow int, day_name string")
    return days.join(counts, "dow", "left")


def topic_daily_prevalence(
    df: DataFrame, topics: DataFrame | Sequence[str], days: int = 30, col: str = "cleaned_text"
) -> DataFrame:
    """Share of each day's reviews that mention a topic, for the last days of the table."""
    day = D.day(F.col("review_date"))
    last = df.agg(F.to_date(F.max("review_date"))).scalar()
    recent = df.where(day > F.date_sub(last, days)).select("review_date", col)
    totals = recent.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("reviews"))
    mentions = (
        topic_mentions(recent, topics, col)
        .groupBy(day.alias("day"), "topic")
        .agg(F.count(F.lit(1)).alias("mentions"))
    )
    if isinstance(topics, DataFrame):
        listed = topics.select("topic").distinct()
    else:
        listed = df.sparkSession.createDataFrame([(t,) for t in dict.fromkeys(topics)], "topic string")
    grid = listed.select(
        "topic", F.explode(F.sequence(F.date_sub(last, days - 1), last, F.make_dt_interval(F.lit(1)))).alias("day")
    )
    return (
        grid.join(mentions, ["day", "topic"], "left")
        .join(totals, "day", "left")
        .na.fill({"mentions": 0, "reviews": 0})
        .withColumn(
            "prevalence",
            F.coalesce(F.try_divide(F.col("mentions"), F.col("reviews")), F.lit(0.0)),
        )
    )
