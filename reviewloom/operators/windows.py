"""Window functions over aggregated series.

Windows without a partition key run on days, weeks or categories only, of which
there are few whatever the number of reviews.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import labels as L
from ..plans.ordered import top_rows
from .filters import trend_start
from .timeseries import daily_volume


def _series(order: Column | str) -> Window:
    return Window.partitionBy(F.lit(0)).orderBy(order)


def rolling_7(df: DataFrame) -> DataFrame:
    """Daily volume with the mean of the last seven rows, null before the seventh."""
    frame = _series("day").rowsBetween(-6, 0)
    mean = F.when(F.count("n").over(frame) == 7, F.avg("n").over(frame))
    return daily_volume(df).withColumn("rolling_mean", mean)


def trend_4w(weekly: DataFrame) -> DataFrame:
    """Mean positive rate of the last four weeks against the four before."""
    age = F.row_number().over(_series(F.desc("week_end")))
    rates = weekly.withColumn("age", age).agg(
        F.avg(F.when(F.col("age") <= 4, F.col("positive_rate"))).alias("recent_rate"),
        F.avg(F.when(F.col("age").between(5, 8), F.col("positive_rate"))).alias("previous_rate"),
    )
    better = F.coalesce(F.col("recent_rate") > F.col("previous_rate"), F.lit(False))
    return rates.withColumn("trend", F.when(better, "improving").otherwise("declining"))


def anomaly_weeks(weekly: DataFrame, z: float = 2) -> DataFrame:
    """Weeks more than z population standard deviations from the mean."""
    whole = Window.partitionBy(F.lit(0))
    score = F.try_divide(
        F.col("positive_rate") - F.avg("positive_rate").over(whole),
        F.stddev_pop("positive_rate").over(whole),
    )
    return (
        weekly.select("week_end", "positive_rate", score.alias("z_score"))
        .where(F.abs("z_score") > z)
    )


def topn_per_group(df: DataFrame, by: str, score: str, n: int, tiebreak: str = "term") -> DataFrame:
    return top_rows(df, [by], [F.desc(score), F.asc(tiebreak)], n)


def model_rank(metrics: DataFrame) -> DataFrame:
    """Rank of every model for every metric of a (model, metric, value) table."""
    window = Window.partitionBy("metric").orderBy(F.desc("value"), F.asc("model"))
    return metrics.withColumn("rank", F.row_number().over(window))


def share_of_total(df: DataFrame, by: Sequence[str], value: str = "n") -> DataFrame:
    return df.withColumn("share", F.col(value) / F.sum(value).over(Window.partitionBy(*by)))


def priority_matrix(df: DataFrame) -> DataFrame:
    """Categories by business impact and effort, against the median impact."""
    table = df.groupBy("category").agg(
        F.count(F.lit(1)).alias("volume"),
        L.share(L.sentiment_is("negative")).alias("negative_rate"),
        F.avg("rating").alias("avg_rating"),
    )
    table = table.select(
        "category",
        "volume",
        (F.col("negative_rate") * 100).alias("negative_pct"),
        (F.col("volume") * F.col("negative_rate")).alias("impact"),
        ((5 - F.col("avg_rating")) / 5 * 100).alias("effort"),
    )
    high = F.col("impact") > table.agg(F.median("impact")).scalar()
    easy = F.col("effort") < 50
    order = F.when(easy & high, 1).when(high, 2).when(easy, 3).otherwise(4)
    names = ("Quick Win", "Major Project", "Fill-in", "Low Priority")
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("priority_order"))
    return (
        table.withColumn("priority_order", order)
        .withColumn("priority", label)
        .orderBy("priority_order", F.desc("impact"), "category")
    )


def category_trend(df: DataFrame, days: int = 30) -> DataFrame:
    """Change of each category's negative rate from the period before to the latest one."""
    ts = F.col("review_date")
    middle, start = trend_start(df, days), trend_start(df, 2 * days)
    negative = F.when(L.sentiment_is("negative"), 1.0).otherwise(0.0)
    return (
        df.groupBy("category")
        .agg(
            F.avg(F.when(ts > middle, negative)).alias("recent_negative"),
            F.avg(F.when((ts > start) & (ts <= middle), negative)).alias("prior_negative"),
        )
        .withColumn("trend", F.col("recent_negative") - F.col("prior_negative"))
    )


def month_over_prior(df: DataFrame, drop: float = 0.10) -> DataFrame:
    """Weekly negative rate, its change from the week before, and an alert on a large rise."""
    weeks = df.groupBy(D.week_start(F.col("review_date")).alias("week")).agg(
        L.share(L.sentiment_is("negative")).alias("negative_rate")
    )
    change = F.col("negative_rate") - F.lag("negative_rate").over(_series("week"))
    return weeks.withColumn("change", change).withColumn(
        "alert", F.coalesce(F.col("change") > drop, F.lit(False))
    )


def volume_anomaly(df: DataFrame, days: int = 28) -> DataFrame:
    """Daily volume as a z-score against the days before it."""
    before = _series("day").rowsBetween(-days, -1)
    return daily_volume(df).withColumn(
        "z_score",
        F.try_divide(F.col("n") - F.avg("n").over(before), F.stddev_samp("n").over(before)),
    )
