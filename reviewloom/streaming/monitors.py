"""Monitors over a stream of reviews.

The review stream has the columns of the review table; ``review_date`` is the event
time. Each monitor maps a streaming frame to a streaming frame.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import labels as L
from ..functions.text import exploded, gram_tokens
from ..functions.wordlists import ENGLISH_STOP_WORDS, URGENT_WORDS
from ..operators.filters import urgent_keyword_flag
from ..plans.scratch import is_folder, scratch_path

# Read by Spark when a stream starts.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
STATE_ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_review_stream(
    spark: SparkSession, path: str, schema: T.StructType, table: str | None = None
) -> DataFrame:
    """New Parquet files of a folder as a stream; with ``table``, those of that name in it, a file or a folder of files."""
    reader = spark.readStream.schema(schema)
    if table:
        # A folder is streamed itself; the name of a file is matched in its parent, which a stream has to read.
        if is_folder(spark, f"{path}/{table}"):
            return reader.parquet(f"{path}/{table}")
        reader = reader.option("pathGlobFilter", table)
    return reader.parquet(path)


def _timed(stream: DataFrame, watermark: str) -> DataFrame:
    return stream.withColumn("review_date", F.col("review_date").cast("timestamp")).withWatermark(
        "review_date", watermark
    )


def _windowed(stream: DataFrame, window: str, watermark: str, slide: str | None, *by: str) -> DataFrame:
    span = F.window("review_date", window, slide) if slide else F.window("review_date", window)
    return (
        _timed(stream, watermark)
        .groupBy(span, *by)
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(L.sentiment_is("negative")).alias("negative"))
    )


def stream_negative_rate(
    stream: DataFrame, window: str = "1 day", watermark: str = "1 hour"
) -> DataFrame:
    """Negative rate per tumbling window and category."""
    return _windowed(stream, window, watermark, None, "category").select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "category",
        "n",
        (F.col("negative") / F.col("n")).alias("negative_rate"),
    )


def stream_sentiment_drop(rates: DataFrame, drop: float = 0.10) -> DataFrame:
    """Windows whose negative rate rose by more than ``drop`` over the one before.

    ``rates`` streams the table that ``stream_negative_rate`` appends to: one row per
    closed window and category, so the groups are short. The state keeps the last
    rate of a category.
    """

    def compare(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        closed = pd.concat(list(batches)).sort_values("window_start")
        previous = closed["negative_rate"].shift(1)
        if last is not None:
            previous.iloc[0] = last
        state.update((float(closed["negative_rate"].iloc[-1]),))
        change = closed["negative_rate"] - previous
        yield closed.assign(category=key[0], change=change, alert=change > drop)[
            ["category", "window_start", "negative_rate", "change", "alert"]
        ]

    return rates.groupBy("category").applyInPandasWithState(
        compare,
        "category string, window_start timestamp, negative_rate double, change double, alert boolean",
        "rate double",
        "append",
        GroupStateTimeout.NoTimeout,
    )


def stream_volume(
    stream: DataFrame, window: str = "1 hour", slide: str = "15 minutes", watermark: str = "1 hour"
) -> DataFrame:
    """Reviews per sliding window and category."""
    return _windowed(stream, window, watermark, slide, "category").select(
        F.col("window.start").alias("window_start"), "category", "n"
    )


def stream_volume_anomaly(volumes: DataFrame, z: float = 3.0) -> DataFrame:
    """The volume of each window against the running mean of its category.

    ``volumes`` streams the table that ``stream_volume`` appends to. The state holds
    count, mean and squared deviation of the windows seen so far.
    """

    def compare(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        count, mean, m2 = state.get if state.exists else (0, 0.0, 0.0)
        closed = pd.concat(list(batches)).sort_values("window_start")
        scores = []
        for n in closed["n"]:
            std = (m2 / (count - 1)) ** 0.5 if count > 1 else 0.0
            scores.append((n - mean) / std if std > 0 else None)
            count += 1
            delta = n - mean
            mean += delta / count
            m2 += delta * (n - mean)
        state.update((int(count), float(mean), float(m2)))
        z_score = pd.Series(scores, index=closed.index, dtype="float64")
        yield closed.assign(category=key[0], z_score=z_score, alert=z_score.abs() > z)[
            ["category", "window_start", "n", "z_score", "alert"]
        ]

    return volumes.groupBy("category").applyInPandasWithState(
        compare,
        "category string, window_start timestamp, n bigint, z_score double, alert boolean",
        "count bigint, mean double, m2 double",
        "append",
        GroupStateTimeout.NoTimeout,
    )


def stream_trending_terms(
    stream: DataFrame, window: str = "7 days", slide: str = "1 day", watermark: str = "1 day",
    text_col: str = "review_text",
) -> DataFrame:
    """Term counts per slide of a sliding window; ``sliding_counts`` adds them up to windows where they are stored.

    So a term is in the state once, not once for each window. A slide stays open as long as a window with it does.
    """
    tokens = gram_tokens(F.col(text_col), ENGLISH_STOP_WORDS)
    span, step, late = _micros(stream.sparkSession, window, slide, watermark)
    terms = exploded(_timed(stream, f"{span - step + late} microseconds"), tokens, "review_date")
    return (
        terms.groupBy(F.window("review_date", slide), "term")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("slide_start"), "term", "n")
    )


def _micros(spark: SparkSession, *intervals: str) -> list[int]:
    epoch = "TIMESTAMP '1970-01-01 00:00:00Z'"
    return list(spark.sql("SELECT " + ", ".join(f"unix_micros({epoch} + INTERVAL {i})" for i in intervals)).first())


def sliding_counts(counts: DataFrame, window: str = "7 days", slide: str = "1 day") -> DataFrame:
    """Term counts of all sliding windows from those of their slides; the window is a multiple of the slide."""
    span, step = _micros(counts.sparkSession, window, slide)
    if span % step:
        raise ValueError("the window must be a multiple of the slide")
    starts = [F.timestamp_micros(F.unix_micros("slide_start") - i * step) for i in range(span // step)]
    spread = counts.select(F.explode(F.array(*starts)).alias("window_start"), "term", "n")
    return spread.groupBy("window_start", "term").agg(F.sum("n").alias("n"))


def top_terms(counts: DataFrame, k: int = 10) -> DataFrame:
    window = Window.partitionBy("window_start").orderBy(F.desc("n"), F.asc("term"))
    return counts.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def stream_category_issues(
    stream: DataFrame, categories: DataFrame, keywords: Sequence[str] = URGENT_WORDS,
    text_col: str = "review_text",
) -> DataFrame:
    """Negative reviews with what a table says of their category, if anything; urgent ones flagged."""
    negative = stream.where(L.sentiment_is("negative"))
    joined = negative.join(categories, "category", "left")
    return urgent_keyword_flag(joined, keywords, col=text_col)


def stream_session(stream: DataFrame, gap: str = "30 minutes", watermark: str = "1 hour") -> DataFrame:
    """Bursts of reviews per product: a session ends after a gap without any."""
    return (
        _timed(stream, watermark)
        .groupBy(F.session_window("review_date", gap).alias("s"), "product_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "product_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n"
        )
    )


def stream_dedup(stream: DataFrame, id_col: str = "review_id", watermark: str = "1 hour") -> DataFrame:
    return _timed(stream, watermark).dropDuplicatesWithinWatermark([id_col])


def _run(result: DataFrame, timeout: int) -> str:
    path = scratch_path(result.sparkSession, "stream")
    query = (
        result.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{path}-progress")
        .trigger(availableNow=True)
        .start(path)
    )
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError("the stream did not finish")
    return path


def run_available(result: DataFrame, timeout: int = 600) -> DataFrame:
    """Run an append-mode stream over what is there now into a table, and read it."""
    path = _run(result, timeout)
    return result.sparkSession.read.schema(result.schema).parquet(path)


def restream(result: DataFrame, timeout: int = 600) -> DataFrame:
    """Run an append-mode stream into a table, and stream that table."""
    path = _run(result, timeout)
    return read_review_stream(result.sparkSession, path, result.schema)


def run_available_updates(result: DataFrame, keys: Sequence[str], timeout: int = 600) -> DataFrame:
    """Run an update-mode stream over what is there now; the newest row per key stands.

    Every batch is a folder of its own, so a repeated batch replaces itself. The state is kept on
    disk, as it has a row for each key.
    """
    spark = result.sparkSession
    path = scratch_path(spark, "stream")

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    provider = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, STATE_ON_DISK)
    try:
        query = (
            result.writeStream.foreachBatch(store)
            .outputMode("update")
            .option("checkpointLocation", f"{path}-progress")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(STATE_STORE, provider)
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError("the stream did not finish")
    schema = T.StructType(result.schema.fields + [T.StructField("batch", T.IntegerType())])
    rows = spark.read.schema(schema).parquet(path) if is_folder(spark, path) else spark.createDataFrame([], schema)
    values = [c for c in result.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v"))
    return newest.select(*keys, "v.*")
