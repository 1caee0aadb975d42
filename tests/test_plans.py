import random

import numpy as np
from pyspark.sql import functions as F

from reviewloom.operators import evaluation, joins, ml, timeseries, topics, windows
from reviewloom.plans import ordered


def skewed(spark, n=4000):
    """Values of which a third are equal, in two groups of unequal size."""
    rng = random.Random(7)
    rows = [
        (i, "a" if rng.random() < 0.9 else "b", 5.0 if rng.random() < 0.34 else rng.random() * 10)
        for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, "id long, g string, v double")


def test_quantiles_match_numpy(spark):
    rows, df = skewed(spark)
    got = {(r.g, r.probability): r.value for r in ordered.quantiles(df, ["g"], "v", (0.0, 0.1, 0.5, 0.75, 1.0)).collect()}
    for g in "ab":
        values = [v for _, k, v in rows if k == g]
        for p in (0.0, 0.1, 0.5, 0.75, 1.0):
            assert abs(got[g, p] - np.quantile(values, p)) < 1e-9


def test_running_totals(spark):
    rows, df = skewed(spark, 1500)
    counts = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = ordered.running_totals(counts, "v", ["n"], ["g"], descending=True, ranges=16).collect()
    for r in got[:300]:
        assert r.cum_n == sum(1 for _, g, v in rows if g == r.g and v >= r.v)


def test_split_and_rank_are_exact(spark):
    rows, df = skewed(spark)
    split = ordered.split_by_hash(df, "g", "id", 0.8)
    got = {(r.g, r.is_train): r.n for r in split.groupBy("g", "is_train").agg(F.count(F.lit(1)).alias("n")).collect()}
    for g in "ab":
        size = sum(1 for r in rows if r[1] == g)
        assert got[g, True] == round(size * 0.8) and got[g, True] + got[g, False] == size
    ranks = [r.hash_rank for r in ordered.rank_by_hash(df, "g", "id").where("g = 'b'").collect()]
    assert sorted(ranks) == list(range(len(ranks)))
    folds = ml.with_folds(df, "g", 5, 42, "id").groupBy("g", "fold").count().collect()
    for g in "ab":
        sizes = [r["count"] for r in folds if r.g == g]
        assert max(sizes) - min(sizes) <= 1


def test_top_rows_beyond_the_limit(spark):
    _, df = skewed(spark)
    order = [F.desc("v"), F.asc("id")]
    small = ordered.top_rows(df, ["g"], order, 5).collect()
    large = ordered.top_rows(df, ["g"], order, 1500).where("rank <= 5").collect()
    assert sorted(small) == sorted(large)
    plan = ordered.top_rows(df, ["g"], order, 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_auc_against_pairs(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 2), round(rng.random(), 2)) for _ in range(500)]
    df = spark.createDataFrame(rows, "label int, score double")
    pos, neg = [s for y, s in rows if y == 2], [s for y, s in rows if y != 2]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert abs(evaluation.roc_auc(df).first().roc_auc - wins) < 1e-9
    points = evaluation.roc_points(df).collect()
    assert sum(r.threshold == float("inf") for r in points) == 1
    assert evaluation.binary_auc(df).first().roc_auc is None


def test_calibration_edges(spark):
    df = spark.createDataFrame([(1, 1, 0.0), (1, 1, 0.1), (1, 0, 1.0)], "label int, prediction int, confidence double")
    assert {r.bin for r in evaluation.calibration(df).collect()} == {0, 9}


def test_trend_score(spark):
    recent = spark.createDataFrame([("a", 0.3), ("b", 0.3)], "term string, score double")
    older = spark.createDataFrame([("a", 0.2)], "term string, score double")
    got = {r.term: r.trend_score for r in joins.trend_score(recent, older).collect()}
    assert abs(got["a"] - 0.5) < 1e-9 and abs(got["b"] - 299) < 1e-9


def test_weekly_gaps(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-01-07 10:00:00', 'positive', 5, 't'),
        (TIMESTAMP_NTZ'2024-01-08 00:00:00', 'negative', 1, 't'), (TIMESTAMP_NTZ'2024-01-24 00:00:00', 'positive', 4, 't')
        AS d(review_date, predicted_sentiment, rating, review_text)"""
    )
    weeks = timeseries.weekly_sentiment(df).orderBy("week_end").collect()
    assert [(str(r.week_end), r.positive_rate, r.avg_rating) for r in weeks] == [
        ("2024-01-07", 1.0, 5.0), ("2024-01-14", 0.0, 1.0), ("2024-01-21", 0.0, None), ("2024-01-28", 1.0, 4.0),
    ]
    assert windows.trend_4w(timeseries.weekly_sentiment(df)).first().trend == "declining"


def test_topics_from_a_table(spark):
    docs = spark.createDataFrame([(1, "Good battery"), (2, "bad screen"), (3, None)], "review_id int, cleaned_text string")
    table = spark.createDataFrame([("battery",), ("ba",)], "topic string")
    got = sorted((r.review_id, r.topic) for r in joins.topic_mentions(docs, table).select("review_id", "topic").collect())
    assert got == [(1, "ba"), (1, "battery"), (2, "ba")]
    pairs = {(r.topic_a, r.topic_b): r.together for r in topics.topic_cooccurrence(docs, table).collect()}
    assert pairs["ba", "battery"] == 1 and pairs["ba", "ba"] == 2


def test_summary_reads_the_reviews_once(spark):
    from reviewloom.catalog.base import Views
    from reviewloom.operators import business
    from sessions import SF

    views = Views(spark, SF)
    row = business.executive_summary(views.reviews, text_col="product_name", report_date="2024-05-01")
    plan = row._jdf.queryExecution().toString()
    assert "lineitem" not in plan and "part.parquet" not in plan
    assert row.first().report_date == "2024-05-01"
    assert "lineitem" not in business.recommendations(views.reviews, text_col="product_name")._jdf.queryExecution().toString()


def test_histograms_are_made_once(spark):
    _, df = skewed(spark)
    df.createOrReplaceTempView("skewed_rows")
    plan = ordered.quantiles(spark.table("skewed_rows"), ["g"], "v", (0.5,))._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" not in plan and "Scan ExistingRDD" not in plan
    scores = df.select(F.col("v").alias("score"), (F.col("id") % 3).cast("int").alias("label"))
    assert "Scan ExistingRDD" not in evaluation.roc_auc(scores)._jdf.queryExecution().executedPlan().toString()
