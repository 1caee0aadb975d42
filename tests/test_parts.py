"""Texts are dealt once by key; what is made of them stays inside the tasks."""

import pytest
from pyspark.sql import functions as F

from reviewloom.catalog import QUERIES
from reviewloom.operators import keywords as M
from reviewloom.operators import text
from reviewloom.plans.parts import parts_by_text, together
from reviewloom.streaming.monitors import sliding_counts
from tests.sessions import make_session


@pytest.fixture(scope="module")
def spark():
    return make_session()


@pytest.fixture
def tables(spark, tmp_path):
    rows = [(i, f"Large batteries of the unit {i % 7} last long. Batteries are large!", "en", "web", 60) for i in range(40)]
    table = spark.createDataFrame(rows + rows[:1], "doc_id long, text string, lang string, source string, n_chars int")
    table.repartition(20).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 40, 2)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def shuffles(df):
    """How often rows move."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_partitions_grow_with_the_text(spark):
    texts = spark.createDataFrame([(i % 50, "x" * 1000) for i in range(200)] + [(None, None)], "k int, t string")
    assert parts_by_text(texts, "t", 10_000) == 20
    dealt = together(texts, "k", "t", 10_000).select("k", F.spark_partition_id().alias("p")).distinct().collect()
    assert len({r.k for r in dealt}) == len(dealt)


def test_ngrams_move_texts_only(spark, tables):
    result = QUERIES["ngrams"](spark, tables)
    assert shuffles(result) == 1
    assert {r.review_id: r.n for r in result.collect()}[0] == 2 * result.where("review_id = 1").first().n


def test_key_phrases_move_texts_only(spark, tables):
    result = QUERIES["doc_keywords"](spark, tables)
    assert shuffles(result) == 1 and result.select("review_id").distinct().count() == 40


def test_a_phrase_has_consecutive_places(spark):
    text = "Solar panel costs. Panel and solar; solar panel. İzmir panel"
    rows = M.doc_keywords(spark.createDataFrame([(1, text), (None, text)], "review_id int, review_text string"), k=50, dedup=1.0).collect()
    phrases = {r.phrase for r in rows}
    # A stop word or the end of a sentence parts a phrase; so does a word that lower case cuts in two.
    assert {"solar panel", "panel costs", "solar panel costs", "solar solar", "solar solar panel"} == {p for p in phrases if " " in p}
    assert {r.review_id for r in rows} == {1}


def test_lemmas_move_texts_only(spark, tables):
    result = QUERIES["lemmatize_table"](spark, tables)
    # The texts, with and without those that have no id.
    assert shuffles(result) <= 2 and result.count() == 41
    assert "T1 unit 3" in result.where("review_id = 3").first().cleaned_text


def test_a_table_of_many_files_is_streamed(spark, tables):
    result = QUERIES["stream_trending_terms"](spark, tables)
    assert result.where("rank = 1").first().n > 0
    # Negative are ids whose remainder by seven is 0 or 1.
    assert QUERIES["stream_category_issues"](spark, tables).count() == sum(i % 7 <= 1 for i in [*range(40), 0])


def test_windows_are_sums_of_slides(spark):
    rows = [("2024-01-01 00:00:00", "a", 2), ("2024-01-03 00:00:00", "a", 5)]
    counts = spark.createDataFrame(rows, "t string, term string, n long").selectExpr("CAST(t AS TIMESTAMP) AS slide_start", "term", "n")
    got = {r.d: r.n for r in sliding_counts(counts, "3 days", "1 day").selectExpr("date_format(window_start, 'MM-dd') AS d", "n").collect()}
    assert got == {"12-30": 2, "12-31": 2, "01-01": 7, "01-02": 5, "01-03": 5}
    with pytest.raises(ValueError):
        sliding_counts(counts, "3 days", "2 days")


def test_texts_are_dealt_before_valence(spark, monkeypatch):
    """The tasks do not depend on how many files the texts come from."""
    rows = [(i, f"not a good unit {i}, but great! " * 40) for i in range(64)] + [(None, None)]
    df = spark.createDataFrame(rows, "review_id long, review_text string").coalesce(1)
    plain = sorted(map(str, text.row_polarity(df).collect()))
    monkeypatch.setattr(text, "parts_by_text", lambda df, col: parts_by_text(df, col, 4_000))
    for scores in (text.row_polarity, text.all_features):
        given = df.withColumn("rating", F.lit(5)).withColumn("helpful_count", F.lit(1)).withColumn("verified_purchase", F.lit(True)) if scores is text.all_features else df
        parts = scores(given).select(F.spark_partition_id().alias("p"), F.length("review_text").alias("n")).groupBy("p").agg(F.sum("n").alias("n")).collect()
        assert len(parts) > 16 and max(r.n or 0 for r in parts) < 12_000
    assert sorted(map(str, text.row_polarity(df).collect())) == plain
