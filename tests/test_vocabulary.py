"""Pruned vocabularies against counts of all n-grams, and what is fitted on them."""

import math
import random
from collections import Counter

import pytest
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from reviewloom.functions.text import gram_tokens, ngrams
from reviewloom.operators import ml as J
from reviewloom.operators import topics as T
from reviewloom.operators import vocabulary
from reviewloom.operators.vocabulary import gram_vocabulary


def plain_counts(texts, lo, hi):
    tf, df = Counter(), Counter()
    for text in texts:
        t = (text or "").split()
        grams = [" ".join(t[i : i + n]) for n in range(lo, hi + 1) for i in range(len(t) - n + 1)]
        tf.update(grams)
        df.update(set(grams))
    return tf, df


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    return [" ".join(f"w{min(int(rng.expovariate(0.25)), 40)}" for _ in range(rng.randrange(0, 60))) for _ in range(200)] + ["", None, "w1 w1 w1 w1"]


@pytest.fixture(scope="module")
def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "review_id long, cleaned_text string").repartition(4)


@pytest.mark.parametrize(("span", "min_df", "max_df"), [((1, 3), 5, 0.95), ((1, 1), 1, 1.0), ((2, 3), 0.05, 0.5), ((1, 2), 12, 60)])
def test_equal_to_the_unpruned_one(spark, table, texts, span, min_df, max_df):
    tokens = table.select("review_id", gram_tokens(F.col("cleaned_text")).alias("tokens"))
    got, docs = gram_vocabulary(tokens, 10_000, span, min_df, max_df)
    tf, df = plain_counts(texts, *span)
    n = len(texts)
    low, high = min_df if min_df >= 1 else min_df * n, max_df * n if max_df <= 1 else max_df
    want = sorted(((t, df[t]) for t in tf if low <= df[t] <= high), key=lambda x: (-tf[x[0]], x[0]))
    assert docs == n and got == want and len(got) > 10
    assert gram_vocabulary(tokens, 7, span, min_df, max_df)[0] == want[:7]
    grams = tokens.select(ngrams(F.col("tokens"), *span).alias("grams"))
    spark_terms = CountVectorizer(inputCol="grams", outputCol="c", vocabSize=10_000, minDF=float(min_df), maxDF=float(max_df) if max_df != 1.0 else float(n)).fit(grams).vocabulary
    assert set(spark_terms) == {t for t, _ in want}


def test_vectors_of_texts(table, texts):
    model = J.tfidf_vectorize(table, min_df=5)
    terms = model.stages[1].vocabulary
    tf, df = plain_counts(texts, 1, 3)
    rows = {r.review_id: r.f for r in model.transform(table).select("review_id", vector_to_array("features").alias("f")).collect()}
    for k in (0, 7, 50, 202):
        own, _ = plain_counts([texts[k]], 1, 3)
        raw = [own[t] * (math.log((1 + len(texts)) / (1 + df[t])) + 1) for t in terms]
        norm = math.sqrt(sum(x * x for x in raw)) or 1.0
        assert rows[k] == pytest.approx([x / norm for x in raw], abs=1e-12)


def test_nothing_larger_than_the_tokens_is_written(table, monkeypatch):
    from reviewloom.operators import ml, topics, vocabulary

    written = []

    def note(df, name="stage"):
        written.append((name, set(df.columns)))
        return df.cache()

    for module in (ml, topics, vocabulary):
        monkeypatch.setattr(module, "materialize", note)
    J.tfidf_vectorize(table, min_df=5)
    T.train_lda(table, k=3, iterations=2)
    assert written and all("grams" not in columns for _, columns in written)
    assert {name for name, _ in written} == {"tokens", "counts", "level-1", "level-2", "level-3"}


def test_topics_find_separate_words(spark):
    rng = random.Random(2)
    groups = [[f"a{k}" for k in range(12)], [f"b{k}" for k in range(12)]]
    rows = [(k, " ".join(rng.choice(groups[k % 2]) for _ in range(40))) for k in range(120)]
    df = spark.createDataFrame(rows, "review_id long, cleaned_text string")
    model = T.train_lda(df, k=2, min_df=2, iterations=30, max_features=24)
    shares = {r.review_id: r.main_topic for r in T.doc_topics(model, df).collect()}
    even, odd = ({shares[k] for k in range(start, 120, 2)} for start in (0, 1))
    assert len(even) == len(odd) == 1 and even != odd
    words = {r.topic_id: set() for r in T.lda_topics(model).collect()}
    for r in T.lda_topics(model, 8).collect():
        words[r.topic_id].add(r.word[0])
    assert sorted(map(sorted, words.values())) == [["a"], ["b"]]


def test_no_terms(spark):
    df = spark.createDataFrame([(1, "one two")], "review_id long, cleaned_text string")
    with pytest.raises(ValueError, match="no term"):
        J.tfidf_vectorize(df, min_df=5)


def test_words_are_moved_once_by_document(spark, monkeypatch):
    """Pairs of neighbours and their counts per document need one exchange by the key; keys may repeat or be null."""
    plans = []
    whole = vocabulary.materialize

    def looked_at(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return whole(df, name)

    monkeypatch.setattr(vocabulary, "materialize", looked_at)
    rows = [(1, ["a", "b", "c"]), (1, ["a", "b"]), (2, ["b", "c"]), (None, ["a", "b"]), (3, []), (4, ["c"])]
    tokens = whole(spark.createDataFrame(rows, "review_id long, tokens array<string>"), "tokens")
    got = {r["term"]: (r["tf"], r["df"]) for r in vocabulary.gram_counts(tokens, 1, 2, 1).collect()}
    # Rows of one key are one document, whose neighbouring places are paired with each other.
    assert got == {"a": (3, 3), "b": (4, 4), "c": (3, 3), "a b": (4, 1), "b c": (3, 2)}
    plan = dict(plans)["level-2"]
    initial = plan.split("== Initial Plan ==")[-1]
    assert initial.count("hashpartitioning(review_id") == 1 and initial.count("hashpartitioning(") <= 2
