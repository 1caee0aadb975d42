"""What fitted models say of data whose answer is known."""

import random

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from reviewloom.operators import joins as C
from reviewloom.operators import keywords as M
from reviewloom.operators import ml as J
from reviewloom.operators import ranking as R

WORDS = {0: "awful broken refund", 1: "okay average fine", 2: "lovely superb delight"}


@pytest.fixture(scope="module")
def reviews(spark):
    rng = random.Random(1)
    filler = [f"word{k}" for k in range(30)]
    rows = []
    for k in range(240):
        label = k % 3
        text = rng.choices(filler, k=20) + rng.choices(WORDS[label].split(), k=4)
        rng.shuffle(text)
        rows.append((k, " ".join(text), float(label), k >= 180))
    return spark.createDataFrame(rows, "review_id long, cleaned_text string, label double, held boolean").repartition(4)


@pytest.fixture(scope="module")
def fitted(reviews):
    vectorizer = J.tfidf_vectorize(reviews.where("NOT held"), min_df=3, ngram_range=(1, 1))
    features = vectorizer.transform(reviews)
    return vectorizer, features, J.train_random_forest(features.where("NOT held"), 30, max_depth=8)


def accuracy(df):
    return df.agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]


def test_forest_and_linear_machine(fitted):
    _, features, forest = fitted
    held, known = features.where("held"), features.where("NOT held")
    assert accuracy(forest.transform(held)) > 0.9
    assert accuracy(J.train_linear_svm(known).transform(held)) > 0.9


def test_histograms_are_bounded_and_forests_that_fit_stay_the_same(fitted):
    _, features, forest = fitted
    assert forest.getOrDefault("maxMemoryInMB") <= 256
    roomy = RandomForestClassifier(numTrees=30, maxDepth=8, seed=42, maxMemoryInMB=1024).fit(features.where("NOT held"))
    assert [t.toDebugString.split("\n", 1)[1] for t in forest.trees] == [t.toDebugString.split("\n", 1)[1] for t in roomy.trees]


def test_a_forest_grown_in_many_passes_is_whole(spark):
    # Rows without pattern, and more open nodes than a pass of 1 MB has room for: trees still grow until all leaves are pure.
    rng = random.Random(3)
    noise = spark.createDataFrame(
        [(Vectors.dense([rng.random() for _ in range(100)]), float(rng.randrange(3))) for _ in range(120)], ["features", "label"]
    )
    whole = J.random_forest(12).setBootstrap(False).setMaxMemoryInMB(1).fit(noise)
    assert len(whole.trees) == 12 and accuracy(whole.transform(noise)) == 1


def test_predictions_have_a_row_per_review(fitted):
    _, features, forest = fitted
    rows = J.predict_with_confidence(forest, features).collect()
    assert len(rows) == 240 and all(1 / 3 <= r.confidence_score <= 1 for r in rows)
    names = {0: "negative", 1: "neutral", 2: "positive"}
    assert all(r.predicted_sentiment == names[int(r.prediction)] for r in rows)
    assert C.attach_predictions(features, forest).count() == 240


def test_important_features_are_the_telling_words(spark, fitted):
    vectorizer, _, forest = fitted
    table = J.feature_importance(forest, vectorizer.stages[1].vocabulary, spark, 100)
    best = [r.feature for r in R.top_features(table, 9).collect()]
    assert set(best) == {w for words in WORDS.values() for w in words.split()}
    assert abs(sum(r.score for r in table.collect()) - 1) < 1e-9


def test_folds(fitted):
    _, features, _ = fitted
    forest = RandomForestClassifier(numTrees=10, maxDepth=5, seed=1)
    rows = J.cross_validate(forest, features.select("review_id", "label", "features"), 4).collect()
    assert {(r.metric, r.fold) for r in rows} == {(m, f) for m in ("accuracy", "precision", "recall", "f1") for f in range(4)}
    own = [r.value for r in rows if r.metric == "accuracy"]
    assert min(own) > 0.8 and all(abs(r["mean"] - sum(own) / 4) < 1e-12 for r in rows if r.metric == "accuracy")


def test_grid_search_prefers_the_better_point(fitted):
    _, features, _ = fitted
    forest = RandomForestClassifier(numTrees=10, seed=1)
    best, table = J.grid_search(forest, {forest.maxDepth: [1, 6]}, features.select("review_id", "label", "features"), 3)
    scores = {r.params: r.accuracy for r in table.collect()}
    assert scores["maxDepth=6"] > scores["maxDepth=1"] and max(t.depth for t in best.trees) > 1


def test_key_phrases_of_a_document(spark):
    text = "The Battery Life is short. Battery Life matters to me, and battery life was promised. The box is blue, and a box is a box."
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "review_id long, review_text string")
    rows = M.doc_keywords(df).collect()
    assert {r.review_id for r in rows} == {1} and any("battery" in str(r).lower() for r in rows)
