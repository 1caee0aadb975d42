"""Queries of sections J, O and A: models, user functions, sources and sinks."""

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import filters as B
from ..operators import joins as C
from ..operators import ml as J
from ..operators import ranking as R
from ..operators import udfs as O
from ..operators.kernels import train_kernel_svm
from ..plans.scratch import materialize, scratch_path
from ..sources import readers, versions, writers
from ..schema import SENTIMENTS
from .aggregates import PERFORMANCE, rate
from .base import query
from .evaluation import METRICS, headline_sql


def _features(v, min_df=5):
    """Labelled reviews as (review_id, label, is_train, features), and the vectorizer."""
    labelled = v.cleaned.where(F.col("true_sentiment").isNotNull())
    labelled = materialize(B.stratified_split(labelled), "labelled")
    vectorizer = J.tfidf_vectorize(labelled.where("is_train"), min_df=min_df)
    encoded = vectorizer.transform(B.encode_labels(labelled))
    return materialize(encoded.select("review_id", "label", "is_train", "features"), "features"), vectorizer


def _forest(v):
    """The forest of 100 trees with its features and vectorizer."""
    features, vectorizer = _features(v)
    return J.train_random_forest(features.where("is_train")), features, vectorizer


def _scored(v, score):
    """Every review of the table, scored by the forest."""
    model, _, vectorizer = _forest(v)
    return score(model, vectorizer.transform(v.cleaned))


def _tested(model, features):
    return model.transform(features.where(~F.col("is_train"))).select(
        "review_id", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")
    )


@query("tfidf_vectorize")
def _(v):
    features, _ = _features(v)
    values = vector_to_array("features")
    norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda a, x: a + x * x))
    return features.select("review_id", "label", "is_train", norm.alias("norm"))


@query("train_random_forest")
def _(v):
    model, features, _ = _forest(v)
    return _tested(model, features)


@query("train_linear_svm")
def _(v):
    features, _ = _features(v)
    return _tested(J.train_linear_svm(features.where("is_train")), features)


@query("train_kernel_svm")
def _(v):
    """Predictions and probabilities of the rows that were not learned from."""
    features, _ = _features(v)
    model = train_kernel_svm(features.where("is_train"), folds=3)
    scored = model.transform(features.where(~F.col("is_train")))
    p = vector_to_array("probability")
    return scored.select(
        "review_id", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"),
        *[F.get(p, F.lit(c)).alias(f"p_{name}") for c, name in enumerate(SENTIMENTS)],
    )


@query("predict")
def _(v):
    return _scored(v, J.predict).select("review_id", "predicted_sentiment")


@query("predict_with_confidence")
def _(v):
    return _scored(v, J.predict_with_confidence).select("review_id", "predicted_sentiment", "confidence_score")


@query("attach_predictions")
def _(v):
    model, features, vectorizer = _forest(v)
    scored = C.attach_predictions(vectorizer.transform(v.cleaned), model)
    return scored.select("review_id", "category", "prediction")


@query("save_load_model")
def _(v):
    model, features, _ = _forest(v)
    loaded = writers.save_load_model(model, scratch_path(v.spark, "model"))
    before = _tested(model, features)
    after = _tested(loaded, features).select("review_id", F.col("prediction").alias("reloaded"))
    return before.join(after, "review_id").select("review_id", (F.col("prediction") == F.col("reloaded")).alias("same"))


class LengthModel:
    """A stand-in for a user's model object: class odds from the text length."""

    def predict_proba(self, frame: pd.DataFrame) -> np.ndarray:
        size = frame["cleaned_text"].str.len().to_numpy(dtype="float64")
        odds = np.stack([1 + size % 3, 1 + size % 5, 1 + size % 7], axis=1)
        return odds / odds.sum(axis=1, keepdims=True)


@query(
    "score_batch",
    """WITH s AS (SELECT review_id, 1 + length(cleaned_text) % 3 AS a, 1 + length(cleaned_text) % 5 AS b, 1 + length(cleaned_text) % 7 AS c FROM cleaned)
    SELECT review_id, CASE WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 1 ELSE 2 END::INT AS prediction,
    round(greatest(a, b, c) / (a + b + c)::DOUBLE, 6) AS confidence_score FROM s""",
    "cleaned",
)
def _(v):
    return J.score_batch(v.cleaned, LengthModel, ["cleaned_text"])


@query(
    "ensemble_vote",
    """WITH b AS (SELECT review_id, 'random_forest' AS model, 0.2::DOUBLE AS w, predicted_sentiment AS best, confidence_score AS p, false AS alone FROM reviews
     UNION ALL SELECT review_id, 'svm', 0.15, true_sentiment, 0.6, false FROM reviews
     UNION ALL SELECT review_id, 'transformer', 0.4, 'neutral', rating / 10.0::DOUBLE, true FROM reviews WHERE rating <> 2),
    c AS (SELECT unnest(['negative', 'neutral', 'positive']) AS label),
    s AS (SELECT review_id, model, w, label, CASE WHEN label = best THEN p WHEN alone THEN 0 ELSE (1 - p) / 2 END AS p FROM b, c),
    l AS (SELECT review_id, label, sum(w * p) / sum(w) AS p, max(p) - min(p) AS spread FROM s GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY round(p, 12) DESC, label DESC) AS r FROM l)
    SELECT review_id, label, round(p, 6) AS probability, spread > 0.3 AS disagreement FROM r WHERE r = 1""",
)
def _(v):
    # Two models give all classes; the third names one class only, and says nothing of rating 2.
    cells = [F.struct(F.lit("transformer").alias("model"), F.lit("neutral").alias("label"), (F.col("rating") / 10).alias("probability"))]
    for name, best, p in (
        ("random_forest", F.col("predicted_sentiment"), F.col("confidence_score")), ("svm", F.col("true_sentiment"), F.lit(0.6))
    ):
        for label in SENTIMENTS:
            odds = F.when(best == label, p).otherwise((1 - p) / 2)
            cells.append(F.struct(F.lit(name).alias("model"), F.lit(label).alias("label"), odds.alias("probability")))
    scores = v.reviews.select("review_id", "rating", F.explode(F.array(*cells)).alias("s")).select("review_id", "rating", "s.*")
    scores = scores.where("model <> 'transformer' OR rating <> 2")
    return J.ensemble_vote(scores, {"random_forest": 0.2, "svm": 0.15, "lstm": 0.25, "transformer": 0.4})


COMPARED = {"all": "true", "confident": "confidence >= 0.8"}


@query(
    "compare_models",
    f"""WITH {headline_sql(COMPARED)} SELECT model, {", ".join(f"round({m}, 6) AS {m}" for m in METRICS)},
    {", ".join(f"round(p_{s}, 6) AS precision_{s}" for s in SENTIMENTS)} FROM h""",
    "pred",
)
def _(v):
    table = J.compare_models({"all": v.pred, "confident": v.pred.where("confidence >= 0.8")})
    each = [F.col("class_precision")[s].alias(f"precision_{s}") for s in SENTIMENTS]
    return table.select("model", *METRICS, *each)


@query("cross_validate")
def _(v):
    features, _ = _features(v)
    return J.cross_validate(J.random_forest(), features.select("review_id", "label", "features"), 5)


@query("feature_importance")
def _(v):
    model, _, vectorizer = _forest(v)
    return J.feature_importance(model, vectorizer.stages[1].vocabulary, v.spark)


@query("top_features")
def _(v):
    model, _, vectorizer = _forest(v)
    return R.top_features(J.feature_importance(model, vectorizer.stages[1].vocabulary, v.spark, 100), 20)


MI_COLS = ("rating", "helpful_count", "confidence_score")


def _digamma_sql(n):
    y = f"({n} + 6)::DOUBLE"
    steps = " ".join(f"- 1 / ({n} + {i})::DOUBLE" for i in range(6))
    return f"(ln({y}) - 1 / (2 * {y}) - 1 / (12 * {y} ** 2) + 1 / (120 * {y} ** 4) - 1 / (252 * {y} ** 6) {steps})"


_NEAR = ", ".join(f"abs(x - lag(x, {i}) OVER w), abs(lead(x, {i}) OVER w - x)" for i in (1, 2, 3))


@query(
    "mutual_info_select",
    "WITH f AS (" + " UNION ALL ".join(f"SELECT true_sentiment AS label, '{c}' AS feature, CAST({c} AS DOUBLE) AS value, review_id FROM reviews" for c in MI_COLS)
    + f"""), s AS (SELECT feature, CASE WHEN max(abs(value)) > 0 THEN 2.0::DOUBLE ** (32 - ceil(log2(max(abs(value))))) ELSE 1.0 END AS scale FROM f GROUP BY 1),
    x AS (SELECT feature, label, CAST(floor(value * scale + 0.5) AS BIGINT) * 268435456 + CAST('0x' || substr(md5(review_id || ':' || feature), 1, 7) AS BIGINT) AS x
     FROM f JOIN s USING (feature)),
    d AS (SELECT feature, label, x, count(*) OVER (PARTITION BY feature, label) AS n,
     list_sort(list_filter([{_NEAR}], lambda v: v IS NOT NULL)) AS near FROM x WINDOW w AS (PARTITION BY feature, label ORDER BY x)),
    k AS (SELECT *, least(3, n - 1) AS k, greatest(near[least(3, n - 1)] - 1, 0) AS reach FROM d WHERE n > 1),
    m AS (SELECT *, count(*) OVER (PARTITION BY feature ORDER BY x RANGE BETWEEN reach PRECEDING AND reach FOLLOWING) AS m FROM k)
    SELECT feature, round(greatest({_digamma_sql("count(*)")} + avg({_digamma_sql("k")}) - avg({_digamma_sql("n")}) - avg({_digamma_sql("m")}), 0), 6) + 0.0::DOUBLE AS score FROM m GROUP BY 1""",
)
def _(v):
    return J.mutual_info_select(v.reviews, MI_COLS, "true_sentiment")


@query("grid_search")
def _(v):
    features, _ = _features(v)
    svm = LinearSVC(featuresCol="features", maxIter=50)
    model = OneVsRest(classifier=svm, featuresCol="features", labelCol="label")
    _, table = J.grid_search(model, {svm.regParam: [0.01, 0.1, 1.0]}, features.select("review_id", "label", "features"), 3)
    return table


@query("udf_text_feature", "SELECT review_id, round(length(replace(cleaned_text, 'e', '')) / greatest(length(cleaned_text), 1)::DOUBLE, 6) AS feature FROM cleaned", "cleaned")
def _(v):
    fn = O.udf_text_feature(lambda t: len(t.replace("e", "")) / max(len(t), 1))
    return v.cleaned.select("review_id", fn("cleaned_text").alias("feature"))


@query("udaf_rate", f"SELECT product_id, round({rate('negative')}, 6) AS rate FROM reviews GROUP BY 1")
def _(v):
    return v.reviews.groupBy("product_id").agg(O.udaf_rate(F.col("predicted_sentiment") == "negative").alias("rate"))


@query(
    "udtf_keywords",
    """WITH t AS (SELECT review_id, regexp_extract_all(cleaned_text, '[a-z0-9_]{4,}') AS t FROM cleaned),
    w AS (SELECT review_id, unnest(t) AS term, len(t) AS n FROM t), c AS (SELECT review_id, term, count(*) / any_value(n)::DOUBLE AS score, count(*) AS k FROM w GROUP BY 1, 2)
    SELECT review_id, term, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY k DESC, term) AS r FROM c) WHERE r <= 5""",
    "cleaned",
)
def _(v):
    keywords = O.udtf_keywords(5)
    return v.cleaned.select("review_id", "cleaned_text").lateralJoin(keywords(F.col("cleaned_text").outer())).select("review_id", "term", "score")


@query("udf_multi_feature", "SELECT review_id, length(cleaned_text)::INT AS chars, contains(cleaned_text, 'the') AS has_the FROM cleaned", "cleaned")
def _(v):
    text = F.col("cleaned_text")
    return O.udf_multi_feature(
        v.cleaned.select("review_id", "cleaned_text"), {"chars": F.length(text), "has_the": F.contains(text, F.lit("the"))}
    ).drop("cleaned_text")


@query("apply_per_group", "SELECT product_id, count(*) AS n, round(median(rating), 6) AS mid FROM reviews GROUP BY 1")
def _(v):
    def middle(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"product_id": [group["product_id"].iloc[0]], "n": [len(group)], "mid": [group["rating"].median()]})

    return O.apply_per_group(v.reviews.select("product_id", "rating"), "product_id", middle, "product_id bigint, n bigint, mid double")


@query("versioned_stages", "SELECT true_sentiment, predicted_sentiment, count(*) AS n FROM reviews GROUP BY 1, 2")
def _(v):
    """Labels and predictions as stages of their own, joined bucket by bucket."""
    labels, predictions = scratch_path(v.spark, "labels"), scratch_path(v.spark, "predictions")
    versions.write_version(v.reviews.select("review_id", "true_sentiment"), labels)
    versions.write_version(v.reviews.select("review_id", "predicted_sentiment"), predictions)
    return versions.agreement(versions.join_stages(versions.read_version(v.spark, labels), versions.read_version(v.spark, predictions)))


def _fields(df):
    return df.select("review_id", "product_id", "category", "rating", "review_date", "verified_purchase")


SCAN_SQL = "SELECT review_id, product_id, category, rating, strftime(review_date, '%Y-%m-%d %H:%M:%S') AS review_date, verified_purchase FROM reviews"


@query("scan_reviews", SCAN_SQL)
def _(v):
    rows = _fields(v.reviews)
    return readers.scan_reviews(v.spark, _written(rows), schema=rows.schema)


def _written(rows):
    path = scratch_path(rows.sparkSession, "scan")
    rows.write.parquet(path)
    return path


@query("scan_reviews_csv", SCAN_SQL)
def _(v):
    rows = _fields(v.reviews)
    path = scratch_path(v.spark, "scan-csv")
    rows.write.option("header", True).csv(path)
    return readers.scan_reviews(v.spark, path, "csv", rows.schema)


@query("parse_review_date", "SELECT review_id, strftime(review_date, '%Y-%m-%d %H:%M:%S') AS review_date FROM review_events", "review_events")
def _(v):
    text = v.events.select("review_id", F.date_format("review_date", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("review_date"))
    return readers.parse_review_date(text)


@query("write_stage", "SELECT category, count(*) AS n, round(avg(rating), 6) AS avg_rating FROM reviews GROUP BY 1")
def _(v):
    path = scratch_path(v.spark, "written")
    writers.write_stage(_fields(v.reviews), path)
    return v.spark.read.parquet(path).groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.avg("rating").alias("avg_rating"))


@query("write_summary_json", PERFORMANCE)
def _(v):
    performance = A.category_performance(v.reviews)
    path = scratch_path(v.spark, "summary")
    writers.write_summary_json(performance, path)
    return v.spark.read.schema(performance.schema).json(path)


@query("export_filtered_csv", "SELECT review_id, rating FROM reviews WHERE rating >= 4 AND verified_purchase")
def _(v):
    kept = B.filter_panel(v.reviews, rating_range=(4, 5), verified_only=True).select("review_id", "rating")
    path = writers.export_filtered_csv(kept, scratch_path(v.spark, "export"))
    return v.spark.read.schema(kept.schema).option("header", True).csv(path)


@query("write_eval_summary", f"WITH {headline_sql({'all': 'true'})} SELECT model, {', '.join(f'round({m}, 6) AS {m}' for m in METRICS)} FROM h", "pred")
def _(v):
    path = scratch_path(v.spark, "metrics")
    metrics = J.compare_models({"all": v.pred})
    writers.write_eval_summary(metrics, path)
    schema = "model string, accuracy double, precision double, recall double, f1 double"
    return v.spark.read.schema(schema).option("header", True).csv(path)
