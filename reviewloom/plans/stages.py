"""The batch flow: raw -> processed -> predictions -> reports.

Every stage is one table, written once and read by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import business, ml, text, topics
from ..operators.filters import derive_sentiment, encode_labels, stratified_split
from ..schema import DEFAULTS, Settings
from ..sources.readers import parse_review_date
from ..sources.writers import (
    save_load_model,
    write_eval_summary,
    write_stage,
    write_summary_json,
    write_topic_report,
)


def build_processed(spark: SparkSession, raw: DataFrame, root: str, cfg: Settings = DEFAULTS) -> DataFrame:
    processed = text.preprocess(parse_review_date(raw), cfg)
    write_stage(processed, f"{root}/processed")
    return spark.read.parquet(f"{root}/processed")


def build_predictions(
    spark: SparkSession, processed: DataFrame, root: str, cfg: Settings = DEFAULTS, trees: int = 100,
    min_df: float = 5,
) -> DataFrame:
    """Train on four fifths, compare the models on the rest, and score every review."""
    labelled = processed
    if "true_sentiment" not in processed.columns:
        labelled = derive_sentiment(processed).withColumnRenamed("sentiment", "true_sentiment")
    labelled = stratified_split(labelled.where(F.col("true_sentiment").isNotNull()))
    vectorizer = ml.tfidf_vectorize(labelled.where("is_train"), cfg.max_features, min_df=min_df)
    vectorizer = save_load_model(vectorizer, f"{root}/models/vectorizer")
    features = vectorizer.transform(encode_labels(labelled))
    features.select("review_id", "label", "is_train", "features").write.mode("overwrite").parquet(f"{root}/features")
    features = spark.read.parquet(f"{root}/features")
    train, test = features.where("is_train"), features.where(~F.col("is_train"))
    forest = save_load_model(ml.train_random_forest(train, trees), f"{root}/models/random_forest")
    svm = save_load_model(ml.train_linear_svm(train), f"{root}/models/linear_svm")
    tested = {
        name: model.transform(test).select("label", F.col("prediction").cast("int").alias("prediction"))
        for name, model in (("random_forest", forest), ("linear_svm", svm))
    }
    write_eval_summary(ml.compare_models(tested), f"{root}/model_comparison")
    # The table has a row per model; the most accurate one scores, of equals the first by name.
    compared = spark.read.option("header", True).csv(f"{root}/model_comparison")
    best = compared.orderBy(F.desc(F.col("accuracy").cast("double")), "model").first()["model"]
    scored = ml.predict_with_confidence({"random_forest": forest, "linear_svm": svm}[best], vectorizer.transform(processed))
    scores = ["predicted_sentiment", "confidence_score"]  # those of an earlier run are replaced
    columns = [*[c for c in processed.columns if c not in scores], *scores]
    write_stage(scored.select(*columns), f"{root}/predictions")
    return spark.read.parquet(f"{root}/predictions")


def build_reports(predictions: DataFrame, root: str, cfg: Settings = DEFAULTS) -> DataFrame:
    sections = topics.topic_report(predictions, cfg.topics)
    write_topic_report(sections, f"{root}/topics")
    summary = business.executive_summary(predictions, sections["trending"], cfg)
    write_summary_json(summary, f"{root}/executive_summary")
    return summary


def run_all(spark: SparkSession, raw: DataFrame, root: str, cfg: Settings = DEFAULTS, **kw) -> DataFrame:
    processed = build_processed(spark, raw, root, cfg)
    predictions = build_predictions(spark, processed, root, cfg, **kw)
    return build_reports(predictions, root, cfg)
