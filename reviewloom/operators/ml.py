"""Sentiment models on TF-IDF features."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    ElementwiseProduct,
    Normalizer,
    SQLTransformer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.text import GRAM_TOKEN, gram_tokens
from ..plans.ordered import rank_by_hash
from ..plans.scratch import materialize
from .evaluation import headline_metrics
from .forest import Forest
from .kernels import with_class_weights
from .neighbours import mutual_information
from .vocabulary import gram_vocabulary, vocabulary_counter


#: MB of histograms that Spark's trainer would hold for a pass, about. While all open nodes fit, features are drawn in its order.
HISTOGRAM_MB = 256


def _gram_sql(text_col: str, lo: int, hi: int) -> str:
    """The n-gram column as SQL, so that it can be a saved stage of the model."""
    pattern = GRAM_TOKEN.replace("\\", "\\\\")
    tokens = f"regexp_extract_all(lower(coalesce({text_col}, '')), '{pattern}', 0)"
    parts = []
    for n in range(lo, hi + 1):
        count = f"greatest(size(__t) - {n - 1}, 0)"
        gram = f"slice(__t, 1, {count})"
        for start in range(2, n + 1):
            gram = f"zip_with({gram}, slice(__t, {start}, {count}), (a, b) -> concat_ws(' ', a, b))"
        parts.append(gram)
    return (
        f"SELECT * EXCEPT (__t), concat({', '.join(parts)}) AS grams"
        f" FROM (SELECT *, {tokens} AS __t FROM __THIS__)"
    )


def tfidf_vectorize(
    df: DataFrame, max_features: int = 17000, ngram_range=(1, 3), min_df: float = 5,
    max_df: float = 0.95, text_col: str = "cleaned_text",
) -> PipelineModel:
    """Fit text -> L2-normalised TF-IDF ``features``.

    Inverse document frequencies are ln((1+n)/(1+df)) + 1, from the counts of the vocabulary.
    Every stage is a built-in transformer and can be saved.
    """
    grams = SQLTransformer(statement=_gram_sql(text_col, *ngram_range))
    words = gram_tokens(F.col(text_col)).alias("tokens")
    tokens = materialize(df.select(F.monotonically_increasing_id().alias("doc"), words), "tokens")
    terms, docs = gram_vocabulary(tokens, max_features, ngram_range, min_df, max_df, key="doc")
    counter = vocabulary_counter([t for t, _ in terms])
    idf = [math.log((1 + docs) / (1 + n)) + 1 for _, n in terms]
    scale = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="counts", outputCol="weighted")
    unit = Normalizer(p=2.0, inputCol="weighted", outputCol="features")
    drop = SQLTransformer(statement="SELECT * EXCEPT (grams, counts, weighted) FROM __THIS__")
    return PipelineModel(stages=[grams, counter, scale, unit, drop])


def random_forest(n: int = 100, seed: int = 42, max_depth: int = 30, label: str = "label") -> Forest:
    """The untrained forest; 30 is the largest depth that Spark grows."""
    return Forest(
        featuresCol="features", labelCol=label, numTrees=n, seed=seed, maxDepth=max_depth,
        maxMemoryInMB=HISTOGRAM_MB, cacheNodeIds=False,
    )


def train_random_forest(
    features: DataFrame, n: int = 100, seed: int = 42, max_depth: int = 30, label: str = "label", balanced: bool = False
) -> Model:
    """A forest of n trees. ``balanced`` weighs classes alike."""
    forest = random_forest(n, seed, max_depth, label)
    if balanced:
        return forest.setWeightCol("weight").fit(with_class_weights(features, label))
    return forest.fit(features)


def train_linear_svm(features: DataFrame, label: str = "label", iterations: int = 50, balanced: bool = False) -> Model:
    svm = LinearSVC(featuresCol="features", maxIter=iterations, regParam=0.01)
    machine = OneVsRest(classifier=svm, featuresCol="features", labelCol=label)
    if balanced:
        return machine.setWeightCol("weight").fit(with_class_weights(features, label))
    return machine.fit(features)


def predict(model: Model, df: DataFrame) -> DataFrame:
    """Add ``predicted_sentiment``."""
    scored = model.transform(df)
    return scored.withColumn("predicted_sentiment", L.decode(F.col("prediction").cast("int")))


def predict_with_confidence(model: Model, df: DataFrame) -> DataFrame:
    """Add ``predicted_sentiment`` and ``confidence_score``, the largest class probability.

    A model without probabilities gets the softmax of its raw scores.
    """
    scored = predict(model, df)
    if "probability" in scored.columns:
        top = F.array_max(vector_to_array("probability"))
    else:
        raw = vector_to_array("rawPrediction")
        peak = F.array_max(raw)
        top = 1 / F.aggregate(raw, F.lit(0.0), lambda a, x: a + F.exp(x - peak))
    return scored.withColumn("confidence_score", top)


def score_batch(
    df: DataFrame, load_model: Callable[[], object], cols: Sequence[str], key: str = "review_id"
) -> DataFrame:
    """Score with any model object, in Arrow batches; it is loaded once per task.

    The object's ``predict_proba`` takes the pandas columns and returns one row of
    class probabilities per review, ordered as the label codes.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for batch in batches:
            probabilities = model.predict_proba(batch[list(cols)])
            yield pd.DataFrame(
                {
                    key: batch[key],
                    "prediction": probabilities.argmax(axis=1),
                    "confidence_score": probabilities.max(axis=1),
                }
            )

    key_type = df.schema[key].dataType.simpleString()
    return df.select(key, *[c for c in cols if c != key]).mapInPandas(
        run, f"{key} {key_type}, prediction int, confidence_score double"
    )


def ensemble_vote(
    scores: DataFrame, weights: Mapping[str, float], key: str = "review_id", disagree: float = 0.3
) -> DataFrame:
    """Weighted soft vote over (key, model, label, probability) rows, one for each class of a model.

    A label's probability is the sum of weight times probability over all models, divided by the weight
    of the models that the key has; a class that a model leaves out has probability 0. The flag is
    set when the models' probabilities of the winner differ by more than ``disagree``. All
    votes on a key, models times classes, are one row.
    """
    weight = reduce(
        lambda acc, item: F.when(F.col("model") == item[0], item[1]).otherwise(acc),
        weights.items(),
        F.lit(None).cast("double"),
    )
    votes = (
        scores.withColumn("w", weight)
        .where(F.col("w").isNotNull() & F.col("label").isNotNull())
        .groupBy(key)
        .agg(
            F.collect_set(F.struct("model", "w")).alias("models"),
            F.collect_list(F.struct("label", (F.col("w") * F.col("probability")).alias("wp"), "probability")).alias("votes"),
        )
    )
    total = F.aggregate("models", F.lit(0.0), lambda acc, m: acc + m["w"])
    # The largest probability wins; of equal ones the smaller number or the larger name.
    tie = (lambda x: x * -1) if _numeric(scores, "label") else (lambda x: x)

    def tally(label: Column) -> Column:
        own = F.filter("votes", lambda x: x["label"] == label)
        p = F.aggregate(own, F.lit(0.0), lambda acc, x: acc + x["wp"]) / F.col("total")
        each = F.transform(own, lambda x: x["probability"])
        least = F.when(F.size(own) < F.size("models"), F.lit(0.0)).otherwise(F.array_min(each))
        return F.struct(
            F.round(p, 12).alias("rounded"), tie(label).alias("tie"), label.alias("label"), p.alias("p"),
            (F.array_max(each) - least).alias("spread"),
        )

    labels = F.array_distinct(F.transform("votes", lambda x: x["label"]))
    best = F.array_max(F.transform(labels, tally))
    return votes.withColumn("total", total).withColumn("best", best).select(
        key, F.col("best.label").alias("label"), F.col("best.p").alias("probability"),
        (F.col("best.spread") > disagree).alias("disagreement"),
    )


def _numeric(df: DataFrame, col: str) -> bool:
    return df.schema[col].dataType.typeName() not in ("string", "boolean")


def compare_models(predictions: Mapping[str, DataFrame]) -> DataFrame:
    """Headline metrics and the precision of each class of every model, the best first."""
    rows = [headline_metrics(pred, name, by_class=True) for name, pred in predictions.items()]
    return reduce(DataFrame.unionByName, rows).orderBy(F.desc("accuracy"), "model")


def with_folds(df: DataFrame, label: str, folds: int, seed: int, key: str) -> DataFrame:
    """A fold number per row: the labels are dealt evenly over the folds, in hash order."""
    ranked = rank_by_hash(df, label, key, seed)
    return ranked.withColumn("fold", F.pmod("hash_rank", F.lit(folds)).cast("int")).drop("hash_rank")


def cross_validate(
    pipeline: Estimator, df: DataFrame, folds: int = 5, seed: int = 42, label: str = "label",
    key: str = "review_id", parallelism: int = 3,
) -> DataFrame:
    """Accuracy and macro precision, recall and F1 per fold, with their mean, population
    deviation and mean ± 2 deviations. So many folds are trained at a time."""
    folded = materialize(with_folds(df, label, folds, seed, key), "folds")

    def of_fold(i: int) -> DataFrame:
        model = pipeline.copy().fit(folded.where(F.col("fold") != i))
        held = model.transform(folded.where(F.col("fold") == i)).select(
            F.col(label).cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")
        )
        return headline_metrics(held, str(i))

    with ThreadPoolExecutor(parallelism) as pool:
        rows = list(pool.map(inheritable_thread_target(df.sparkSession)(of_fold), range(folds)))
    cells = F.explode(
        F.array(
            *[
                F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
                for m in ("accuracy", "precision", "recall", "f1")
            ]
        )
    )
    scores = reduce(DataFrame.unionByName, rows).select(F.col("model").cast("int").alias("fold"), cells.alias("c"))
    by_metric = Window.partitionBy("metric")
    mean, std = F.avg("value").over(by_metric), F.stddev_pop("value").over(by_metric)
    return scores.select("fold", "c.*").select(
        "metric", "fold", "value", mean.alias("mean"), std.alias("std"),
        (mean - 2 * std).alias("low"), (mean + 2 * std).alias("high"),
    )


def feature_importance(model: Model, vocabulary: Sequence[str], spark, n: int = 20) -> DataFrame:
    """The n most important terms of a fitted forest."""
    weights = model.featureImportances
    rows = [(vocabulary[int(i)], float(v)) for i, v in zip(weights.indices, weights.values)]
    table = spark.createDataFrame(rows, "feature string, score double")
    return table.orderBy(F.desc("score"), "feature").limit(n)


def mutual_info_select(
    df: DataFrame, features: Sequence[str], label: str, neighbours: int = 3, n: int = 50, key: str = "review_id"
) -> DataFrame:
    """The n features with most mutual information with the label, estimated by nearest neighbours."""
    scores = mutual_information(df, features, label, neighbours, key)
    return scores.orderBy(F.desc(F.round("score", 9)), "feature").limit(n)


def grid_search(
    pipeline: Estimator, grid: Mapping, df: DataFrame, folds: int = 3, seed: int = 42,
    label: str = "label", key: str = "review_id", parallelism: int = 2,
) -> tuple[Model, DataFrame]:
    """The best model over a parameter grid, and the mean accuracy of every point."""
    builder = ParamGridBuilder()
    for param, values in grid.items():
        builder = builder.addGrid(param, values)
    points = builder.build()
    evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    search = CrossValidator(
        estimator=pipeline, estimatorParamMaps=points, evaluator=evaluator, numFolds=folds,
        foldCol="fold", parallelism=parallelism,
    )
    folded = materialize(with_folds(df, label, folds, seed, key), "folds")
    fitted = search.fit(folded)
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in point.items()), float(score))
        for point, score in zip(points, fitted.avgMetrics)
    ]
    table = df.sparkSession.createDataFrame(rows, "params string, accuracy double")
    return fitted.bestModel, table.orderBy(F.desc("accuracy"), "params")


