"""Evaluation of predictions.

Tables have ``label`` and ``prediction``, and where needed ``confidence`` (of the
prediction) or ``score`` (of the positive class).
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.ordered import running_totals
from ..plans.scratch import materialize
from ..schema import SENTIMENTS


def _contingency(pred: DataFrame) -> DataFrame:
    """Counts per (label, prediction): a handful of rows that every metric starts from."""
    return pred.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def _zero_div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def class_metrics(pred: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of every class seen in either column."""
    table = _contingency(pred)
    sides = table.select(
        F.explode(
            F.array(
                F.struct(F.col("label").cast("string").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
                F.struct(F.col("prediction").cast("string").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")),
            )
        ).alias("s"),
        F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit"),
    )
    # A correct row is seen from both sides, so its hits are halved.
    totals = sides.groupBy("s.class").agg(
        F.sum("s.support").alias("support"),
        F.sum("s.predicted").alias("predicted"),
        (F.sum("hit") / 2).alias("tp"),
    )
    precision, recall = _zero_div(F.col("tp"), F.col("predicted")), _zero_div(F.col("tp"), F.col("support"))
    return totals.select(
        "class", precision.alias("precision"), recall.alias("recall"),
        _zero_div(2 * precision * recall, precision + recall).alias("f1"),
        "support", "tp",
    )


def classification_metrics(pred: DataFrame) -> DataFrame:
    """Per-class rows, then their plain mean as 'macro' with the accuracy beside it."""
    per_class = class_metrics(pred)
    macro = per_class.agg(
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1"),
        F.sum("support").alias("support"),
        F.try_divide(F.sum("tp"), F.sum("support")).alias("accuracy"),
    )
    return per_class.select(
        "class", "precision", "recall", "f1", "support", F.lit(None).cast("double").alias("accuracy")
    ).unionByName(macro.select(F.lit("macro").alias("class"), "precision", "recall", "f1", "support", "accuracy"))


def headline_metrics(pred: DataFrame, model: str, by_class: bool = False) -> DataFrame:
    """One row for a model: accuracy and macro precision, recall and F1.

    ``by_class`` adds ``class_precision``, a map from each class to its precision.
    """
    listed = F.map_from_entries(F.array_sort(F.collect_list(F.struct("class", "precision"))))
    return class_metrics(pred).agg(
        F.try_divide(F.sum("tp"), F.sum("support")).alias("accuracy"),
        *[F.avg(m).alias(m) for m in ("precision", "recall", "f1")],
        *([listed.alias("class_precision")] if by_class else []),
    ).select(F.lit(model).alias("model"), "*")


def confusion_matrix(pred: DataFrame) -> DataFrame:
    """Counts and row shares per (label, prediction), empty cells included."""
    counts = pred.groupBy("label").agg(
        *[F.count_if(F.col("prediction") == s).alias(s) for s in SENTIMENTS],
        F.count(F.lit(1)).alias("total"),
    )
    shares = [_zero_div(F.col(s), F.col("total")).alias(f"{s}_share") for s in SENTIMENTS]
    return counts.select("label", *SENTIMENTS, *shares)


def misclassification_patterns(pred: DataFrame) -> DataFrame:
    wrong = pred.where(F.col("label") != F.col("prediction"))
    return wrong.groupBy("label").agg(
        *[F.count_if(F.col("prediction") == s).alias(s) for s in SENTIMENTS]
    )


def error_analysis(pred: DataFrame) -> DataFrame:
    """Errors in total and by label, prediction and category, from one grouping-set pass."""
    total = pred.agg(F.count(F.lit(1)).cast("double")).scalar()
    wrong = pred.where(F.col("label") != F.col("prediction"))
    sets = wrong.groupingSets(
        [[F.col("label")], [F.col("prediction")], [F.col("category")], []],
        "label", "prediction", "category",
    ).agg(
        F.grouping_id().alias("gid"),
        F.count(F.lit(1)).alias("errors"),
        F.avg("confidence").alias("avg_confidence"),
    )
    kind = F.when(F.col("gid") == 3, "label").when(F.col("gid") == 5, "prediction").when(
        F.col("gid") == 6, "category"
    ).otherwise("total")
    return sets.select(
        kind.alias("kind"),
        F.coalesce("label", "prediction", "category").alias("value"),
        "errors",
        F.try_divide(F.col("errors") * F.lit(100.0), total).alias("error_rate"),
        "avg_confidence",
    )


def error_patterns(pred: DataFrame) -> DataFrame:
    """How many errors contradict the star rating; patterns without any are left out."""
    wrong = pred.where(F.col("label") != F.col("prediction"))
    rules = {
        "High rating but negative prediction": (F.col("rating") >= 4) & (F.col("prediction") == "negative"),
        "Low rating but positive prediction": (F.col("rating") <= 2) & (F.col("prediction") == "positive"),
    }
    row = wrong.agg(
        F.count(F.lit(1)).alias("errors"), *[F.count_if(c).alias(f"r{i}") for i, c in enumerate(rules.values())]
    )
    cells = [
        F.struct(
            F.lit(name).alias("pattern"),
            F.col(f"r{i}").alias("n"),
            F.try_divide(F.col(f"r{i}") * F.lit(100.0), F.col("errors")).alias("percentage"),
        )
        for i, name in enumerate(rules)
    ]
    return row.select(F.explode(F.array(*cells)).alias("r")).select("r.*").where(F.col("n") > 0)


def calibration(pred: DataFrame, bins: int = 10) -> DataFrame:
    """Accuracy against confidence in equal bins (lo, hi]; empty bins are dropped.

    The expected calibration error and the overall mean confidence and accuracy stand on every
    row. A confidence of 0 is in no bin.
    """
    edges = [i * (1.0 / bins) for i in range(bins)] + [1.0]
    c = F.col("confidence")
    index = F.lit(-1)
    for i in range(bins - 1, -1, -1):
        index = F.when((c > edges[i]) & (c <= edges[i + 1]), i).otherwise(index)
    total = pred.agg(F.count(F.lit(1)).cast("double")).scalar()
    correct = F.when(F.col("label") == F.col("prediction"), 1.0).otherwise(0.0)
    table = (
        pred.groupBy(index.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(correct).alias("accuracy"),
            F.avg(c).alias("avg_confidence"),
        )
        .where(F.col("bin") >= 0)
        .withColumn("proportion", F.col("n") / total)
    )
    gap = F.abs(F.col("accuracy") - F.col("avg_confidence")) * F.col("proportion")
    overall = pred.agg(F.struct(F.avg(c).alias("confidence"), F.avg(correct).alias("accuracy")).alias("x"))
    low = F.element_at(F.array(*[F.lit(x) for x in edges]), F.col("bin") + 1)
    high = F.element_at(F.array(*[F.lit(x) for x in edges]), F.col("bin") + 2)
    return table.select(
        "*", low.alias("lower"), high.alias("upper"),
        F.sum(gap).over(Window.partitionBy(F.lit(0))).alias("ece"),  # a row per bin
        overall.select("x.confidence").scalar().alias("overall_confidence"),
        overall.select("x.accuracy").scalar().alias("overall_accuracy"),
    )


def score_counts(scores: DataFrame, positive: int | str = 2) -> DataFrame:
    """Positives and negatives per distinct score, so that a frequent score is one row."""
    hit = F.coalesce(F.col("label") == positive, F.lit(False))
    return scores.groupBy("score").agg(
        F.count_if(hit).alias("tp"), F.count_if(~hit).alias("fp")
    )


def _curve(scores: DataFrame, positive) -> DataFrame:
    counts = materialize(score_counts(scores, positive), "scores")
    cumulative = running_totals(counts, "score", ["tp", "fp"], descending=True)
    totals = counts.agg(F.sum("tp").alias("p"), F.sum("fp").alias("n"))
    return cumulative.withColumns(
        {"p": totals.select("p").scalar(), "n": totals.select("n").scalar()}
    )


def roc_points(scores: DataFrame, positive: int | str = 2) -> DataFrame:
    """True and false positive rates down to every distinct score, from (0, 0)."""
    points = _curve(scores, positive).select(
        F.col("score").cast("double").alias("threshold"),
        F.try_divide(F.col("cum_tp").cast("double"), F.col("p")).alias("tpr"),
        F.try_divide(F.col("cum_fp").cast("double"), F.col("n")).alias("fpr"),
    )
    origin = scores.sparkSession.createDataFrame(
        [(float("inf"), 0.0, 0.0)], "threshold double, tpr double, fpr double"
    )
    return origin.unionByName(points)


def pr_points(scores: DataFrame, positive: int | str = 2) -> DataFrame:
    """Precision and recall at every distinct score."""
    return _curve(scores, positive).select(
        F.col("score").cast("double").alias("threshold"),
        F.try_divide(F.col("cum_tp").cast("double"), F.col("cum_tp") + F.col("cum_fp")).alias("precision"),
        F.try_divide(F.col("cum_tp").cast("double"), F.col("p")).alias("recall"),
    )


def roc_auc(scores: DataFrame, positive: int | str = 2) -> DataFrame:
    """Area under the ROC curve, and average precision.

    Both are sums over the points that need only the point itself: the step of the
    curve at a score is its own count, so no lag over the whole curve is needed.
    """
    c = _curve(scores, positive)
    trapezoid = F.col("fp") * (F.col("cum_tp") - F.col("tp") / 2)
    step = F.col("tp") * F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))
    return c.agg(
        F.try_divide(F.sum(trapezoid.cast("double")), F.max(F.col("p").cast("double") * F.col("n"))).alias("roc_auc"),
        F.try_divide(F.sum(step), F.max("p")).alias("average_precision"),
    )


def binary_auc(scores: DataFrame, positive: int | str = 2) -> DataFrame:
    """ROC AUC and average precision, null unless there are exactly two labels."""
    two = scores.agg(F.count_distinct("label") == 2).scalar()
    areas = roc_auc(scores, positive)
    return areas.select(*[F.when(two, F.col(c)).alias(c) for c in areas.columns])


def sample_errors(pred: DataFrame, n: int = 10, key: str = "review_id") -> DataFrame:
    return pred.where(F.col("label") != F.col("prediction")).orderBy(key).limit(n)
