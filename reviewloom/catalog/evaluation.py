"""Queries of section K, with the ROC, PR and model-rank windows of E."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluation as K
from ..operators import windows as E
from ..schema import SENTIMENTS
from .base import query

CLASSES = """c AS (SELECT unnest(['negative', 'neutral', 'positive']) AS class),
m AS (SELECT class, count(*) FILTER (WHERE label = class AND prediction = class)::DOUBLE AS tp, count(*) FILTER (WHERE prediction = class) AS p,
  count(*) FILTER (WHERE label = class) AS support FROM pred, c GROUP BY 1),
q AS (SELECT class, coalesce(tp / nullif(p, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall, support, tp FROM m),
f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM q)"""


METRICS = ("accuracy", "precision", "recall", "f1")


def headline_sql(models: dict[str, str]) -> str:
    """CTE h: accuracy, macro precision, recall and F1, and precision per class (p_class), of filtered predictions."""
    listed = " UNION ALL ".join(f"SELECT '{m}' AS model, label, prediction FROM pred WHERE {c}" for m, c in models.items())
    return f"""hp AS ({listed}), hc AS (SELECT model, label AS class FROM hp UNION SELECT model, prediction FROM hp),
    hm AS (SELECT hc.model, class, count(*) FILTER (WHERE label = class AND prediction = class)::DOUBLE AS tp, count(*) FILTER (WHERE prediction = class) AS p,
      count(*) FILTER (WHERE label = class) AS support FROM hp JOIN hc ON hp.model = hc.model GROUP BY 1, 2),
    hq AS (SELECT *, coalesce(tp / nullif(p, 0), 0) AS pr, coalesce(tp / nullif(support, 0), 0) AS rc FROM hm),
    h AS (SELECT model, sum(tp) / sum(support)::DOUBLE AS accuracy, avg(pr) AS precision, avg(rc) AS recall,
      avg(coalesce(2 * pr * rc / nullif(pr + rc, 0), 0)) AS f1, {", ".join(f"coalesce(max(pr) FILTER (WHERE class = '{s}'), 0) AS p_{s}" for s in SENTIMENTS)} FROM hq GROUP BY 1)"""


@query(
    "classification_metrics",
    f"""WITH {CLASSES} SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support, CAST(NULL AS DOUBLE) AS accuracy FROM f
    UNION ALL SELECT 'macro', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT), round(sum(tp) / sum(support)::DOUBLE, 6) FROM f""",
    "pred",
)
def _(v):
    return K.classification_metrics(v.pred)


@query(
    "confusion_matrix",
    "SELECT label, " + ", ".join(
        f"count(*) FILTER (WHERE prediction = '{s}') AS {s}, round(count(*) FILTER (WHERE prediction = '{s}') / count(*)::DOUBLE, 6) AS {s}_share" for s in SENTIMENTS
    ) + " FROM pred GROUP BY 1",
    "pred",
)
def _(v):
    return K.confusion_matrix(v.pred)


@query(
    "misclassification_patterns",
    "SELECT label, " + ", ".join(f"count(*) FILTER (WHERE prediction = '{s}') AS {s}" for s in SENTIMENTS) + " FROM pred WHERE label <> prediction GROUP BY 1",
    "pred",
)
def _(v):
    return K.misclassification_patterns(v.pred)


def _errors(kind, value):
    group = f" GROUP BY {value}" if kind != "total" else ""
    return f"""SELECT '{kind}' AS kind, {value} AS value, count(*) AS errors, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM pred), 6) AS error_rate,
     round(avg(confidence), 6) AS avg_confidence FROM pred WHERE label <> prediction{group}"""


@query(
    "error_analysis",
    " UNION ALL ".join(_errors(k, x) for k, x in (("label", "label"), ("prediction", "prediction"), ("category", "category"), ("total", "CAST(NULL AS VARCHAR)"))),
    "pred",
)
def _(v):
    return K.error_analysis(v.pred)


@query(
    "error_patterns",
    """WITH e AS (SELECT * FROM pred WHERE label <> prediction),
    r AS (SELECT 'High rating but negative prediction' AS pattern, count(*) FILTER (WHERE rating >= 4 AND prediction = 'negative') AS n, count(*) AS t FROM e
     UNION ALL SELECT 'Low rating but positive prediction', count(*) FILTER (WHERE rating <= 2 AND prediction = 'positive'), count(*) FROM e)
    SELECT pattern, n, round(n * 100.0::DOUBLE / t, 6) AS percentage FROM r WHERE n > 0""",
    "pred",
)
def _(v):
    return K.error_patterns(v.pred)


@query(
    "calibration",
    """WITH e AS (SELECT i, i * 0.1::DOUBLE AS lo, CASE WHEN i = 9 THEN 1.0::DOUBLE ELSE (i + 1) * 0.1::DOUBLE END AS hi FROM (SELECT unnest(range(10)) AS i)),
    b AS (SELECT i, count(*) AS n, avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0 END) AS a, avg(confidence) AS c, count(*)::DOUBLE / (SELECT count(*) FROM pred) AS p
     FROM pred JOIN e ON confidence > lo AND confidence <= hi GROUP BY 1)
    SELECT i::INT AS bin, n, round(i * 0.1::DOUBLE, 6) AS lower, round((i + 1) * 0.1::DOUBLE, 6) AS upper, (SELECT round(avg(confidence), 6) FROM pred) AS overall_confidence,
     (SELECT round(avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0 END), 6) FROM pred) AS overall_accuracy, round(a, 6) AS accuracy, round(c, 6) AS avg_confidence, round(p, 6) AS proportion, round(sum(abs(a - c) * p) OVER (), 6) AS ece FROM b""",
    "pred",
)
def _(v):
    return K.calibration(v.pred)


CURVE = """s AS (SELECT score, count(*) FILTER (WHERE label = 'positive') AS tp, count(*) FILTER (WHERE label <> 'positive') AS fp FROM pred GROUP BY 1),
k AS (SELECT score, tp, fp, sum(tp) OVER (ORDER BY score DESC) AS ct, sum(fp) OVER (ORDER BY score DESC) AS cf, sum(tp) OVER () AS p, sum(fp) OVER () AS n FROM s)"""


@query(
    "roc_points",
    f"""WITH {CURVE} SELECT round(score, 6) AS threshold, round(ct::DOUBLE / p, 6) AS tpr, round(cf::DOUBLE / n, 6) AS fpr FROM k
     UNION ALL SELECT 'Infinity'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE""",
    "pred",
)
def _(v):
    return K.roc_points(v.pred, "positive")


@query(
    "pr_points",
    f"""WITH {CURVE} SELECT round(score, 6) AS threshold, round(ct::DOUBLE / (ct + cf), 6) AS precision, round(ct::DOUBLE / p, 6) AS recall FROM k""",
    "pred",
)
def _(v):
    return K.pr_points(v.pred, "positive")


AREAS = f"""WITH {CURVE}, l AS (SELECT *, lag(ct, 1, 0) OVER (ORDER BY score DESC) AS lt, lag(cf, 1, 0) OVER (ORDER BY score DESC) AS lf FROM k)
    SELECT round(sum((cf - lf)::DOUBLE / n * (ct + lt)::DOUBLE / p / 2), 6) AS roc_auc, round(sum((ct - lt)::DOUBLE / p * ct / (ct + cf)), 6) AS average_precision FROM l"""


@query("roc_auc", AREAS, "pred")
def _(v):
    return K.roc_auc(v.pred, "positive")


@query(
    "binary_auc",
    AREAS.replace("pred GROUP", "(SELECT * FROM pred WHERE label <> 'neutral') GROUP"),
    "pred",
)
def _(v):
    return K.binary_auc(v.pred.where("label <> 'neutral'"), "positive")


@query("sample_errors", "SELECT review_id, label, prediction, rating FROM pred WHERE label <> prediction ORDER BY review_id LIMIT 10", "pred")
def _(v):
    return K.sample_errors(v.pred).select("review_id", "label", "prediction", "rating")


MODELS = {"a": "true", "b": "rating >= 2", "c": "confidence >= 0.7"}


@query(
    "model_rank",
    "WITH " + headline_sql(MODELS) + ", v AS (" + " UNION ALL ".join(
        f"SELECT model, '{m}' AS metric, {m} AS value FROM h" for m in METRICS
    ) + ") SELECT model, metric, round(value, 6) AS value, CAST(row_number() OVER (PARTITION BY metric ORDER BY value DESC, model) AS INT) AS rank FROM v",
    "pred",
)
def _(v):
    rows = [K.headline_metrics(v.pred.where(c), m) for m, c in MODELS.items()]
    table = reduce(DataFrame.unionByName, rows)
    cells = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS]))
    return E.model_rank(table.select("model", cells.alias("c")).select("model", "c.*"))
