"""Queries of sections F and G: top-k and set operations."""

from pyspark.sql import functions as F

from ..operators import joins as C
from ..operators import ranking as R
from ..operators import sets as G
from .aggregates import HIERARCHY, rate
from .base import query
from .periods import RECENT_OLDER, period_words


@query(
    "review_explorer",
    """SELECT review_id, category, rating, round(confidence_score, 6) AS confidence_score FROM cleaned
    WHERE regexp_matches(review_text, '(?i)tion') OR regexp_matches(cleaned_text, '(?i)tion')
    ORDER BY confidence_score DESC, review_id LIMIT 20""",
    "cleaned",
)
def _(v):
    found = R.review_explorer(v.cleaned, "tion", "confidence_score", n=20)
    return found.select("review_id", "category", "rating", "confidence_score")


@query("topk_keywords", f"WITH {RECENT_OLDER} SELECT term, round(score, 6) AS score FROM r ORDER BY r.score DESC, term LIMIT 20", "cleaned")
def _(v):
    return R.topk_keywords(period_words(v)[0].select("term", "score"), 20)


@query(
    "topk_trending",
    f"""WITH {RECENT_OLDER}, t AS (SELECT r.term, (r.score - coalesce(o.score, 0.001::DOUBLE)) / coalesce(o.score, 0.001::DOUBLE) AS s FROM r LEFT JOIN o ON r.term = o.term)
    SELECT term, round(s, 6) AS trend_score FROM t WHERE s > 0.5 ORDER BY s DESC, term LIMIT 20""",
    "cleaned",
)
def _(v):
    return R.topk_trending(C.trend_score(*period_words(v))).select("term", "trend_score")


@query(
    "peak_low_months",
    f"""WITH m AS (SELECT CAST(month(review_date) AS INT) AS month, {rate("positive")} AS p FROM reviews GROUP BY 1)
    SELECT * FROM (SELECT 'peak' AS kind, month, round(p, 6) AS positive_rate FROM m ORDER BY p DESC, month LIMIT 3)
    UNION ALL SELECT * FROM (SELECT 'low', month, round(p, 6) FROM m ORDER BY p, month LIMIT 3)""",
)
def _(v):
    return R.peak_low_months(v.reviews)


@query(
    "worst3_categories",
    f"""WITH m AS (SELECT category, {rate("negative")} AS r FROM reviews GROUP BY 1 ORDER BY r DESC, category LIMIT 3)
    SELECT category, round(r, 6) AS negative_rate,
    '**' || category || '**: ' || format('{{:.1f}}', round_even(r * 100, 1)) || '% negative reviews - Immediate quality review recommended' AS recommendation
    FROM m WHERE r > 0.3""",
)
def _(v):
    return R.worst3_categories(v.reviews)


@query(
    "distinct_values",
    """SELECT DISTINCT 'category' AS "column", category AS value FROM reviews UNION ALL SELECT DISTINCT 'predicted_sentiment', predicted_sentiment FROM reviews
    UNION ALL SELECT DISTINCT 'rating', CAST(rating AS VARCHAR) FROM reviews""",
)
def _(v):
    return G.distinct_values(v.reviews, ["category", "predicted_sentiment", "rating"])


@query(
    "union_hierarchy",
    f"SELECT label, parent, n FROM ({HIERARCHY})",
)
def _(v):
    return G.union_hierarchy(v.reviews)


@query(
    "new_vs_old_terms",
    f"""WITH {RECENT_OLDER} SELECT term, 'new' AS kind FROM r WHERE term NOT IN (SELECT term FROM o)
    UNION ALL SELECT term, 'common' FROM r WHERE term IN (SELECT term FROM o)""",
    "cleaned",
)
def _(v):
    return G.new_vs_old_terms(*period_words(v))


@query(
    "union_rules",
    f"""WITH m AS (SELECT category, {rate("negative")} AS r FROM reviews GROUP BY 1)
    SELECT * FROM (SELECT 'worst' AS rule, category, round(r, 6) AS rate FROM m ORDER BY r DESC, category LIMIT 1)
    UNION ALL SELECT 'above average', category, round(r, 6) FROM m WHERE r > (SELECT {rate("negative")} FROM reviews)""",
)
def _(v):
    rates = v.reviews.groupBy("category").agg(
        F.avg(F.when(F.col("predicted_sentiment") == "negative", 1.0).otherwise(0.0)).alias("rate")
    )
    overall = v.reviews.agg(
        F.avg(F.when(F.col("predicted_sentiment") == "negative", 1.0).otherwise(0.0))
    ).scalar()
    worst = rates.orderBy(F.desc("rate"), "category").limit(1)
    return G.union_rules(
        worst.select(F.lit("worst").alias("rule"), "category", "rate"),
        rates.where(F.col("rate") > overall).select(F.lit("above average").alias("rule"), "category", "rate"),
    )
