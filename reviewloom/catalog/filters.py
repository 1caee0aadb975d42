"""Queries of section B: filters and labels."""

from pyspark.sql import functions as F

from ..operators import filters as B
from .base import query

ROW = """review_id, category, rating, predicted_sentiment, round(confidence_score, 6) AS confidence_score,
 strftime(review_date, '%Y-%m-%d') AS day"""


def _row(df):
    return df.selectExpr(
        "review_id", "category", "rating", "predicted_sentiment", "confidence_score",
        "date_format(review_date, 'yyyy-MM-dd') AS day",
    )


PANEL = {
    "date_range": ("1996-01-01", "1997-12-31"),
    "sentiments": ["negative", "positive"],
    "rating_range": (2, 5),
    "min_confidence": 0.6,
    "verified_only": True,
}
PANEL_SQL = """CAST(review_date AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'
 AND predicted_sentiment IN ('negative', 'positive') AND rating BETWEEN 2 AND 5
 AND confidence_score >= 0.6 AND verified_purchase"""


@query("filter_panel", f"SELECT {ROW} FROM reviews WHERE {PANEL_SQL}")
def _(v):
    return _row(B.filter_panel(v.reviews, **PANEL))


@query(
    "filter_share",
    f"""SELECT count(*) FILTER (WHERE {PANEL_SQL}) AS filtered, count(*) AS total,
    round(100.0 * count(*) FILTER (WHERE {PANEL_SQL}) / count(*), 6) AS shown_pct FROM reviews""",
)
def _(v):
    return B.filter_share(v.reviews, **PANEL)


@query("length_filter", "SELECT review_id, word_count FROM sized WHERE word_count BETWEEN 5 AND 1500", "sized")
def _(v):
    return B.length_filter(v.sized).select("review_id", "word_count")


@query(
    "keyword_search",
    "SELECT review_id, category FROM cleaned WHERE regexp_matches(review_text, '(?i)tion|amos') OR regexp_matches(cleaned_text, '(?i)tion|amos')",
    "cleaned",
)
def _(v):
    return B.keyword_search(v.cleaned, "tion|amos").select("review_id", "category")


@query("urgent_reviews", f"SELECT {ROW} FROM reviews WHERE predicted_sentiment = 'negative' AND confidence_score > 0.8")
def _(v):
    return _row(B.urgent_reviews(v.reviews))


@query(
    "misaligned_reviews",
    f"""SELECT {ROW} FROM reviews WHERE (rating >= 4 AND predicted_sentiment = 'negative')
    OR (rating <= 2 AND predicted_sentiment = 'positive')""",
)
def _(v):
    return _row(B.misaligned_reviews(v.reviews))


@query(
    "confidence_band",
    f"SELECT {ROW} FROM reviews WHERE confidence_score >= 0.6 AND confidence_score < 0.8",
)
def _(v):
    return _row(B.confidence_band(v.reviews, 0.6, 0.8))


@query(
    "confidence_bands",
    """SELECT CAST(CASE WHEN c >= 0 AND c < 0.2::DOUBLE THEN 0 WHEN c >= 0.2::DOUBLE AND c < 0.4::DOUBLE THEN 1
     WHEN c >= 0.4::DOUBLE AND c < 0.6::DOUBLE THEN 2 WHEN c >= 0.6::DOUBLE AND c < 0.8::DOUBLE THEN 3
     WHEN c >= 0.8::DOUBLE AND c < 1 THEN 4 END AS INT) AS band, count(*) AS n
     FROM (SELECT confidence_score AS c FROM review_docs) GROUP BY 1""",
    "review_docs",
)
def _(v):
    return B.confidence_bands(v.docs)


@query(
    "recent_split",
    """SELECT review_date >= (SELECT max(review_date) - INTERVAL 30 DAY FROM reviews) AS is_recent, count(*) AS n
    FROM reviews GROUP BY 1""",
)
def _(v):
    return B.recent_split(v.reviews).groupBy("is_recent").count().withColumnRenamed("count", "n")


@query(
    "recent_negative_alert",
    """WITH r AS (SELECT avg(CASE WHEN predicted_sentiment = 'negative' THEN 1.0::DOUBLE ELSE 0 END)
       FILTER (WHERE review_date > (SELECT max(review_date) - INTERVAL 30 DAY FROM reviews)) AS a,
       avg(CASE WHEN predicted_sentiment = 'negative' THEN 1.0::DOUBLE ELSE 0 END) AS b FROM reviews)
    SELECT round(a, 6) AS recent_negative, round(b, 6) AS overall_negative, a > b * 1.2 AS alert FROM r""",
)
def _(v):
    return B.recent_negative_alert(v.reviews)


@query(
    "derive_sentiment",
    """SELECT CASE WHEN rating >= 4 THEN 'positive' WHEN rating <= 2 THEN 'negative' ELSE 'neutral' END AS sentiment,
    true_sentiment, count(*) AS n FROM reviews GROUP BY 1, 2""",
)
def _(v):
    df = B.derive_sentiment(v.reviews)
    return df.groupBy("sentiment", "true_sentiment").count().withColumnRenamed("count", "n")


@query(
    "encode_labels",
    """SELECT true_sentiment, CAST(CASE true_sentiment WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 ELSE 2 END AS INT) AS label,
    count(*) AS n FROM reviews GROUP BY 1, 2""",
)
def _(v):
    df = B.encode_labels(v.reviews)
    return df.groupBy("true_sentiment", "label").count().withColumnRenamed("count", "n")


@query(
    "decode_labels",
    """SELECT CAST(rating - 1 AS INT) AS label, CASE rating WHEN 1 THEN 'negative' WHEN 2 THEN 'neutral' WHEN 3 THEN 'positive' END AS sentiment,
    count(*) AS n FROM reviews GROUP BY 1, 2""",
)
def _(v):
    df = B.decode_labels(v.reviews.selectExpr("CAST(rating - 1 AS INT) AS label"))
    return df.groupBy("label", "sentiment").count().withColumnRenamed("count", "n")


@query(
    "sentiment_score",
    """SELECT predicted_sentiment, round(sum(CASE predicted_sentiment WHEN 'positive' THEN 1.0::DOUBLE WHEN 'neutral' THEN 0.5 ELSE 0 END), 6) AS unit_sum,
    round(sum(CASE predicted_sentiment WHEN 'positive' THEN 1.0::DOUBLE WHEN 'neutral' THEN 0 ELSE -1 END), 6) AS signed_sum
    FROM reviews GROUP BY 1""",
)
def _(v):
    unit = B.sentiment_score(v.reviews).withColumnRenamed("sentiment_score", "unit")
    both = B.sentiment_score(unit, "signed")
    return both.groupBy("predicted_sentiment").agg(
        F.sum("unit").alias("unit_sum"), F.sum("sentiment_score").alias("signed_sum")
    )


@query(
    "rating_sentiment_aligned",
    """SELECT rating, predicted_sentiment, CAST((rating >= 4 AND predicted_sentiment = 'positive') OR (rating <= 2 AND predicted_sentiment = 'negative')
    OR (rating = 3 AND predicted_sentiment = 'neutral') AS INT) AS rating_sentiment_aligned, count(*) AS n FROM reviews GROUP BY 1, 2, 3""",
)
def _(v):
    df = B.rating_sentiment_aligned(v.reviews)
    return df.groupBy("rating", "predicted_sentiment", "rating_sentiment_aligned").count().withColumnRenamed("count", "n")


@query(
    "stratified_split",
    """WITH c AS (SELECT true_sentiment, count(*) AS n FROM reviews GROUP BY 1)
    SELECT true_sentiment, true AS is_train, CAST(round(n * 0.8::DOUBLE) AS BIGINT) AS n FROM c
    UNION ALL SELECT true_sentiment, false, n - CAST(round(n * 0.8::DOUBLE) AS BIGINT) FROM c""",
)
def _(v):
    df = B.stratified_split(v.reviews.select("review_id", "true_sentiment"))
    return df.groupBy("true_sentiment", "is_train").count().withColumnRenamed("count", "n")


@query("sample_rows")
def _(v):
    return _row(B.sample_rows(v.reviews, 5))


@query("verified_only", "SELECT verified_purchase, count(*) AS n, round(avg(rating), 6) AS avg_rating FROM reviews GROUP BY 1")
def _(v):
    parts = [
        B.verified_only(v.reviews, flag)
        .groupBy("verified_purchase")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("rating").alias("avg_rating"))
        for flag in (True, False)
    ]
    return parts[0].unionByName(parts[1])


@query(
    "null_text_guard",
    """SELECT review_id, coalesce(CASE WHEN review_id % 3 = 0 THEN NULL ELSE review_text END, '') AS review_text FROM review_docs""",
    "review_docs",
)
def _(v):
    texts = v.docs.selectExpr("review_id", "CASE WHEN review_id % 3 = 0 THEN NULL ELSE review_text END AS review_text")
    return B.null_text_guard(texts)


@query(
    "urgent_keyword_flag",
    """SELECT is_urgent, is_high_value, count(*) AS n FROM (
      SELECT regexp_matches(lower(review_text), 'the|and|los') AS is_urgent, category IN ('en', 'fr') AS is_high_value FROM review_docs)
      GROUP BY 1, 2""",
    "review_docs",
)
def _(v):
    df = B.urgent_keyword_flag(v.docs, ["the", "and", "los"], ["en", "fr"])
    return df.groupBy("is_urgent", "is_high_value").count().withColumnRenamed("count", "n")


@query(
    "critical_category",
    """SELECT category, round(avg(CASE WHEN predicted_sentiment = 'positive' THEN 1.0::DOUBLE ELSE 0 END), 6) AS positive_rate,
    count(*) AS review_count FROM reviews GROUP BY 1 HAVING avg(CASE WHEN predicted_sentiment = 'positive' THEN 1.0::DOUBLE ELSE 0 END) < 0.335""",
)
def _(v):
    return B.critical_category(v.reviews, 0.335)
