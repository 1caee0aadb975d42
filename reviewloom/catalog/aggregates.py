"""Queries of section D: aggregates."""

from pyspark.sql import functions as F

from ..functions.wordlists import ENGLISH_STOP_WORDS
from ..operators import aggregates as A
from ..operators import text as H
from ..schema import SENTIMENTS
from .base import query, sql_gram_tokens, sql_words
from .joins import PROBLEMS_SQL


def rate(label, col="predicted_sentiment"):
    return f"avg(CASE WHEN {col} = '{label}' THEN 1.0::DOUBLE ELSE 0 END)"


def counts(col="predicted_sentiment"):
    return ", ".join(f"count(*) FILTER (WHERE {col} = '{s}') AS {s}" for s in SENTIMENTS)


SIGNED = "CASE predicted_sentiment WHEN 'positive' THEN 1.0::DOUBLE WHEN 'neutral' THEN 0 WHEN 'negative' THEN -1 END"
UNIT = "CASE predicted_sentiment WHEN 'positive' THEN 1.0::DOUBLE WHEN 'neutral' THEN 0.5 WHEN 'negative' THEN 0 END"
CSI = f"avg((rating - 1) / 4.0::DOUBLE * 0.3 + {UNIT} * 0.7) * 100"


@query("sentiment_distribution", "SELECT predicted_sentiment, count(*) AS n, round(count(*) / (sum(count(*)) OVER ())::DOUBLE, 6) AS share FROM reviews GROUP BY 1")
def _(v):
    return A.sentiment_distribution(v.reviews)


@query("rating_distribution", "SELECT rating, count(*) AS n FROM reviews GROUP BY 1")
def _(v):
    return A.rating_distribution(v.reviews)


@query("category_distribution", "SELECT category, count(*) AS n FROM reviews GROUP BY 1")
def _(v):
    return A.category_distribution(v.reviews)


@query(
    "category_sentiment_pct",
    "SELECT category, " + ", ".join(f"round(count(*) FILTER (WHERE predicted_sentiment = '{s}') * 100.0::DOUBLE / count(*), 6) AS {s}" for s in SENTIMENTS) + " FROM reviews GROUP BY 1",
)
def _(v):
    return A.category_sentiment_pct(v.reviews)


@query("rating_sentiment_crosstab", f"SELECT rating, {counts()} FROM reviews GROUP BY 1")
def _(v):
    return A.rating_sentiment_crosstab(v.reviews)


@query("verified_sentiment_crosstab", f"SELECT verified_purchase, {counts('true_sentiment')} FROM reviews GROUP BY 1")
def _(v):
    return A.verified_sentiment_crosstab(v.reviews)


@query(
    "verified_positive_gap",
    f"""WITH r AS (SELECT {rate("positive")} FILTER (WHERE verified_purchase) AS a, {rate("positive")} FILTER (WHERE NOT verified_purchase) AS b
     FROM (SELECT * REPLACE (CASE WHEN rating = 3 THEN NULL ELSE predicted_sentiment END AS predicted_sentiment) FROM reviews) WHERE predicted_sentiment IS NOT NULL)
    SELECT round(a, 6) AS verified_positive, round(b, 6) AS unverified_positive, a < b - 0.1 AS alert FROM r""",
)
def _(v):
    some = F.when(F.col("rating") != 3, F.col("predicted_sentiment"))
    return A.verified_positive_gap(v.reviews.withColumn("predicted_sentiment", some))


@query("avg_rating_by_verified", "SELECT verified_purchase, round(avg(rating), 6) AS avg_rating FROM reviews GROUP BY 1")
def _(v):
    return A.avg_rating_by_verified(v.reviews)


@query(
    "overview_kpis",
    """SELECT count(*) AS total_reviews, round(avg(rating), 6) AS avg_rating, count(DISTINCT category) AS categories,
    round(avg(CASE WHEN verified_purchase THEN 1.0::DOUBLE ELSE 0 END) * 100, 6) AS verified_pct FROM reviews""",
)
def _(v):
    return A.overview_kpis(v.reviews)


PERFORMANCE = f"""SELECT category, round({rate("positive")}, 6) AS positive_rate, round({rate("negative")}, 6) AS negative_rate,
  count(predicted_sentiment) AS review_count, round(avg(rating), 6) AS avg_rating, round(stddev_samp(rating), 6) AS rating_std,
  round(avg(confidence_score), 6) AS avg_confidence, CAST(sum(helpful_count) AS BIGINT) AS total_helpful,
  round(sum(helpful_count)::DOUBLE / count(predicted_sentiment), 6) AS engagement_score FROM reviews GROUP BY 1"""


@query("category_performance", PERFORMANCE)
def _(v):
    return A.category_performance(v.reviews)


@query(
    "best_worst_categories",
    f"""WITH m AS (SELECT category, {rate("positive")} AS p, {rate("negative")} AS n FROM reviews GROUP BY 1)
    SELECT * FROM (SELECT 'best' AS side, category, round(p, 6) AS rate, CAST(row_number() OVER (ORDER BY p DESC, category) AS INT) AS rank FROM m
    UNION ALL SELECT 'worst', category, round(n, 6), CAST(row_number() OVER (ORDER BY n DESC, category) AS INT) FROM m) WHERE rank <= 3""",
)
def _(v):
    return A.best_worst_categories(v.reviews)


@query(
    "category_performance_score",
    f"""WITH m AS (SELECT category, round_even({rate("positive")} * 100, 2) AS positive_pct, round_even({rate("negative")} * 100, 2) AS negative_pct,
      count(*) AS review_count, round_even(avg(rating), 2) AS avg_rating, round_even(avg(helpful_count), 2) AS avg_helpful FROM reviews GROUP BY 1)
    SELECT *, round_even(positive_pct * 0.4 + avg_rating * 20 * 0.3 + (100 - negative_pct) * 0.3, 1) AS performance_score FROM m""",
)
def _(v):
    return A.category_performance_score(v.reviews)


@query(
    "category_status",
    f"""WITH m AS (SELECT category, round_even({rate("positive")} * 100, 2) AS positive_pct, round_even({rate("negative")} * 100, 2) AS negative_pct,
      count(*) AS review_count, round_even(avg(rating), 2) AS avg_rating, round_even(stddev_samp(rating), 2) AS rating_std,
      round_even(avg(confidence_score), 2) AS avg_confidence FROM reviews GROUP BY 1)
    SELECT *, CASE WHEN positive_pct > 70 THEN '🟢' WHEN positive_pct > 50 THEN '🟡' ELSE '🔴' END AS status FROM m""",
)
def _(v):
    return A.category_status(v.reviews)


@query(
    "quadrant_label",
    f"""WITH m AS (SELECT category, avg(rating) AS r, {rate("positive")} * 100 AS p FROM review_events GROUP BY 1)
    SELECT category, round(r, 6) AS avg_rating, round(p, 6) AS positive_pct, CASE WHEN r >= 3 AND p >= 60 THEN 'Stars'
     WHEN r >= 3 THEN 'Improve Sentiment' WHEN p >= 60 THEN 'Mixed Signals' ELSE 'Problem Areas' END AS quadrant FROM m""",
    "review_events",
)
def _(v):
    return A.quadrant_label(v.events, rating=3)


@query(
    "category_bubble",
    f"""SELECT category, round(avg(rating), 6) AS avg_rating, round({rate("positive")} * 100, 6) AS positive_pct, count(review_id) AS review_count,
    CAST(sum(helpful_count) AS BIGINT) AS total_helpful, round(sum(helpful_count)::DOUBLE / count(review_id), 6) AS engagement FROM reviews GROUP BY 1""",
)
def _(v):
    return A.category_bubble(v.reviews)


@query(
    "problem_products",
    f"""WITH {PROBLEMS_SQL.replace("TEXT", "product_name")} SELECT product_id, round(negative_rate, 6) AS negative_rate,
    round(avg_rating, 6) AS avg_rating, review_count FROM p""",
)
def _(v):
    return A.problem_products(v.reviews, text_col="product_name")


@query("csi", f"SELECT round({CSI}, 6) AS csi FROM reviews")
def _(v):
    return A.csi(v.reviews)


@query("satisfaction_score", f"SELECT round({rate('positive')} * 100, 6) AS satisfaction, round({rate('positive')} * 100 - 75, 6) AS delta FROM reviews")
def _(v):
    return A.satisfaction_score(v.reviews)


@query("avg_confidence", "SELECT round(avg(confidence_score), 6) AS avg_confidence FROM reviews")
def _(v):
    return A.avg_confidence(v.reviews)


def box(by, value, source):
    return f"""SELECT {by}, count({value}) AS n, round(avg({value}), 6) AS mean, round(CAST(min({value}) AS DOUBLE), 6) AS min,
     round(CAST(max({value}) AS DOUBLE), 6) AS max, round(quantile_cont(CAST({value} AS DOUBLE), 0.25), 6) AS q25,
     round(quantile_cont(CAST({value} AS DOUBLE), 0.5), 6) AS median,
     round(quantile_cont(CAST({value} AS DOUBLE), 0.75), 6) AS q75 FROM {source} GROUP BY 1"""


@query("confidence_by_sentiment", box("predicted_sentiment", "confidence_score", "reviews"))
def _(v):
    return A.confidence_by_sentiment(v.reviews)


@query("word_count_by_sentiment", box("true_sentiment", "word_count", "sized"), "sized")
def _(v):
    return A.word_count_by_sentiment(v.sized)


@query(
    "feature_means_by_sentiment",
    """SELECT true_sentiment, round(avg(length(review_text) - length(replace(review_text, '!', ''))), 6) AS exclamation_count,
     round(avg(length(review_text) - length(replace(review_text, '?', ''))), 6) AS question_count,
     round(avg(len(regexp_extract_all(review_text, '\\p{Lu}')) / greatest(length(review_text), 1)::DOUBLE), 6) AS caps_ratio
     FROM review_docs GROUP BY 1""",
    "review_docs",
)
def _(v):
    df = H.processed_features(v.cleaned)
    return A.feature_means_by_sentiment(df, ["exclamation_count", "question_count", "caps_ratio"])


ALIGNED = """((rating >= 4 AND predicted_sentiment = 'positive') OR (rating <= 2 AND predicted_sentiment = 'negative')
 OR (rating = 3 AND predicted_sentiment = 'neutral'))"""


@query(
    "coverage_alignment_curve",
    " UNION ALL ".join(
        f"""SELECT {t}::DOUBLE AS threshold, round(count(*) FILTER (WHERE confidence_score >= {t}::DOUBLE) * 100.0::DOUBLE / count(*), 6) AS coverage_pct,
        round(coalesce(count(*) FILTER (WHERE confidence_score >= {t}::DOUBLE AND {ALIGNED}) * 100.0::DOUBLE
         / nullif(count(*) FILTER (WHERE confidence_score >= {t}::DOUBLE), 0), 0), 6) AS aligned_pct FROM reviews"""
        for t in A.THRESHOLDS
    ),
)
def _(v):
    return A.coverage_alignment_curve(v.reviews)


@query("rating_sentiment_corr", f"SELECT round(corr(rating, {SIGNED}), 6) AS correlation FROM reviews")
def _(v):
    return A.rating_sentiment_corr(v.reviews)


CORR_COLS = ("rating", "helpful_count", "confidence_score", "verified")


@query(
    "correlation_matrix",
    "WITH d AS (SELECT rating, helpful_count, confidence_score, CAST(verified_purchase AS INT) AS verified FROM reviews) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round({'1.0::DOUBLE' if a == b else f'corr({min(a, b)}, {max(a, b)})'}, 6) AS correlation {'' if a == b else 'FROM d'}"
        for a in CORR_COLS for b in CORR_COLS
    ),
)
def _(v):
    df = v.reviews.withColumn("verified", F.col("verified_purchase").cast("int"))
    return A.correlation_matrix(df, CORR_COLS)


@query(
    "describe_numeric",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
        round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75 FROM {s}"""
        for c, s in (("rating", "sized"), ("helpful_count", "sized"), ("char_count", "sized"), ("word_count", "sized"))
    ),
    "sized",
)
def _(v):
    return A.describe_numeric(v.sized, ["rating", "helpful_count", "char_count", "word_count"])


@query(
    "missing_values",
    """SELECT 'true_sentiment' AS "column", count(*) FILTER (WHERE true_sentiment IS NULL) AS missing,
    round(count(*) FILTER (WHERE true_sentiment IS NULL) * 100.0::DOUBLE / count(*), 6) AS missing_pct FROM review_docs""",
    "review_docs",
)
def _(v):
    return A.missing_values(v.docs)


@query(
    "duplicate_rows",
    """SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates FROM (SELECT r.*, count(*) AS n FROM (SELECT * EXCLUDE (review_id) FROM reviews) r
     GROUP BY ALL)""",
)
def _(v):
    # All columns but the unique id, which would make every row distinct.
    return A.duplicate_rows(v.reviews.drop("review_id"))


@query("duplicate_texts", "SELECT count(*) - count(DISTINCT review_text) AS duplicates FROM review_docs", "review_docs")
def _(v):
    return A.duplicate_texts(v.docs)


@query(
    "dataset_summary",
    """SELECT count(*) AS total_reviews, strftime(min(review_date), '%Y-%m-%d') AS first_date, strftime(max(review_date), '%Y-%m-%d') AS last_date,
    count(DISTINCT product_id) AS products, count(DISTINCT category) AS categories, round(avg(word_count), 6) AS avg_words,
    round(avg(rating), 6) AS avg_rating, round(avg(CASE WHEN verified_purchase THEN 100.0::DOUBLE ELSE 0 END), 6) AS verified_pct,
    (SELECT rating FROM sized GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS modal_rating FROM sized""",
    "sized",
)
def _(v):
    return A.dataset_summary(v.sized)


@query(
    "best_worst_rated_category",
    """WITH m AS (SELECT category, avg(rating) AS r FROM reviews GROUP BY 1)
    SELECT * FROM (SELECT 'best' AS side, category, round(r, 6) AS avg_rating FROM m ORDER BY r DESC, category LIMIT 1)
    UNION ALL SELECT * FROM (SELECT 'worst', category, round(r, 6) FROM m ORDER BY r, category LIMIT 1)""",
)
def _(v):
    return A.best_worst_rated_category(v.reviews)


@query(
    "category_topics_summary",
    """WITH c AS (SELECT category, predicted_sentiment, count(*) AS n FROM review_docs GROUP BY 1, 2)
    SELECT category, CAST(sum(n) AS BIGINT) AS total_reviews, string_agg(predicted_sentiment || '=' || n, ',' ORDER BY predicted_sentiment) AS sentiments
    FROM c GROUP BY 1 HAVING sum(n) >= 50""",
    "review_docs",
)
def _(v):
    df = A.category_topics_summary(v.docs)
    pairs = F.transform(
        F.map_entries("sentiment_distribution"), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return df.select("category", "total_reviews", F.array_join(F.array_sort(pairs), ",").alias("sentiments"))


def top_words(tokens, label, n, source, extra=""):
    return f"""WITH w AS (SELECT {label}, unnest({tokens}) AS word FROM {source} WHERE {label} IS NOT NULL),
    c AS (SELECT {label}, word, count(*) AS n FROM w GROUP BY 1, 2),
    r AS (SELECT {label}, word, n, CAST(row_number() OVER (PARTITION BY {label} ORDER BY n DESC, word) AS INT) AS rank FROM c)
    SELECT * {extra} FROM r WHERE rank <= {n}"""


@query(
    "top_words_by_sentiment",
    top_words("regexp_extract_all(lower(review_text), '[\\p{L}\\p{N}_]{4,}')", "true_sentiment", 15, "review_docs"),
    "review_docs",
)
def _(v):
    return A.top_words_by_sentiment(v.docs)


@query(
    "top_tokens_by_sentiment",
    top_words(sql_words("cleaned_text"), "predicted_sentiment", 10, "cleaned") + " AND length(word) >= 4",
    "cleaned",
)
def _(v):
    return A.top_tokens_by_sentiment(v.cleaned)


@query(
    "wordcloud_terms",
    top_words(
        sql_gram_tokens("cleaned_text"), "predicted_sentiment", 100, "cleaned",
        ", round(n::DOUBLE / max(n) OVER (PARTITION BY predicted_sentiment), 6) AS weight",
    ),
    "cleaned",
)
def _(v):
    return A.wordcloud_terms(v.cleaned, stop_words=ENGLISH_STOP_WORDS)


@query(
    "service_issue_rate",
    f"""WITH m AS (SELECT count(*) AS n, coalesce({rate("negative")}, 0) AS r FROM cleaned WHERE regexp_matches(cleaned_text, '(?i)tion|eau|ing'))
    SELECT n AS mentions, round(r, 6) AS negative_rate, r > 0.2 AS alert FROM m""",
    "cleaned",
)
def _(v):
    return A.service_issue_rate(v.cleaned, ["tion", "eau", "ing"], 0.2)


@query("response_rate", "SELECT round(avg(CASE WHEN helpful_count > 0 THEN 100.0::DOUBLE ELSE 0 END), 6) AS response_rate FROM reviews")
def _(v):
    return A.response_rate(v.reviews)


@query(
    "worst_category_insight",
    """WITH c AS (SELECT category, count(*) AS t, count(*) FILTER (WHERE predicted_sentiment = 'positive') AS p,
      count(*) FILTER (WHERE predicted_sentiment = 'negative') AS n FROM reviews GROUP BY 1 HAVING count(*) >= 50),
    r AS (SELECT CASE WHEN n > p * 0.3 THEN 'negative' ELSE 'fallback' END AS kind, category,
      CASE WHEN n > p * 0.3 THEN n::DOUBLE / t ELSE p::DOUBLE / t END AS ratio FROM c)
    SELECT kind, category, round(ratio, 6) AS ratio FROM r
    ORDER BY CASE kind WHEN 'negative' THEN -ratio ELSE 1 + ratio END, category LIMIT 1""",
)
def _(v):
    return A.worst_category_insight(v.reviews)


HIERARCHY = """SELECT CAST(0 AS INT) AS level, 'All Reviews' AS label, '' AS parent, count(*) AS n FROM reviews
 UNION ALL SELECT 1, category, 'All Reviews', count(*) FROM reviews GROUP BY category
 UNION ALL SELECT 2, upper(left(predicted_sentiment, 1)) || substr(predicted_sentiment, 2), category, count(*) FROM reviews GROUP BY category, predicted_sentiment"""


@query("sentiment_hierarchy", HIERARCHY)
def _(v):
    return A.sentiment_hierarchy(v.reviews)


@query(
    "rating_hierarchy",
    """SELECT 'Rating ' || rating AS label, '' AS parent, count(*) AS n FROM reviews GROUP BY rating
    UNION ALL SELECT upper(left(predicted_sentiment, 1)) || substr(predicted_sentiment, 2), 'Rating ' || rating, count(*) FROM reviews GROUP BY rating, predicted_sentiment""",
)
def _(v):
    return A.rating_hierarchy(v.reviews)
