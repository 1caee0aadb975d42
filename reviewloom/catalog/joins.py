"""Queries of section C: joins."""

from pyspark.sql import functions as F

from ..functions.text import words
from ..functions.wordlists import ENGLISH_STOP_WORDS
from ..operators import aggregates as A
from ..operators import joins as C
from .base import query, sql_list, sql_words
from .periods import RECENT_OLDER, period_words

# Frequent words of the supplied texts serve as topics and as a lexicon.
TOPICS = ("tion", "the", "eau", "los", "ung", "and")
POSITIVE = ("the", "and", "les", "der")
NEGATIVE = ("of", "in", "los", "die")

MENTIONS = f"""SELECT review_id, topic FROM cleaned, (SELECT unnest({list(TOPICS)}) AS topic)
 WHERE contains(lower(cleaned_text), topic)"""


@query(
    "weekly_sentiment_share",
    """WITH c AS (SELECT CAST(date_trunc('week', review_date) AS DATE) AS week, predicted_sentiment, count(*) AS n FROM reviews GROUP BY 1, 2)
    SELECT strftime(week, '%Y-%m-%d') AS week, predicted_sentiment, n, CAST(sum(n) OVER (PARTITION BY week) AS BIGINT) AS total,
    round(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY week), 6) AS percentage FROM c""",
)
def _(v):
    return C.weekly_sentiment_share(v.reviews)


@query(
    "trend_score",
    f"""WITH {RECENT_OLDER}
    SELECT r.term, round(r.score, 6) AS recent_score, round(coalesce(o.score, 0.001::DOUBLE), 6) AS older_score,
     round((r.score - coalesce(o.score, 0.001::DOUBLE)) / coalesce(o.score, 0.001::DOUBLE), 6) AS trend_score,
     round((r.score - coalesce(o.score, 0.001::DOUBLE)) / coalesce(o.score, 0.001::DOUBLE) * 100, 6) AS percentage_change
    FROM r LEFT JOIN o ON r.term = o.term""",
    "cleaned",
)
def _(v):
    return C.trend_score(*period_words(v))


@query("topic_mentions", MENTIONS, "cleaned")
def _(v):
    return C.topic_mentions(v.cleaned.select("review_id", "cleaned_text"), TOPICS).select("review_id", "topic")


@query(
    "topic_mentions_regex",
    """SELECT review_id, topic FROM cleaned, (SELECT unnest(['t[ih]on', '\\bthe\\b', 'e.u$']) AS topic)
     WHERE regexp_matches(cleaned_text, '(?i)' || topic)""",
    "cleaned",
)
def _(v):
    topics = ("t[ih]on", r"\bthe\b", "e.u$")
    return C.topic_mentions(v.cleaned.select("review_id", "cleaned_text"), topics, regex=True).select(
        "review_id", "topic"
    )


PATTERNS = ("t[ih]on", r"\bthe\b", "e.u$", "los|den", r"[xyz]\d", "z+a", "(ab|cd)e", r"\d{3}-\d", "QU(E|I)", "^a", "nowhere at all")


@query(
    "topic_mentions_patterns",
    f"""SELECT review_id, topic FROM cleaned, (SELECT unnest([{", ".join(f"'{p}'" for p in PATTERNS)}]) AS topic)
     WHERE regexp_matches(cleaned_text, '(?i)' || topic)""",
    "cleaned",
)
def _(v):
    topics = v.spark.createDataFrame([(p,) for p in PATTERNS], "topic string")
    return C.topic_mentions(v.cleaned.select("review_id", "cleaned_text"), topics, regex=True).select("review_id", "topic")


@query(
    "lexicon_join",
    f"""WITH w AS (SELECT review_id, unnest({sql_words("lower(cleaned_text)")}) AS term FROM cleaned)
    SELECT review_id, count(*) FILTER (WHERE term IN {sql_list(POSITIVE)}) AS positive_word_count,
     count(*) FILTER (WHERE term IN {sql_list(NEGATIVE)}) AS negative_word_count
    FROM w WHERE term IN {sql_list(POSITIVE + NEGATIVE)} GROUP BY 1""",
    "cleaned",
)
def _(v):
    return C.lexicon_join(v.cleaned, C.lexicon_table(v.cleaned, POSITIVE, NEGATIVE))


@query(
    "stopword_anti_join",
    f"""WITH w AS (SELECT review_id, unnest({sql_words("cleaned_text")}) AS word FROM cleaned)
    SELECT review_id, word, count(*) AS n FROM w WHERE word NOT IN {sql_list(ENGLISH_STOP_WORDS)} GROUP BY 1, 2""",
    "cleaned",
)
def _(v):
    tokens = v.cleaned.select("review_id", F.explode(words(F.col("cleaned_text"))).alias("word"))
    stops = v.spark.createDataFrame([(w,) for w in ENGLISH_STOP_WORDS], "w string")
    kept = C.stopword_anti_join(tokens, stops)
    return kept.groupBy("review_id", "word").agg(F.count(F.lit(1)).alias("n"))


PROBLEMS_SQL = """p AS (SELECT product_id, avg(CASE WHEN predicted_sentiment = 'negative' THEN 1.0::DOUBLE ELSE 0 END) AS negative_rate,
  avg(rating) AS avg_rating, count(TEXT) AS review_count FROM reviews GROUP BY 1
  HAVING count(TEXT) >= 10 AND avg(CASE WHEN predicted_sentiment = 'negative' THEN 1.0::DOUBLE ELSE 0 END) > 0.3
  ORDER BY negative_rate DESC, product_id LIMIT 10)"""


@query(
    "problem_product_samples",
    f"""WITH {PROBLEMS_SQL.replace("TEXT", "product_name")}
    SELECT * FROM (SELECT product_id, review_id, product_name, CAST(row_number() OVER (PARTITION BY product_id ORDER BY review_id) AS INT) AS rank
     FROM reviews WHERE predicted_sentiment = 'negative' AND product_id IN (SELECT product_id FROM p)) WHERE rank <= 3""",
)
def _(v):
    products = A.problem_products(v.reviews, text_col="product_name")
    return C.problem_product_samples(v.reviews, products, text_col="product_name")


@query(
    "true_vs_predicted",
    """SELECT review_id, true_sentiment, predicted_sentiment, true_sentiment = predicted_sentiment AS correct
    FROM review_docs WHERE true_sentiment IS NOT NULL""",
    "review_docs",
)
def _(v):
    return C.true_vs_predicted(v.docs, v.docs)
