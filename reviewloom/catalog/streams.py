"""Queries of section N: the monitors, run over what the stream holds now."""

from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..streaming import monitors as N
from .base import query, sql_gram_tokens

SENTIMENT = "CASE WHEN event_id % 10 < 6 THEN 'positive' WHEN event_id % 10 < 8 THEN 'negative' ELSE 'neutral' END"


def event_stream(v):
    """The event table as a stream of reviews."""
    raw = N.read_review_stream(v.spark, v.sf_dir, v.table("events").schema, "events.parquet")
    return raw.selectExpr(
        "event_id AS review_id", "user_id AS product_id", "event_type AS category", "ts AS review_date",
        "CAST(1 + event_id % 5 AS INT) AS rating", f"{SENTIMENT} AS predicted_sentiment",
    )


def document_stream(v):
    raw = N.read_review_stream(v.spark, v.sf_dir, v.table("documents").schema, "documents.parquet")
    return raw.selectExpr(
        "doc_id AS review_id", "lang AS category", "text AS review_text",
        "CAST(DATE '2023-01-01' + CAST(doc_id % 730 AS INT) AS TIMESTAMP) AS review_date",
        "CASE WHEN doc_id % 7 <= 1 THEN 'negative' WHEN doc_id % 7 = 2 THEN 'neutral' ELSE 'positive' END AS predicted_sentiment",
    )


RATES = """r AS (SELECT CAST(date_trunc('day', review_date) AS TIMESTAMP) AS window_start, category, count(*) AS n,
 avg(CASE WHEN predicted_sentiment = 'negative' THEN 1.0::DOUBLE ELSE 0 END) AS negative_rate FROM review_events GROUP BY 1, 2)"""
TS = "'%Y-%m-%d %H:%M:%S'"


@query(
    "stream_negative_rate",
    f"""WITH {RATES} SELECT strftime(window_start, {TS}) AS window_start, strftime(window_start + INTERVAL 1 DAY, {TS}) AS window_end, category, n,
    round(negative_rate, 6) AS negative_rate FROM r""",
    "review_events",
)
def _(v):
    return N.run_available_updates(N.stream_negative_rate(event_stream(v)), ["window_start", "window_end", "category"])


# Windows are given out once the watermark, an hour behind the newest event, has passed their end.
CLOSED = "window_start + INTERVAL 1 DAY <= (SELECT max(review_date) - INTERVAL 1 HOUR FROM review_events)"


@query(
    "stream_sentiment_drop",
    f"""WITH {RATES}, c AS (SELECT *, negative_rate - lag(negative_rate) OVER (PARTITION BY category ORDER BY window_start) AS change FROM r WHERE {CLOSED})
    SELECT category, strftime(window_start, {TS}) AS window_start, round(negative_rate, 6) AS negative_rate, round(change, 6) AS change, coalesce(change > 0.1, false) AS alert FROM c""",
    "review_events",
)
def _(v):
    rates = N.restream(N.stream_negative_rate(event_stream(v)))
    return N.run_available(N.stream_sentiment_drop(rates))


@query(
    "stream_volume_anomaly",
    f"""WITH e AS (SELECT category, time_bucket(INTERVAL 15 MINUTE, review_date) - INTERVAL 15 MINUTE * unnest(range(4)) AS window_start FROM review_events),
    c AS (SELECT category, window_start, count(*) AS n FROM e GROUP BY 1, 2 HAVING window_start + INTERVAL 1 HOUR <= (SELECT max(review_date) - INTERVAL 1 HOUR FROM review_events)),
    z AS (SELECT *, (n - avg(n) OVER f) / nullif(stddev_samp(n) OVER f, 0) AS z FROM c WINDOW f AS (PARTITION BY category ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT category, strftime(window_start, {TS}) AS window_start, n, round(z, 4) AS z_score, coalesce(abs(z) > 3, false) AS alert FROM z""",
    "review_events",
)
def _(v):
    volumes = N.restream(N.stream_volume(event_stream(v)))
    return N.run_available(N.stream_volume_anomaly(volumes)).withColumn("z_score", F.round("z_score", 4))


@query(
    "stream_trending_terms",
    f"""WITH t AS (SELECT review_date, unnest({sql_gram_tokens("cleaned_text")}) AS term FROM cleaned),
    w AS (SELECT CAST(review_date AS TIMESTAMP) - INTERVAL 1 DAY * unnest(range(7)) AS window_start, term FROM t),
    c AS (SELECT window_start, term, count(*) AS n FROM w GROUP BY 1, 2),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY n DESC, term) AS INT) AS rank FROM c)
    SELECT strftime(window_start, {TS}) AS window_start, term, n, rank FROM r WHERE rank <= 3""",
    "cleaned",
)
def _(v):
    stream = document_stream(v).withColumn("review_text", clean_text(F.col("review_text")))
    counts = N.run_available_updates(N.stream_trending_terms(stream), ["slide_start", "term"])
    return N.top_terms(N.sliding_counts(counts), 3)


@query(
    "stream_category_issues",
    """SELECT review_id, category, CASE category WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' END AS team, regexp_matches(lower(review_text), 'the|les') AS is_urgent
    FROM review_docs WHERE predicted_sentiment = 'negative'""",
    "review_docs",
)
def _(v):
    teams = v.spark.createDataFrame([("en", "English"), ("fr", "French")], "category string, team string")
    issues = N.stream_category_issues(document_stream(v), teams, ["the", "les"])
    return N.run_available(issues.select("review_id", "category", "team", "is_urgent"))


@query(
    "stream_session",
    f"""WITH o AS (SELECT product_id, review_date, CASE WHEN review_date <= lag(review_date) OVER (PARTITION BY product_id ORDER BY review_date) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS brk FROM review_events),
    g AS (SELECT *, sum(brk) OVER (PARTITION BY product_id ORDER BY review_date ROWS UNBOUNDED PRECEDING) AS s FROM o),
    a AS (SELECT product_id, min(review_date) AS session_start, max(review_date) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM g GROUP BY product_id, s)
    SELECT product_id, strftime(session_start, {TS}) AS session_start, strftime(session_end, {TS}) AS session_end, n FROM a
    WHERE session_end <= (SELECT max(review_date) - INTERVAL 1 HOUR FROM review_events)""",
    "review_events",
)
def _(v):
    return N.run_available(N.stream_session(event_stream(v)))


@query("stream_dedup", "SELECT review_id, product_id FROM review_events", "review_events")
def _(v):
    # Every third review is sent twice.
    sent = event_stream(v).select("review_id", "product_id", "review_date")
    again = F.when(F.col("review_id") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    kept = N.stream_dedup(sent.select("*", F.explode(again).alias("copy")).drop("copy"), "review_id", "60 days")
    return N.run_available(kept.select("review_id", "product_id"))
