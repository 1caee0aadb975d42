"""Queries of sections E and I: windows over series and time buckets."""

from pyspark.sql import functions as F

from ..operators import timeseries as I
from ..operators import windows as E
from .aggregates import SIGNED, rate
from .base import query
from .joins import TOPICS

DAILY = "d AS (SELECT CAST(review_date AS DATE) AS day, count(*) AS n FROM reviews GROUP BY 1)"
WEEKLY = f"""w0 AS (SELECT CAST(date_trunc('week', review_date) AS DATE) + 6 AS week_end, {rate("positive")} AS positive_rate,
  avg(rating) AS avg_rating, count(product_name) AS review_count FROM reviews GROUP BY 1),
 w AS (SELECT s.week_end, coalesce(positive_rate, 0) AS positive_rate, avg_rating, coalesce(review_count, 0) AS review_count
  FROM (SELECT CAST(unnest(generate_series((SELECT min(week_end) FROM w0), (SELECT max(week_end) FROM w0), INTERVAL 7 DAY)) AS DATE) AS week_end) s
  LEFT JOIN w0 USING (week_end))"""


def _weekly(v):
    return I.weekly_sentiment(v.reviews, "product_name")


@query(
    "rolling_7",
    f"""WITH {DAILY} SELECT strftime(day, '%Y-%m-%d') AS day, n,
    CASE WHEN count(n) OVER f = 7 THEN round(avg(n) OVER f, 6) END AS rolling_mean FROM d
    WINDOW f AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def _(v):
    return E.rolling_7(v.reviews)


@query(
    "trend_4w",
    f"""WITH {WEEKLY}, a AS (SELECT positive_rate, row_number() OVER (ORDER BY week_end DESC) AS age FROM w),
    r AS (SELECT avg(positive_rate) FILTER (WHERE age <= 4) AS a, avg(positive_rate) FILTER (WHERE age BETWEEN 5 AND 8) AS b FROM a)
    SELECT round(a, 6) AS recent_rate, round(b, 6) AS previous_rate, CASE WHEN a > b THEN 'improving' ELSE 'declining' END AS trend FROM r""",
)
def _(v):
    return E.trend_4w(_weekly(v))


@query(
    "anomaly_weeks",
    f"""WITH {WEEKLY}, z AS (SELECT week_end, positive_rate, (positive_rate - avg(positive_rate) OVER ()) / stddev_pop(positive_rate) OVER () AS z FROM w)
    SELECT strftime(week_end, '%Y-%m-%d') AS week_end, round(positive_rate, 6) AS positive_rate, round(z, 6) AS z_score FROM z WHERE abs(z) > 2""",
)
def _(v):
    return E.anomaly_weeks(_weekly(v))


@query(
    "topn_per_group",
    """WITH c AS (SELECT category, CAST(product_id AS VARCHAR) AS term, avg(rating) AS score FROM reviews GROUP BY 1, 2)
    SELECT category, term, round(score, 6) AS score, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY category ORDER BY score DESC, term) AS INT) AS rank FROM c) WHERE rank <= 5""",
)
def _(v):
    scores = v.reviews.groupBy("category", F.col("product_id").cast("string").alias("term")).agg(
        F.avg("rating").alias("score")
    )
    return E.topn_per_group(scores, "category", "score", 5)


@query(
    "share_of_total",
    """SELECT category, predicted_sentiment, count(*) AS n, round(count(*) / (sum(count(*)) OVER (PARTITION BY category))::DOUBLE, 6) AS share
    FROM reviews GROUP BY 1, 2""",
)
def _(v):
    counts = v.reviews.groupBy("category", "predicted_sentiment").agg(F.count(F.lit(1)).alias("n"))
    return E.share_of_total(counts, ["category"])


@query(
    "priority_matrix",
    f"""WITH m AS (SELECT category, count(*) AS volume, {rate("negative")} AS r, avg(rating) AS a FROM reviews GROUP BY 1),
    e AS (SELECT category, volume, r * 100 AS negative_pct, volume * r AS impact, (5 - a) / 5 * 100 AS effort FROM m),
    p AS (SELECT *, CASE WHEN effort < 50 AND impact > (SELECT median(impact) FROM e) THEN 1 WHEN impact > (SELECT median(impact) FROM e) THEN 2
      WHEN effort < 50 THEN 3 ELSE 4 END AS o FROM e)
    SELECT category, volume, round(negative_pct, 6) AS negative_pct, round(impact, 6) AS impact, round(effort, 6) AS effort, CAST(o AS INT) AS priority_order,
    CASE o WHEN 1 THEN 'Quick Win' WHEN 2 THEN 'Major Project' WHEN 3 THEN 'Fill-in' ELSE 'Low Priority' END AS priority FROM p""",
)
def _(v):
    return E.priority_matrix(v.reviews)


@query(
    "category_trend",
    f"""WITH m AS (SELECT max(review_date) AS hi FROM reviews)
    SELECT category, round(a, 6) AS recent_negative, round(b, 6) AS prior_negative, round(a - b, 6) AS trend FROM (
     SELECT category, {rate("negative")} FILTER (WHERE review_date > hi - INTERVAL 300 DAY) AS a,
     {rate("negative")} FILTER (WHERE review_date > hi - INTERVAL 600 DAY AND review_date <= hi - INTERVAL 300 DAY) AS b FROM reviews, m GROUP BY 1)""",
)
def _(v):
    return E.category_trend(v.reviews, 300)


@query(
    "month_over_prior",
    f"""WITH w AS (SELECT CAST(date_trunc('week', review_date) AS DATE) AS week, {rate("negative")} AS r FROM reviews GROUP BY 1),
    c AS (SELECT week, r, r - lag(r) OVER (ORDER BY week) AS change FROM w)
    SELECT strftime(week, '%Y-%m-%d') AS week, round(r, 6) AS negative_rate, round(change, 6) AS change, coalesce(change > 0.1, false) AS alert FROM c""",
)
def _(v):
    return E.month_over_prior(v.reviews)


@query(
    "volume_anomaly",
    f"""WITH {DAILY}, z AS (SELECT day, n, (n - avg(n) OVER f) / nullif(stddev_samp(n) OVER f, 0) AS z FROM d
      WINDOW f AS (ORDER BY day ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))
    SELECT strftime(day, '%Y-%m-%d') AS day, n, round(z, 6) AS z_score FROM z""",
)
def _(v):
    return E.volume_anomaly(v.reviews)


@query(
    "weekly_sentiment",
    f"""WITH {WEEKLY} SELECT strftime(week_end, '%Y-%m-%d') AS week_end, round(positive_rate, 6) AS positive_rate,
    round(avg_rating, 6) AS avg_rating, review_count FROM w""",
)
def _(v):
    return _weekly(v)


@query(
    "weekly_share_monday",
    """SELECT strftime(week, '%Y-%m-%d') AS week, predicted_sentiment, n, round(n / (sum(n) OVER (PARTITION BY week))::DOUBLE, 6) AS share FROM (
     SELECT CAST(date_trunc('week', review_date) AS DATE) AS week, predicted_sentiment, count(*) AS n FROM reviews GROUP BY 1, 2)""",
)
def _(v):
    return I.weekly_share_monday(v.reviews)


@query(
    "weekly_share_filled",
    """WITH c AS (SELECT predicted_sentiment, CAST(date_trunc('week', review_date) AS DATE) + 6 AS week_end, count(*) AS n FROM reviews GROUP BY 1, 2),
    s AS (SELECT predicted_sentiment, CAST(unnest(generate_series(min(week_end), max(week_end), INTERVAL 7 DAY)) AS DATE) AS week_end FROM c GROUP BY 1),
    f AS (SELECT s.predicted_sentiment, s.week_end, coalesce(n, 0) AS n FROM s LEFT JOIN c USING (predicted_sentiment, week_end))
    SELECT predicted_sentiment, strftime(week_end, '%Y-%m-%d') AS week_end, n,
    round(n * 100.0::DOUBLE / nullif(sum(n) OVER (PARTITION BY week_end), 0), 6) AS percentage FROM f""",
)
def _(v):
    return I.weekly_share_filled(v.reviews)


@query("daily_volume", f"WITH {DAILY} SELECT strftime(day, '%Y-%m-%d') AS day, n FROM d")
def _(v):
    return I.daily_volume(v.reviews)


@query("daily_sentiment", "SELECT strftime(review_date, '%Y-%m-%d') AS day, predicted_sentiment, count(*) AS n FROM reviews GROUP BY 1, 2")
def _(v):
    return I.daily_sentiment(v.reviews)


@query("monthly_positive", f"SELECT CAST(month(review_date) AS INT) AS month, round({rate('positive')}, 6) AS positive_rate FROM reviews GROUP BY 1")
def _(v):
    return I.monthly_positive(v.reviews)


def heat(value, digits=6):
    return "SELECT dow, " + ", ".join(
        f"round(max(v) FILTER (WHERE h = {h}), {digits}) AS h{h:02d}" for h in range(24)
    ) + f""" FROM (SELECT CAST(isodow(review_date) - 1 AS INT) AS dow, hour(review_date) AS h, {value} AS v
    FROM review_events GROUP BY 1, 2) GROUP BY 1"""


@query("dow_hour_heatmap", heat(f"{rate('positive')} * 100"), "review_events")
def _(v):
    return I.dow_hour_heatmap(v.events)


@query("dow_hour_heatmap_score", heat(f"avg({SIGNED})"), "review_events")
def _(v):
    return I.dow_hour_heatmap(v.events, "score")


@query(
    "dayofweek_counts",
    "WITH days AS (SELECT unnest(range(7)) AS d), names AS (SELECT d, ['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'][d + 1] AS day_name FROM days), "
    "c AS (SELECT isodow(review_date) - 1 AS d, count(*) AS n FROM reviews GROUP BY 1) "
    "SELECT CAST(names.d AS INT) AS dow, day_name, n FROM names LEFT JOIN c ON c.d = names.d",
)
def _(v):
    return I.dayofweek_counts(v.reviews)


@query(
    "topic_daily_prevalence",
    f"""WITH m AS (SELECT CAST(max(review_date) AS DATE) AS hi FROM cleaned),
    r AS (SELECT CAST(review_date AS DATE) AS day, cleaned_text FROM cleaned, m WHERE CAST(review_date AS DATE) > hi - 30),
    t AS (SELECT unnest({list(TOPICS)}) AS topic),
    g AS (SELECT CAST(unnest(generate_series((SELECT hi - 29 FROM m), (SELECT hi FROM m), INTERVAL 1 DAY)) AS DATE) AS day),
    k AS (SELECT day, topic, count(*) AS mentions FROM r, t WHERE contains(cleaned_text, topic) GROUP BY 1, 2),
    n AS (SELECT day, count(*) AS reviews FROM r GROUP BY 1)
    SELECT strftime(g.day, '%Y-%m-%d') AS day, t.topic, coalesce(mentions, 0) AS mentions, coalesce(reviews, 0) AS reviews,
     round(coalesce(mentions::DOUBLE / nullif(reviews, 0), 0), 6) AS prevalence
    FROM g CROSS JOIN t LEFT JOIN k ON k.day = g.day AND k.topic = t.topic LEFT JOIN n ON n.day = g.day""",
    "cleaned",
)
def _(v):
    return I.topic_daily_prevalence(v.cleaned, TOPICS)
