"""Queries of section L: business rules."""

from pyspark.sql import functions as F

from ..operators import business as B
from ..operators import keywords as M
from ..operators import ranking as R
from ..plans.scratch import materialize
from .aggregates import CSI, rate
from .base import query
from .joins import PROBLEMS_SQL
from .periods import PERIODS
from .timeseries import WEEKLY


def pct(value, digits):
    return f"format('{{:.{digits}f}}', round_even({value}, {digits}))"


@query(
    "financial_impact",
    f"""WITH b AS (SELECT count(DISTINCT review_id) AS c, {rate("negative")} AS r FROM reviews)
    SELECT c AS total_customers, round(r * c * 75 * 2.5, 6) AS lost_revenue, round(c * 0.1::DOUBLE * 75, 6) AS improvement_potential, 50000.0::DOUBLE AS intervention_cost,
    round((c * 0.1::DOUBLE * 75 - 50000) / 50000 * 100, 6) AS roi, CAST(trunc(50000 / (c * 0.1::DOUBLE * 75 / 365)) AS BIGINT) AS payback_days FROM b""",
)
def _(v):
    return B.financial_impact(v.reviews)


FINANCE = f"""b AS (SELECT count(*) AS n, {rate("negative")} AS r FROM reviews),
fin AS (SELECT n, r * n AS neg, r * n * 75 * 2.5 AS lost, n * r * 0.3 * 500 AS churn, r * n * 0.1 * 75 * 12 AS rec FROM b)"""


@query(
    "financial_metrics_dashboard",
    f"""WITH {FINANCE} SELECT n AS total_customers, CAST(trunc(neg) AS BIGINT) AS negative_customers, round(lost, 6) AS lost_revenue, round(churn, 6) AS churn_loss,
    round(lost + churn, 6) AS revenue_at_risk, round(rec, 6) AS improvement_potential, 50000.0::DOUBLE AS intervention_cost,
    round((rec - 50000) / 50000 * 100, 6) AS roi, CAST(trunc(50000 / (rec / 365)) AS BIGINT) AS payback_days FROM fin""",
)
def _(v):
    return B.financial_metrics_dashboard(v.reviews)


@query(
    "revenue_waterfall",
    f"""WITH {FINANCE} SELECT 1 AS step, 'Current Risk' AS name, round(lost + churn, 6) AS value FROM fin UNION ALL SELECT 2, 'Investment', -50000.0 FROM fin
    UNION ALL SELECT 3, 'Recovery Potential', round(rec, 6) FROM fin UNION ALL SELECT 4, 'Net Benefit', round(rec - 50000, 6) FROM fin""",
)
def _(v):
    return B.revenue_waterfall(v.reviews)


RULES = f"""
csi AS (SELECT {CSI} AS c FROM reviews),
{PROBLEMS_SQL.replace("TEXT", "product_name")},
p1 AS (SELECT * FROM p ORDER BY negative_rate DESC, product_id LIMIT 1),
worst AS (SELECT category, {rate("negative")} AS r FROM reviews GROUP BY 1 ORDER BY r DESC, category LIMIT 1),
{WEEKLY}, age AS (SELECT positive_rate, row_number() OVER (ORDER BY week_end DESC) AS age FROM w),
tr AS (SELECT avg(positive_rate) FILTER (WHERE age <= 4) AS a, avg(positive_rate) FILTER (WHERE age BETWEEN 5 AND 8) AS b FROM age),
rec AS (
SELECT 1 AS rule_order, 'Customer Satisfaction' AS category, 'HIGH' AS priority, 'Customer Satisfaction Index (' || {pct("c", 1)} || '%) is ' || {pct("80 - c", 1)} || '% below target' AS issue,
 'Implement immediate quality improvement program' AS recommendation, 'Increase customer retention by ' || {pct("(80 - c) * 0.5", 0)} || '%' AS expected_impact, '30 days' AS timeline FROM csi WHERE c < 80
UNION ALL SELECT 2, 'Product Quality', 'HIGH', 'Product ' || product_id || ' has ' || {pct("negative_rate * 100", 0)} || '% negative reviews',
 'Conduct quality audit and consider product redesign', 'Reduce returns by 20-30%', '60 days' FROM p1
UNION ALL SELECT 3, 'Category Management', 'MEDIUM', category || ' category has ' || {pct("r * 100", 0)} || '% negative reviews',
 'Review supplier quality standards and enhance QC processes', 'Improve category NPS by 15-20 points', '45 days' FROM worst WHERE r > 0.25
UNION ALL SELECT 5, 'Trend Alert', 'HIGH', 'Customer satisfaction declining by ' || {pct("(b - a) * 100", 1)} || '% over past month',
 'Launch customer win-back campaign and service recovery program', 'Reverse negative trend within 30 days', 'Immediate' FROM tr WHERE NOT coalesce(a > b, false))"""


@query("recommendations", f"WITH {RULES} SELECT * FROM rec")
def _(v):
    return B.recommendations(v.reviews, text_col="product_name")


@query("top5_recommendations", f"WITH {RULES} SELECT * FROM rec ORDER BY rule_order LIMIT 5")
def _(v):
    return R.top5_recommendations(B.recommendations(v.reviews, text_col="product_name"))


# The rules over the texts, with the trending topics and what their mentions say.
TOPIC_RULES = f"""reviews AS (SELECT *, review_text AS product_name FROM cleaned), {RULES}, {PERIODS},
mt AS (SELECT t.term AS topic, t.trend_score, c.rating FROM trending t JOIN cleaned c ON contains(c.cleaned_text, t.term)),
im AS (SELECT topic, count(*) AS n, avg(rating) AS avg_rating, any_value(trend_score) AS trend_score FROM mt GROUP BY 1 ORDER BY any_value(trend_score) DESC, topic LIMIT 3),
trec AS (SELECT * FROM rec UNION ALL SELECT 4, 'Emerging Issues', 'MEDIUM', '"' || topic || '" mentioned in ' || n || ' reviews with avg rating ' || {pct("avg_rating", 1)},
 'Address ' || topic || ' issues across affected products', 'Prevent escalation to major customer concern', '14 days' FROM im WHERE avg_rating < 3)""".replace("\ntr AS (SELECT r.term", "\ntrd AS (SELECT r.term").replace("FROM tr WHERE trend_score > 0.5", "FROM trd WHERE trend_score > 0.5")


@query("recommendations_with_topics", f"WITH {TOPIC_RULES} SELECT * FROM trec", "cleaned")
def _(v):
    trending = materialize(M.trending_topics(v.stage), "trending")
    return B.recommendations(v.stage, trending)


@query(
    "dashboard_recommendations",
    f"""WITH {FINANCE}, rates AS (SELECT category, {rate("negative")} AS r FROM reviews GROUP BY 1),
    worst AS (SELECT * FROM rates ORDER BY r DESC, category LIMIT 1), best AS (SELECT * FROM rates ORDER BY r, category DESC LIMIT 1),
    service AS (SELECT coalesce({rate("negative")}, 0) AS r FROM reviews WHERE regexp_matches(product_name, '(?i)response|service|support|help')),
    rn AS (SELECT {rate("negative")} FILTER (WHERE review_date > (SELECT max(review_date) - INTERVAL 30 DAY FROM reviews)) AS a, {rate("negative")} AS b FROM reviews),
    roi AS (SELECT (rec - 50000) / 50000 * 100 AS roi, lost + churn AS risk FROM fin)
    SELECT 1 AS rule_order, 'Financial' AS category, 'HIGH' AS priority, '$' || {pct("risk / 1000", 0)} || 'K revenue at risk' AS issue, 'Implement customer recovery program' AS recommendation,
     {pct("roi", 0)} || '% ROI' AS expected_impact, '30 days' AS timeline FROM roi WHERE roi > 200
    UNION ALL SELECT 2, 'Product Quality', 'HIGH', category || ': ' || {pct("r * 100", 0)} || '% negative', 'Quality audit and supplier review', 'Reduce returns by 25%', '45 days' FROM worst WHERE r > 0.3
    UNION ALL SELECT 3, 'Customer Service', 'MEDIUM', {pct("r * 100", 0)} || '% negative service mentions', 'Enhance support training program', 'Improve CSAT by 15%', '60 days' FROM service WHERE r > 0.4
    UNION ALL SELECT 4, 'Marketing', 'MEDIUM', category || ': ' || {pct("(1 - r) * 100", 0)} || '% positive', 'Leverage in marketing campaigns', '+10% sales potential', '30 days' FROM best WHERE 1 - r > 0.7
    UNION ALL SELECT 5, 'Trend Alert', 'HIGH', 'Negative sentiment increasing', 'Immediate intervention required', 'Prevent escalation', 'Immediate' FROM rn WHERE a > b * 1.2""",
)
def _(v):
    return B.dashboard_recommendations(v.reviews, "product_name")


INSIGHTS = f"""
ins AS (SELECT 1 AS rule_order, CASE WHEN c < 70 THEN '⚠️ Customer satisfaction critically low at ' ELSE '✅ Strong customer satisfaction at ' END || {pct("c", 1)} || '%' AS insight FROM csi WHERE c < 70 OR c > 85
UNION ALL SELECT 2, CASE WHEN coalesce(a > b, false) THEN '📈 Customer sentiment improving over past month' ELSE '📉 Customer sentiment showing declining trend over past month' END FROM tr
UNION ALL SELECT 3, '🔴 ' || category || ' category needs attention (' || {pct("r * 100", 0)} || '% negative)' FROM worst
UNION ALL SELECT 5, '⚡ Verified purchasers significantly less satisfied than unverified' FROM (SELECT {rate("positive")} FILTER (WHERE verified_purchase) AS a,
  {rate("positive")} FILTER (WHERE NOT verified_purchase) AS b FROM reviews) WHERE a < b - 0.1)"""


@query("top_insights", f"WITH {RULES}, {INSIGHTS} SELECT * FROM ins")
def _(v):
    return B.top_insights(v.reviews, text_col="product_name")


@query(
    "top_insights_with_topics",
    f"""WITH {TOPIC_RULES}, {INSIGHTS} SELECT * FROM ins
    UNION ALL SELECT 4, '🔥 \'\'' || term || '\'\' emerging as key customer concern' FROM (SELECT * FROM trending ORDER BY trend_score DESC, term LIMIT 1)""".replace("\\'", "'"),
    "cleaned",
)
def _(v):
    return B.top_insights(v.stage, materialize(M.trending_topics(v.stage), "trending"))


@query(
    "kpi_scorecard",
    f"""WITH {FINANCE}, m AS (SELECT {CSI} AS c, avg(rating) AS r, avg(CASE WHEN helpful_count > 0 THEN 100.0::DOUBLE ELSE 0 END) AS h, (SELECT lost + churn FROM fin) AS k FROM reviews)
    SELECT 'Customer Satisfaction Index' AS kpi, {pct("c", 1)} || '%' AS value, '80%' AS target, CASE WHEN c >= 80 THEN '✅' WHEN c >= 70 THEN '⚠️' ELSE '❌' END AS status,
     CASE WHEN c >= 75 THEN '📈' ELSE '📉' END AS trend FROM m
    UNION ALL SELECT 'Average Rating', {pct("r", 2)} || '/5.0', '4.0/5.0', CASE WHEN r >= 4 THEN '✅' WHEN r >= 3.5 THEN '⚠️' ELSE '❌' END, '📈' FROM m
    UNION ALL SELECT 'Response Rate', {pct("h", 1)} || '%', '10%', '✅', '➡️' FROM m
    UNION ALL SELECT 'Revenue at Risk', '$' || {pct("k / 1000", 0)} || 'K', '<$100K', CASE WHEN k > 100000 THEN '❌' ELSE '✅' END, '📉' FROM m""",
)
def _(v):
    return B.kpi_scorecard(v.reviews)


@query(
    "executive_summary",
    f"""WITH {RULES}, {INSIGHTS},
    m AS (SELECT strftime(min(review_date), '%Y-%m-%d') || ' to ' || strftime(max(review_date), '%Y-%m-%d') AS period, count(*) AS n, avg(rating) AS r, {rate("positive")} * 100 AS p,
     count(DISTINCT review_id) AS c, {rate("negative")} AS neg FROM reviews)
    SELECT period AS analysis_period, {pct("(SELECT c FROM csi)", 1)} || '%' AS csi, format('{{:,}}', n) AS total, {pct("r", 2)} || '/5.0' AS rating, {pct("p", 1)} || '%' AS positive,
     (SELECT CASE WHEN coalesce(a > b, false) THEN 'improving' ELSE 'declining' END FROM tr) AS trend,
     '$' || format('{{:,}}', CAST(round_even(neg * c * 75 * 2.5, 0) AS BIGINT)) AS risk, '$' || format('{{:,}}', CAST(round_even(c * 0.1::DOUBLE * 75, 0) AS BIGINT)) AS opportunity,
     {pct("(c * 0.1::DOUBLE * 75 - 50000) / 50000 * 100", 0)} || '%' AS roi, CAST(trunc(50000 / (c * 0.1::DOUBLE * 75 / 365)) AS BIGINT) || ' days' AS payback,
     (SELECT string_agg(insight, '|' ORDER BY rule_order) FROM ins) AS insights, (SELECT string_agg(issue, '|' ORDER BY rule_order) FROM rec) AS issues,
     4::INT AS steps FROM m""",
)
def _(v):
    s = B.executive_summary(v.reviews, text_col="product_name")
    k, f = F.col("key_metrics"), F.col("financial_impact")
    return s.select(
        "analysis_period",
        k["customer_satisfaction_index"].alias("csi"),
        k["total_reviews_analyzed"].alias("total"),
        k["average_rating"].alias("rating"),
        k["positive_sentiment_rate"].alias("positive"),
        k["response_rate_trend"].alias("trend"),
        f["estimated_revenue_at_risk"].alias("risk"),
        f["improvement_opportunity"].alias("opportunity"),
        f["expected_roi"].alias("roi"),
        f["payback_period"].alias("payback"),
        F.array_join("top_insights", "|").alias("insights"),
        F.array_join(F.col("recommendations")["issue"], "|").alias("issues"),
        F.size("next_steps").alias("steps"),
    )


@query(
    "emerging_alert",
    f"""WITH {PERIODS} SELECT term AS topic, '+' || {pct("percentage_change", 0)} || '% growth' AS growth, CASE WHEN percentage_change > 100 THEN 'red' ELSE 'orange' END AS color
    FROM trending ORDER BY trend_score DESC, term LIMIT 3""",
    "cleaned",
)
def _(v):
    return B.emerging_alert(M.trending_topics(v.stage))
