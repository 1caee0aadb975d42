"""Financial estimates, rule-based recommendations and the executive summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..plans.scratch import materialize
from ..schema import DEFAULTS, Settings
from .aggregates import (
    best_worst_categories,
    csi_value,
    problem_products,
    service_issue_rate,
    verified_positive_gap,
)
from .filters import recent_negative_alert
from .ranking import topk_trending
from .sets import union_rules
from .text import format_kpi
from .timeseries import weekly_sentiment
from .topics import topic_impact
from .windows import trend_4w

NEGATIVE = "negative"


def _pct(value: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", F.bround(value.cast("double"), digits))


def _payback(cost: float, yearly: Column) -> Column:
    return F.try_divide(F.lit(cost), yearly / 365).cast("bigint")


def financial_impact(
    df: DataFrame, order_value: float = 75.0, multiplier: float = 2.5, uplift: float = 0.1,
    cost: float = 50000.0,
) -> DataFrame:
    """Revenue lost to negative reviews and what an improvement would bring."""
    base = df.agg(
        F.count_distinct("review_id").alias("customers"),
        F.avg(F.when(L.sentiment_is(NEGATIVE), 1.0).when(F.col("predicted_sentiment").isNotNull(), 0.0)).alias("neg"),
    )
    potential = F.col("customers") * uplift * order_value
    return base.select(
        F.col("customers").alias("total_customers"),
        (F.coalesce("neg", F.lit(0.0)) * F.col("customers") * order_value * multiplier).alias("lost_revenue"),
        potential.alias("improvement_potential"),
        F.lit(cost).alias("intervention_cost"),
        ((potential - cost) / cost * 100).alias("roi"),
        _payback(cost, potential).alias("payback_days"),
    )


def financial_metrics_dashboard(
    df: DataFrame, order_value: float = 75.0, lifetime_value: float = 500.0,
    cfg: Settings = DEFAULTS,
) -> DataFrame:
    base = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.when(L.sentiment_is(NEGATIVE), 1.0).when(F.col("predicted_sentiment").isNotNull(), 0.0)).alias("r"),
    ).withColumn("r", F.coalesce("r", F.lit(0.0)))
    negative = F.col("r") * F.col("n")
    lost = negative * order_value * cfg.negative_multiplier
    churn = F.col("n") * F.col("r") * cfg.churn_share * lifetime_value
    recovery = negative * cfg.uplift * order_value * 12
    cost = cfg.programme_cost
    return base.select(
        F.col("n").alias("total_customers"),
        negative.cast("bigint").alias("negative_customers"),
        lost.alias("lost_revenue"),
        churn.alias("churn_loss"),
        (lost + churn).alias("revenue_at_risk"),
        recovery.alias("improvement_potential"),
        F.lit(cost).alias("intervention_cost"),
        ((recovery - cost) / cost * 100).alias("roi"),
        F.when(recovery > 0, _payback(cost, recovery)).otherwise(F.lit(999)).cast("bigint").alias("payback_days"),
    )


def revenue_waterfall(df: DataFrame) -> DataFrame:
    """The four bars of the waterfall."""
    f = financial_metrics_dashboard(df)
    steps = (
        ("Current Risk", F.col("revenue_at_risk")),
        ("Investment", -F.col("intervention_cost")),
        ("Recovery Potential", F.col("improvement_potential")),
        ("Net Benefit", F.col("improvement_potential") - F.col("intervention_cost")),
    )
    cells = [
        F.struct(F.lit(i + 1).alias("step"), F.lit(n).alias("name"), v.alias("value"))
        for i, (n, v) in enumerate(steps)
    ]
    return f.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


COLUMNS = ("rule_order", "category", "priority", "issue", "recommendation", "expected_impact", "timeline")


def _rule(order: int | Column, category, priority, issue, recommendation, impact, timeline) -> list[Column]:
    values = (order, category, priority, issue, recommendation, impact, timeline)
    return [
        (v if isinstance(v, Column) else F.lit(v)).alias(c) for c, v in zip(COLUMNS, values)
    ]


def rule_rows(df: DataFrame, text_col: str) -> DataFrame:
    """What the rules read of a review, written once: no texts but an empty one, which none of the rules looks at."""
    columns = ("review_id", "product_id", "category", "rating", "predicted_sentiment", "confidence_score", "verified_purchase", "helpful_count", "review_date")
    kept = [c for c in columns if c in df.columns]
    return materialize(df.select(*kept, F.lit("").alias(text_col)), "rules")


def recommendations(
    df: DataFrame, trending: DataFrame | None = None, cfg: Settings = DEFAULTS,
    text_col: str = "review_text", topic_col: str = "cleaned_text",
) -> DataFrame:
    """The rules that fire, in order, one row each. Texts are read for topics only."""
    return _recommendations(rule_rows(df, text_col), df, trending, cfg, text_col, topic_col)


def _recommendations(
    df: DataFrame, texts: DataFrame, trending: DataFrame | None, cfg: Settings, text_col: str, topic_col: str
) -> DataFrame:
    goal = cfg.satisfaction_goal * 100
    index = df.agg(csi_value(cfg.rating_weight, cfg.text_weight).alias("csi"))
    gap = goal - F.col("csi")
    rules = [
        index.where(F.col("csi") < goal).select(
            *_rule(
                1, "Customer Satisfaction", "HIGH",
                F.concat(
                    F.lit("Customer Satisfaction Index ("), _pct(F.col("csi"), 1), F.lit("%) is "),
                    _pct(gap, 1), F.lit("% below target"),
                ),
                "Implement immediate quality improvement program",
                F.concat(F.lit("Increase customer retention by "), _pct(gap * 0.5, 0), F.lit("%")),
                "30 days",
            )
        ),
        problem_products(df, n=1, text_col=text_col).select(
            *_rule(
                2, "Product Quality", "HIGH",
                F.concat(
                    F.lit("Product "), F.col("product_id"), F.lit(" has "),
                    _pct(F.col("negative_rate") * 100, 0), F.lit("% negative reviews"),
                ),
                "Conduct quality audit and consider product redesign",
                "Reduce returns by 20-30%",
                "60 days",
            )
        ),
        best_worst_categories(df, 1)
        .where((F.col("side") == "worst") & (F.col("rate") > 0.25))
        .select(
            *_rule(
                3, "Category Management", "MEDIUM",
                F.concat(
                    F.col("category"), F.lit(" category has "), _pct(F.col("rate") * 100, 0),
                    F.lit("% negative reviews"),
                ),
                "Review supplier quality standards and enhance QC processes",
                "Improve category NPS by 15-20 points",
                "45 days",
            )
        ),
    ]
    if trending is not None:
        # The first topics that are mentioned at all count, whatever their rating.
        impact = (
            topic_impact(texts, trending, topic_col).orderBy(F.desc("trend_score"), "topic").limit(3)
        )
        rules.append(
            impact.where(F.col("avg_rating") < 3).select(
                *_rule(
                    4, "Emerging Issues", "MEDIUM",
                    F.concat(
                        F.lit('"'), F.col("topic"), F.lit('" mentioned in '),
                        F.col("mention_count"), F.lit(" reviews with avg rating "),
                        _pct(F.col("avg_rating"), 1),
                    ),
                    F.concat(F.lit("Address "), F.col("topic"), F.lit(" issues across affected products")),
                    "Prevent escalation to major customer concern",
                    "14 days",
                )
            )
        )
    decline = trend_4w(weekly_sentiment(df, text_col)).where(F.col("trend") == "declining")
    rules.append(
        decline.select(
            *_rule(
                5, "Trend Alert", "HIGH",
                F.concat(
                    F.lit("Customer satisfaction declining by "),
                    _pct((F.col("previous_rate") - F.col("recent_rate")) * 100, 1),
                    F.lit("% over past month"),
                ),
                "Launch customer win-back campaign and service recovery program",
                "Reverse negative trend within 30 days",
                "Immediate",
            )
        )
    )
    return union_rules(*rules)


def dashboard_recommendations(df: DataFrame, text_col: str = "cleaned_text") -> DataFrame:
    finance = financial_metrics_dashboard(df)
    rates = df.groupBy("category").agg(L.share(L.sentiment_is(NEGATIVE)).alias("rate"))
    worst = rates.orderBy(F.desc("rate"), "category").limit(1)
    best = rates.orderBy("rate", F.desc("category")).limit(1)
    return union_rules(
        finance.where(F.col("roi") > 200).select(
            *_rule(
                1, "Financial", "HIGH",
                F.concat(F.lit("$"), _pct(F.col("revenue_at_risk") / 1000, 0), F.lit("K revenue at risk")),
                "Implement customer recovery program",
                F.concat(_pct(F.col("roi"), 0), F.lit("% ROI")),
                "30 days",
            )
        ),
        worst.where(F.col("rate") > 0.3).select(
            *_rule(
                2, "Product Quality", "HIGH",
                F.concat(F.col("category"), F.lit(": "), _pct(F.col("rate") * 100, 0), F.lit("% negative")),
                "Quality audit and supplier review",
                "Reduce returns by 25%",
                "45 days",
            )
        ),
        service_issue_rate(df, col=text_col).where("alert").select(
            *_rule(
                3, "Customer Service", "MEDIUM",
                F.concat(_pct(F.col("negative_rate") * 100, 0), F.lit("% negative service mentions")),
                "Enhance support training program",
                "Improve CSAT by 15%",
                "60 days",
            )
        ),
        best.where(1 - F.col("rate") > 0.7).select(
            *_rule(
                4, "Marketing", "MEDIUM",
                F.concat(F.col("category"), F.lit(": "), _pct((1 - F.col("rate")) * 100, 0), F.lit("% positive")),
                "Leverage in marketing campaigns",
                "+10% sales potential",
                "30 days",
            )
        ),
        recent_negative_alert(df).where("alert").select(
            *_rule(
                5, "Trend Alert", "HIGH", "Negative sentiment increasing",
                "Immediate intervention required", "Prevent escalation", "Immediate",
            )
        ),
    )


def top_insights(
    df: DataFrame, trending: DataFrame | None = None, text_col: str = "review_text", n: int = 5
) -> DataFrame:
    """Up to five findings as (rule_order, insight) rows."""
    csi = df.agg(csi_value().alias("csi"))
    low, high = F.col("csi") < 70, F.col("csi") > 85
    trend = trend_4w(weekly_sentiment(df, text_col))
    worst = best_worst_categories(df, 1).where(F.col("side") == "worst")
    parts = [
        csi.where(low | high).select(
            F.lit(1).alias("rule_order"),
            F.concat(
                F.when(low, "⚠️ Customer satisfaction critically low at ").otherwise("✅ Strong customer satisfaction at "),
                _pct(F.col("csi"), 1), F.lit("%"),
            ).alias("insight"),
        ),
        trend.select(
            F.lit(2).alias("rule_order"),
            F.when(F.col("trend") == "declining", "📉 Customer sentiment showing declining trend over past month")
            .otherwise("📈 Customer sentiment improving over past month").alias("insight"),
        ),
        worst.select(
            F.lit(3).alias("rule_order"),
            F.concat(
                F.lit("🔴 "), F.col("category"), F.lit(" category needs attention ("),
                _pct(F.col("rate") * 100, 0), F.lit("% negative)"),
            ).alias("insight"),
        ),
    ]
    if trending is not None:
        top = trending.orderBy(F.desc("trend_score"), "term").limit(1)
        parts.append(
            top.select(
                F.lit(4).alias("rule_order"),
                F.concat(F.lit("🔥 '"), F.col("term"), F.lit("' emerging as key customer concern")).alias("insight"),
            )
        )
    parts.append(
        verified_positive_gap(df).where("alert").select(
            F.lit(5).alias("rule_order"),
            F.lit("⚡ Verified purchasers significantly less satisfied than unverified").alias("insight"),
        )
    )
    return union_rules(*parts).orderBy("rule_order").limit(n)


def kpi_scorecard(df: DataFrame) -> DataFrame:
    """Four KPIs as text, with target, status and trend."""
    risk = financial_metrics_dashboard(df).select("revenue_at_risk").scalar()
    row = df.agg(
        csi_value().alias("csi"),
        F.avg("rating").alias("rating"),
        (L.share(F.col("helpful_count") > 0) * 100).alias("response"),
    ).withColumn("risk", risk)
    kpis = (
        (
            "Customer Satisfaction Index", format_kpi(F.col("csi"), "percent"), "80%",
            L.kpi_status(F.col("csi"), 80, 70), F.when(F.col("csi") >= 75, "📈").otherwise("📉"),
        ),
        (
            "Average Rating", F.concat(_pct(F.col("rating"), 2), F.lit("/5.0")), "4.0/5.0",
            L.kpi_status(F.col("rating"), 4.0, 3.5), F.lit("📈"),
        ),
        ("Response Rate", format_kpi(F.col("response"), "percent"), "10%", F.lit("✅"), F.lit("➡️")),
        (
            "Revenue at Risk", F.concat(F.lit("$"), _pct(F.col("risk") / 1000, 0), F.lit("K")), "<$100K",
            F.when(F.col("risk") > 100000, "❌").otherwise("✅"), F.lit("📉"),
        ),
    )
    cells = [
        F.struct(
            F.lit(name).alias("kpi"), value.alias("value"), F.lit(target).alias("target"),
            status.alias("status"), trend.alias("trend"),
        )
        for name, value, target, status, trend in kpis
    ]
    return row.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


# The closing lines of the summary.
NEXT_STEPS: Sequence[str] = (
    "Review and prioritize recommendations with leadership team",
    "Allocate resources for high-priority initiatives",
    "Establish KPIs and monitoring dashboard",
    "Schedule 30-day progress review",
)


def executive_summary(
    df: DataFrame, trending: DataFrame | None = None, cfg: Settings = DEFAULTS,
    text_col: str = "review_text", topic_col: str = "cleaned_text", report_date: str | None = None,
) -> DataFrame:
    """Everything above as one row of text, arrays and structs, with the date of the report where it is given."""
    texts, df = df, rule_rows(df, text_col)
    finance = financial_impact(df, cfg.order_value).select(
        F.struct(
            format_kpi(F.col("lost_revenue"), "dollars").alias("estimated_revenue_at_risk"),
            format_kpi(F.col("improvement_potential"), "dollars").alias("improvement_opportunity"),
            F.concat(_pct(F.col("roi"), 0), F.lit("%")).alias("expected_roi"),
            F.concat(F.col("payback_days"), F.lit(" days")).alias("payback_period"),
        )
    )
    trend = trend_4w(weekly_sentiment(df, text_col)).select("trend")
    insights = top_insights(df, trending, text_col).agg(
        F.array_sort(F.collect_list(F.struct("rule_order", "insight")))["insight"]
    )
    recs = _recommendations(df, texts, trending, cfg, text_col, topic_col).orderBy("rule_order", "issue").limit(5)
    packed = recs.agg(F.array_sort(F.collect_list(F.struct(*COLUMNS))))
    row = df.agg(
        csi_value(cfg.rating_weight, cfg.text_weight).alias("csi"),
        F.count(F.lit(1)).alias("n"),
        F.avg("rating").alias("rating"),
        (F.avg(F.when(L.sentiment_is("positive"), 1.0).when(F.col("predicted_sentiment").isNotNull(), 0.0)) * 100).alias("pos"),
        F.min("review_date").alias("lo"),
        F.max("review_date").alias("hi"),
    )
    return row.select(
        F.lit(report_date).cast("string").alias("report_date"),
        F.concat_ws(" to ", F.date_format("lo", "yyyy-MM-dd"), F.date_format("hi", "yyyy-MM-dd")).alias("analysis_period"),
        F.struct(
            format_kpi(F.col("csi"), "percent").alias("customer_satisfaction_index"),
            format_kpi(F.col("n"), "thousands").alias("total_reviews_analyzed"),
            F.concat(_pct(F.col("rating"), 2), F.lit("/5.0")).alias("average_rating"),
            format_kpi(F.col("pos"), "percent").alias("positive_sentiment_rate"),
            trend.scalar().alias("response_rate_trend"),
        ).alias("key_metrics"),
        finance.scalar().alias("financial_impact"),
        insights.scalar().alias("top_insights"),
        packed.scalar().alias("recommendations"),
        F.array(*[F.lit(s) for s in NEXT_STEPS]).alias("next_steps"),
    )


def emerging_alert(trending: DataFrame, n: int = 3) -> DataFrame:
    """The fastest growing topics, red above a doubling."""
    growth = F.col("percentage_change")
    return topk_trending(trending, 0.0, n).select(
        F.col("term").alias("topic"),
        F.concat(F.lit("+"), _pct(growth, 0), F.lit("% growth")).alias("growth"),
        F.when(growth > 100, "red").otherwise("orange").alias("color"),
    )
