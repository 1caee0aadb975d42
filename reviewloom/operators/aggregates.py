"""Distributions, cross tables, scores and data-quality aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.text import WORD, exploded, gram_tokens, squeeze, text_or_empty, words
from ..functions.wordlists import ENGLISH_STOP_WORDS, SERVICE_WORDS
from ..plans.ordered import quantiles, top_rows
from ..schema import SENTIMENTS

POSITIVE = "positive"
NEGATIVE = "negative"


def _n(alias: str = "n") -> Column:
    return F.count(F.lit(1)).alias(alias)


def _counts(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(_n())


def sentiment_distribution(df: DataFrame, col: str = "predicted_sentiment") -> DataFrame:
    total = Window.partitionBy(F.lit(0))
    return (
        _counts(df.where(F.col(col).isNotNull()), col)
        .withColumn("share", F.col("n") / F.sum("n").over(total))
    )


def rating_distribution(df: DataFrame) -> DataFrame:
    return _counts(df, "rating").orderBy("rating")


def category_distribution(df: DataFrame) -> DataFrame:
    return _counts(df, "category").orderBy(F.desc("n"), "category")


def crosstab(df: DataFrame, row: str, col: str, values: Sequence[str] = SENTIMENTS) -> DataFrame:
    """Counts with one column per value. The values are given, so no extra job finds them."""
    return df.groupBy(row).agg(
        *[F.count_if(F.col(col) == v).alias(v) for v in values]
    )


def category_sentiment_pct(df: DataFrame) -> DataFrame:
    table = crosstab(df, "category", "predicted_sentiment")
    total = sum((F.col(v) for v in SENTIMENTS[1:]), F.col(SENTIMENTS[0]))
    return table.select(
        "category", *[F.try_divide(F.col(v) * F.lit(100.0), total).alias(v) for v in SENTIMENTS]
    )


def rating_sentiment_crosstab(df: DataFrame, col: str = "predicted_sentiment") -> DataFrame:
    return crosstab(df, "rating", col)


def verified_sentiment_crosstab(df: DataFrame, col: str = "true_sentiment") -> DataFrame:
    return crosstab(df, "verified_purchase", col)


def verified_positive_gap(df: DataFrame, gap: float = 0.1) -> DataFrame:
    """Positive shares of verified and unverified reviews; those without a sentiment are left out."""
    def rate(verified: bool) -> Column:
        known = F.col("predicted_sentiment").isNotNull()
        positive = F.when(known, F.when(L.sentiment_is(POSITIVE), 1.0).otherwise(0.0))
        return F.coalesce(
            F.avg(F.when(F.col("verified_purchase") == verified, positive)), F.lit(0.0)
        )

    rates = df.agg(
        rate(True).alias("verified_positive"), rate(False).alias("unverified_positive")
    )
    return rates.withColumn(
        "alert", F.col("verified_positive") < F.col("unverified_positive") - gap
    )


def avg_rating_by_verified(df: DataFrame) -> DataFrame:
    return df.groupBy("verified_purchase").agg(F.avg("rating").alias("avg_rating"))


def overview_kpis(df: DataFrame, approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(
        _n("total_reviews"),
        F.avg("rating").alias("avg_rating"),
        distinct("category").alias("categories"),
        (L.share(F.col("verified_purchase")) * 100).alias("verified_pct"),
    )


def category_performance(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("category")
        .agg(
            L.share(L.sentiment_is(POSITIVE)).alias("positive_rate"),
            L.share(L.sentiment_is(NEGATIVE)).alias("negative_rate"),
            F.count("predicted_sentiment").alias("review_count"),
            F.avg("rating").alias("avg_rating"),
            F.stddev_samp("rating").alias("rating_std"),
            F.avg("confidence_score").alias("avg_confidence"),
            F.sum("helpful_count").alias("total_helpful"),
        )
        .withColumn(
            "engagement_score", F.try_divide(F.col("total_helpful"), F.col("review_count"))
        )
    )


def best_worst_categories(df: DataFrame, n: int = 3) -> DataFrame:
    performance = category_performance(df)
    tops = []
    for side, measure in (("best", "positive_rate"), ("worst", "negative_rate")):
        ranked = top_rows(
            performance.select(F.lit(side).alias("side"), "category", F.col(measure).alias("rate")),
            ["side"],
            [F.desc("rate"), F.asc("category")],
            n,
        )
        tops.append(ranked)
    return tops[0].unionByName(tops[1])


def category_performance_score(df: DataFrame) -> DataFrame:
    """Weighted score; inputs to two decimals and the result to one, ties to even."""
    rounded = df.groupBy("category").agg(
        F.bround(L.share(L.sentiment_is(POSITIVE)) * 100, 2).alias("positive_pct"),
        F.bround(L.share(L.sentiment_is(NEGATIVE)) * 100, 2).alias("negative_pct"),
        F.count("predicted_sentiment").alias("review_count"),
        F.bround(F.avg("rating"), 2).alias("avg_rating"),
        F.bround(F.avg("helpful_count"), 2).alias("avg_helpful"),
    )
    return rounded.withColumn(
        "performance_score",
        F.bround(
            F.col("positive_pct") * 0.4
            + F.col("avg_rating") * 20 * 0.3
            + (100 - F.col("negative_pct")) * 0.3,
            1,
        ),
    )


def category_status(df: DataFrame) -> DataFrame:
    p = category_performance(df)
    return p.select(
        "category",
        F.bround(F.col("positive_rate") * 100, 2).alias("positive_pct"),
        F.bround(F.col("negative_rate") * 100, 2).alias("negative_pct"),
        "review_count",
        F.bround("avg_rating", 2).alias("avg_rating"),
        F.bround("rating_std", 2).alias("rating_std"),
        F.bround("avg_confidence", 2).alias("avg_confidence"),
        L.traffic_light(F.bround(F.col("positive_rate") * 100, 2), 70, 50).alias("status"),
    )


def quadrant_label(df: DataFrame, rating: float = 3.5, positive: float = 60) -> DataFrame:
    table = df.groupBy("category").agg(
        F.avg("rating").alias("avg_rating"),
        (L.share(L.sentiment_is(POSITIVE)) * 100).alias("positive_pct"),
    )
    high_rating, high_positive = F.col("avg_rating") >= rating, F.col("positive_pct") >= positive
    return table.withColumn(
        "quadrant",
        F.when(high_rating & high_positive, "Stars")
        .when(high_rating, "Improve Sentiment")
        .when(high_positive, "Mixed Signals")
        .otherwise("Problem Areas"),
    )


def category_bubble(df: DataFrame) -> DataFrame:
    table = df.groupBy("category").agg(
        F.avg("rating").alias("avg_rating"),
        (L.share(L.sentiment_is(POSITIVE)) * 100).alias("positive_pct"),
        F.count("review_id").alias("review_count"),
        F.sum("helpful_count").alias("total_helpful"),
    )
    return table.withColumn(
        "engagement", F.try_divide(F.col("total_helpful"), F.col("review_count"))
    )


def problem_products(
    df: DataFrame,
    threshold: float = 0.3,
    min_reviews: int = 10,
    n: int = 10,
    text_col: str = "review_text",
) -> DataFrame:
    return (
        df.groupBy("product_id")
        .agg(
            L.share(L.sentiment_is(NEGATIVE)).alias("negative_rate"),
            F.avg("rating").alias("avg_rating"),
            F.count(text_col).alias("review_count"),
        )
        .where((F.col("review_count") >= min_reviews) & (F.col("negative_rate") > threshold))
        .orderBy(F.desc("negative_rate"), "product_id")
        .limit(n)
    )


def csi_value(rating_weight: float = 0.3, text_weight: float = 0.7) -> Column:
    """Satisfaction index as an aggregate; a review without sentiment is left out."""
    rating = (F.col("rating") - 1) / F.lit(4.0)
    return F.avg(rating * rating_weight + L.score(F.col("predicted_sentiment")) * text_weight) * 100


def csi(df: DataFrame, rating_weight: float = 0.3, text_weight: float = 0.7) -> DataFrame:
    return df.agg(csi_value(rating_weight, text_weight).alias("csi"))


def satisfaction_score(df: DataFrame, target: float = 75) -> DataFrame:
    score = L.share(L.sentiment_is(POSITIVE)) * 100
    return df.agg(score.alias("satisfaction"), (score - target).alias("delta"))


def avg_confidence(df: DataFrame) -> DataFrame:
    return df.agg(F.avg("confidence_score").alias("avg_confidence"))


QUARTILES = (0.25, 0.5, 0.75)


def distribution_by(df: DataFrame, by: str, value: str) -> DataFrame:
    """Box-plot statistics of a column per group, with exact quartiles."""
    basic = df.groupBy(by).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.min(value).cast("double").alias("min"),
        F.max(value).cast("double").alias("max"),
    )
    cut = quantiles(df, [by], value, QUARTILES)
    wide = cut.groupBy(by).agg(
        *[
            F.max(F.when(F.col("probability") == p, F.col("value"))).alias(name)
            for p, name in zip(QUARTILES, ("q25", "median", "q75"))
        ]
    )
    return basic.join(wide.withColumnRenamed(by, "__by"), F.col(by).eqNullSafe(F.col("__by")), "left").drop("__by")


def confidence_by_sentiment(df: DataFrame) -> DataFrame:
    return distribution_by(df, "predicted_sentiment", "confidence_score")


def word_count_by_sentiment(df: DataFrame, label: str = "true_sentiment") -> DataFrame:
    return distribution_by(df, label, "word_count")


def feature_means_by_sentiment(
    df: DataFrame, cols: Sequence[str], label: str = "true_sentiment"
) -> DataFrame:
    return df.groupBy(label).agg(*[F.avg(c).alias(c) for c in cols])


THRESHOLDS = (0.5, 0.6, 0.7, 0.8, 0.9)


def coverage_alignment_curve(
    df: DataFrame, thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """Per threshold, the share of confident reviews and how many of those are aligned."""
    ok = L.aligned(F.col("rating"), F.col("predicted_sentiment"))
    counts = df.agg(
        _n("total"),
        *[F.count_if(F.col("confidence_score") >= t).alias(f"c{i}") for i, t in enumerate(thresholds)],
        *[
            F.count_if((F.col("confidence_score") >= t) & ok).alias(f"a{i}")
            for i, t in enumerate(thresholds)
        ],
    )
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(t).alias("threshold"),
                    F.try_divide(F.col(f"c{i}") * F.lit(100.0), F.col("total")).alias("coverage_pct"),
                    F.coalesce(
                        F.try_divide(F.col(f"a{i}") * F.lit(100.0), F.col(f"c{i}")), F.lit(0.0)
                    ).alias("aligned_pct"),
                )
                for i, t in enumerate(thresholds)
            ]
        )
    )
    return counts.select(rows.alias("r")).select("r.*")


def rating_sentiment_corr(df: DataFrame) -> DataFrame:
    score = L.score(F.col("predicted_sentiment"), "signed")
    return df.agg(F.corr(F.col("rating").cast("double"), score).alias("correlation"))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise Pearson correlation in long form, from one aggregation."""
    pairs = list(combinations(cols, 2))
    row = df.agg(
        *[
            F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"p{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    cells = [
        F.struct(F.lit(x).alias("col_a"), F.lit(y).alias("col_b"), F.col(f"p{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)
        for x, y in ((a, b), (b, a))
    ] + [
        F.struct(F.lit(c).alias("col_a"), F.lit(c).alias("col_b"), F.lit(1.0).alias("correlation"))
        for c in cols
    ]
    return row.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def unpivot_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                    for c in cols
                ]
            )
        ).alias("r")
    ).select("r.*")


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, spread and exact quartiles of each column."""
    long = unpivot_numeric(df, cols)
    basic = long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    cut = quantiles(long, ["column"], "value", QUARTILES)
    wide = cut.groupBy("column").agg(
        *[
            F.max(F.when(F.col("probability") == p, F.col("value"))).alias(name)
            for p, name in zip(QUARTILES, ("q25", "median", "q75"))
        ]
    )
    return basic.join(wide, "column", "left")


def missing_values(df: DataFrame) -> DataFrame:
    """Columns that hold nulls, with count and percentage, from one pass."""
    row = df.agg(_n("__total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    cells = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.col(c).alias("missing"),
                    F.try_divide(F.col(c) * F.lit(100.0), F.col("__total")).alias("missing_pct"),
                )
                for c in df.columns
            ]
        )
    )
    return row.select(cells.alias("r")).select("r.*").where(F.col("missing") > 0)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows."""
    groups = df.groupBy(*df.columns).agg(_n())
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def duplicate_texts(df: DataFrame, col: str = "review_text") -> DataFrame:
    """Repeated texts; missing texts count as equal. Digests travel instead of the texts."""
    groups = df.groupBy(F.sha2(F.col(col), 256).alias("digest"), F.length(col).alias("size")).agg(_n())
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def dataset_summary(df: DataFrame) -> DataFrame:
    """One row of totals; the most common rating is the smallest one on ties."""
    modal = (
        _counts(df.where(F.col("rating").isNotNull()), "rating")
        .orderBy(F.desc("n"), "rating")
        .limit(1)
        .select("rating")
    )
    return df.agg(
        _n("total_reviews"),
        F.to_date(F.min("review_date")).alias("first_date"),
        F.to_date(F.max("review_date")).alias("last_date"),
        F.count_distinct("product_id").alias("products"),
        F.count_distinct("category").alias("categories"),
        F.avg("word_count").alias("avg_words"),
        F.avg("rating").alias("avg_rating"),
        (L.share(F.col("verified_purchase")) * 100).alias("verified_pct"),
    ).withColumn("modal_rating", modal.scalar())


def best_worst_rated_category(df: DataFrame) -> DataFrame:
    means = df.groupBy("category").agg(F.avg("rating").alias("avg_rating"))
    # Equal means go to the category that comes first in name order.
    ordered = means.orderBy(F.desc("avg_rating"), "category").limit(1)
    lowest = means.orderBy("avg_rating", "category").limit(1)
    return ordered.select(F.lit("best").alias("side"), "category", "avg_rating").unionByName(
        lowest.select(F.lit("worst").alias("side"), "category", "avg_rating")
    )


def preprocessing_report(df: DataFrame) -> DataFrame:
    return df.agg(
        _n("total_reviews"),
        F.avg("word_count").alias("avg_word_count"),
        F.avg("char_count").alias("avg_char_count"),
        F.avg("avg_word_length").alias("avg_word_length"),
        F.count_if(F.col("positive_word_count") > 0).alias("with_positive_words"),
        F.count_if(F.col("negative_word_count") > 0).alias("with_negative_words"),
        F.avg("textblob_polarity").alias("avg_polarity"),
        F.count_if(F.col("exclamation_count") > 0).alias("with_exclamations"),
        F.count_if(F.col("question_count") > 0).alias("with_questions"),
        F.sum("is_weekend").alias("weekend_reviews"),
        (F.avg("is_weekend") * 100).alias("weekend_pct"),
    )


def category_topics_summary(df: DataFrame, min_docs: int = 50) -> DataFrame:
    """Categories with enough reviews: their size and a sentiment -> count map."""
    counts = df.groupBy("category", "predicted_sentiment").agg(_n())
    known = F.when(
        F.col("predicted_sentiment").isNotNull(), F.struct("predicted_sentiment", "n")
    )
    return (
        counts.groupBy("category")
        .agg(
            F.sum("n").alias("total_reviews"),
            F.map_from_entries(F.array_sort(F.collect_list(known))).alias("sentiment_distribution"),
        )
        .where(F.col("total_reviews") >= min_docs)
    )


def _word_counts(df: DataFrame, label: str, tokens: Column) -> DataFrame:
    rows = exploded(df.where(F.col(label).isNotNull()), tokens, label, out="word")
    return rows.groupBy(label, "word").agg(_n())


def top_words_by_sentiment(
    df: DataFrame, n: int = 15, min_len: int = 4, label: str = "true_sentiment",
    col: str = "review_text",
) -> DataFrame:
    """Most frequent words per sentiment among those of at least ``min_len`` letters."""
    tokens = F.regexp_extract_all(F.lower(text_or_empty(F.col(col))), F.lit(rf"[{WORD}]{{{min_len},}}"), 0)
    counts = _word_counts(df, label, tokens)
    return top_rows(counts, [label], [F.desc("n"), F.asc("word")], n)


def top_tokens_by_sentiment(
    df: DataFrame, n: int = 10, min_len: int = 4, col: str = "cleaned_text"
) -> DataFrame:
    """The n most frequent whitespace tokens per sentiment, short ones dropped afterwards."""
    counts = _word_counts(df, "predicted_sentiment", words(text_or_empty(F.col(col))))
    ranked = top_rows(counts, ["predicted_sentiment"], [F.desc("n"), F.asc("word")], n)
    return ranked.where(F.length("word") >= min_len)


def wordcloud_terms(
    df: DataFrame, n: int = 100, col: str = "cleaned_text", stop_words=ENGLISH_STOP_WORDS
) -> DataFrame:
    """Term frequency per sentiment, relative to its most frequent term."""
    counts = _word_counts(df, "predicted_sentiment", gram_tokens(F.col(col), stop_words))
    ranked = top_rows(counts, ["predicted_sentiment"], [F.desc("n"), F.asc("word")], n)
    largest = Window.partitionBy("predicted_sentiment")
    return ranked.withColumn("weight", F.col("n") / F.max("n").over(largest))


def service_issue_rate(
    df: DataFrame, service_words: Sequence[str] = SERVICE_WORDS, t: float = 0.4,
    col: str = "cleaned_text",
) -> DataFrame:
    mentions = df.where(F.col(col).rlike(f"(?i){'|'.join(service_words)}"))
    rates = mentions.agg(
        _n("mentions"),
        F.coalesce(L.share(L.sentiment_is(NEGATIVE)), F.lit(0.0)).alias("negative_rate"),
    )
    return rates.withColumn("alert", F.col("negative_rate") > t)


def response_rate(df: DataFrame) -> DataFrame:
    return df.agg((L.share(F.col("helpful_count") > 0) * 100).alias("response_rate"))


def common_complaints(category_kw: DataFrame, n: int = 5) -> DataFrame:
    """Terms that are negative keywords in the most categories."""
    return (
        category_kw.where(F.col("sentiment") == NEGATIVE)
        .groupBy("term")
        .agg(_n("categories"))
        .orderBy(F.desc("categories"), "term")
        .limit(n)
    )


def worst_category_insight(df: DataFrame, min_docs: int = 50) -> DataFrame:
    """The category with the worst negative ratio, else the one with fewest positives."""
    counts = df.groupBy("category").agg(
        _n("total"),
        F.count_if(L.sentiment_is(POSITIVE)).alias("positive"),
        F.count_if(L.sentiment_is(NEGATIVE)).alias("negative"),
    ).where(F.col("total") >= min_docs)
    flagged = F.col("negative") > F.col("positive") * 0.3
    ratio = F.col("negative") / F.col("total")
    ranked = counts.select(
        F.when(flagged, "negative").otherwise("fallback").alias("kind"),
        "category",
        F.when(flagged, ratio).otherwise(F.col("positive") / F.col("total")).alias("ratio"),
        F.when(flagged, -ratio).otherwise(F.lit(1.0) + F.col("positive") / F.col("total")).alias("o"),
    )
    return ranked.orderBy("o", "category").limit(1).drop("o")


def sentiment_hierarchy(df: DataFrame) -> DataFrame:
    """Counts for all reviews, per category, and per category and sentiment."""
    levels = df.rollup("category", "predicted_sentiment").agg(
        F.grouping_id().alias("gid"), _n()
    )
    level = F.when(F.col("gid") == 3, 0).when(F.col("gid") == 1, 1).otherwise(2)
    return levels.select(
        level.alias("level"),
        F.when(level == 0, "All Reviews").when(level == 1, F.col("category"))
        .otherwise(F.initcap("predicted_sentiment")).alias("label"),
        F.when(level == 0, "").when(level == 1, "All Reviews").otherwise(F.col("category")).alias("parent"),
        "n",
    )


def rating_hierarchy(df: DataFrame) -> DataFrame:
    """Counts per rating, and per rating and sentiment."""
    name = F.concat(F.lit("Rating "), F.col("rating"))
    levels = df.groupingSets(
        [[F.col("rating")], [F.col("rating"), F.col("predicted_sentiment")]],
        "rating", "predicted_sentiment",
    ).agg(F.grouping("predicted_sentiment").alias("top"), _n())
    return levels.select(
        F.when(F.col("top") == 1, name).otherwise(F.initcap("predicted_sentiment")).alias("label"),
        F.when(F.col("top") == 1, "").otherwise(name).alias("parent"),
        "n",
    )


def reading_sizes(df: DataFrame, col: str = "review_text") -> DataFrame:
    """Add char_count and word_count of a text column."""
    flat = squeeze(text_or_empty(F.col(col)))
    return df.withColumns(
        {
            "char_count": F.length(F.col(col)),
            "word_count": F.when(F.col(col).isNotNull(), F.size(words(flat))),
        }
    )
