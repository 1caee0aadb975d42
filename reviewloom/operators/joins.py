"""Joins between reviews, keywords, lexicons, products and labels."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import labels as L
from ..functions.patterns import required_literals
from ..functions.text import bind, exploded, text_or_empty, words
from ..plans.ordered import top_rows
from ..plans.scratch import materialize


def weekly_sentiment_share(df: DataFrame) -> DataFrame:
    """Share of each sentiment in its week (labelled by Monday).

    The weekly totals come from a window over the weekly counts, so the review
    table is shuffled once.
    """
    counts = df.groupBy(
        D.week_start(F.col("review_date")).alias("week"), "predicted_sentiment"
    ).agg(F.count(F.lit(1)).alias("n"))
    week = Window.partitionBy("week")
    return counts.withColumn("total", F.sum("n").over(week)).withColumn(
        "percentage", F.col("n") * F.lit(100.0) / F.col("total")
    )


def trend_score(recent_kw: DataFrame, older_kw: DataFrame, floor: float = 0.001) -> DataFrame:
    """Growth of each recent keyword over its older score."""
    older = older_kw.select("term", F.col("score").alias("older_score"))
    return (
        recent_kw.select("term", F.col("score").alias("recent_score"))
        .join(older, "term", "left")
        .withColumn("older_score", F.coalesce("older_score", F.lit(floor)))
        .withColumn(
            "trend_score", (F.col("recent_score") - F.col("older_score")) / F.col("older_score")
        )
        .withColumn("percentage_change", F.col("trend_score") * 100)
    )


def listed_topics(text: Column, topics: Sequence[str], regex: bool = False) -> Column:
    """Those of a given list that occur in the text; every topic is a literal, compiled once."""

    def occurs(topic: str) -> Column:
        if regex:
            return F.rlike(text, F.lit("(?i)" + topic))
        return F.contains(text, F.lit(topic.lower()))

    found = F.array(*[F.when(occurs(t), F.lit(t)) for t in dict.fromkeys(topics)]).cast("array<string>")
    return F.filter(found, lambda x: x.isNotNull())


def _pieces(text: Column, size: int) -> Column:
    """The distinct pieces of this many characters."""
    def cut(chars: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(chars) - size)
        pieces = F.transform(starts, lambda i: F.concat(*[F.get(chars, i + k) for k in range(size)]))
        return F.when(F.size(chars) >= size, F.array_distinct(pieces)).otherwise(F.array().cast("array<string>"))

    return bind(F.filter(F.split(text, ""), lambda c: c != ""), cut)


def text_key(col: str) -> Column:
    """Equal for equal lowered texts."""
    return F.xxhash64(F.lower(text_or_empty(F.col(col))))


def _candidates(df: DataFrame, literals: DataFrame, col: str) -> DataFrame:
    """(__topic_text, topic): the keys of texts that may hold a literal of the topic, from (topic, literal).

    Every literal is looked up by one piece of up to three characters, the one that the fewest
    texts hold. Pieces and literals meet in an equi-join without the texts. A piece of many texts is
    looked up only by literals that have no rarer one. Texts are cut only into pieces of the sizes that occur.
    """
    lowered = F.lower(text_or_empty(F.col(col)))
    size = F.least(F.length("literal"), F.lit(3))
    sizes = sorted(r[0] for r in literals.select(size).distinct().collect())  # of 1, 2 and 3
    if not sizes:
        return literals.select(F.lit(0).cast("long").alias("__topic_text"), "topic").limit(0)
    by_size = reduce(lambda other, n: F.when(size == n, _pieces(F.col("literal"), n)).otherwise(other), sizes, F.lit(None))
    pieces = literals.select("topic", "literal", F.explode(by_size).alias("piece"))
    texts = df.select(text_key(col).alias("__topic_text"), F.explode(F.concat(*[_pieces(lowered, n) for n in sizes])).alias("piece"))
    used = texts.join(pieces.select("piece").distinct(), "piece")
    counted = used.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    rarest = pieces.join(counted, "piece").groupBy("topic", "literal").agg(F.min_by("piece", F.struct("n", "piece")).alias("piece"))
    return used.join(rarest.select("topic", "piece").distinct(), "piece").select("__topic_text", "topic").distinct()


def _tested_in_rows(df: DataFrame, topics: DataFrame, col: str, matches: Callable[[Column, Column], Column], blocks: int = 1) -> DataFrame:
    """Mentions of the topics of a written table, each tested on the lowered text of every row; a row meets the topics in blocks."""
    block = F.pmod(F.xxhash64("topic"), F.lit(blocks)).cast("int")
    packed = topics.groupBy(block.alias("__block")).agg(F.collect_list("topic").alias("__topics"))
    each = df.withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(packed, "__block")
    found = bind(F.lower(text_or_empty(F.col(col))), lambda text: F.filter("__topics", lambda topic: matches(text, topic)))
    return exploded(each.withColumn("__found", found), F.col("__found"), *df.columns, out="topic")


def _table_mentions(df: DataFrame, topics: DataFrame, col: str) -> DataFrame:
    """Mentions of a table of topics of any length: candidates are joined to the rows by the key of their text and verified there.

    A table of one block is tested in the rows: cutting all texts into pieces costs more.
    """
    lowered = F.lower(text_or_empty(F.col(col)))
    wanted = materialize(topics.select("topic").where(F.length("topic") > 0).distinct(), "topics")
    if wanted.count() <= PATTERN_BLOCK:
        return _tested_in_rows(df, wanted, col, lambda text, topic: F.contains(text, F.lower(topic)))
    candidates = _candidates(df, wanted.select("topic", F.lower("topic").alias("literal")), col)
    keyed = df.withColumn("__topic_text", text_key(col))
    return keyed.join(candidates, "__topic_text").where(F.contains(lowered, F.lower("topic"))).drop("__topic_text")


#: Topics, or patterns without a literal, that a row is tested against at a time.
PATTERN_BLOCK = 200


def _table_pattern_mentions(df: DataFrame, topics: DataFrame, col: str) -> DataFrame:
    """Mentions of a table of patterns.

    A pattern that needs one of some literals is a candidate where one of them may occur. Others are packed into blocks,
    and every text is tested against every block: there is no key to find them by. So is a table of one block.
    """
    lowered = F.lower(text_or_empty(F.col(col)))
    matches = lambda text, topic: F.rlike(text, F.concat(F.lit("(?i)"), topic))

    @F.udf("array<string>", useArrow=True)
    def literals(pattern):
        return required_literals(pattern)

    wanted = topics.select("topic").where(F.length("topic") > 0).distinct().withColumn("literals", literals("topic"))
    wanted = materialize(wanted, "patterns")
    if wanted.count() <= PATTERN_BLOCK:
        return _tested_in_rows(df, wanted, col, matches)
    keyed = df.withColumn("__topic_text", text_key(col))
    bound = wanted.where(F.col("literals").isNotNull()).select("topic", F.explode("literals").alias("literal"))
    found = keyed.join(_candidates(df, bound, col), "__topic_text").where(matches(lowered, F.col("topic"))).drop("__topic_text")
    free = wanted.where(F.col("literals").isNull()).select("topic")
    blocks = -(-free.count() // PATTERN_BLOCK)
    if not blocks:
        return found
    return found.unionByName(_tested_in_rows(df, free, col, matches, blocks).select(*found.columns))


def topic_mentions(
    df: DataFrame, topics: DataFrame | Sequence[str], col: str = "cleaned_text", regex: bool = False
) -> DataFrame:
    """One row per review and topic that occurs in its text, ignoring case; empty topics never do.

    A given list is tested in the row; a table (topic) of any size, of words or of patterns, is joined.
    """
    if isinstance(topics, DataFrame):
        mentions = _table_pattern_mentions if regex else _table_mentions
        return mentions(df.drop("topic"), topics, col).select(*[c for c in df.columns if c != "topic"], "topic")
    found = bind(F.lower(text_or_empty(F.col(col))), lambda text: listed_topics(text, [t for t in topics if t], regex))
    return exploded(df.withColumn("topics", found), F.col("topics"), *df.columns, out="topic")


def lexicon_table(df: DataFrame, positive: Sequence[str], negative: Sequence[str]) -> DataFrame:
    """The two word lists as a (term, polarity) table."""
    rows = [(w, "positive") for w in positive] + [(w, "negative") for w in negative]
    return df.sparkSession.createDataFrame(rows, "term string, polarity string")


def lexicon_join(df: DataFrame, lexicon: DataFrame, col: str = "cleaned_text") -> DataFrame:
    """Positive and negative word counts per review that has any.

    Counts are combined per task before the shuffle. The planner broadcasts the
    lexicon when its size allows.
    """
    tokens = exploded(df, words(F.lower(text_or_empty(F.col(col)))), "review_id")
    return (
        tokens.join(lexicon, "term")
        .groupBy("review_id")
        .agg(
            F.count_if(F.col("polarity") == "positive").alias("positive_word_count"),
            F.count_if(F.col("polarity") == "negative").alias("negative_word_count"),
        )
    )


def stopword_anti_join(tokens: DataFrame, stop_words: DataFrame, col: str = "word") -> DataFrame:
    """Rows whose token is not a stop word."""
    stops = stop_words.select(F.col(stop_words.columns[0]).alias(col))
    return tokens.join(stops, col, "left_anti")


def problem_product_samples(
    df: DataFrame, products: DataFrame, n: int = 3, text_col: str = "review_text"
) -> DataFrame:
    """A few negative reviews of each problem product, the smallest ids first."""
    negative = df.where(L.sentiment_is("negative")).select("product_id", "review_id", text_col)
    wanted = products.select("product_id")
    return top_rows(
        negative.join(wanted, "product_id", "left_semi"), ["product_id"], [F.asc("review_id")], n
    )


def attach_predictions(df: DataFrame, model: Transformer) -> DataFrame:
    """Predictions beside the rows they belong to; no join is needed."""
    return model.transform(df)


def attach_scores(df: DataFrame, scores: DataFrame) -> DataFrame:
    """Scores made elsewhere, by review id."""
    return df.join(scores, "review_id", "left")


def true_vs_predicted(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """Label and prediction side by side for the labelled reviews."""
    joined = predictions.select("review_id", "predicted_sentiment").join(
        labels.where(F.col("true_sentiment").isNotNull()).select("review_id", "true_sentiment"),
        "review_id",
    )
    return joined.withColumn("correct", F.col("true_sentiment") == F.col("predicted_sentiment"))
