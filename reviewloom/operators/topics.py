"""Topic models, coherence, topic impact and topic relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import LDA, KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import exploded, gram_tokens, ngrams, text_or_empty, with_grams, words
from ..functions.wordlists import ENGLISH_STOP_WORDS
from ..plans.ordered import top_rows
from ..plans.parts import parts_by_text
from ..plans.scratch import materialize
from ..schema import SENTIMENTS
from . import keywords as K
from .aggregates import category_topics_summary, common_complaints, worst_category_insight
from .density import NOISE, density_clusters
from .joins import text_key, topic_mentions
from .vocabulary import gram_vocabulary, vocabulary_counter


def topic_tokens(df: DataFrame, text_col: str = "cleaned_text", ngram_range=(1, 2)) -> DataFrame:
    return with_grams(df, text_col, *ngram_range, ENGLISH_STOP_WORDS)


def train_lda(
    df: DataFrame, k: int = 12, max_features: int = 5000, min_df: float = 5, max_df: float = 0.8,
    iterations: int = 10, seed: int = 42, text_col: str = "cleaned_text",
) -> PipelineModel:
    """Vocabulary and online LDA in one model; both are fitted over all documents.

    The vocabulary comes from the written tokens; what LDA reads again and again are the counts of its terms.
    """
    words = gram_tokens(F.col(text_col), ENGLISH_STOP_WORDS).alias("tokens")
    tokens = materialize(df.select("review_id", words), "tokens")
    terms, _ = gram_vocabulary(tokens, max_features, (1, 2), min_df, max_df)
    counter = vocabulary_counter([t for t, _ in terms])
    counts = counter.transform(tokens.select("review_id", ngrams(F.col("tokens"), 1, 2).alias("grams")))
    counts = materialize(counts.select("review_id", "counts"), "counts")
    lda = LDA(
        featuresCol="counts", k=k, optimizer="online", learningOffset=50.0, learningDecay=0.7,
        maxIter=iterations, seed=seed, subsamplingRate=1.0, optimizeDocConcentration=False,
    )
    return PipelineModel(stages=[counter, lda.fit(counts)])


def lda_topics(model: PipelineModel, words_n: int = 10) -> DataFrame:
    """The best words of every topic, with their weights."""
    counter, lda = model.stages
    described = lda.describeTopics(words_n)
    spark = described.sparkSession
    vocabulary = spark.createDataFrame(list(enumerate(counter.vocabulary)), "i int, word string")
    terms = described.select(
        F.col("topic").alias("topic_id"),
        F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("pos", "t"),
    )
    return terms.join(vocabulary, F.col("t.termIndices") == F.col("i")).select(
        "topic_id", (F.col("pos") + 1).alias("rank"), "word", F.col("t.termWeights").alias("score")
    )


def topic_structs(topics: DataFrame) -> DataFrame:
    """One row per topic: id, words and scores in order."""
    return (
        topics.groupBy("topic_id")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "word", "score"))).alias("t"))
        .select("topic_id", F.col("t.word").alias("words"), F.col("t.score").alias("scores"))
    )


def doc_topics(model: PipelineModel, df: DataFrame, text_col: str = "cleaned_text") -> DataFrame:
    """Topic shares of every document and its main topic."""
    scored = model.transform(topic_tokens(df, text_col))
    shares = vector_to_array("topicDistribution")
    return scored.select("review_id", shares.alias("shares")).withColumn(
        "main_topic", F.array_position("shares", F.array_max("shares")) - 1
    )


def topic_coherence(
    topics: DataFrame, docs: DataFrame, window: int = 110, text_col: str = "cleaned_text",
) -> DataFrame:
    """c_v coherence of each topic over sliding windows of all documents.

    A window is never built. Each occurrence of a topic word covers a run of window
    starts; a lag over the occurrences of one word (or of either word of a pair) in
    one document gives the starts not covered before. Both words share a window as
    often as the word counts exceed the count of their union.
    """
    chosen = topics.select("topic_id", F.col("word")).distinct()
    tokens = docs.select("review_id", words(text_or_empty(F.col(text_col))).alias("t"))
    starts = F.greatest(F.size("t") - (window - 1), F.lit(1))
    total = tokens.agg(F.sum(starts).cast("double").alias("n"))
    vocabulary = chosen.select("word").distinct()
    hits = materialize(
        tokens.select("review_id", starts.alias("starts"), F.posexplode("t").alias("pos", "word"))
        .join(vocabulary, "word"),
        "occurrences",
    )

    left, right = chosen.alias("l"), chosen.alias("r")
    pairs = left.join(right, "topic_id").select(
        "topic_id", F.col("l.word").alias("a"), F.col("r.word").alias("b")
    )
    unordered = pairs.where(F.col("a") < F.col("b")).select("a", "b").distinct()
    members = unordered.select("a", "b", F.col("a").alias("word")).unionByName(
        unordered.select("a", "b", F.col("b").alias("word"))
    ).unionByName(vocabulary.select(F.col("word").alias("a"), F.col("word").alias("b"), "word"))

    covered_to = F.least(F.col("pos"), F.col("starts") - 1)
    covered_from = F.greatest(F.col("pos") - (window - 1), F.lit(0))
    in_doc = Window.partitionBy("a", "b", "review_id").orderBy("pos")
    fresh = covered_to - F.greatest(
        covered_from - 1, F.coalesce(F.lag(covered_to).over(in_doc), F.lit(-1))
    )
    unions = (
        hits.join(members, "word")
        .withColumn("fresh", fresh)
        .groupBy("a", "b")
        .agg(F.sum("fresh").cast("double").alias("u"))
    )
    unions = materialize(unions, "unions")
    single = unions.where(F.col("a") == F.col("b")).select(F.col("a").alias("word"), F.col("u").alias("c"))
    n = total.scalar()
    low, high = F.least("a", "b"), F.greatest("a", "b")
    probs = (
        pairs.withColumns({"lo": low, "hi": high})
        .join(single.select(F.col("word").alias("a"), F.col("c").alias("ca")), "a", "left")
        .join(single.select(F.col("word").alias("b"), F.col("c").alias("cb")), "b", "left")
        .join(unions.select(F.col("a").alias("lo"), F.col("b").alias("hi"), "u"), ["lo", "hi"], "left")
        .na.fill(0.0, ["ca", "cb", "u"])
        .select(
            "topic_id", "a", "b",
            (F.col("ca") / n).alias("pa"),
            (F.col("cb") / n).alias("pb"),
            (F.when(F.col("a") == F.col("b"), F.col("ca")).otherwise(F.col("ca") + F.col("cb") - F.col("u")) / n).alias("pab"),
        )
    )
    eps = 1e-12
    npmi = F.when((F.col("pa") == 0) | (F.col("pb") == 0), 0.0).otherwise(
        F.log((F.col("pab") + eps) / (F.col("pa") * F.col("pb"))) / -F.log(F.col("pab") + eps)
    )
    cells = probs.select("topic_id", "a", "b", npmi.alias("v"))
    whole = Window.partitionBy("topic_id", "b")
    cells = cells.withColumn("s", F.sum("v").over(whole))
    cosine = F.try_divide(
        F.sum(F.col("v") * F.col("s")),
        F.sqrt(F.sum(F.col("v") * F.col("v"))) * F.sqrt(F.sum(F.col("s") * F.col("s"))),
    )
    per_word = cells.groupBy("topic_id", "a").agg(F.coalesce(cosine, F.lit(0.0)).alias("cos"))
    return per_word.groupBy("topic_id").agg(F.avg("cos").alias("coherence"))


def cluster_words(
    assigned: DataFrame, min_size: int = 50, n: int = 10, ngram_range=(1, 2),
    text_col: str = "cleaned_text",
) -> DataFrame:
    """Class-based TF-IDF: the best terms of every cluster with enough documents."""
    sizes = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("docs"))
    kept = sizes.where(F.col("docs") >= min_size)
    members = assigned.join(kept.select("cluster"), "cluster", "left_semi")
    # Most terms are in few texts: counting them per task first would hold nearly all in memory and move as many.
    parts = parts_by_text(members, text_col)
    tf = (
        with_grams(members.select("cluster", text_col).repartition(parts), text_col, *ngram_range, ENGLISH_STOP_WORDS)
        .transform(exploded, F.col("grams"), "cluster")
        .repartition(parts, "cluster", "term")
        .groupBy("cluster", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    tf = materialize(tf, "cluster-terms")
    # Written, so that its size is known: terms are not moved by cluster for a join with a row per cluster.
    per_cluster = materialize(tf.groupBy("cluster").agg(F.sum("tf").alias("size")), "cluster-sizes")
    mean_size = per_cluster.agg(F.avg("size")).scalar()
    by_term = tf.repartition(parts, "term")
    overall = by_term.groupBy("term").agg(F.sum("tf").alias("f"))
    scored = (
        by_term.join(overall, "term")
        .join(per_cluster, "cluster")
        .select(
            F.col("cluster").alias("topic_id"),
            "term",
            (F.col("tf") / F.col("size") * F.log(1 + mean_size / F.col("f"))).alias("score"),
        )
    )
    return top_rows(scored, ["topic_id"], [F.desc(F.round("score", 12)), F.asc("term")], n)


def embedding_clusters(
    vectors: DataFrame, k: int | None = None, min_size: int = 50, neighbours: int = 15, seed: int = 42
) -> DataFrame:
    """(review_id, cluster) of document vectors (review_id, embedding).

    Without k the clusters are those of density, as many as there are, and -1 is noise; with k they are k means.
    """
    if k is None:
        return density_clusters(vectors, min_size, neighbours, seed=seed)
    features = vectors.select("review_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    features = materialize(features, "vectors")
    return KMeans(k=k, seed=seed, predictionCol="cluster").fit(features).transform(features).select("review_id", "cluster")


def embedding_topics(
    df: DataFrame, vectors: DataFrame, k: int | None = None, min_size: int = 50, n: int = 10,
    text_col: str = "cleaned_text", neighbours: int = 15, seed: int = 42,
) -> DataFrame:
    """Topics as clusters of document vectors (review_id, embedding), with their best terms; noise has no topic.

    Documents without a vector are in no topic.
    """
    known = vectors.join(df.select("review_id"), "review_id", "left_semi")
    placed = embedding_clusters(known, k, min_size, neighbours, seed).where(F.col("cluster") != NOISE)
    assigned = materialize(df.select("review_id", text_col).join(placed, "review_id"), "assigned")
    return cluster_words(assigned, min_size, n, text_col=text_col)


def topic_weight(topics: DataFrame, n: int = 5) -> DataFrame:
    """Sum of the first n word scores of each topic."""
    structs = topic_structs(topics)
    total = F.aggregate(F.slice("scores", 1, n), F.lit(0.0), lambda a, x: a + x)
    return structs.select(
        "topic_id", F.array_join(F.slice("words", 1, n), ", ").alias("top_words"), total.alias("weight")
    )


def topic_word_edges(topics: DataFrame, n_topics: int = 8, n_words: int = 5) -> DataFrame:
    """Edges from the first topics to their best words."""
    order = Window.partitionBy(F.lit(0)).orderBy("topic_id")
    structs = topic_structs(topics).withColumn("nth", F.row_number().over(order))
    return structs.where(F.col("nth") <= n_topics).select(
        F.concat(F.lit("Topic "), F.col("topic_id")).alias("topic"),
        F.explode(F.slice(F.arrays_zip("words", "scores"), 1, n_words)).alias("e"),
    ).select("topic", F.col("e.words").alias("word"), F.col("e.scores").alias("weight"))


def topic_word_nodes(edges: DataFrame) -> DataFrame:
    """Nodes of the graph: topics of size 30, words by their weight in the last topic."""
    words_n = edges.groupBy("word").agg(F.max_by("weight", "topic").alias("w"))
    return (
        edges.select(F.col("topic").alias("node")).distinct()
        .select("node", F.lit("topic").alias("node_type"), F.lit(30.0).alias("size"))
        .unionByName(
            words_n.select(
                F.col("word").alias("node"), F.lit("word").alias("node_type"), (F.col("w") * 20).alias("size")
            )
        )
    )


def topic_impact(
    df: DataFrame, trending: DataFrame, text_col: str = "cleaned_text"
) -> DataFrame:
    """Mentions, mean rating, sentiments and main categories, with counts, of every trending topic."""
    topics = trending.select(F.col("term").alias("topic"), "trend_score")
    mentions = topic_mentions(
        df.select("category", "rating", "predicted_sentiment", text_col),
        topics, text_col,
    )
    # The finest counts are a short table: topics x categories x sentiments.
    fine = mentions.groupBy("topic", "category", "predicted_sentiment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("rating_sum"), F.count("rating").alias("rated")
    )
    fine = materialize(fine, "topic-counts")
    totals = fine.groupBy("topic").agg(
        F.sum("n").alias("mention_count"),
        F.try_divide(F.sum("rating_sum"), F.sum("rated")).alias("avg_rating"),
        *[
            F.coalesce(
                F.sum(F.when(F.col("predicted_sentiment") == s, F.col("n"))), F.lit(0)
            ).alias(s)
            for s in SENTIMENTS
        ],
    )
    categories = fine.groupBy("topic", "category").agg(F.sum("n").alias("n"))
    best = (
        top_rows(categories, ["topic"], [F.desc("n"), F.asc("category")], 3)
        .groupBy("topic")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "category", "n"))).alias("c"))
        .select("topic", F.transform("c", lambda x: F.struct(x["category"], x["n"])).alias("affected_categories"))
    )
    return totals.join(best, "topic").join(topics, "topic")


def topic_sentiment_matrix(
    df: DataFrame, topics: DataFrame | Sequence[str], text_col: str = "cleaned_text"
) -> DataFrame:
    """Mentions per topic and sentiment, zeros included."""
    counts = (
        topic_mentions(df.select("predicted_sentiment", text_col), topics, text_col)
        .groupBy("topic")
        .agg(*[F.count_if(F.col("predicted_sentiment") == s).alias(s) for s in SENTIMENTS])
    )
    if isinstance(topics, DataFrame):
        wanted = topics.select("topic").distinct()
    else:
        wanted = df.sparkSession.createDataFrame([(t,) for t in topics], "topic string")
    return wanted.join(counts, "topic", "left").na.fill(0, list(SENTIMENTS))


def category_keyword_pivot(
    category_kw: DataFrame, categories: Sequence[str] | None = None, n: int = 5
) -> DataFrame:
    """Score of the best keywords of each category in every category, 0 where absent.

    Without a list, the categories are those found; there is a column for each.
    """
    top = category_kw.where((F.col("sentiment") == "all") & (F.col("rank") <= n))
    grouped = top.groupBy("term")
    pivoted = grouped.pivot("category", list(categories)) if categories is not None else grouped.pivot("category")
    return pivoted.agg(F.avg("score")).na.fill(0.0)


def topic_cooccurrence(
    df: DataFrame, topics: DataFrame | Sequence[str], text_col: str = "cleaned_text"
) -> DataFrame:
    """In how many reviews each two topics occur together, and the Jaccard share.

    Each unordered pair of a text's topics is counted once, with the number of reviews that have
    the text; the other order is added to the counts.
    """
    keyed = df.select(text_col, text_key(text_col).alias("__text"))
    reviews = keyed.groupBy("__text").agg(F.count(F.lit(1)).alias("n"))
    lists = (
        topic_mentions(keyed, topics, text_col)
        .groupBy("__text").agg(F.array_sort(F.collect_set("topic")).alias("ts"))
        .join(reviews, "__text")
    )
    first = lists.select(F.posexplode("ts").alias("i", "topic_a"), "ts", "n")
    upper = first.select(
        "topic_a", F.explode(F.slice("ts", F.col("i") + 1, F.size("ts"))).alias("topic_b"), "n"
    )
    upper = upper.groupBy("topic_a", "topic_b").agg(F.sum("n").alias("together"))
    other = upper.where(F.col("topic_a") < F.col("topic_b")).select(
        F.col("topic_b").alias("topic_a"), F.col("topic_a").alias("topic_b"), "together"
    )
    counts = upper.unionByName(other)
    single = upper.where(F.col("topic_a") == F.col("topic_b"))
    a = single.select("topic_a", F.col("together").alias("na"))
    b = single.select("topic_b", F.col("together").alias("nb"))
    return (
        counts.join(a, "topic_a").join(b, "topic_b")
        .select(
            "topic_a", "topic_b", "together",
            (F.col("together") / (F.col("na") + F.col("nb") - F.col("together"))).alias("jaccard"),
        )
    )


def topic_report(
    df: DataFrame, k: int = 12, text_col: str = "cleaned_text", vectors: DataFrame | None = None
) -> dict[str, DataFrame]:
    """All sections of the report as tables.

    With document vectors (review_id, embedding) there are topics of embeddings too.
    """
    model = train_lda(df, k, text_col=text_col)
    topics = materialize(lda_topics(model), "topics")
    category = materialize(K.category_keywords(df, text_col=text_col), "category-keywords")
    trending = materialize(K.trending_topics(df, text_col=text_col), "trending")
    coherence = materialize(topic_coherence(topics, df, text_col=text_col), "coherence")
    sections = {
        "lda_results": coherence.agg(
            F.count(F.lit(1)).alias("num_topics"), F.avg("coherence").alias("coherence_score")
        ),
        "topic_terms": topics,
        "coherence": coherence,
        "category_summary": category_topics_summary(df),
        "category_keywords": category,
        "trending": trending,
        "insights": report_insights(df, category, trending),
    }
    if vectors is not None:
        sections["embedding_topics"] = embedding_topics(df, vectors, text_col=text_col)
    return sections


def report_insights(df: DataFrame, category_kw: DataFrame, trending: DataFrame) -> DataFrame:
    """The findings of the report as one line of text each."""
    worst = worst_category_insight(df)
    alert = worst.select(
        F.lit(1).alias("rule_order"),
        F.when(
            F.col("kind") == "negative",
            F.format_string(
                "ALERT: %s has %.1f%% negative reviews", "category", F.bround(F.col("ratio") * 100, 1)
            ),
        ).otherwise(F.concat("category", F.lit(" has the lowest positive sentiment rate"))).alias("insight"),
    )

    def listed(rows: DataFrame, order: int, head: str, by) -> DataFrame:
        packed = rows.agg(F.array_sort(F.collect_list(F.struct(by.alias("o"), "term"))).alias("t"))
        return packed.where(F.size("t") > 0).select(
            F.lit(order).alias("rule_order"),
            F.concat(F.lit(head), F.array_join(F.col("t.term"), ", ")).alias("insight"),
        )

    complaints = listed(
        common_complaints(category_kw), 2, "Top complaints across all categories: ", -F.col("categories")
    )
    top = trending.orderBy(F.desc("trend_score"), "term").limit(3)
    rising = listed(top, 3, "Trending topics (last 30 days): ", -F.col("trend_score"))
    return alert.unionByName(complaints).unionByName(rising)
