"""Queries of section M: keywords and topics."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import words
from ..operators import aggregates as A
from ..operators import keywords as M
from ..operators import sets as G
from ..operators import topics as T
from ..operators.density import density_clusters
from ..plans.graphs import nearest_neighbours
from ..plans.ordered import top_rows
from ..plans.scratch import materialize, scratch_path
from ..sources.writers import write_topic_report
from .base import query, sql_gram_tokens, sql_grams, sql_words
from .joins import MENTIONS, TOPICS
from .periods import PERIODS, tfidf_sql


CORPUS = "corpus AS (SELECT *, 'all' AS scope FROM cleaned)," + tfidf_sql("corpus", ["scope"], 20)


@query("corpus_keywords", f"WITH {CORPUS} SELECT term, round(score, 6) AS score, rank FROM kw", "cleaned")
def _(v):
    return M.corpus_keywords(v.cleaned)


CATEGORY = f"""
sizes AS (SELECT category FROM cleaned GROUP BY 1 HAVING count(*) >= 50),
sents AS (SELECT category, predicted_sentiment FROM cleaned WHERE predicted_sentiment <> 'neutral' GROUP BY 1, 2 HAVING count(*) > 10),
scoped AS (SELECT review_id, category, 'all' AS sentiment, cleaned_text FROM cleaned WHERE category IN (SELECT category FROM sizes)
 UNION ALL SELECT review_id, c.category, c.predicted_sentiment, cleaned_text FROM cleaned c JOIN sents s ON c.category = s.category AND c.predicted_sentiment = s.predicted_sentiment
  WHERE c.category IN (SELECT category FROM sizes)),
{tfidf_sql("scoped", ["category", "sentiment"], 15, name="ck0")},
ck AS (SELECT * FROM ck0 WHERE rank <= CASE sentiment WHEN 'all' THEN 15 ELSE 10 END)"""


@query("category_keywords", f"WITH {CATEGORY} SELECT category, sentiment, term, round(score, 6) AS score, rank FROM ck", "cleaned")
def _(v):
    return M.category_keywords(v.cleaned)


@query(
    "trending_topics",
    f"""WITH {PERIODS} SELECT term, round(recent_score, 6) AS recent_score, round(older_score, 6) AS older_score, round(trend_score, 4) AS trend_score,
    round(percentage_change, 2) AS percentage_change FROM trending""",
    "cleaned",
)
def _(v):
    t = M.trending_topics(v.cleaned)
    return t.withColumns({"trend_score": F.round("trend_score", 4), "percentage_change": F.round("percentage_change", 2)})


@query("common_complaints", f"WITH {CATEGORY} SELECT term, count(*) AS categories FROM ck WHERE sentiment = 'negative' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5", "cleaned")
def _(v):
    return A.common_complaints(M.category_keywords(v.cleaned))


@query("concat_keyword_lists", f"WITH {CATEGORY} SELECT category, rank, term FROM ck WHERE sentiment = 'negative'", "cleaned")
def _(v):
    return G.concat_keyword_lists(M.category_keywords(v.cleaned))


@query(
    "category_keyword_pivot",
    f"""WITH {CATEGORY}, top5 AS (SELECT category, term, score FROM ck WHERE sentiment = 'all' AND rank <= 5),
    g AS (SELECT term, category, avg(score) AS score FROM top5 GROUP BY 1, 2),
    p AS (SELECT t.term, c.category, coalesce(g.score, 0) AS score FROM (SELECT DISTINCT term FROM top5) t CROSS JOIN (SELECT DISTINCT category FROM top5) c
     LEFT JOIN g ON g.term = t.term AND g.category = c.category)
    SELECT term, string_agg(category || '=' || CAST(CAST(floor(score * 1000000 + 0.5) AS BIGINT) AS VARCHAR), ',' ORDER BY category) AS cells FROM p GROUP BY 1""",
    "cleaned",
)
def _(v):
    """The columns of the pivot, in millionths, as one text, as their names come from the data."""
    pivoted = T.category_keyword_pivot(M.category_keywords(v.cleaned))
    names = sorted(c for c in pivoted.columns if c != "term")
    cells = [F.concat(F.lit(f"{c}="), F.floor(F.col(f"`{c}`") * 1000000 + 0.5).cast("string")) for c in names]
    return pivoted.select("term", F.concat_ws(",", *cells).alias("cells"))


@query(
    "topic_impact",
    f"""WITH {PERIODS}, m AS (SELECT t.term AS topic, t.trend_score, c.category, c.rating, c.predicted_sentiment FROM trending t JOIN cleaned c ON contains(cleaned_text, t.term)),
    k AS (SELECT topic, category, count(*) AS n, row_number() OVER (PARTITION BY topic ORDER BY count(*) DESC, category) AS r FROM m GROUP BY 1, 2),
    b AS (SELECT topic, string_agg(category || ' ' || n, ',' ORDER BY r) AS affected_categories FROM k WHERE r <= 3 GROUP BY 1)
    SELECT m.topic, count(*) AS mention_count, round(avg(rating), 6) AS avg_rating, count(*) FILTER (WHERE predicted_sentiment = 'negative') AS negative,
     count(*) FILTER (WHERE predicted_sentiment = 'neutral') AS neutral, count(*) FILTER (WHERE predicted_sentiment = 'positive') AS positive,
     any_value(affected_categories) AS affected_categories, round(any_value(trend_score), 4) AS trend_score FROM m JOIN b ON m.topic = b.topic GROUP BY 1""",
    "cleaned",
)
def _(v):
    impact = T.topic_impact(v.stage, materialize(M.trending_topics(v.cleaned), "trending"))
    listed = F.array_join(F.transform("affected_categories", lambda x: F.concat_ws(" ", x["category"], x["n"].cast("string"))), ",")
    return impact.withColumn("trend_score", F.round("trend_score", 4)).withColumn("affected_categories", listed)


@query(
    "topic_sentiment_matrix",
    f"""WITH m AS ({MENTIONS.replace("review_id, topic", "predicted_sentiment, topic")}), t AS (SELECT unnest({list(TOPICS + ("zzzz",))}) AS topic)
    SELECT t.topic, count(*) FILTER (WHERE predicted_sentiment = 'negative') AS negative, count(*) FILTER (WHERE predicted_sentiment = 'neutral') AS neutral,
    count(*) FILTER (WHERE predicted_sentiment = 'positive') AS positive FROM t LEFT JOIN m ON m.topic = t.topic GROUP BY 1""",
    "cleaned",
)
def _(v):
    return T.topic_sentiment_matrix(v.stage, TOPICS + ("zzzz",))


@query(
    "topic_cooccurrence",
    f"""WITH m AS ({MENTIONS}), s AS (SELECT topic, count(*) AS n FROM m GROUP BY 1),
    p AS (SELECT a.topic AS topic_a, b.topic AS topic_b, count(*) AS together FROM m a JOIN m b ON a.review_id = b.review_id GROUP BY 1, 2)
    SELECT topic_a, topic_b, together, round(together / (a.n + b.n - together)::DOUBLE, 6) AS jaccard FROM p JOIN s a ON topic_a = a.topic JOIN s b ON topic_b = b.topic""",
    "cleaned",
)
def _(v):
    return T.topic_cooccurrence(v.stage, TOPICS)


# Frequent words as three topics of scored words.
WORD_TOPICS = f"""
ws AS (SELECT word, count(*) AS n FROM (SELECT unnest({sql_words("cleaned_text")}) AS word FROM cleaned) WHERE length(word) >= 4 AND regexp_matches(word, '^[a-z]+$') GROUP BY 1),
wr AS (SELECT word, n, row_number() OVER (ORDER BY n DESC, word) - 1 AS i FROM ws),
topics AS (SELECT CAST(i % 3 AS INT) AS topic_id, CAST(i // 3 + 1 AS INT) AS rank, word, n::DOUBLE AS score FROM wr WHERE i < 18)"""


def word_topics(v):

    tokens = v.stage.select(F.explode(words(F.col("cleaned_text"))).alias("word"))
    counts = tokens.where(F.col("word").rlike("^[a-z]{4,}$")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    best = top_rows(counts.withColumn("all", F.lit(0)), ["all"], [F.desc("n"), F.asc("word")], 18, "i")
    i = F.col("i") - 1
    topics = best.select(
        (i % 3).cast("int").alias("topic_id"), (F.floor(i / 3) + 1).cast("int").alias("rank"),
        "word", F.col("n").cast("double").alias("score"),
    )
    return materialize(topics, "word-topics")


@query("topic_weight", f"WITH {WORD_TOPICS} SELECT topic_id, string_agg(word, ', ' ORDER BY rank) AS top_words, round(sum(score), 6) AS weight FROM topics WHERE rank <= 5 GROUP BY 1", "cleaned")
def _(v):
    return T.topic_weight(word_topics(v))


@query("topic_word_edges", f"WITH {WORD_TOPICS} SELECT 'Topic ' || topic_id AS topic, word, round(score, 6) AS weight FROM topics WHERE rank <= 5 AND topic_id < 2", "cleaned")
def _(v):
    return T.topic_word_edges(word_topics(v), 2)


@query(
    "topic_word_nodes",
    f"""WITH {WORD_TOPICS} SELECT DISTINCT 'Topic ' || topic_id AS node, 'topic' AS node_type, 30.0::DOUBLE AS size FROM topics
    UNION ALL SELECT word, 'word', round(score * 20, 6) FROM topics WHERE rank <= 5""",
    "cleaned",
)
def _(v):
    return T.topic_word_nodes(T.topic_word_edges(word_topics(v)))


# Brute force: every window start that an occurrence covers, one row each.
COHERENCE = f"""WITH {WORD_TOPICS},
d AS (SELECT review_id, {sql_words("cleaned_text")} AS t FROM cleaned),
o AS (SELECT review_id, unnest(t) AS word, unnest(range(len(t))) AS pos, greatest(len(t) - 109, 1) AS s FROM d),
n AS (SELECT sum(greatest(len(t) - 109, 1))::DOUBLE AS n FROM d),
h AS (SELECT * FROM o WHERE word IN (SELECT word FROM topics)),
x AS (SELECT DISTINCT review_id, word, unnest(range(greatest(pos - 109, 0), least(pos, s - 1) + 1)) AS st FROM h),
c AS (SELECT word, count(*)::DOUBLE AS c FROM x GROUP BY 1),
pr AS (SELECT a.topic_id, a.word AS a, b.word AS b FROM topics a JOIN topics b ON a.topic_id = b.topic_id),
up AS (SELECT DISTINCT a, b FROM pr WHERE a < b),
j AS (SELECT up.a, up.b, count(*)::DOUBLE AS c FROM up JOIN x xa ON xa.word = up.a JOIN x xb ON xb.word = up.b AND xb.review_id = xa.review_id AND xb.st = xa.st GROUP BY 1, 2),
p AS (SELECT pr.topic_id, pr.a, pr.b, ca.c / n AS pa, cb.c / n AS pb, (CASE WHEN pr.a = pr.b THEN ca.c ELSE coalesce(j.c, 0) END) / n AS pab
 FROM pr JOIN c ca ON ca.word = pr.a JOIN c cb ON cb.word = pr.b LEFT JOIN j ON j.a = least(pr.a, pr.b) AND j.b = greatest(pr.a, pr.b), n),
v AS (SELECT topic_id, a, b, ln((pab + 1e-12) / (pa * pb)) / -ln(pab + 1e-12) AS v FROM p),
w AS (SELECT *, sum(v) OVER (PARTITION BY topic_id, b) AS s FROM v),
q AS (SELECT topic_id, a, sum(v * s) / (sqrt(sum(v * v)) * sqrt(sum(s * s))) AS cos FROM w GROUP BY 1, 2)
SELECT topic_id, round(avg(cos), 6) AS coherence FROM q GROUP BY 1"""


@query("topic_coherence", COHERENCE, "cleaned")
def _(v):
    return T.topic_coherence(word_topics(v), v.stage)


def _cluster_sql():
    return f"""WITH a AS (SELECT review_id, CASE WHEN review_id % 9 = 8 AND review_id % 5 <> 0 THEN 9 ELSE CAST(review_id % 9 AS INT) END AS cluster, cleaned_text FROM cleaned),
    kept AS (SELECT cluster FROM a GROUP BY 1 HAVING count(*) >= 50),
    g AS (SELECT * FROM {sql_grams("(SELECT * FROM a WHERE cluster IN (SELECT cluster FROM kept))", "cluster", sql_gram_tokens("cleaned_text"), 1, 2)}),
    tf AS (SELECT cluster, term, count(*) AS tf FROM g GROUP BY 1, 2), sz AS (SELECT cluster, sum(tf) AS size FROM tf GROUP BY 1),
    f AS (SELECT term, sum(tf) AS f FROM tf GROUP BY 1),
    s AS (SELECT tf.cluster AS topic_id, tf.term, tf.tf / sz.size::DOUBLE * ln(1 + (SELECT avg(size) FROM sz) / f.f::DOUBLE) AS score FROM tf JOIN sz USING (cluster) JOIN f USING (term))
    SELECT topic_id, term, round(score, 6) AS score, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY topic_id ORDER BY round(score, 12) DESC, term) AS INT) AS rank FROM s) WHERE rank <= 10"""


@query("cluster_words", _cluster_sql(), "cleaned")
def _(v):
    # Cluster 8 is too small to be kept.
    ninth = (F.col("review_id") % 9).cast("int")
    moved = F.when((ninth == 8) & (F.col("review_id") % 5 != 0), 9).otherwise(ninth)
    assigned = v.stage.select("review_id", "cleaned_text", moved.alias("cluster"))
    return T.cluster_words(assigned)


def _vectors(v):
    return v.table("embeddings").select(F.col("vec_id").alias("review_id"), "embedding")


@query(
    "neighbour_graph",
    # All pairs; ranks and distances only, as rows at equal distances may change places.
    """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings),
    u AS (SELECT vec_id, list_transform(x, lambda v: v / sqrt(list_inner_product(x, x))) AS x FROM e),
    p AS (SELECT a.vec_id AS id, list_distance(a.x, b.x) AS distance FROM u a JOIN u b ON a.vec_id <> b.vec_id)
    SELECT id, rank, round(distance, 6) AS distance
    FROM (SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY distance) AS INT) AS rank FROM p) WHERE rank <= 15""",
)
def _(v):
    ranked = Window.partitionBy("id").orderBy("distance", "neighbour")
    return nearest_neighbours(_vectors(v)).select("id", F.row_number().over(ranked).alias("rank"), "distance")


@query("density_clusters")
def _(v):
    return density_clusters(_vectors(v), min_size=15)


@query("embedding_topics")
def _(v):
    return T.embedding_topics(v.stage, _vectors(v))


@query("doc_keywords")
def _(v):
    return M.doc_keywords(v.docs)


@query("lda_topics")
def _(v):
    return T.lda_topics(T.train_lda(v.stage))


@query("doc_topics")
def _(v):
    return T.doc_topics(T.train_lda(v.stage), v.stage)


def _report(v):
    return T.topic_report(v.stage, vectors=_vectors(v))


@query("topic_report")
def _(v):
    """All sections as rows of JSON."""
    rows = [
        section.select(F.lit(name).alias("section"), F.to_json(F.struct(*section.columns)).alias("value"))
        for name, section in _report(v).items()
    ]
    return reduce(DataFrame.unionByName, rows)


@query("write_topic_report")
def _(v):
    sections = _report(v)
    root = scratch_path(v.spark, "report")
    write_topic_report(sections, root)
    counts = [
        v.spark.read.parquet(f"{root}/{name}").agg(F.lit(name).alias("section"), F.count(F.lit(1)).alias("n"))
        for name in sections
    ]
    return reduce(DataFrame.unionByName, counts)
