"""Vocabularies of n-grams by document frequency, level by level.

A document that holds an n-gram holds both (n - 1)-grams in it, so an n-gram of ``min_df`` documents has both of them
in as many. Words are counted first; each further level joins neighbouring survivors of the one before and counts those only. What
is written are the counts of survivors; tokens are exploded anew for each level, and no table of all n-grams is made.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import exploded
from ..plans.scratch import materialize


#: Places of terms in a task, about; with a given number of tasks their memory does not grow with the table.
PLACES = 1 << 18


def _least(value: float, docs: int) -> float:
    """A share under 1 is one of all documents."""
    return value if value >= 1 else value * docs


def gram_counts(tokens: DataFrame, lo: int, hi: int, min_df: float, key: str = "review_id") -> DataFrame:
    """(term, tf, df) of all n-grams of lo to hi words in min_df documents or more, from written (key, tokens)."""
    # Each task adds up its words; a document counts once for each of its own.
    one, none = F.lit(1).alias("tf"), F.lit(0).alias("df")
    words = exploded(tokens, F.col("tokens")).select("term", one, none)
    once = exploded(tokens, F.array_distinct("tokens")).select("term", F.lit(0).alias("tf"), F.lit(1).alias("df"))
    counts = words.unionByName(once).groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    level = materialize(counts.where(F.col("df") >= min_df), "level-1")
    levels = [level] if lo == 1 else []
    places = tokens.select(key, F.posexplode("tokens").alias("pos", "term")).join(level.select("term"), "term").select(key, "pos", "term")
    for n in range(2, hi + 1):
        # Words are moved once, by document: what follows them and the counts per document are made where they lie.
        at_next = Window.partitionBy(key).orderBy("pos").rangeBetween(1, 1)
        following = F.collect_list(F.substring_index("term", " ", -1)).over(at_next)
        rows = level.agg(F.sum("tf").alias("n")).first()["n"] or 0
        parts = max(tokens.sparkSession.sparkContext.defaultParallelism, -(-rows // PLACES))
        lying = places.where(F.col(key).isNotNull()).repartition(parts, key)
        pairs = lying.select(key, "pos", "term", following.alias("words"))
        longer = pairs.select(key, "pos", "term", F.explode("words").alias("word"))
        longer = longer.select(key, "pos", F.concat_ws(" ", "term", "word").alias("term"))
        by_document = longer.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
        counts = by_document.groupBy("term").agg(F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df"))
        level = materialize(counts.where(F.col("df") >= min_df), f"level-{n}")
        if n >= lo:
            levels.append(level)
        places = longer.join(level.select("term"), "term").select(key, "pos", "term")
    return reduce(DataFrame.unionByName, levels)


def gram_vocabulary(
    tokens: DataFrame, max_features: int, ngram_range=(1, 1), min_df: float = 1, max_df: float = 1.0, key: str = "review_id"
) -> tuple[list[tuple[str, int]], int]:
    """The ``max_features`` most frequent terms with their document frequencies, equal ones by name, and the number of documents.

    A frequency of documents is a number from 1 on, and a share of all below; 1.0 as the largest is all.
    """
    docs = tokens.count()
    counts = gram_counts(tokens, *ngram_range, _least(min_df, docs), key)
    most = docs if max_df == 1.0 else _least(max_df, docs)
    best = counts.where(F.col("df") <= most).orderBy(F.desc("tf"), "term").limit(max_features)
    return [(r["term"], r["df"]) for r in best.collect()], docs  # max_features rows


def vocabulary_counter(terms: list[str]) -> CountVectorizerModel:
    """From ``grams`` to ``counts``."""
    if not terms:
        raise ValueError("no term is in as many documents as asked for")
    return CountVectorizerModel.from_vocabulary(terms, "grams", "counts")
