"""TF-IDF keywords per scope, trending terms and key phrases."""

from __future__ import annotations

from functools import reduce
from operator import add, mul

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import (
    WORD,
    exploded,
    gram_tokens,
    neighbours,
    ngrams,
    text_or_empty,
)
from ..functions.wordlists import ENGLISH_STOP_WORDS
from ..plans.ordered import top_rows
from ..plans.parts import together
from ..plans.scratch import materialize
from .filters import trend_start
from .joins import trend_score
from .ranking import topk_trending


BROADCAST_TERMS = 200_000


def scoped_keywords(
    docs: DataFrame,
    scopes: list[str],
    k: int,
    vocab: int = 1000,
    ngram_range: tuple[int, int] = (1, 3),
    text_col: str = "cleaned_text",
    key: str = "review_id",
    stop_words=ENGLISH_STOP_WORDS,
) -> DataFrame:
    """Mean L2-normalised TF-IDF per term, fitted separately inside every scope.

    ``docs`` has one row per document, with its scopes. A scope column may be an array, for
    documents in several scopes. Texts are tokenised once and the tokens written; the
    vocabulary of a scope is its most frequent terms and is written next, as a small table; the
    terms of the documents are then joined with it, so only vocabulary terms are shuffled. All
    scopes are done together.
    """
    tokens = gram_tokens(F.col(text_col), stop_words).alias("tokens")
    staged = materialize(docs.select(*scopes, key, tokens), "tokens")
    terms = _vocabulary(staged, scopes, vocab, ngram_range)
    sizes = _spread_scopes(staged.groupBy(*scopes).agg(F.count(F.lit(1)).alias("docs")), scopes)
    sizes = sizes.groupBy(*scopes).agg(F.sum("docs").alias("docs"))
    # Scopes are spread once the terms of a document are counted; a term of another scope is dropped then.
    counted = (
        exploded(staged, ngrams(F.col("tokens"), *ngram_range), *scopes, key)
        .join(materialize(terms.select("term").distinct(), "terms"), "term")
        .groupBy(*scopes, key, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    tf = (
        _spread_scopes(counted, scopes)
        .join(terms, [*scopes, "term"])
        .repartition(*scopes, key)
        .groupBy(*scopes, key, "term")
        .agg(F.sum("tf").alias("tf"))
    )
    # Reading tf here keeps both uses of the table alike, so that one shuffle serves them.
    df_counts = tf.groupBy(*scopes, "term").agg(F.count_if(F.col("tf") > 0).alias("df"))
    idf = df_counts.join(sizes, scopes).select(
        *scopes,
        "term",
        "docs",
        (F.log((1 + F.col("docs")) / (1 + F.col("df"))) + 1).alias("idf"),
    )
    # Planned by size alone, a shuffle of tf would come before the size of this small table is known.
    if terms.count() <= BROADCAST_TERMS:
        idf = F.broadcast(idf)
    weight = F.col("tf") * F.col("idf")
    document = Window.partitionBy(*scopes, key)
    scores = (
        tf.join(idf, [*scopes, "term"])
        .select(*scopes, key, "term", "docs", weight.alias("w"))
        .withColumn("unit", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(document)))
        .groupBy(*scopes, "term")
        .agg((F.sum("unit") / F.max("docs")).alias("score"))
    )
    # Scores are compared to twelve digits, so that sums of another order rank alike.
    return top_rows(scores, scopes, [F.desc(F.round("score", 12)), F.asc("term")], k)


def _spread_scopes(rows: DataFrame, scopes: list[str]) -> DataFrame:
    """A row for each element of the scopes that are arrays."""
    for name in scopes:
        if rows.schema[name].dataType.typeName() == "array":
            rows = rows.withColumn(name, F.explode(name))
    return rows


def _scope_counts(rows: DataFrame, scopes: list[str]) -> DataFrame:
    """How often each scope has each term. Rows are counted before their scopes are spread."""
    counts = rows.groupBy(*scopes, "term").agg(F.count(F.lit(1)).alias("n"))
    return _spread_scopes(counts, scopes).groupBy(*scopes, "term").agg(F.sum("n").alias("n"))


def _vocabulary(
    docs: DataFrame, scopes: list[str], vocab: int, ngram_range: tuple[int, int]
) -> DataFrame:
    """The ``vocab`` most frequent terms of every scope, as a small table.

    An n-gram is no more frequent than any of its words. So once the words are
    counted, an n-gram with a word below the vocab-th word count cannot be in the
    vocabulary. Those with a word that is that frequent in no scope are dropped before anything
    is shuffled. Words that tie with the vocab-th stay, so the result is exact.
    """
    tokens = F.col("tokens")
    lo, hi = ngram_range
    first = [F.desc("n"), F.asc("term")]
    if lo > 1:
        counts = _scope_counts(exploded(docs, ngrams(tokens, lo, hi), *scopes), scopes)
        top = top_rows(counts, scopes, first, vocab)
        return materialize(top.select(*scopes, "term"), "vocabulary")
    singles = _scope_counts(exploded(docs, tokens, *scopes), scopes)
    by_count = Window.partitionBy(*scopes).orderBy(F.desc("n"))
    frequent = materialize(
        singles.withColumn("r", F.rank().over(by_count)).where(F.col("r") <= vocab).drop("r"),
        "words",
    )
    candidates = frequent
    if hi > 1:
        names = ["w0"] + [f"a{i}" for i in range(1, hi)]
        rows = neighbours(docs, tokens, *scopes, after=hi - 1)
        words = materialize(frequent.select("term").distinct(), "distinct-words")
        for i, name in enumerate(names):
            known = words.select(F.col("term").alias(name), F.lit(True).alias(f"k{i}"))
            # Every n-gram of a position holds its first two words.
            rows = rows.join(known, name, "inner" if i < 2 else "left")
        grams = []
        whole = F.lit(True)
        for n in range(2, hi + 1):
            whole = whole & F.coalesce(F.col(f"k{n - 1}"), F.lit(False))
            grams.append(F.when(whole, F.concat_ws(" ", *names[:n])))
        longer = _scope_counts(exploded(rows, F.array_compact(F.array(*grams)), *scopes), scopes)
        candidates = frequent.unionByName(longer)
    return materialize(top_rows(candidates, scopes, first, vocab).select(*scopes, "term"), "vocabulary")


def corpus_keywords(
    df: DataFrame, k: int = 20, vocab: int = 1000, ngram_range=(1, 3),
    text_col: str = "cleaned_text",
) -> DataFrame:
    """The k best terms of the whole table."""
    scoped = scoped_keywords(
        df.withColumn("scope", F.lit("all")), ["scope"], k, vocab, ngram_range, text_col
    )
    return scoped.select("term", "score", "rank")


def _category_scopes(
    df: DataFrame, min_docs: int, min_sent: int, text_col: str
) -> DataFrame:
    """Each review with its category and, as an array, "all" and the sentiments that are large enough in it."""
    sizes = df.groupBy("category").agg(
        F.count(F.lit(1)).alias("total"),
        *[
            F.count_if(F.col("predicted_sentiment") == s).alias(s)
            for s in ("positive", "negative")
        ],
    )
    # Written, so that its size is known: texts are not moved by category for a join with a few rows.
    kept = materialize(sizes.where(F.col("total") >= min_docs), "sizes")
    label = F.col("predicted_sentiment")
    big = ((label == "positive") & (F.col("positive") > min_sent)) | (
        (label == "negative") & (F.col("negative") > min_sent)
    )
    labels = F.filter(
        F.array(F.lit("all"), F.when(big, label)), lambda s: s.isNotNull()
    )
    return df.join(kept, "category").select(
        "review_id", "category", text_col, labels.alias("sentiment")
    )


def category_keywords(
    df: DataFrame, k: int = 15, k_sent: int = 10, min_docs: int = 50, min_sent: int = 10,
    vocab: int = 1000, ngram_range=(1, 3), text_col: str = "cleaned_text",
) -> DataFrame:
    """Keywords per category and per category and sentiment, from one run over the text."""
    scoped = scoped_keywords(
        _category_scopes(df, min_docs, min_sent, text_col),
        ["category", "sentiment"], max(k, k_sent), vocab, ngram_range, text_col,
    )
    limit = F.when(F.col("sentiment") == "all", k).otherwise(k_sent)
    return scoped.where(F.col("rank") <= limit)


def period_keywords(
    df: DataFrame, days: int = 30, k: int = 20, vocab: int = 1000, ngram_range=(1, 3),
    text_col: str = "cleaned_text",
) -> DataFrame:
    """Keywords of the recent and of the older period."""
    recent = F.col("review_date") >= trend_start(df, days)
    marked = df.withColumn("period", F.when(recent, "recent").otherwise("older"))
    return scoped_keywords(marked, ["period"], k, vocab, ngram_range, text_col)


def trending_topics(
    df: DataFrame, days: int = 30, t: float = 0.5, k: int = 20, text_col: str = "cleaned_text",
) -> DataFrame:
    """Recent keywords that grew by more than t over the older period."""
    periods = materialize(period_keywords(df, days, 20, text_col=text_col), "periods")
    scored = trend_score(
        periods.where(F.col("period") == "recent"), periods.where(F.col("period") == "older")
    )
    return topk_trending(scored, t, k)


def _is_term(word: Column) -> Column:
    return (F.length(word) > 2) & ~word.isin(list(ENGLISH_STOP_WORDS))


def _term_places(df: DataFrame, text_col: str, key: str) -> DataFrame:
    """One row per (document, term) with the YAKE features and the places where phrases have the term.

    Every row of a document carries its places, so that phrases are put together again without a join. A document's
    rows are in one task, and nothing moves after the texts. Terms come from the words of the text, phrases from those of its lower
    case; the two differ where lower case changes what a word is, and are then rows of their own.
    """
    texts = together(df.where(F.col(key).isNotNull()).select(key, text_col), key, text_col)
    text = text_or_empty(F.col(text_col))
    split = texts.select(
        key, F.monotonically_increasing_id().alias("row"),
        F.split(text, r"[.!?\n]+").alias("s"), F.split(F.lower(text), r"[.!?\n]+").alias("l"),
    )
    parts = split.select(key, "row", F.size("s").alias("sentences"), F.posexplode(F.arrays_zip("s", "l")).alias("sent", "p"))
    found = lambda c: F.regexp_extract_all(c, F.lit(rf"[{WORD}]+"), 0)
    tokens = parts.select(
        key, "row", "sent", F.when(F.col("sent") == 0, F.col("sentences")).alias("sentences"),
        found(F.col("p.s")).alias("raw"), found(F.col("p.l")).alias("low"),
    )
    tokens = tokens.withColumn("terms", F.transform("raw", F.lower))
    none = F.array(F.lit(None).cast("string"))
    zipped = F.arrays_zip(
        F.col("raw"), F.col("terms"), F.concat(none, "terms").alias("left"),
        F.slice("terms", 2, F.greatest(F.size("terms"), F.lit(1))).alias("right"),
    )
    alike = tokens.select("*", (F.col("terms") == F.col("low")).alias("alike"), zipped.alias("z"))
    no_word = F.lit(None).cast("string")

    def whole(z: Column, pos: Column) -> Column:
        return F.struct(
            z["terms"].alias("term"), pos.alias("pos"), z["raw"].alias("word"), z["left"].alias("left"),
            z["right"].alias("right"), F.col("alike").alias("place"),
        )

    def place(w: Column, pos: Column) -> Column:
        return F.struct(
            w.alias("term"), pos.alias("pos"), no_word.alias("word"), no_word.alias("left"), no_word.alias("right"), F.lit(True).alias("place")
        )

    # The last element, without a word, tells the sentences of the document.
    mark = F.array(place(no_word, F.lit(-1)))
    spoken = F.filter(F.transform("z", whole), lambda x: _is_term(x["term"]))
    apart = F.filter(F.transform("low", place), lambda x: _is_term(x["term"]))
    rows = F.concat(
        spoken, F.when(F.col("alike"), F.array().cast(_PLACE)).otherwise(apart),
        F.when(F.col("sentences").isNotNull(), mark).otherwise(F.array().cast(_PLACE)),
    )
    words = alike.select(key, "row", "sent", "sentences", F.explode(rows).alias("w")).select(key, "row", "sent", "sentences", "w.*")
    said = F.col("word").isNotNull()
    stats = words.groupBy(key, "term").agg(
        F.count("word").alias("tf"),
        F.count_if(F.col("word").rlike(r"^\p{Lu}") & (F.col("pos") > 0)).alias("cased"),
        F.count_if(F.col("word").rlike(r"^\p{Lu}{2,}$")).alias("acronym"),
        F.median(F.when(said, F.col("sent"))).alias("middle"),
        F.size(F.collect_set(F.when(said, F.col("sent")))).alias("spread"),
        F.size(F.collect_set("left")).alias("lefts"),
        F.count("left").alias("left_n"),
        F.size(F.collect_set("right")).alias("rights"),
        F.count("right").alias("right_n"),
        F.sum(F.when(F.col("term").isNull(), F.col("sentences"))).alias("sentences"),
        F.collect_list(F.when(F.col("place"), F.struct("row", "sent", "pos"))).alias("places"),
    )
    doc = Window.partitionBy(key)
    spoken_tf = F.when(F.col("tf") > 0, F.col("tf"))
    stats = stats.select(
        key, "term", "tf", "cased", "acronym", "middle", "spread", "lefts", "left_n", "rights", "right_n", "places",
        F.max("sentences").over(doc).alias("sentences"), F.avg(spoken_tf).over(doc).alias("mean_tf"),
        F.coalesce(F.stddev_pop(spoken_tf).over(doc), F.lit(0.0)).alias("std_tf"), F.max("tf").over(doc).alias("max_tf"),
    ).where("term IS NOT NULL AND tf > 0")
    case = F.greatest("cased", "acronym") / (1 + F.log(F.col("tf")))
    middle = F.log(F.log(3 + F.col("middle"))) + 1
    frequency = F.col("tf") / (F.col("mean_tf") + F.col("std_tf"))
    variety = F.coalesce(F.try_divide("lefts", "left_n"), F.lit(0.0)) + F.coalesce(
        F.try_divide("rights", "right_n"), F.lit(0.0)
    )
    relatedness = 1 + variety * F.col("tf") / F.col("max_tf")
    spread = F.col("spread") / F.col("sentences")
    features = stats.select(
        key, "term", "tf", case.alias("case"), middle.alias("place"),
        frequency.alias("frequency"), relatedness.alias("rel"), spread.alias("spread"), "places",
    )
    score = (F.col("rel") * F.col("place")) / (
        F.col("case") + (F.col("frequency") + F.col("spread")) / F.col("rel")
    )
    return features.withColumn("h", score)


_PLACE = "array<struct<term:string,pos:int,word:string,left:string,right:string,place:boolean>>"


def phrase_features(df: DataFrame, text_col: str = "review_text", key: str = "review_id") -> DataFrame:
    """Term scores of every document by the published YAKE features (low is good).

    Case, position, frequency, context variety and sentence spread of each term are
    grouped aggregates over (document, term); a document is one row, so no group is
    larger than a text.
    """
    return _term_places(df, text_col, key).drop("places")


def doc_keywords(
    df: DataFrame, k: int = 10, n: int = 3, dedup: float = 0.7, text_col: str = "review_text",
    key: str = "review_id",
) -> DataFrame:
    """The k best key phrases of up to n words of every document, near-equal ones dropped.

    A phrase is dropped when a better one of the same document is more alike than
    ``dedup`` by edit distance. Duplicates are looked for among a document's best
    phrases in turn, inside its row. A phrase is scored where it stands, from the scores of its
    words at consecutive places; words without a score have no place.
    """
    terms = _term_places(df, text_col, key)
    placed = terms.select(key, "term", "h", F.explode("places").alias("at")).select(key, "term", "h", "at.*")
    order = Window.partitionBy(key).orderBy("row", "sent", "pos")
    word = F.struct("row", "sent", "pos", "term", "h")
    runs = placed.select(key, *[(F.lead(word, i).over(order) if i else word).alias(f"w{i}") for i in range(n)])
    grams, whole = [], F.lit(True)
    for size in range(1, n + 1):
        last = F.col(f"w{size - 1}")
        follows = (last["row"] == F.col("w0.row")) & (last["sent"] == F.col("w0.sent")) & (last["pos"] == F.col("w0.pos") + size - 1)
        whole = whole & F.coalesce(follows, F.lit(False))
        h = [F.col(f"w{i}.h") for i in range(size)]
        grams.append(
            F.when(whole, F.struct(
                F.concat_ws(" ", *[F.col(f"w{i}.term") for i in range(size)]).alias("phrase"),
                reduce(mul, h).alias("product"), reduce(add, h).alias("total"),
            ))
        )
    scored = (
        runs.select(key, F.explode(F.array_compact(F.array(*grams))).alias("g"))
        .groupBy(key, F.col("g.phrase").alias("phrase"))
        .agg(F.count(F.lit(1)).alias("ptf"), F.min("g.product").alias("product"), F.min("g.total").alias("total"))
        .withColumn("score", F.col("product") / (F.col("ptf") * (1 + F.col("total"))))
    )
    ordered = scored.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("score", "phrase"))).alias("all")
    )

    def similar(a: Column, b: Column) -> Column:
        return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))

    def keep(kept: Column, item: Column) -> Column:
        clash = F.exists(kept, lambda o: similar(o["phrase"], item["phrase"]) > dedup)
        return F.when((F.size(kept) >= k) | clash, kept).otherwise(F.array_append(kept, item))

    empty = F.array().cast("array<struct<score:double,phrase:string>>")
    best = F.aggregate("all", empty, keep)
    return ordered.select(key, F.posexplode(best).alias("p", "b")).select(
        key, (F.col("p") + 1).alias("rank"), F.col("b.phrase").alias("phrase"), F.col("b.score").alias("score")
    )
