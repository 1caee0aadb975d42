"""Registering queries with the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import (
    PHONE,
    SPACE,
    SPECIAL,
    URL,
    clean_text,
)
from ..functions.text import EMAIL as EMAIL_PATTERN
from ..functions.wordlists import CONTRACTIONS, ENGLISH_STOP_WORDS
from ..operators.aggregates import reading_sizes
from ..plans.scratch import materialize
from ..sources.readers import parse_review_date

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()

REVIEWS = """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT)) AS review_id,
       l_partkey AS product_id, p_name AS product_name, p_type AS category,
       CAST(1 + (CAST(l_quantity AS INT) % 5) AS INT) AS rating,
       CASE l_returnflag WHEN 'R' THEN 'negative' WHEN 'A' THEN 'neutral' ELSE 'positive' END AS predicted_sentiment,
       CASE WHEN CAST(l_quantity AS INT) % 5 >= 3 THEN 'positive'
            WHEN CAST(l_quantity AS INT) % 5 <= 1 THEN 'negative' ELSE 'neutral' END AS true_sentiment,
       CAST(0.5 AS DOUBLE) + l_discount * 5 AS confidence_score,
       (l_linestatus = 'F') AS verified_purchase,
       CAST(round(l_tax * 100) AS INT) AS helpful_count,
       l_shipdate AS review_date
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""

REVIEW_DOCS = """
SELECT d.doc_id AS review_id, d.source AS product_id, d.lang AS category, d.text AS review_text,
       CAST(1 + d.doc_id % 5 AS INT) AS rating,
       CASE WHEN d.doc_id % 7 <= 1 THEN 'negative' WHEN d.doc_id % 7 = 2 THEN 'neutral' ELSE 'positive' END AS predicted_sentiment,
       CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 0 THEN 'neutral' WHEN l.quality = 1 THEN 'positive' END AS true_sentiment,
       CAST(50 + d.doc_id % 51 AS DOUBLE) / 100 AS confidence_score,
       (d.doc_id % 4 <> 0) AS verified_purchase,
       CAST(d.doc_id % 11 AS INT) AS helpful_count,
       DATE '2023-01-01' + CAST(d.doc_id % 730 AS INT) AS review_date
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
"""

REVIEW_EVENTS = """
SELECT event_id AS review_id, user_id AS product_id, event_type AS category,
       CAST(1 + event_id % 5 AS INT) AS rating,
       CASE WHEN event_id % 10 < 6 THEN 'positive' WHEN event_id % 10 < 8 THEN 'negative' ELSE 'neutral' END AS predicted_sentiment,
       value AS weight, ts AS review_date
FROM {events}
"""


def _spread(documents: DataFrame) -> DataFrame:
    """The supplied texts are one row group, which one task would read: they are dealt over the cores.

    A table of many files stays where it is; the answers do not depend on it.
    """
    cores = documents.sparkSession.sparkContext.defaultParallelism
    return documents.repartition(cores, "doc_id") if 2 * len(documents.inputFiles()) <= cores else documents


class Views:
    """The supplied tables as review tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _sql(self, text: str) -> DataFrame:
        used = {t: self.table(t) for t in TABLES if "{" + t + "}" in text}
        if "documents" in used:
            used["documents"] = _spread(used["documents"])
        return parse_review_date(self.spark.sql(text, **used))

    @cached_property
    def reviews(self) -> DataFrame:
        return self._sql(REVIEWS)

    @cached_property
    def docs(self) -> DataFrame:
        return self._sql(REVIEW_DOCS)

    @cached_property
    def events(self) -> DataFrame:
        return self._sql(REVIEW_EVENTS)

    @cached_property
    def cleaned(self) -> DataFrame:
        return self.docs.withColumn("cleaned_text", clean_text(F.col("review_text")))

    @cached_property
    def stage(self) -> DataFrame:
        """The cleaned reviews as a stage table, for queries that read the text several times."""
        return materialize(self.cleaned, "cleaned")

    @cached_property
    def sized(self) -> DataFrame:
        return reading_sizes(self.docs)

    @cached_property
    def pred(self) -> DataFrame:
        """Reviews as evaluated predictions."""
        return self.reviews.select(
            "review_id", "category", "rating",
            F.col("true_sentiment").alias("label"),
            F.col("predicted_sentiment").alias("prediction"),
            F.col("confidence_score").alias("confidence"),
            F.when(F.col("predicted_sentiment") == "positive", F.col("confidence_score"))
            .otherwise(1 - F.col("confidence_score")).alias("score"),
        )


def sql_string(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "(" + ", ".join(sql_string(v) for v in values) + ")"


def sql_replace_all(column: str, pattern: str, by: str = " ") -> str:
    return f"regexp_replace({column}, {sql_string(pattern)}, {sql_string(by)}, 'g')"


def sql_squeeze(column: str) -> str:
    return f"trim({sql_replace_all(column, f'[{SPACE}]+')})"


def sql_expand(column: str) -> str:
    out = f"lower({column})"
    for short, long in CONTRACTIONS.items():
        out = f"replace({out}, {sql_string(short)}, {sql_string(long)})"
    return out


def sql_clean(column: str) -> str:
    out = sql_expand(f"coalesce({column}, '')")
    for pattern in (URL, EMAIL_PATTERN, PHONE, SPECIAL):
        out = sql_replace_all(out, pattern)
    return f"lower({sql_squeeze(out)})"


def sql_words(column: str) -> str:
    return f"list_filter(string_split({sql_squeeze(column)}, ' '), lambda x: x <> '')"


def sql_gram_tokens(column: str, stop: bool = True) -> str:
    tokens = f"regexp_extract_all(lower({column}), '[\\p{{L}}\\p{{N}}_]{{2,}}')"
    if not stop:
        return tokens
    stops = "[" + ", ".join(sql_string(w) for w in ENGLISH_STOP_WORDS) + "]"
    return f"list_filter({tokens}, lambda x: NOT list_contains({stops}, x))"


def sql_grams(source: str, keep: str, tokens: str, lo: int = 1, hi: int = 3) -> str:
    """SELECT giving one row per n-gram of the token list."""
    parts = []
    for n in range(lo, hi + 1):
        gram = " || ' ' || ".join(f"t[i + {j}]" for j in range(n))
        parts.append(
            f"SELECT {keep}, unnest(list_transform(range(1, len(t) - {n} + 2), lambda i: {gram})) AS term FROM g0"
        )
    return f"(WITH g0 AS (SELECT {keep}, {tokens} AS t FROM {source}) " + " UNION ALL ".join(parts) + ")"


def _oracle_view(text: str) -> str:
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text


ORACLE_VIEWS = {
    "reviews": _oracle_view(REVIEWS),
    "review_docs": _oracle_view(REVIEW_DOCS),
    "review_events": _oracle_view(REVIEW_EVENTS),
    "cleaned": f"SELECT *, {sql_clean('review_text')} AS cleaned_text FROM review_docs",
    "sized": f"SELECT *, CAST(length(review_text) AS INT) AS char_count, CAST(len({sql_words('review_text')}) AS INT) AS word_count FROM review_docs",
    "pred": """SELECT review_id, category, rating, true_sentiment AS label, predicted_sentiment AS prediction,
        confidence_score AS confidence,
        CASE WHEN predicted_sentiment = 'positive' THEN confidence_score ELSE 1 - confidence_score END AS score FROM reviews""",
}
NEEDS = {"cleaned": "review_docs", "sized": "review_docs", "pred": "reviews"}


def oracle_text(body: str, uses: str) -> str:
    """The statement with the views it uses in front."""
    names: list[str] = []
    for name in uses.split():
        for wanted in (NEEDS.get(name), name):
            if wanted and wanted not in names:
                names.append(wanted)
    ctes = [f"{n} AS ({ORACLE_VIEWS[n]})" for n in names]
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {', '.join(ctes)}, {body[5:]}" if ctes else body
    return f"WITH {', '.join(ctes)} {body}" if ctes else body


def presentable(df: DataFrame) -> DataFrame:
    """Doubles to six digits and dates as text, so that engines can be compared."""
    columns = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        columns.append(c.alias(field.name))
    return df.select(*columns)


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None, uses: str = "reviews"):
    """Register a function of the views under a key, with its SQL where there is any."""

    def register(fn: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return presentable(fn(Views(spark, sf_dir)))

        run.__name__ = key
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = oracle_text(sql, uses)
        return fn

    return register
