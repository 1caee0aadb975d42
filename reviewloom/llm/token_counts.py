"""Token counts of a corpus for every context limit, from one exact histogram of encoded lengths.

Every text is encoded once; tasks send only (length, documents) rows. Sums over the histogram then
answer totals, quantiles and truncated totals for each limit: the suffix sum of documents is the
number of texts longer than a limit, and each of them counts as the limit itself.

The histogram has a row per distinct length. Its running sums are taken in two steps, within
ranges of RANGE lengths and over the ranges' totals, so no task gets all rows of it.

Defined cases: null and empty texts have 0 tokens; every row counts, repeated ones too; an empty
table gives an empty histogram and no answers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.scratch import materialize
from .common import arrow_rows
from .encode import VOCABULARY, encoder

RANGE = 1024
#: Context limits that are answered whether or not a text has just that length.
LIMITS = (512, 1024, 2048, 4096, 8192, 16384, 32768, 65536, 131072)


def histogram(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(n_tokens, n_docs)."""

    def count(batches):
        encode = encoder(vocabulary)
        for batch in batches:
            found = Counter(len(encode(text)) // 4 for (text,) in arrow_rows(batch, "text"))
            yield pa.RecordBatch.from_pydict({
                "n_tokens": pa.array(list(found), pa.int64()), "n_docs": pa.array(list(found.values()), pa.int64())
            })

    counted = docs.select("text").mapInArrow(count, "n_tokens long, n_docs long")
    return counted.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def by_limit(lengths: DataFrame, limits: Sequence[int] = LIMITS) -> DataFrame:
    """For every length that occurs and every given limit, taken as a context limit:

    n_docs: documents of this length; docs_over: longer ones (suffix sum); tokens_upto: all tokens of
    documents that fit; truncated_tokens: tokens left if every document is cut at the limit;
    share_upto: share of documents that fit, so the least limit with share_upto >= q is quantile q.

    The histogram is written once, so texts are not encoded again for the second sum.
    """
    given = F.explode(F.array(*[F.lit(n) for n in limits]).cast("array<long>"))
    asked = lengths.sparkSession.range(1).select(given.alias("n_tokens"), F.lit(0).cast("long").alias("n_docs"))
    rows = lengths.unionByName(asked).groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))
    rows = materialize(rows, "lengths").select("n_tokens", "n_docs", F.floor(F.col("n_tokens") / RANGE).alias("range"))
    totals = rows.groupBy("range").agg(F.sum("n_docs").alias("docs"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("tokens"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row per RANGE lengths
    everything = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "range",
        F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("tokens_before"),
        F.sum("docs").over(everything).alias("all_docs"),
    )
    run = Window.partitionBy("range").orderBy("n_tokens")
    summed = rows.select(
        "*", F.sum("n_docs").over(run).alias("docs_run"), F.sum(F.col("n_docs") * F.col("n_tokens")).over(run).alias("tokens_run")
    ).join(offsets.where("all_docs > 0"), "range")
    upto, tokens = F.col("docs_before") + F.col("docs_run"), F.col("tokens_before") + F.col("tokens_run")
    over = F.col("all_docs") - upto
    return summed.select(
        "n_tokens", "n_docs", over.alias("docs_over"), tokens.alias("tokens_upto"),
        (tokens + over * F.col("n_tokens")).alias("truncated_tokens"),
        F.round(upto / F.col("all_docs"), 6).alias("share_upto"),
    )
