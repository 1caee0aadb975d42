"""Order-dependent work without a single-task window.

A window without a partition key sorts its whole input in one task, and one keyed
by a few labels does so for a large part of it. The functions here cut the order
into ranges first: sums per range are few, so only those are accumulated in one
task, and the window inside a range sees a small, even part of the rows. Results
are exact whatever the range bounds are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import materialize

RANGES = 256
_BUCKET = "__range"


def _with_range(df: DataFrame, order: str, ranges: int) -> DataFrame:
    """Number the range of each row by how many bounds lie below its value."""
    points = [i / ranges for i in range(1, ranges)]
    bounds = df.agg(
        F.array_distinct(F.percentile_approx(F.col(order).cast("double"), points, 10000))
    ).scalar()
    value = F.col(order).cast("double")
    below = F.size(F.filter("__bounds", lambda b: b < value))
    return (
        df.withColumn("__bounds", bounds)
        .withColumn(_BUCKET, F.coalesce(below, F.lit(-1)))
        .drop("__bounds")
    )


def running_totals(
    df: DataFrame,
    order: str,
    values: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    ranges: int = RANGES,
) -> DataFrame:
    """Add ``cum_<value>``: the inclusive running sum of each value in the given order.

    One row per (by, order) is expected: aggregate first, which also evens out
    values that hold a large part of the rows.
    """
    by = list(by)
    ranged = _with_range(df, order, ranges)
    direction = F.desc if descending else F.asc
    across = Window.partitionBy(*by).orderBy(direction(_BUCKET))
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*by, _BUCKET)
        .agg(*[F.sum(v).alias(f"__sum_{v}") for v in values])
        .select(
            *by,
            _BUCKET,
            *[
                F.coalesce(F.sum(f"__sum_{v}").over(before), F.lit(0)).alias(f"__before_{v}")
                for v in values
            ],
        )
    )
    inside = (
        Window.partitionBy(*by, _BUCKET)
        .orderBy(direction(order))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    joined = _null_safe_join(ranged, offsets, [*by, _BUCKET])
    summed = joined.select(
        *[F.col(c) for c in df.columns],
        *[
            (F.sum(v).over(inside) + F.col(f"__before_{v}")).alias(f"cum_{v}")
            for v in values
        ],
    )
    return summed


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = None
    for k in keys:
        same = left[k].eqNullSafe(renamed[f"__r_{k}"])
        condition = same if condition is None else condition & same
    return left.join(renamed, condition).drop(*[f"__r_{k}" for k in keys])


def quantiles(
    df: DataFrame, by: Sequence[str], value: str, probabilities: Sequence[float]
) -> DataFrame:
    """Exact, linearly interpolated quantiles: one row per (by, probability).

    The rows are first folded to one per distinct value, so the memory of a task
    does not grow with the data, unlike that of the ``percentile`` aggregate. The folded
    rows are written, as bounds, sums and ranks all read them.
    """
    by = list(by)
    histogram = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("double").alias("__v"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    histogram = materialize(histogram, "histogram")
    ranked = running_totals(histogram, "__v", ["__n"], by)
    sizes = histogram.groupBy(*by).agg(F.sum("__n").alias("__total"))
    ranked = _null_safe_join(ranked, sizes, by) if by else ranked.withColumn(
        "__total", sizes.scalar()
    )
    first, last = F.col("cum___n") - F.col("__n"), F.col("cum___n") - 1

    def touches(p: Column) -> Column:
        # The value holds the position just below or just above the wanted one.
        target = p * (F.col("__total") - 1)
        low, high = F.floor(target), F.ceil(target)
        return ((first <= low) & (low <= last)) | ((first <= high) & (high <= last))

    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    hits = ranked.select(
        *by, "__v", "__total", F.explode(F.filter(wanted, touches)).alias("probability")
    )
    target = F.col("probability") * (F.col("__total") - 1)
    return hits.groupBy(*by, "probability").agg(
        (
            F.min("__v") + (F.max("__v") - F.min("__v")) * F.max(target - F.floor(target))
        ).alias("value")
    )


def top_rows(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first n rows of every group, with their rank from 1.

    Spark keeps only n rows per task before the shuffle for n up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``; beyond that the groups are
    salted so that the first cut runs in many tasks.
    """
    by = list(by)
    limit = int(
        df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    )
    if n > limit:
        salted = df.withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(64)))
        window = Window.partitionBy(*by, "__salt").orderBy(*order)
        df = (
            salted.withColumn(rank, F.row_number().over(window))
            .where(F.col(rank) <= n)
            .drop("__salt", rank)
        )
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


HASH_BUCKETS = 4096


def _hash_buckets(df: DataFrame, key: str, seed: int) -> DataFrame:
    hashed = df.withColumn("__h", F.xxhash64(F.col(key), F.lit(seed)))
    bucket = F.pmod(F.shiftright("__h", 20), F.lit(HASH_BUCKETS)).cast("int")
    return hashed.withColumn("__b", bucket)


def rank_by_hash(df: DataFrame, stratum: str, key: str, seed: int = 42) -> DataFrame:
    """Add ``hash_rank``: the position of a row in its stratum in hash order, from 0."""
    hashed = _hash_buckets(df, key, seed)
    upto = Window.partitionBy(stratum).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        hashed.groupBy(stratum, "__b")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(stratum, "__b", F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__start"))
    )
    inside = Window.partitionBy(stratum, "__b").orderBy("__h", key)
    return _null_safe_join(hashed, starts, [stratum, "__b"]).select(
        *df.columns, (F.col("__start") + F.row_number().over(inside) - 1).alias("hash_rank")
    )


def split_by_hash(
    df: DataFrame, stratum: str, key: str, fraction: float, seed: int = 42, flag: str = "is_train"
) -> DataFrame:
    """Mark exactly round(fraction * n) rows of every stratum, chosen by hash order.

    Counts per hash bucket decide every bucket but one per stratum; only the rows
    of that one are ranked.
    """
    hashed = _hash_buckets(df, key, seed)
    counts = hashed.groupBy(stratum, "__b").agg(F.count(F.lit(1)).alias("__n"))
    upto = Window.partitionBy(stratum).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(stratum)
    plan = counts.select(
        stratum,
        "__b",
        (F.sum("__n").over(upto) - F.col("__n")).alias("__start"),
        F.sum("__n").over(upto).alias("__end"),
        F.round(F.sum("__n").over(whole) * F.lit(fraction)).cast("long").alias("__take"),
    )
    joined = _null_safe_join(hashed, plan, [stratum, "__b"])
    open_bucket = (F.col("__start") < F.col("__take")) & (F.col("__take") < F.col("__end"))
    in_bucket = Window.partitionBy(stratum, "__b").orderBy("__h", key)
    decided = joined.where(~open_bucket).withColumn(flag, F.col("__end") <= F.col("__take"))
    ranked = joined.where(open_bucket).withColumn(
        flag, F.col("__start") + F.row_number().over(in_bucket) <= F.col("__take")
    )
    return decided.unionByName(ranked).select(*df.columns, flag)
