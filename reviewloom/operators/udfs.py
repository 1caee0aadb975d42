"""User functions: Arrow-batched where Python is needed, expressions where it is not."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from inspect import signature
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def udf_text_feature(fn: Callable[[str], float], returns: str = "double"):
    """A user function on one text as a vectorised UDF; null texts reach it as ''."""

    @F.pandas_udf(returns)
    def feature(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.fillna("").map(fn)

    return feature


def udaf_rate(condition: Column) -> Column:
    """Aggregate: share of rows that meet a condition."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def udtf_keywords(k: int = 10):
    """A table function: one text to its k most frequent words, as (term, score) rows."""

    @F.udtf(returnType="term: string, score: double")
    class Keywords:
        def eval(self, text: str):
            tokens = re.findall(r"\w{4,}", (text or "").lower())
            counts: dict[str, int] = {}
            for token in tokens:
                counts[token] = counts.get(token, 0) + 1
            for term, n in sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:k]:
                yield term, n / len(tokens)

    return Keywords


def udf_multi_feature(df: DataFrame, features: Mapping[str, Column]) -> DataFrame:
    """Several features of a row as one struct, then as columns."""
    struct = F.struct(*[v.alias(k) for k, v in features.items()])
    return df.withColumn("__s", struct).select(*df.columns, "__s.*")


#: Types of which a batch gives the same pandas column as a group of it, and those of them that a null would change.
_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.BooleanType())
_PLAIN = (*_WHOLE, T.FloatType(), T.DoubleType(), T.StringType())


def apply_per_group(
    df: DataFrame, by: str, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """A user function on a whole group at once.

    A group is held by one task: aggregate or salt large groups first. The
    operators of this library do not use it. Groups of numbers and strings come to Python many in a batch of sorted rows
    and are cut there; other groups are sent one by one, which costs far more for small ones.
    """
    types = {f.name: f.dataType for f in df.schema}
    alone = len(types) < len(df.columns) or by not in types or len(signature(fn).parameters) != 1
    if alone or types[by] not in (*_WHOLE, T.StringType()) or any(t not in _PLAIN for t in types.values()):
        return df.groupBy(by).applyInPandas(fn, schema)
    # A null would make floats or objects of a batch's whole numbers: it goes as 0 with a mark.
    whole = {c: f"__null_{i}" for i, c in enumerate(df.columns) if types[c] in _WHOLE}
    columns = df.columns

    def kept(c: str) -> Column:
        quoted = F.col(f"`{c}`")
        return F.coalesce(quoted, F.lit(0).cast(types[c])).alias(c) if c in whole else quoted

    def cut(batch: pd.DataFrame, starts: Sequence[int], ends: Sequence[int]) -> Iterator[pd.DataFrame]:
        """The results of groups of a frame of rows."""
        frame = batch[columns].reset_index(drop=True)
        nulls = [(c, batch[mark].to_numpy()) for c, mark in whole.items()]
        nulls = [(c, null) for c, null in nulls if null.any()]
        for start, end in zip(starts, ends, strict=True):
            rows = frame.iloc[start:end]
            rows.index = pd.RangeIndex(end - start)
            for c, null in nulls:
                if null[start:end].any():
                    loose = rows[c].astype(object if rows[c].dtype == bool else "float64")
                    rows = rows.assign(**{c: loose.mask(null[start:end], None)})
            yield fn(rows)

    def groups(batches: Iterator[pd.DataFrame]) -> Iterator[Iterator[pd.DataFrame]]:
        """The results of the groups that end in a batch."""
        begun: list[pd.DataFrame] = []  # the rows so far of the group that may go on in the next batch
        for batch in batches:
            if not len(batch):
                continue
            new = np.zeros(len(batch), dtype=bool)
            for c in order:
                key = batch[c].to_numpy()
                new[1:] |= key[1:] != key[:-1]
                new[0] |= not begun or key[0] != begun[-1][c].iloc[-1]
            starts = np.flatnonzero(new).tolist()
            if starts and begun:
                before = pd.concat([*begun, batch.iloc[: starts[0]]])
                yield cut(before, [0], [len(before)])
            if starts:
                yield cut(batch, starts[:-1], starts[1:])
                begun = []
            begun.append(batch.iloc[starts[-1] if starts else 0 :])
        if begun:
            rows = pd.concat(begun)
            yield cut(rows, [0], [len(rows)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for done in groups(batches):
            # Results of one shape are sent together; whole numbers are not mixed with floats.
            for _, alike in groupby(done, lambda r: (r.columns.to_list(), r.dtypes.to_list())):
                yield pd.concat(list(alike), ignore_index=True)

    order = [by, *[whole[c] for c in (by,) if c in whole]]
    marks = [F.col(f"`{c}`").isNull().alias(mark) for c, mark in whole.items()]
    rows = df.select(*map(kept, columns), *marks).repartition(F.col(f"`{by}`"))
    return rows.sortWithinPartitions(*[f"`{c}`" for c in order]).mapInPandas(run, schema)
