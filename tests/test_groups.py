"""User functions on whole groups."""

import pandas as pd
import pytest
from pyspark.sql import types as T

from reviewloom.operators.udfs import apply_per_group


def looking():
    """A function that tells what it sees of its group; Python workers cannot import it from here."""

    def seen(group: pd.DataFrame) -> pd.DataFrame:
        kinds = ",".join(map(str, group.dtypes))
        top = group["n"].max() if group["n"].notna().any() else None
        return pd.DataFrame({
            "key": [group.iloc[0, 0]], "rows": [len(group)], "kinds": [kinds], "index": [str(group.index)], "top": [str(top)], "first": [top],
        })

    return seen


ROWS = [
    (1, 2**60 + 1, True, "a"), (1, 2**60 + 3, None, None), (2, None, False, "b"), (2, 5, True, "c"), (None, 7, True, "d"),
    (None, None, None, None), (0, 2**53 + 1, False, "e"), (3, None, None, "f"), (3, None, None, "f"),
]


@pytest.mark.parametrize("key", [T.LongType(), T.StringType()])
@pytest.mark.parametrize("batch", ["2", "10000"])
def test_groups_are_those_of_apply_in_pandas(spark, monkeypatch, key, batch):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    seen = looking()
    try:
        rows = [(k if k is None or key == T.LongType() else str(k), *rest) for k, *rest in ROWS * 3]
        schema = T.StructType([T.StructField("key", key), T.StructField("n", T.LongType()), T.StructField("b", T.BooleanType()), T.StructField("t", T.StringType())])
        df = spark.createDataFrame(rows, schema)
        out = f"key {key.simpleString()}, rows bigint, kinds string, `index` string, top string, first bigint"
        got = sorted(map(str, apply_per_group(df, "key", seen, out).collect()))
        assert got == sorted(map(str, df.groupBy("key").applyInPandas(seen, out).collect()))
        assert len(got) == 5
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_small_groups_share_batches(spark):
    rows = spark.range(2000).selectExpr("id % 500 AS key", "id AS n")
    frame = apply_per_group(rows, "key", lambda g: g.head(1), "key bigint, n bigint")
    assert "FlatMapGroupsInPandas" not in frame._jdf.queryExecution().toString()
    assert frame.count() == 500


def test_other_types_are_sent_group_by_group(spark):
    rows = spark.range(20).selectExpr("id % 3 AS key", "array(id) AS n")
    frame = apply_per_group(rows, "key", lambda g: pd.DataFrame({"key": [g["key"].iloc[0]], "n": [len(g)]}), "key bigint, n bigint")
    assert sorted(map(tuple, frame.collect())) == [(0, 7), (1, 7), (2, 6)]
