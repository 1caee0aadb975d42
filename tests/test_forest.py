"""Own forests against those of Spark's trainer."""

import itertools
import random

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from reviewloom.operators import forest
from reviewloom.operators import ml as J
from reviewloom.operators.forest import Forest, _drawn, _poisson


@pytest.fixture(scope="module")
def sparse(spark):
    rng, rows = random.Random(3), []
    for i in range(240):
        places = sorted(rng.sample(range(50), rng.randrange(0, 10)))
        vector = Vectors.sparse(50, places, [rng.choice([1.0, 2.0, rng.random()]) for _ in places])
        label = rng.randrange(3) if rng.random() < 0.4 else min(2, int(vector.toArray()[:3].sum()))
        rows.append((float(label), vector, 1.0 + i % 3))
    return spark.createDataFrame(rows, ["label", "features", "weight"]).repartition(3)


@pytest.fixture(scope="module")
def dense(spark):
    rng = random.Random(4)
    rows = [(float(rng.randrange(2)), Vectors.dense([rng.choice([0, rng.gauss(0, 1), 1.0, -2.0]) for _ in range(20)])) for _ in range(200)]
    return spark.createDataFrame(rows, ["label", "features"]).repartition(2)


def trees(model):
    return [t.toDebugString.split("\n", 1)[1] for t in model.trees]


@pytest.mark.parametrize(
    ("table", "params"),
    [
        ("sparse", {"numTrees": 20, "maxDepth": 30}),
        ("sparse", {"numTrees": 6, "maxDepth": 5, "weightCol": "weight"}),
        ("sparse", {"numTrees": 3, "maxDepth": 8, "bootstrap": False}),
        ("sparse", {"numTrees": 2, "maxDepth": 4, "impurity": "entropy"}),
        ("dense", {"numTrees": 1, "maxDepth": 6}),
        ("dense", {"numTrees": 8, "maxDepth": 9, "maxBins": 8, "minInstancesPerNode": 4, "minInfoGain": 0.01}),
    ],
)
def test_the_trees_are_those_of_spark(request, table, params):
    df = request.getfixturevalue(table)
    own, other = (kind(seed=42, **params).fit(df) for kind in (Forest, RandomForestClassifier))
    assert trees(own) == trees(other)
    assert np.array_equal(own.featureImportances.toArray(), other.featureImportances.toArray())
    assert own.transform(df).select("prediction", "probability").collect() == other.transform(df).select("prediction", "probability").collect()


def test_the_number_of_jobs_is_that_of_levels(spark):
    """Open nodes that need many passes of Spark's trainer are a job or two for each level."""
    rng = random.Random(5)
    noise = spark.createDataFrame(
        [(Vectors.dense([rng.random() for _ in range(900)]), float(rng.randrange(3))) for _ in range(240)], ["features", "label"]
    ).repartition(2)
    spark.sparkContext.setJobGroup("forest", "forest")
    model = J.random_forest(100).setMaxMemoryInMB(1).fit(noise)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("forest"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(model.trees) == 100 and model.totalNumNodes > 3000
    assert jobs <= 2 * (max(t.depth for t in model.trees) + 1) + 20


def test_wrong_labels_are_refused(spark):
    df = spark.createDataFrame([(0.5, Vectors.dense([1.0])), (1.0, Vectors.dense([2.0]))], ["label", "features"])
    with pytest.raises(Exception, match="[Ll]abel"):
        J.train_random_forest(df, 2)


def test_draws_are_different_features_and_all_as_likely():
    drawn = _drawn(np.arange(3000, dtype=np.uint64), 30, 6)
    assert all(len(set(row)) == 6 for row in drawn.tolist())
    counts = np.bincount(drawn.ravel(), minlength=30)
    assert len(counts) == 30 and abs(counts - 600).max() < 120
    assert np.array_equal(drawn[7:9], _drawn(np.array([7, 8], np.uint64), 30, 6))
    assert sorted(_drawn(np.array([5], np.uint64), 4, 3)[0]) != sorted(_drawn(np.array([5], np.uint64), 4, 4)[0])


def test_bootstrap_numbers_are_those_of_the_library(spark):
    poisson = spark._jvm.org.apache.commons.math3.distribution.PoissonDistribution(1.0)
    poisson.reseedRandomGenerator(43)
    assert list(poisson.sample(3000)) == list(itertools.islice(_poisson(43), 3000))


def test_counts_that_meet_in_a_task_do_not_grow_with_the_tasks_before():
    level = {"m": 100, "bins": 32, "sides": 3, "weighted": False, "density": 0.5, "totals": np.full((2000, 3), 1e6)}
    for tasks in (1, 20, 400):
        buckets = forest._buckets(level, tasks, 8)
        assert (np.diff(buckets) >= 0).all() and buckets[0] == 0
        assert np.bincount(buckets).max() * 9600 * tasks <= forest.GOT + 9600 * tasks


def test_folds_are_trained_side_by_side_with_the_same_result(spark, sparse):
    table = sparse.select("label", "features").withColumn("review_id", F.monotonically_increasing_id())
    one, three = (sorted(J.cross_validate(J.random_forest(5, max_depth=4), table, 3, parallelism=p).collect()) for p in (1, 3))
    assert one == three and len(one) == 12
