from pathlib import Path

import pytest

from reviewloom.plans import scratch


def test_a_scope_leaves_nothing_behind(spark):
    with scratch.scope(spark) as folder:
        kept = scratch.materialize(spark.range(5)).count()
        assert kept == 5 and list(Path(folder.removeprefix("file:")).iterdir())
    assert not Path(folder.removeprefix("file:")).exists()


def test_one_folder_per_application(spark):
    first, second = scratch.scratch_path(spark, "a"), scratch.scratch_path(spark, "a")
    assert first != second
    assert first.startswith(scratch.scratch_root(spark)) and spark.sparkContext.applicationId in first


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def __init__(self, **values):
            self.values = {k.replace("_", "."): v for k, v in values.items()}

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf(**values)

    for master in ("local-cluster[3,2,1024]", "spark://host:7077", "yarn"):
        with pytest.raises(ValueError):
            scratch._shared_folder(Session(spark_master=master))
    named = Session(spark_master="yarn", **{"spark_checkpoint_dir": "hdfs:///shared/"})
    assert scratch._shared_folder(named) == "hdfs:///shared"
