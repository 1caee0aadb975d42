"""Cutting lineage with tables in shared storage.

Everything goes to one folder per Spark application under ``spark.checkpoint.dir``, which all
executors must share; the file system deletes the folder when the application ends. ``scope``
deletes earlier what is written inside it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_roots: dict[str, str] = {}
_scopes: list[str] = []


def _path(spark: SparkSession, name: str):
    """The Hadoop path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def is_folder(spark: SparkSession, name: str) -> bool:
    path, fs = _path(spark, name)
    return fs.exists(path) and fs.getFileStatus(path).isDirectory()


def _shared_folder(spark: SparkSession) -> str:
    """What the session names; a temporary folder only in a single-process session without one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="reviewloom-")


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application."""
    app = spark.sparkContext.applicationId
    if app not in _roots:
        _roots[app] = f"{_shared_folder(spark)}/reviewloom-{app}-{uuid.uuid4().hex[:8]}"
        path, fs = _path(spark, _roots[app])
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return _roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    root = scratch_root(spark)
    return "/".join([root, *_scopes[-1:], f"{name}-{uuid.uuid4().hex}"])


@contextmanager
def scope(spark: SparkSession) -> Iterator[str]:
    """Deletes at its end what was written inside it; frames that read it are of no use then."""
    name = f"scope-{uuid.uuid4().hex}"
    _scopes.append(name)
    try:
        yield f"{scratch_root(spark)}/{name}"
    finally:
        _scopes.remove(name)
        path, fs = _path(spark, f"{scratch_root(spark)}/{name}")
        fs.delete(path, True)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write the frame once and read it back.

    Later uses neither recompute it nor depend on the executors that made it, and
    its file size is known to the planner, which then picks broadcast or sort-merge
    for joins on it by ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
