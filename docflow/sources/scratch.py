"""Intermediate tables in the folder the cluster shares."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


_recorders: list[list[str]] = []


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths of the tables staged inside the block, for :func:`remove`."""
    made: list[str] = []
    _recorders.append(made)
    try:
        yield made
    finally:
        _recorders.remove(made)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables that nothing will read again."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def has_scratch(spark: SparkSession) -> bool:
    """Whether the session has a folder for intermediate tables."""
    return bool(spark.conf.get("spark.checkpoint.dir", None)) or spark.conf.get("spark.master", "").startswith("local")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for ``name`` under ``spark.checkpoint.dir``.

    Only a local session may do without that setting: a machine's own temporary
    folder is out of reach for the executors of a cluster.
    """
    if not has_scratch(spark):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    root = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="docflow-")
    return f"{root.rstrip('/')}/docflow/{name}-{uuid4().hex}"


def staged(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once and read it back.

    For frames used several times over: the work is done once, survives the loss
    of executors, and later filters and projections reach the files. A filter on a
    column of ``partition_by`` opens the folders of its values only.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    for made in _recorders:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)
