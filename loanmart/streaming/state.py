"""Versioned snapshots of what a stream remembers between micro-batches.

Batch ``b`` reads the newest snapshot of an earlier batch and writes its own,
``version=b``.  A replay of the batch reads the same snapshot as the first try
and overwrites what that left.  A snapshot holds the state as a whole, so a
batch never looks at earlier output, and older ones are deleted.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Snapshots that stay; a replay needs the one before its batch.
KEPT_VERSIONS = 3


def _versions(spark: SparkSession, path: str) -> dict[int, object]:
    """Finished snapshots by batch."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return {}
    found = {}
    for status in fs.listStatus(folder):
        name = re.fullmatch(r"version=(\d+)", status.getPath().getName())
        if name and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found[int(name[1])] = status.getPath()
    return found


def read_state(spark: SparkSession, path: str, schema: T.StructType, batch_id: int) -> DataFrame | None:
    """The newest snapshot before ``batch_id``; None if there is none."""
    before = [v for v in _versions(spark, path) if v < batch_id]
    return spark.read.schema(schema).parquet(f"{path}/version={max(before)}") if before else None


def write_state(df: DataFrame, path: str, batch_id: int) -> None:
    """The snapshot of ``batch_id``, from which the next batch starts."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}/version={batch_id}")
    versions = _versions(spark, path)
    old = sorted(v for v in versions if v <= batch_id)[:-KEPT_VERSIONS]
    for v in old:
        versions[v].getFileSystem(spark._jsc.hadoopConfiguration()).delete(versions[v], True)
