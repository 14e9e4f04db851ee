"""Outboxes written by micro-batches: a folder per batch id.

A batch overwrites its own folder, so a replayed batch leaves the same rows
as one run, for every sink on its own, wherever the first try stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from loanmart.session import path_exists


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batch(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame:
    """The rows that one batch has written."""
    return spark.read.schema(schema).parquet(f"{path}/batch_id={batch_id}")


def read_outbox(spark: SparkSession, path: str, schema: str | T.StructType, before: int | None = None) -> DataFrame:
    """All rows with their ``batch_id`` (``before``: of earlier batches only);
    no rows where nothing has been written yet."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], whole)
    rows = spark.read.schema(whole).parquet(path)
    return rows if before is None else rows.where(rows.batch_id < before)
