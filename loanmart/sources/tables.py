"""Table sources: the driver's parquet tables and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The driver tables.
DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; parquet gives column pruning and filter pushdown."""
    if name not in DRIVER_TABLES:
        raise KeyError(name)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Columns by which tables of this library are partitioned: the hash bucket of
#: an upsert's key, and the load that appended a row.
BUCKET, LOAD = "_bucket", "_load"


def warehouse_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view (``select *``; Catalyst prunes),
    without the columns of its layout."""
    return spark.read.table(name).drop(BUCKET, LOAD)


def stored_columns(spark: SparkSession, name: str) -> str:
    """The DDL of a table's columns, those of its layout left out."""
    fields = [f for f in spark.read.table(name).schema.fields if f.name not in (BUCKET, LOAD)]
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in fields)
