"""Upsert by key (K5) with key checks (V3).

A frame's new state is ``target ⋉̸ source ∪ source``.  A catalog table is a view
of its columns over a data table in hash buckets of its key, one partition
each, and an upsert rewrites only the buckets that hold a key of the source:
the rows of those buckets and the source meet by bucket in one shuffle, and
dynamic partition overwrite puts the new buckets in the place of the old ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanmart.operators.dedupe import keep_first
from loanmart.session import scratch_path, session_setting
from loanmart.sources.tables import BUCKET, stored_columns, warehouse_table

#: Rows of a bucket that a new table is laid out for, and its least number of buckets.
BUCKET_ROWS = 500_000
LEAST_BUCKETS = 16
_BUCKETS, _KEY = "upsert.buckets", "upsert.key"


class DuplicateKeyError(ValueError):
    pass


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def assert_unique(df: DataFrame, key: Sequence[str]) -> None:
    """V3: raise when a key repeats (checks at most one offending key)."""
    bad = duplicate_keys(df, key).limit(1).collect()
    if bad:
        raise DuplicateKeyError(f"duplicate key {[bad[0][k] for k in key]} ({bad[0]['n']} rows)")


def merge_frames(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Matched rows take the source values, unmatched source rows are
    inserted, other target rows stay.  Result has the target's columns."""
    src = source.select(*target.columns)
    return target.join(src.select(*key), list(key), "left_anti").unionByName(src)


def _sound_source(source: DataFrame, key: Sequence[str], on_duplicate: str, order_col: str | None) -> DataFrame:
    if on_duplicate == "latest":
        if order_col is None:
            raise ValueError("on_duplicate='latest' needs order_col")
        return keep_first(source, key, order_col)
    if on_duplicate == "error":
        assert_unique(source, key)
    elif on_duplicate != "checked":
        raise ValueError(on_duplicate)
    return source


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str],
           on_duplicate: str = "error", order_col: str | None = None) -> DataFrame:
    """K5 (+ V3).  ``on_duplicate``: 'error' raises on repeated source keys
    (Q18); 'latest' keeps the row with the greatest ``order_col``; 'checked'
    says that V3 has been done."""
    return merge_frames(target, _sound_source(source, key, on_duplicate, order_col), key)


# ------------------------------------------------------------- catalog tables
def _bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias(BUCKET)


def _property(spark: SparkSession, table: str, name: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == name).collect()
    return rows[0]["value"] if rows else None


def data_table(table: str) -> str:
    """The table that holds the buckets of ``table``."""
    return f"{table}__buckets"


def _create_buckets(spark: SparkSession, name: str, ddl: str, key: Sequence[str], buckets: int) -> None:
    spark.sql(f"CREATE TABLE {name} ({ddl}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) "
              f"TBLPROPERTIES ('{_BUCKETS}' = '{buckets}', '{_KEY}' = '{','.join(key)}')")


def _show(spark: SparkSession, table: str) -> None:
    """The view of a data table's own columns."""
    data = data_table(table)
    names = ", ".join(f"`{c}`" for c in spark.table(data).columns if c != BUCKET)
    spark.sql(f"CREATE VIEW {table} AS SELECT {names} FROM {data}")


def create_bucketed_table(spark: SparkSession, table: str, ddl: str, key: Sequence[str], buckets: int) -> None:
    """An empty table (K7) in ``buckets`` hash buckets of its key."""
    _create_buckets(spark, data_table(table), ddl, key, buckets)
    _show(spark, table)


def _overwrite_buckets(rows: DataFrame, table: str) -> None:
    """Replace exactly the partitions that ``rows`` holds."""
    with session_setting(rows.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        rows.write.mode("overwrite").insertInto(table)


def merge_buckets(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """The state of the buckets in ``source`` after an upsert, both sides with
    their bucket column.  One shuffle, by bucket: within it a row of the target
    goes when a row of the source has its key (null keys match nothing)."""
    rows = target.withColumn("_new", F.lit(0)).unionByName(source.withColumn("_new", F.lit(1))).repartition(BUCKET)
    newest = F.max("_new").over(Window.partitionBy(BUCKET, *key))
    null_key = F.greatest(*[F.col(k).isNull() for k in key], F.lit(False))
    return rows.withColumn("_newest", newest).where((F.col("_new") == F.col("_newest")) | null_key).select(*target.columns)


def upsert_table(spark: SparkSession, table: str, source: DataFrame, key: Sequence[str], ddl: str | None = None,
                 buckets: int | None = None, on_duplicate: str = "error", order_col: str | None = None) -> None:
    """K5 against a catalog table, creating it when absent (K7; ``ddl`` gives
    its columns, else those of ``source``; ``buckets`` how many, else by the
    number of source rows).

    The source is staged once; V3, the touched buckets and the merge read the
    staged rows.  Buckets are put in place one by one at the end of the job;
    after a crash between two of them the same upsert, run again, gives the
    same table.  A table that outgrows its buckets is laid out anew by
    ``rebucket``.
    """
    path = scratch_path(spark, "upsert-stage")
    source.write.parquet(path)
    staged = spark.read.schema(source.schema).parquet(path)
    data, there = data_table(table), spark.catalog.tableExists(table)
    columns = ddl or ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields)
    schema = spark.table(table).schema if there else spark.createDataFrame([], columns).schema
    extra = [order_col] if order_col and order_col not in schema.names else []
    typed = staged.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields], *extra)
    sound = _sound_source(typed, key, on_duplicate, order_col).drop(*extra)
    if not there:
        create_bucketed_table(spark, table, columns, key, buckets or max(LEAST_BUCKETS, staged.count() // BUCKET_ROWS + 1))
    held = _property(spark, data, _KEY) if spark.catalog.tableExists(data) else None
    if held != ",".join(key):
        raise ValueError(f"{table} is laid out by {held or 'no key'}, not by {','.join(key)}")
    sound = sound.select("*", _bucket(key, int(_property(spark, data, _BUCKETS))))
    touched = [r[0] for r in sound.select(BUCKET).distinct().collect()]  # at most one number per bucket
    if touched:
        _overwrite_buckets(merge_buckets(spark.table(data).where(F.col(BUCKET).isin(touched)), sound, key), data)


def rebucket(spark: SparkSession, table: str, key: Sequence[str], buckets: int) -> None:
    """Lay a table out anew: in more buckets, by another key, or a plain table
    in buckets at all.  Rewrites it once, beside the old one, and takes its name."""
    data, new = data_table(table), f"{table}__rebuckets"
    rows, bucketed = warehouse_table(spark, table), spark.catalog.tableExists(data)
    spark.sql(f"DROP TABLE IF EXISTS {new}")
    _create_buckets(spark, new, stored_columns(spark, data if bucketed else table), key, buckets)
    _overwrite_buckets(rows.select("*", _bucket(key, buckets)).repartition(BUCKET), new)
    spark.sql(f"DROP VIEW {table}" if bucketed else f"DROP TABLE {table}")
    if bucketed:
        spark.sql(f"DROP TABLE {data}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {data}")
    _show(spark, table)
