"""Surrogate key, start 1 step 1, in a stated order.

``row_number()`` over an un-partitioned window moves every row into one task.
Instead: range-partition and sort by the order (plus every other column as a
tie-break, so the result is the same on any re-run), number rows inside each
partition with ``monotonically_increasing_id`` and add the count of all
earlier partitions.  The numbered rows are written once to the shared folder,
and both the counts and the keys come from that copy: a second run of the
range partitioning could cut the rows elsewhere.  The offsets table has one
row per partition, a bound known before the job runs, so it is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanmart.session import scratch_path


def add_surrogate_key(df: DataFrame, order_cols: Sequence[str | Column], name: str = "unique_id",
                      start: int = 1, partitions: int | None = None) -> DataFrame:
    named = [c for c in order_cols if isinstance(c, str)]
    ties = [c for c in df.columns if c not in named]
    order = [c if isinstance(c, Column) else F.col(c).asc_nulls_first() for c in [*order_cols, *ties]]
    ranged = (df.repartitionByRange(partitions, *order) if partitions
              else df.repartitionByRange(*order))
    tagged = (ranged.sortWithinPartitions(*order)
                    .withColumn("_pid", F.spark_partition_id())
                    .withColumn("_mid", F.monotonically_increasing_id()))
    path = scratch_path(df.sparkSession, "surrogate")
    tagged.write.parquet(path)
    tagged = df.sparkSession.read.schema(tagged.schema).parquet(path)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", "_first",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_pid")
                  .select(*[F.col(c) for c in df.columns],
                          (F.col("_off") + F.col("_mid") - F.col("_first") + F.lit(start))
                          .cast("bigint").alias(name)))
