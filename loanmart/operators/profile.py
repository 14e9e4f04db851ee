"""Extract profile.

Everything comes from one aggregation over the full-row groups: each group
carries its multiplicity ``n``, so row count, per-column null counts,
duplicate count and distinct count are sums over groups.  One shuffle with
map-side partial aggregation; a row repeated a billion times is one group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_groups(df: DataFrame) -> DataFrame:
    """Every distinct full row with its multiplicity ``n``."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))


def duplicate_groups(df: DataFrame) -> DataFrame:
    """G7 listing: fully duplicated rows, each once, with ``n`` > 1 copies."""
    return row_groups(df).where(F.col("n") > 1)


def extract_profile(df: DataFrame) -> DataFrame:
    """One row: ``rows``, ``nulls_<col>`` per column, ``duplicate_rows``
    (surplus copies, pandas ``duplicated().sum()``) and ``distinct_rows``."""
    g = row_groups(df)
    n = F.col("n")
    return g.agg(
        F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("rows"),
        *[F.coalesce(F.sum(F.when(F.col(c).isNull(), n).otherwise(0)), F.lit(0)).cast("bigint")
          .alias(f"nulls_{c}") for c in df.columns],
        F.coalesce(F.sum(n - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"),
        F.count(F.lit(1)).alias("distinct_rows"))
