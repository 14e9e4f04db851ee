"""Sorts and top-k (O1, O2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_nulls_last(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """O1: ascending on every key, nulls last (pandas order).  A global range
    sort; use it only at the sink."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in cols])


def top_k(df: DataFrame, order_col: str, k: int, descending: bool = True) -> DataFrame:
    """O2: the first ``k`` rows by one key (a limit that is the feature).
    Spark plans TakeOrderedAndProject: each task keeps its own k, then one
    merge of k-per-task rows; no full sort."""
    c = F.col(order_col)
    return df.orderBy(c.desc_nulls_last() if descending else c.asc_nulls_last()).limit(k)


def top_k_by(df: DataFrame, order, k: int) -> DataFrame:
    """O2 with several keys (Columns with their direction); same plan."""
    return df.orderBy(*order).limit(k)
