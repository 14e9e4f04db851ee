"""Renames and unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; names absent from ``df`` are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename every column by position; the count must match."""
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


def select_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Keep the wanted columns that exist, in the wanted order."""
    return df.select(*[F.col(f"`{c}`") for c in wanted if c in df.columns])


def union_all_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; columns missing in a frame are null.
    A narrow operation: no shuffle, partitions are concatenated."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
