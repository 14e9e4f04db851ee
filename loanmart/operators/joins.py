"""Key-set joins (J3, J4, J8): the key side is reduced to distinct keys first,
so a key that repeats there costs nothing, and AQE may split a hot key of the
other side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def semi_join(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys_df`` (distinct keys first, so
    a repeated key costs nothing on the build side)."""
    return df.join(keys_df.select(*keys).distinct(), list(keys), "left_semi")


def anti_join(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``keys_df``."""
    return df.join(keys_df.select(*keys).distinct(), list(keys), "left_anti")
