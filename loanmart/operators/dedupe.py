"""Keep-first de-duplication (G3) and distinct values.

``dropDuplicates`` keeps an arbitrary row; the reports keep the first row in
source order.  We express "first" as the greatest (or least) order value and
pick it with ``max_by``/``min_by`` over a struct of the other columns: a hash
aggregate with map-side partial aggregation, so a hot key is collapsed in
every task before the shuffle instead of being sorted in one window task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _has_map(t: T.DataType) -> bool:
    """Maps have no order."""
    return "map<" in t.simpleString()


def keep_first(df: DataFrame, keys: Sequence[str], order_col: str,
               descending: bool = True) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order_col`` (or least
    when ``descending`` is False).  Null keys form their own group, as in
    pandas ``drop_duplicates``; a row whose order value is null is kept only
    when the whole group has none; equal order values are settled by the other
    columns."""
    rest = [c for c in df.columns if c not in keys]
    payload = F.struct(*[F.col(c) for c in rest])
    # a null order value loses to any other; ties go by the remaining columns
    ties = [F.col(c) for c in rest if not _has_map(df.schema[c].dataType)]
    value = F.col(order_col)
    if descending:
        pick, order = F.max_by, F.struct(value.isNotNull(), value, *ties)
    else:
        pick, order = F.min_by, F.struct(value.isNull(), value, *ties)
    return (df.groupBy(*keys)
              .agg(pick(payload, order).alias("_row"))
              .select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
              .select(*df.columns))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values of one column (F11 + G4)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct()
