"""Arg-max operators.

Both are hash aggregates with a partial (map-side) step, so a name that owns
a third of all rows is reduced inside every task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_numeric_id(df: DataFrame, group_cols: Sequence[str] = ("name",),
                         id_col: str = "id") -> DataFrame:
    """G1: per group, the id whose *numeric* value is greatest (ids are text,
    so '10' beats '9').  An id that is no number raises, a null id is skipped."""
    num = F.col(id_col).cast("decimal(38,0)")
    return (df.where(F.col(id_col).isNotNull())
              .groupBy(*group_cols)
              .agg(F.max_by(F.col(id_col), num).alias(id_col)))


def latest_report_id(catalogue: DataFrame, name: str) -> str:
    """G1 + F2 + V6 for one report name; raises when none matches (Q20).

    The catalogue holds one row per published report; only one value
    comes back to the driver.
    """
    row = latest_by_numeric_id(catalogue.where(F.col("name") == name)).first()
    if row is None:
        raise LookupError(f"no report named {name!r} in the catalogue")
    return row["id"]


def last_match(df: DataFrame, group_cols: Sequence[str], value_col: str,
               position_col: str) -> DataFrame:
    """The value at the greatest position per group (a loop that keeps
    overwriting leaves the last match)."""
    return (df.groupBy(*group_cols)
              .agg(F.max_by(F.col(value_col), F.col(position_col)).alias(value_col)))


def template_id(templates: DataFrame, name: str) -> str:
    """S3 + F2 + G2: id of the last template item with this name (a loop
    that keeps overwriting leaves the last one); raises when none (Q20)."""
    row = last_match(templates.where(F.col("name") == name), ["name"], "id", "pos").first()
    if row is None:
        raise LookupError(f"no template named {name!r}")
    return row["id"]
