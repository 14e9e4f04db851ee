"""Checks (V1-V5).  Each is one bounded action that raises with a clear
message; none brings rows of the data to the driver beyond one example.

V2, V5 and the counts of R13 have a second form that costs no pass of its own:
metrics that Spark gathers while another action, a write, runs over the frame
(``observed_nulls``, ``observed_errors``), looked at afterwards.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from loanmart.operators.upsert import assert_unique  # noqa: F401  (V3)


class ValidationError(ValueError):
    pass


def require_columns(df: DataFrame, cols: Sequence[str]) -> None:
    """V1: schema check, no job."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValidationError(f"missing required columns: {missing}")


def null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """V2: ``(column, nulls)`` of the listed columns that hold nulls, counted in one pass."""
    counts = df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit(0)).alias("nulls")) for c in cols])
    return counts.select(F.inline(pairs)).where(F.col("nulls") > 0)


def assert_not_null(df: DataFrame, cols: Sequence[str]) -> None:
    """V2: raise when a listed column holds nulls."""
    bad = {r["column"]: r["nulls"] for r in null_violations(df, cols).collect()}
    if bad:
        raise ValidationError(f"null values in NOT NULL columns: {bad}")


def incomplete_pages(pages: DataFrame, group_cols: Sequence[str] = (), content_col: str = "content",
                     total_col: str = "metadata.pagination.total") -> DataFrame:
    """V4: groups (e.g. companies) whose items over all landed pages differ
    from the advertised total.  Sums of page sizes only: no items are gathered."""
    sizes = (pages.groupBy(*group_cols)
             .agg(F.sum(F.coalesce(F.size(F.col(content_col)), F.lit(0))).alias("got"), F.max(F.col(total_col)).alias("want")))
    return sizes.where(F.col("want").isNotNull() & ~F.col("got").eqNullSafe(F.col("want")))


def assert_pages_complete(pages: DataFrame, group_cols: Sequence[str] = (), **kw) -> None:
    """V4: raise when a group's pages are not all there."""
    bad = incomplete_pages(pages, group_cols, **kw).limit(1).collect()
    if bad:
        raise ValidationError(f"incomplete page set: {bad[0].asDict()}")


def error_documents(docs: DataFrame, error_col: str = "error", description_col: str = "error_description") -> DataFrame:
    """V5: error and description of landed error documents."""
    return docs.where(F.col(error_col).isNotNull()).select(error_col, description_col)


def assert_no_error_documents(docs: DataFrame, error_col: str = "error",
                              description_col: str = "error_description") -> None:
    """V5: fail on any landed error document."""
    bad = error_documents(docs, error_col, description_col).limit(1).collect()
    if bad:
        raise ValidationError(f"error document landed: {bad[0].asDict()}")


def assert_sound_documents(docs: DataFrame, group_cols: Sequence[str] | None = None, total_col: str = "metadata.pagination.total") -> None:
    """V5 and, with ``group_cols``, V4 in one pass over the landed documents."""
    group = list(group_cols or ())
    aggs = [F.count("error").alias("errors"), F.max("error").alias("error")]
    if group_cols is not None:
        aggs += [F.sum(F.coalesce(F.size("content"), F.lit(0))).alias("got"), F.max(total_col).alias("want")]
    sums = docs.groupBy(*group).agg(*aggs)
    wrong = F.col("errors") > 0
    if group_cols is not None:
        wrong = wrong | (F.col("want").isNotNull() & ~F.col("got").eqNullSafe(F.col("want")))
    bad = sums.where(wrong).limit(1).collect()
    if bad:
        raise ValidationError(f"{'error document landed' if bad[0]['errors'] else 'incomplete page set'}: {bad[0].asDict()}")


# ------------------------------------------------ checks of the writing pass --
@dataclass
class Observed:
    """Metrics of a frame, there once an action has run over it."""
    metrics: Observation

    @property
    def values(self) -> dict:
        return self.metrics.get

    @property
    def rows(self) -> int:
        return self.values["rows"]

    def nulls(self) -> dict[str, int]:
        """Nulls of every watched column that has some."""
        return {c.removeprefix("nulls_"): n for c, n in self.values.items() if c.startswith("nulls_") and n}

    def assert_not_null(self) -> None:
        """V2 without another read."""
        if self.nulls():
            raise ValidationError(f"null values in NOT NULL columns: {self.nulls()}")

    def assert_no_errors(self) -> None:
        """V5 without another read."""
        if self.values["errors"]:
            raise ValidationError(f"error document landed: {self.values}")


def observed_nulls(df: DataFrame, cols: Sequence[str] | None = None, counted: Column | None = None) -> tuple[DataFrame, Observed]:
    """The same frame, and its rows and nulls by column (all, or ``cols``) once
    an action has run: G5, G6 and V2.  ``counted`` leaves rows out of both."""
    counted = F.lit(True) if counted is None else counted
    metrics = [F.count_if(counted).alias("rows"), *[F.count_if(counted & F.col(f"`{c}`").isNull()).alias(f"nulls_{c}") for c in (df.columns if cols is None else cols)]]
    watch = Observation(f"nulls-{uuid.uuid4().hex}")
    return df.observe(watch, *metrics), Observed(watch)


def observed_errors(docs: DataFrame, error_col: str = "error", description_col: str = "error_description") -> tuple[DataFrame, Observed]:
    """The same documents, and their error documents once an action has run: V5."""
    watch = Observation(f"errors-{uuid.uuid4().hex}")
    metrics = [F.count(F.lit(1)).alias("rows"), F.count(error_col).alias("errors"), F.max(F.concat_ws(": ", error_col, description_col)).alias("example")]
    return docs.observe(watch, *metrics), Observed(watch)
