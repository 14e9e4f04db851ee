"""Draw report (R10, E3): one day of webhook runs -> de-duplicated events ->
loan numbers -> draw items."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from loanmart.functions.dates import pacific_stamp, ts_literal, utc_wall_clock
from loanmart.operators.dedupe import keep_first
from loanmart.operators.joins import semi_join
from loanmart.operators.nested import flatten_draws
from loanmart.operators.validate import require_columns

EVENT_KEYS = ("draw_id", "loan_id", "updated_status")
FAILED = "FAILED"


def day_before(as_of: _dt.datetime | _dt.date):
    """F5 (Q23): the whole previous UTC day as a half-open range."""
    d = as_of.date() if isinstance(as_of, _dt.datetime) else as_of
    start = _dt.datetime.combine(d - _dt.timedelta(days=1), _dt.time())
    return start, start + _dt.timedelta(days=1)


def runs_of_day(runs: DataFrame, as_of, flow_ids: Sequence[str] | None = None,
                time_col: str = "start_time", flow_col: str = "flow_id") -> DataFrame:
    """S7 + F4 + F5 + F6: runs that started the day before ``as_of``, not
    FAILED (null state kept), of the given flows.  All three are plain
    predicates, pushed into the scan; of a history landed by day only that
    day's folder is read."""
    lo, hi = day_before(as_of)
    if "day" in runs.columns:
        runs = runs.where(F.col("day") == F.lit(lo.date().isoformat()).cast("date"))
    t = F.col(time_col)
    if isinstance(runs.schema[time_col].dataType, T.TimestampType):
        t = utc_wall_clock(t)          # zoned instants -> UTC day, any session zone
    out = runs.where((t >= ts_literal(lo)) & (t < ts_literal(hi)))
    if "state_type" in runs.columns:
        out = out.where(~F.col("state_type").eqNullSafe(F.lit(FAILED)))
    if flow_ids:
        out = out.where(F.col(flow_col).isin(list(flow_ids)))
    return out


def draw_events(runs: DataFrame, as_of, run_id: str = "id", **kw) -> DataFrame:
    """S8 + V1 + G3: parameters of the day's runs, one row per
    (draw, loan, status), the newest run winning (the history is read
    newest first)."""
    day = runs_of_day(runs, as_of, **kw)
    require_columns(day, ["loan_id"])
    params = day.select(F.col(run_id).alias("_run"), *EVENT_KEYS)
    return keep_first(params, EVENT_KEYS, "_run").drop("_run")


def draw_report(runs: DataFrame, loan_fields: DataFrame, draws: DataFrame | Callable[[DataFrame], DataFrame], as_of,
                run_id: str = "id", **kw) -> DataFrame:
    """Events ⟕ loans (J1) -> listed columns + stamp (P7, P12) ->
    draws of those events only (J8) flattened (N1-N4) -> ⟕ on draw id as
    text (J2, Q11).  ``draws`` may be a function from the wanted ``(id)`` to
    their documents, so that what they are made of can be narrowed first.

    Rows per draw id are bounded on both sides of J2: the events are
    de-duplicated to one row per (draw, loan, status) and the items of a
    draw come from one landed document.  A plain left join therefore
    suffices (AQE may still split a large left partition); the right side
    is computed once."""
    events = draw_events(runs, as_of, run_id=run_id, **kw)
    loans = loan_fields.select(F.col("loan_id"), F.col("loanNumber")).where(F.col("loan_id").isNotNull())
    merged = (events.join(loans, "loan_id", "left")
                    .select(F.col("draw_id").cast("string").alias("draw_id"), "loan_id", "updated_status",
                            "loanNumber", pacific_stamp(as_of).alias("timestamp")))
    ids = merged.select(F.col("draw_id").alias("id")).where("id IS NOT NULL").distinct()
    if callable(draws):
        wanted = draws(ids)
    else:
        wanted = semi_join(draws.withColumn("id", F.col("id").cast("string")), ids, ["id"])
    return merged.join(flatten_draws(wanted), "draw_id", "left")


def runs_of_days(runs: DataFrame, days: DataFrame) -> DataFrame:
    """The runs of the ``day``s of another frame, of a history landed by
    day.  The days reach the scan at run time and prune its folders."""
    return runs.join(days.select("day").distinct(), "day", "left_semi")
