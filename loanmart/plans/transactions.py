"""Transactions of all accounts over the last two months."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.functions.dates import pacific_stamp, reformat_date
from loanmart.operators.combine import select_existing
from loanmart.operators.validate import require_columns
from loanmart.sources.documents import TRANSACTION_FIELDS

MONTHS_BACK = 2


def window_bounds(as_of: _dt.date, months: int = MONTHS_BACK):
    """[as_of - months, as_of] as Spark date literals (month-end clamp)."""
    day = as_of.date() if isinstance(as_of, _dt.datetime) else as_of
    d = F.lit(day.isoformat()).cast("date")
    return F.add_months(d, -months), d


def transaction_report(accounts: DataFrame, transactions: DataFrame, as_of) -> DataFrame:
    """S5 ids (F11) drive which account documents count (J8: semi-join);
    keep the listed fields that exist (P7, P8), created date in the window
    (F13), dates as MM/dd/yy text (C16, D5), stamp (P12).  The account set is
    small and distinct, so AQE broadcasts it; no per-account loop."""
    lo, hi = window_bounds(as_of)
    ids = accounts.where(F.col("id").isNotNull()).select(F.col("id").cast("string").alias("account_id")).distinct()
    require_columns(transactions, ["account_id", "transactionCreatedDate"])
    tx = transactions.join(ids, "account_id", "left_semi")
    created = F.to_date(F.substring("transactionCreatedDate", 1, 10), "yyyy-MM-dd")
    kept = select_existing(tx.where(created.between(lo, hi)), TRANSACTION_FIELDS)
    dates = {c: reformat_date(c) for c in kept.columns if c.endswith("Date")}
    return kept.withColumns(dates).withColumn("timestamp", pacific_stamp(as_of))
