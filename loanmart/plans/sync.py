"""Core-value synchronization (R11): warehouse rows -> PATCH bodies for
loans that already have core values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.operators.combine import rename_positional
from loanmart.operators.joins import semi_join
from loanmart.sources.sinks import patch_bodies

# Positional names of the core-value columns.
CORE_VALUE_COLUMNS = ("lg_loan_id", "lg_loan_number", "coreSystemLoanId", "coreSystemName",
                      "coreSystemLoanAmount", "coreSystemLoanBalance", "coreSystemLoanBalanceLastUpdated")


def core_values(raw: DataFrame) -> DataFrame:
    """S15 + P4 + C8: rename by position, every value as text (null stays
    null, Q1)."""
    named = rename_positional(raw, CORE_VALUE_COLUMNS)
    return named.select(*[F.col(c).cast("string").alias(c) for c in CORE_VALUE_COLUMNS])


def core_value_patches(raw: DataFrame, existing: DataFrame) -> DataFrame:
    """J4 + P15 + K9: one (target_id, body) row per core-value row whose
    loan already has values (``existing`` has ``lg_loan_id``)."""
    cv = semi_join(core_values(raw), existing, ["lg_loan_id"])
    return patch_bodies(cv, "lg_loan_id")
