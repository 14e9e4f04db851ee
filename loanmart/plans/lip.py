"""Loans-in-process reports, two source systems combined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmart.functions.dates import pacific_stamp, try_parse_timestamp
from loanmart.functions.numbers import to_number
from loanmart.functions.text import null_token_to_null, recode, strip_quotes
from loanmart.operators.combine import rename, union_all_by_name
from loanmart.operators.ordering import sort_nulls_last

# Columns kept from system A (in-process report).
A_COLUMNS = (
    "LOAN_NUMBER", "TBD", "NOTES", "BORROWER_FIRST_NAME", "BORROWER_LAST_NAME", "STREET", "STATE",
    "CLOSING_DATE", "LOCK_EXPIRATION", "LOAN_AMOUNT", "NOTE_RATE", "POINTS",
    "WIRE_AMOUNT", "LO_BROKER", "BP_DOC_REVIEW", "APPROVED", "CLEAR_TO_CLOSE",
    "APPRAISAL_ORDERED", "APPRAISAL_DUE", "APPRAISAL_EXPIRATION", "TITLE_ORDERED",
    "TITLE_RECEIVED", "DOCS_OUT", "SIGNING_APPOINTMENT", "FUND", "LOAN_TYPE", "CLOSING_LIKELIHOOD", "OCCUPANCY",
    "LIEN_POSITION", "LOAN_TERM",
)
# System B names renamed to system A names.
B_RENAMES = {
    "TOTAL_LOAN_AMOUNT": "LOAN_AMOUNT", "TITLE_ORDERED_DATE": "TITLE_ORDERED", "EST_CLOSING_DATE": "CLOSING_DATE",
    "SUBJECT_PROPERTY_ADDRESS": "STREET", "LGC_FUND_SOURCE": "FUND", "LOAN_PROGRAM": "LOAN_TYPE",
    "LOAN_OFFICER": "LO_BROKER", "TITLE_DOC_RECEIVED_DATE": "TITLE_RECEIVED",
    "LOCK_EXPIRATION_DATE": "LOCK_EXPIRATION", "ORIGINATION_CHARGE": "POINTS", "APPRAISAL_ORDERED_DATE": "APPRAISAL_ORDERED",
    "APPRAISAL_ESTIMATED_DUE_DATE": "APPRAISAL_DUE", "SUBJECT_PROPERTY_STATE": "STATE",
    "UNDERWRITING_APPROVAL_DATE": "APPROVED", "UNDERWRITING_CLEAR_TO_CLOSE_DATE": "CLEAR_TO_CLOSE",
    "TOTAL_WIRE_TRANSFER": "WIRE_AMOUNT", "UNDERWRITING_APPRAISAL_EXPIRED_DATE": "APPRAISAL_EXPIRATION",
}
# Columns kept from system B after the renames.
B_COLUMNS = (
    "LOAN_NUMBER", "BORROWER_FIRST_NAME", "BORROWER_LAST_NAME", "NOTE_RATE", "LOAN_AMOUNT", "CLOSING_DATE", "STREET",
    "LIEN_POSITION", "FUND", "LOAN_TYPE", "LO_BROKER", "TITLE_ORDERED", "TITLE_RECEIVED", "LOCK_EXPIRATION", "POINTS",
    "APPRAISAL_ORDERED", "APPRAISAL_DUE", "STATE", "APPROVED", "CLEAR_TO_CLOSE", "WIRE_AMOUNT",
    "APPRAISAL_EXPIRATION", "CLOSING_LIKELIHOOD", "OCCUPANCY", "LOAN_TERM",
)
# Columns parsed as dates (LOCK_EXPIRATION, APPROVED and
# CLEAR_TO_CLOSE stay as delivered, Q8).
DATE_COLUMNS = ("CLOSING_DATE", "BP_DOC_REVIEW", "APPRAISAL_ORDERED", "APPRAISAL_DUE", "APPRAISAL_EXPIRATION",
                "TITLE_ORDERED", "TITLE_RECEIVED", "DOCS_OUT", "SIGNING_APPOINTMENT")
# Columns parsed as numbers.
NUMERIC_COLUMNS = ("LOAN_AMOUNT", "POINTS", "WIRE_AMOUNT", "NOTE_RATE")
# Output columns in their order; the date column of the funded report.
OUTPUT_ORDER = (
    "LOAN_NUMBER", "TBD", "NOTES", "BORROWER_FIRST_NAME", "BORROWER_LAST_NAME", "STREET", "STATE",
    "CLOSING_DATE", "CLOSING_LIKELIHOOD", "LOCK_EXPIRATION", "LOAN_AMOUNT", "NOTE_RATE", "POINTS", "WIRE_AMOUNT",
    "LO_BROKER", "BP_DOC_REVIEW", "APPROVED", "CLEAR_TO_CLOSE", "APPRAISAL_ORDERED", "APPRAISAL_DUE",
    "APPRAISAL_EXPIRATION", "TITLE_ORDERED", "TITLE_RECEIVED", "DOCS_OUT", "SIGNING_APPOINTMENT",
    "FUND", "LOAN_TYPE", "OCCUPANCY", "LIEN_POSITION", "LOAN_TERM",
)
FUNDED = "FUNDED_DATE"
# Recode and sort keys.
LIEN_RECODE = {"First Lien": "First"}
SORT_KEYS = ("CLOSING_DATE", "FUND")
# Date texts accepted by the coercing parse (Q7: an explicit list).
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "M/d/yyyy", "M/d/yyyy H:mm")


def _as_timestamp(df: DataFrame, c: str) -> Column:
    dtype = df.schema[c].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col(c).cast("timestamp_ntz")
    return try_parse_timestamp(F.col(c).cast("string"), DATE_FORMATS)


def combine_lip(system_a: DataFrame, system_b: DataFrame, as_of=None, funded: bool = False,
                sort: bool = True, date_formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """R8 (``funded`` False) / R9 (True).

    prune A (P5) | rename + prune B (P3, P5) -> union by name, B's missing
    columns null (U1) -> [R9: strip quotes, C15] -> dates coerced (D3) ->
    lien recode (C12) -> upper loan number (C13) -> order (P6) -> stamp (P12)
    -> 'null' text to null (C11) -> numbers coerced (C7), in the order of O1.
    Every step is a Project over a narrow union; only the sort shuffles.
    """
    a_cols = list(A_COLUMNS) + ([FUNDED] if funded else [])
    b_cols = list(B_COLUMNS) + ([FUNDED] if funded else [])
    dates = ((FUNDED,) if funded else ()) + DATE_COLUMNS
    order = list(OUTPUT_ORDER)
    if funded:
        order.insert(order.index("CLOSING_DATE"), FUNDED)
    u = union_all_by_name([system_a.select(*a_cols), rename(system_b, B_RENAMES).select(*b_cols)])
    string_cols = {f.name for f in u.schema.fields if isinstance(f.dataType, T.StringType)}

    def step(c: str) -> Column:
        x = F.col(c)
        if funded and c in string_cols:
            x = strip_quotes(x)
        if c in dates:
            typed = _as_timestamp(u, c) if c not in string_cols else try_parse_timestamp(x, date_formats)
            return typed.alias(c)
        if c == "LIEN_POSITION":
            x = recode(x, LIEN_RECODE)
        if c == "LOAN_NUMBER":
            x = F.upper(x)
        if c in string_cols:
            x = null_token_to_null(x)
        if c in NUMERIC_COLUMNS:
            x = to_number(x)
        return x.alias(c)

    parsed = {}
    if sort:
        # Rows are sorted as delivered, by their two parsed keys: the sampling of
        # the sort reads its input once more, and behind it all tasks share the rest.
        parsed = {c: F.col(f"_{c}").alias(c) for c in SORT_KEYS}
        u = sort_nulls_last(u.select("*", *[step(c).alias(f"_{c}") for c in SORT_KEYS]), [f"_{c}" for c in SORT_KEYS])
    cols = [parsed[c] if c in parsed else step(c) for c in order]
    if as_of is not None:
        cols.append(pacific_stamp(as_of).alias("timestamp"))
    return u.select(*cols)
