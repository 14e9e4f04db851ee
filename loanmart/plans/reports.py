"""Report specs R1-R6 and the report extract plan.

Column lists are the reports' headings (fixed values of the source
documents); the cleaning rules per report follow SURVEY §2.10.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmart.functions.text import MONEY_CHARS
from loanmart.operators.latest import latest_report_id
from loanmart.operators.nested import nested_get
from loanmart.plans.headings import BUILDERS_RISK_RENAME
from loanmart.plans.spec import ReportSpec, apply_spec
from loanmart.sources.documents import read_report_document

# Headings of the cash status report.
_CASH_MONEY = (
    "Collateral Holdback", "Appraised Value", "As Permitted Property Value", "Current Loan Amount",
    "Total Principal Loan Paydown", "Total Interest Reserve Amount Disbursed", "Interest Reserve Balance",
    "Loan amount Disbursed excluding Interest Reserve", "Balance to finish Including Retainage",
    "Loan Amount Disbursed",
)
_CASH_PERCENT = ("LTV", "CLTV", "LTC", "As Permitted LTV", "As Permitted CLTV", "Current Interest Rate", "% DISB")
_CASH_TEXT = (
    "Loan Number", "Borrower Last Name", "Property Address", "Loan Program", "Loan Term in Months",
    "Loan Originator", "Total Units", "County", "City", "Investor", "Outside Equity",
    "State", "Zip", "Exception", "Additional Collateral Property", "Funding Account",
)
_CASH_DATES = ("Loan Funded Date", "Original Loan Due Date", "Current Loan Due Date",
               "Builders Risk Insurance Expiration")

CASH_STATUS = ReportSpec(
    name="Capital Cash Status -  Combined",
    pre_renames=BUILDERS_RISK_RENAME,
    clean=_CASH_MONEY + _CASH_PERCENT,
    text=_CASH_TEXT,
    timestamps=_CASH_DATES,
    decimals=_CASH_MONEY + _CASH_PERCENT,
    decimal_scale=4,
)

# Headings of the maturity dates report (R2).
MATURITY_DATES = ReportSpec(
    name="Maturity Dates",
    text=("Loan Number", "Borrower", "Property Address", "Loan Program", "Pinned Note"),
    timestamps=("Loan Funded Date", "Current Loan Due Date"),
)

# Headings of the watchlist report.
_WATCH_CLEAN = (
    "Loan Originator", "Loan Number", "Borrower Full Name", "Co-Borrower 1 Full Name", "Property Address",
    "City", "Investor", "Loan Program", "Loan Term in Months", "Current Loan Amount",
    "Loan amount Disbursed excluding Interest Reserve", "Total Principal Loan Paydown",
    "Balance to finish Including Retainage", "% DISB", "Total Units", "Last Inspection Complete",
    "Pinned Note", "Labels",
)
WATCHLIST = ReportSpec(
    name="Watchlist Report",
    clean=_WATCH_CLEAN,
    text=("Borrower Full Name", "Loan Number", "Loan Originator", "Co-Borrower 1 Full Name", "Property Address",
          "Loan Program", "Loan Term in Months", "Pinned Note", "Total Units", "City", "Investor", "Labels"),
    timestamps=("Loan Funded Date", "Estimated Payoff Date", "Current Loan Due Date", "Original Loan Due Date"),
    decimals=("Current Loan Amount", "Total Principal Loan Paydown",
              "Loan amount Disbursed excluding Interest Reserve", "Balance to finish Including Retainage",
              "Last Inspection Complete", "% DISB"),
    decimal_scale=None,
)

# Headings of the full-population portfolio report.
_PORT_TEXT = (
    "Borrower Last Name", "Loan Number", "Loan Originator", "Property Address", "Loan Program",
    "Loan Term in Months", "Total Units", "Investor", "County", "Exception", "State", "Current Loan Status",
    "Additional Collateral Property", "Funding Account", "Outside Equity", "Zip",
)
_PORT_PERCENT = ("% DISB", "LTV", "CLTV", "LTC", "As Permitted LTV", "As Permitted CLTV", "Current Interest Rate")
_PORT_MONEY = (
    "Current Loan Amount", "Total Principal Loan Paydown", "Balance to finish Including Retainage",
    "Appraised Value", "Total Interest Reserve Amount Disbursed", "Interest Reserve Balance",
    "Collateral Holdback", "As Permitted Property Value",
)
PORTFOLIO_FULL = ReportSpec(
    name="Portfolio Report Full Population",
    clean=_PORT_TEXT + _PORT_PERCENT + _PORT_MONEY,
    text=_PORT_TEXT,
    timestamps=("Loan Funded Date", "Current Loan Due Date", "Original Loan Due Date"),
    dates=("Loan Status Completed Date (Most Recent Change)",),
    decimals=_PORT_MONEY + _PORT_PERCENT,
    decimal_scale=None,
)

# Headings of the investor portfolio report.
INVESTOR_PORTFOLIO = ReportSpec(
    name="Umpqua Portfolio Report",
    pre_renames=BUILDERS_RISK_RENAME,
    clean=("Loan Number", "Borrower", "Property Address", "State", "Total Units", "Funding Account", "Investor",
           "Current Loan Amount", "Loan Amount Disbursed", "Appraised Value", "Calculated LTV", "Loan Program"),
    strip_chars=MONEY_CHARS,
    text=("Loan Number", "Borrower", "Property Address", "State", "Total Units", "Funding Account", "Investor",
          "Loan Program"),
    timestamps=("Loan Funded Date", "Current Loan Due Date"),
    decimals=("Calculated LTV", "Loan Amount Disbursed", "Appraised Value"),
    decimal_scale=4,
)

# Headings of the loan-id list.
LOAN_IDS = ReportSpec(
    name="AccountingAllActiveLoans",
    clean=("Land Gorilla Loan ID", "First Name", "Last Name / Business"),
    text=("Land Gorilla Loan ID", "First Name", "Last Name / Business"),
)

REPORTS = {s.name: s for s in (CASH_STATUS, MATURITY_DATES, WATCHLIST, PORTFOLIO_FULL, INVESTOR_PORTFOLIO)}


def report_extract(spark: SparkSession, catalogue: DataFrame, documents_root: str,
                   spec: ReportSpec, as_of, lines: bool = False, listed_only: bool = False) -> DataFrame:
    """Newest report of ``spec.name`` (G1, V6) -> S1 scan -> spec.

    The catalogue is tiny (one row per published report); picking the id is
    the only driver-side value.  Columns beyond the report's own pass through,
    for which the documents are read once more; with ``listed_only`` they are
    left out, and one scan is all.
    """
    path = f"{documents_root}/{latest_report_id(catalogue, spec.name)}"
    if not listed_only:
        return apply_spec(read_report_document(spark, path, lines=lines), spec, as_of)
    renamed = {new: old for old, new in spec.pre_renames.items()}
    return apply_spec(read_report_document(spark, path, [renamed.get(c, c) for c in spec.required()], lines), spec, as_of)


def loan_id_report(loan_items: DataFrame, as_of=None) -> DataFrame:
    """Active-loan items (S4) -> flat headings with '' for a missing
    borrower part (P9) -> LOAN_IDS spec (F1, C1, C8, P1) + stamp (P12)."""
    landed = loan_items.select(
        F.col("id").cast("string").alias("Land Gorilla Loan ID"),
        F.col("fileNumber").alias("Loan Number"),
        nested_get("borrower.firstName", "").alias("First Name"),
        nested_get("borrower.lastName", "").alias("Last Name / Business"))
    return apply_spec(landed, LOAN_IDS, as_of)
