"""Queries over the driver's tables that exercise the library end to end.

Each query renders driver rows into the shape the loan reports land in
(money as '$ 1,234.50' text, dates as MM/dd/yyyy text, totals rows, nested
documents, ...) *inside Spark*, then runs the library's operators on it.
Its oracle (``ORACLE_SQL``) computes the expected typed result straight from
the plain columns in DuckDB.  ``as_of`` is always a literal.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmart.functions.dates import try_parse_timestamp
from loanmart.functions.numbers import to_decimal_exact, to_number
from loanmart.functions.text import blank_to_null
from loanmart.operators.dedupe import keep_first
from loanmart.operators.latest import last_match, latest_by_numeric_id
from loanmart.operators.ordering import top_k_by
from loanmart.operators.profile import extract_profile
from loanmart.operators.upsert import upsert
from loanmart.plans.alerts import BUILDERS_RISK, FLOOD, HOMEOWNERS, MATURITY, expiring_cases
from loanmart.plans.draws import draw_report
from loanmart.plans.lip import combine_lip
from loanmart.plans.payroll import companies, email_addresses, workers
from loanmart.plans.sync import core_value_patches
from loanmart.plans.transactions import transaction_report
from loanmart.operators.nested import flatten_draws
from loanmart.operators.validate import assert_sound_documents
from loanmart.streaming.draw_events import new_cases
from loanmart.functions.text import case_hash, has_label
from loanmart.functions.dates import STAMP_FORMAT, utc_to_pacific
from loanmart.operators.surrogate import add_surrogate_key
from loanmart.plans.reports import MATURITY_DATES
from loanmart.session import scratch_path
from loanmart.sources.sinks import prepare_append, read_csv_report, report_path, write_csv
from loanmart.streaming.case_messages import broken_messages, case_fields, case_mail
from loanmart.streaming.draw_events import CASE_OUTBOX, DRAW_CREATE, DRAW_SUBMIT, MAIL_OUTBOX, process_batch, start_draw_event_stream
from loanmart.streaming.outbox import read_outbox
from loanmart.plans.reports import CASH_STATUS, INVESTOR_PORTFOLIO, WATCHLIST
from loanmart.plans.spec import apply_spec
from loanmart.sources.tables import table

# Fixed value: the load time used by every stamped query (UTC).
AS_OF = _dt.datetime(2024, 1, 15, 12, 0, 0)
AS_OF_PACIFIC_TEXT = "2024-01-15T04:00:00"

# ---------------------------------------------------------------- Q-01 ----
# Landed form of the cash status report built from ``orders``: (heading,
# Spark SQL text expression).  Money columns are multiples of the order
# price, percent columns are fractions of it, so rounding ties occur.
_Q01_MONEY = [(h, k) for k, h in enumerate((
    "Collateral Holdback", "Appraised Value", "As Permitted Property Value", "Current Loan Amount",
    "Total Principal Loan Paydown", "Total Interest Reserve Amount Disbursed", "Interest Reserve Balance",
    "Loan amount Disbursed excluding Interest Reserve", "Balance to finish Including Retainage",
    "Loan Amount Disbursed"), start=1)]
_Q01_PERCENT = [("LTV", "0.0001"), ("CLTV", "0.00001"), ("LTC", "0.001"), ("As Permitted LTV", "0.00002"),
                ("As Permitted CLTV", "0.000003"), ("Current Interest Rate", "0.0000005"), ("% DISB", "0.00005")]
_Q01_TEXT = [
    ("Loan Number", "concat('LN-', o_orderkey)"),
    ("Borrower Last Name", "concat('Customer ', o_custkey)"),
    ("Property Address", "concat(o_orderkey, ' Oak St')"),
    ("Loan Program", "o_orderpriority"),
    ("Loan Term in Months", "cast(o_custkey as string)"),
    ("Loan Originator", "o_orderstatus"),
    ("Total Units", "'1'"),
    ("County", "CASE WHEN o_orderstatus = 'F' THEN NULL ELSE 'King' END"),
    ("City", "'Seattle'"),
    ("Investor", "o_orderpriority"),
    ("Outside Equity", "''"),
    ("State", "'WA'"),
    ("Zip", "'98101'"),
    ("Exception", "CASE WHEN o_orderstatus = 'P' THEN 'yes' END"),
    ("Additional Collateral Property", "NULL"),
    ("Funding Account", "concat('FA-', o_custkey)"),
]
_Q01_DATES = [
    ("Loan Funded Date", "date_format(o_orderdate, 'MM/dd/yyyy')", "o_orderdate"),
    ("Original Loan Due Date", "date_format(add_months(o_orderdate, 12), 'MM/dd/yyyy')",
     "CAST(o_orderdate + INTERVAL 12 MONTH AS TIMESTAMP)"),
    ("Current Loan Due Date", "date_format(date_add(o_orderdate, 365), 'M/d/yyyy')",
     "CAST(o_orderdate + INTERVAL 365 DAY AS TIMESTAMP)"),
    ("Builder's Risk Insurance Expiration",
     "CASE WHEN o_orderstatus = 'O' THEN '' ELSE date_format(date_add(o_orderdate, 180), 'MM/dd/yyyy') END",
     "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate + INTERVAL 180 DAY AS TIMESTAMP) END"),
]


def _money_text(k: int) -> str:
    return f"concat('$ ', format_number(CAST(o_totalprice AS DECIMAL(18,2)) * {k}, 2))"


def _percent_text(f: str) -> str:
    return f"concat(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * {f} AS STRING), ' %')"


def landed_cash_status(orders: DataFrame) -> DataFrame:
    """Orders as a landed cash-status report: one row per order plus one
    totals row (null Loan Number) per order priority."""
    cols = ([F.expr(e).cast("string").alias(h) for h, e in _Q01_TEXT]
            + [F.expr(_money_text(k)).alias(h) for h, k in _Q01_MONEY]
            + [F.expr(_percent_text(f)).alias(h) for h, f in _Q01_PERCENT]
            + [F.expr(e).alias(h) for h, e, _ in _Q01_DATES])
    rows = orders.select(*cols)
    totals = (orders.groupBy("o_orderpriority")
              .agg(*[F.concat(F.lit("$ "), F.format_number(F.sum(F.col("o_totalprice").cast("decimal(18,2)") * k), 2))
                     .alias(h) for h, k in _Q01_MONEY]))
    return rows.unionByName(totals.drop("o_orderpriority"), allowMissingColumns=True)


def q01_cash_status_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_spec(landed_cash_status(table(spark, sf_dir, "orders")), CASH_STATUS, AS_OF)


# The output column of each heading, written out for the oracle.
_Q01_NAMES = {
    "Collateral Holdback": "collateral_holdback", "Appraised Value": "appraised_value",
    "As Permitted Property Value": "as_permitted_property_value", "Current Loan Amount": "current_loan_amount",
    "Total Principal Loan Paydown": "total_principal_loan_paydown",
    "Total Interest Reserve Amount Disbursed": "total_interest_reserve_amount_disbursed",
    "Interest Reserve Balance": "interest_reserve_balance",
    "Loan amount Disbursed excluding Interest Reserve": "loan_amount_disbursed_excluding_interest_reserve",
    "Balance to finish Including Retainage": "balance_to_finish_including_retainage",
    "Loan Amount Disbursed": "loan_amount_disbursed", "LTV": "ltv", "CLTV": "cltv", "LTC": "ltc",
    "As Permitted LTV": "as_permitted_ltv", "As Permitted CLTV": "as_permitted_cltv",
    "Current Interest Rate": "current_interest_rate", "% DISB": "%_disb", "Loan Number": "loan_number",
    "Borrower Last Name": "borrower_last_name", "Property Address": "property_address", "Loan Program": "loan_program",
    "Loan Term in Months": "loan_term_in_months", "Loan Originator": "loan_originator", "Total Units": "total_units",
    "County": "county", "City": "city", "Investor": "investor", "Outside Equity": "outside_equity", "State": "state",
    "Zip": "zip", "Exception": "exception", "Additional Collateral Property": "additional_collateral_property",
    "Funding Account": "funding_account", "Loan Funded Date": "loan_funded_date",
    "Original Loan Due Date": "original_loan_due_date", "Current Loan Due Date": "current_loan_due_date",
    "Builder's Risk Insurance Expiration": "builders_risk_insurance_expiration"}


def _q01_sql() -> str:
    def out(h):
        return '"' + _Q01_NAMES[h] + '"'
    sel = []
    for h, e in _Q01_TEXT:
        e = e.replace("concat('LN-', o_orderkey)", "'LN-' || o_orderkey") \
             .replace("cast(o_custkey as string)", "CAST(o_custkey AS VARCHAR)")
        sel.append(f"CAST({e} AS VARCHAR) AS {out(h)}")
    for h, k in _Q01_MONEY:
        sel.append(f"CAST(CAST(o_totalprice AS DECIMAL(18,2)) * {k} AS DECIMAL(25,4)) AS {out(h)}")
    for h, f in _Q01_PERCENT:
        sel.append(f"CAST(round_even(CAST(o_totalprice AS DECIMAL(18,2)) * {f}, 4) AS DECIMAL(25,4)) AS {out(h)}")
    for h, _, d in _Q01_DATES:
        sel.append(f"CAST({d} AS TIMESTAMP) AS {out(h)}")
    sel.append(f"'{AS_OF_PACIFIC_TEXT}' AS \"timestamp\"")
    return "SELECT " + ",\n  ".join(sel) + "\nFROM orders"


# ---------------------------------------------------------------- Q-02 ----
# Watchlist report (R3: blank-removing clean C1, exact decimals C5) landed
# from ``lineitem``.  Q3: blanks and commas vanish from names too.
_Q02_PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
_Q02_NET = f"{_Q02_PRICE} * (1 - CAST(l_discount AS DECIMAL(4,2)))"


def landed_watchlist(lineitem: DataFrame) -> DataFrame:
    e = F.expr
    return lineitem.select(
        e("concat('LN-', l_orderkey, '-', l_linenumber)").alias("Loan Number"),
        e("concat('Supplier ', l_suppkey)").alias("Borrower Full Name"),
        F.lit(None).cast("string").alias("Co-Borrower 1 Full Name"),
        e("l_returnflag").alias("Loan Originator"),
        e("concat(l_partkey, ' Elm St, Unit ', l_linenumber)").alias("Property Address"),
        F.lit("San Jose").alias("City"),
        e("l_linestatus").alias("Investor"),
        F.lit("Fix, Flip").alias("Loan Program"),
        e("CAST(l_linenumber AS STRING)").alias("Loan Term in Months"),
        e(f"concat('$ ', format_number({_Q02_PRICE}, 2))").alias("Current Loan Amount"),
        e("concat('$', format_number(CAST(l_quantity AS DECIMAL(18,2)) * 100, 2))")
        .alias("Loan amount Disbursed excluding Interest Reserve"),
        F.lit("").alias("Total Principal Loan Paydown"),
        e(f"concat(' $ ', CAST({_Q02_NET} AS STRING), ' ')").alias("Balance to finish Including Retainage"),
        e("concat(CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS STRING), ' %')").alias("% DISB"),
        F.lit("1").alias("Total Units"),
        e("concat(CAST(CAST(l_tax AS DECIMAL(4,2)) * 100 AS STRING), '%')").alias("Last Inspection Complete"),
        F.lit("note, ok").alias("Pinned Note"),
        e("concat(l_returnflag, ', ', l_linestatus)").alias("Labels"),
        e("date_format(l_shipdate, 'MM/dd/yyyy')").alias("Loan Funded Date"),
        F.lit("").alias("Estimated Payoff Date"),
        e("date_format(date_add(l_shipdate, 30), 'MM/dd/yyyy')").alias("Current Loan Due Date"),
        e("date_format(date_add(l_shipdate, 30), 'M/d/yyyy')").alias("Original Loan Due Date"),
    )


def q02_exact_decimal_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_spec(landed_watchlist(table(spark, sf_dir, "lineitem")), WATCHLIST, AS_OF)


_Q02_SQL = f"""
SELECT 'LN-' || l_orderkey || '-' || l_linenumber AS loan_number,
  'Supplier' || l_suppkey AS borrower_full_name,
  CAST(NULL AS VARCHAR) AS coborrower_1_full_name,
  l_returnflag AS loan_originator,
  l_partkey || 'ElmStUnit' || l_linenumber AS property_address,
  'SanJose' AS city, l_linestatus AS investor, 'FixFlip' AS loan_program,
  CAST(l_linenumber AS VARCHAR) AS loan_term_in_months,
  CAST({_Q02_PRICE} AS DECIMAL(38,18)) AS current_loan_amount,
  CAST(CAST(l_quantity AS DECIMAL(18,2)) * 100 AS DECIMAL(38,18)) AS loan_amount_disbursed_excluding_interest_reserve,
  CAST(NULL AS DECIMAL(38,18)) AS total_principal_loan_paydown,
  CAST({_Q02_NET} AS DECIMAL(38,18)) AS balance_to_finish_including_retainage,
  CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS DECIMAL(38,18)) AS "%_disb",
  '1' AS total_units,
  CAST(CAST(l_tax AS DECIMAL(4,2)) * 100 AS DECIMAL(38,18)) AS last_inspection_complete,
  'noteok' AS pinned_note,
  l_returnflag || l_linestatus AS labels,
  CAST(l_shipdate AS TIMESTAMP) AS loan_funded_date,
  CAST(NULL AS TIMESTAMP) AS estimated_payoff_date,
  CAST(l_shipdate + INTERVAL 30 DAY AS TIMESTAMP) AS current_loan_due_date,
  CAST(l_shipdate + INTERVAL 30 DAY AS TIMESTAMP) AS original_loan_due_date,
  '{AS_OF_PACIFIC_TEXT}' AS "timestamp"
FROM lineitem"""

# ---------------------------------------------------------------- Q-03 ----
# Investor portfolio (R5: clean without blank removal C2, half-even C4).
# Every amount is a tie at the 5th decimal: n.dddd5 made from the line.
_Q03_TIE = "concat(l_linenumber, '.', lpad(CAST(l_orderkey % 10000 AS STRING), 4, '0'), '5')"
_Q03_TIE_DUCK = "l_linenumber || '.' || lpad(CAST(l_orderkey % 10000 AS VARCHAR), 4, '0') || '5'"


def landed_investor(lineitem: DataFrame) -> DataFrame:
    e = F.expr
    return lineitem.select(
        e("concat('LN-', l_orderkey, '-', l_linenumber)").alias("Loan Number"),
        e("concat('  Supplier ', l_suppkey, ' ')").alias("Borrower"),
        e("concat(l_partkey, ' Elm St')").alias("Property Address"),
        F.lit("OR").alias("State"),
        F.lit("2").alias("Total Units"),
        e("concat('FA,', l_suppkey)").alias("Funding Account"),
        e("l_linestatus").alias("Investor"),
        e("l_returnflag").alias("Loan Program"),
        e("concat('$', format_number(CAST(l_extendedprice AS DECIMAL(18,2)), 2))").alias("Current Loan Amount"),
        e(f"concat('$ ', {_Q03_TIE})").alias("Loan Amount Disbursed"),
        e(f"concat('$', {_Q03_TIE}, ' ')").alias("Appraised Value"),
        e(f"concat({_Q03_TIE}, '%')").alias("Calculated LTV"),
        e("date_format(l_shipdate, 'MM/dd/yyyy')").alias("Loan Funded Date"),
        e("date_format(add_months(l_shipdate, 6), 'MM/dd/yyyy')").alias("Current Loan Due Date"),
        e("CASE WHEN l_returnflag = 'R' THEN '' ELSE date_format(l_shipdate, 'MM/dd/yyyy') END")
        .alias("Builder's Risk Insurance Expiration"),
    )


def q03_half_even_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_spec(landed_investor(table(spark, sf_dir, "lineitem")), INVESTOR_PORTFOLIO)


_Q03_ROUND = f"CAST(round_even(CAST({_Q03_TIE_DUCK} AS DECIMAL(18,5)), 4) AS DECIMAL(25,4))"
_Q03_SQL = f"""
SELECT 'LN-' || l_orderkey || '-' || l_linenumber AS loan_number,
  'Supplier ' || l_suppkey AS borrower,
  l_partkey || ' Elm St' AS property_address,
  'OR' AS state, '2' AS total_units, 'FA' || l_suppkey AS funding_account,
  l_linestatus AS investor, l_returnflag AS loan_program,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS current_loan_amount,
  {_Q03_ROUND} AS loan_amount_disbursed,
  {_Q03_ROUND} AS appraised_value,
  {_Q03_ROUND} AS calculated_ltv,
  CAST(l_shipdate AS TIMESTAMP) AS loan_funded_date,
  CAST(l_shipdate + INTERVAL 6 MONTH AS TIMESTAMP) AS current_loan_due_date,
  CASE WHEN l_returnflag = 'R' THEN '' ELSE strftime(l_shipdate, '%m/%d/%Y') END
    AS builders_risk_insurance_expiration
FROM lineitem"""

# ---------------------------------------------------------------- Q-04 ----
# Bad values to null: exact decimal (C5), number (C7), blank (C9), coerced
# dates with one fixed format (D4) and with a format list (D3).
_Q04_TEXT = """CASE event_type
    WHEN 'view' THEN CAST(CAST(value AS DECIMAL(18,2)) AS STRING)
    WHEN 'click' THEN props
    WHEN 'purchase' THEN ''
    WHEN 'signup' THEN CASE event_id % 3 WHEN 0 THEN 'nan' WHEN 1 THEN 'inf' ELSE '-Infinity' END
    ELSE concat(CAST(CAST(value AS DECIMAL(18,2)) AS STRING), CASE event_id % 3 WHEN 0 THEN 'x' WHEN 1 THEN 'd' ELSE 'f' END) END"""
_Q04_DATE = """CASE event_type
    WHEN 'view' THEN date_format(ts, 'MM/dd/yyyy')
    WHEN 'click' THEN '02/30/2024'
    WHEN 'purchase' THEN ''
    WHEN 'signup' THEN date_format(ts, 'yyyy-MM-dd')
    ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END"""


def q04_bad_values_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select(
        "event_id", F.expr(_Q04_TEXT).alias("raw"), F.expr(_Q04_DATE).alias("raw_date"))
    return ev.select(
        "event_id", "raw",
        to_decimal_exact("raw").alias("exact"),
        to_number("raw").alias("number"),
        blank_to_null("raw").alias("blank_null"),
        try_parse_timestamp("raw_date", ("MM/dd/yyyy",)).alias("fixed_date"),
        try_parse_timestamp("raw_date", ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "M/d/yyyy")).alias("any_date"),
    )


_Q04_SQL = """
WITH t AS (
  SELECT event_id, event_type, ts,
    CASE event_type
      WHEN 'view' THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)
      WHEN 'click' THEN props
      WHEN 'purchase' THEN ''
      WHEN 'signup' THEN CASE event_id % 3 WHEN 0 THEN 'nan' WHEN 1 THEN 'inf' ELSE '-Infinity' END
      ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || CASE event_id % 3 WHEN 0 THEN 'x' WHEN 1 THEN 'd' ELSE 'f' END END AS raw
  FROM events)
SELECT event_id, raw,
  CASE WHEN event_type = 'view' THEN CAST(raw AS DECIMAL(38,18)) END AS exact,
  CASE WHEN event_type = 'view' THEN CAST(raw AS DOUBLE) WHEN event_type = 'signup' AND event_id % 3 = 1 THEN CAST('inf' AS DOUBLE)
    WHEN event_type = 'signup' AND event_id % 3 = 2 THEN CAST('-inf' AS DOUBLE) END AS number,
  NULLIF(raw, '') AS blank_null,
  CASE WHEN event_type = 'view' THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) END AS fixed_date,
  CASE WHEN event_type IN ('view', 'signup') THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
       WHEN event_type = 'error' THEN date_trunc('second', ts) END AS any_date
FROM t"""


# ---------------------------------------------------------------- Q-05 ----
def q05_latest_report_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 on a text-id catalogue (numeric order, not text order) and G2
    (last match by position) per priority."""
    orders = table(spark, sf_dir, "orders")
    catalogue = orders.select(F.col("o_orderkey").cast("string").alias("id"),
                              F.col("o_orderpriority").alias("name"))
    latest = latest_by_numeric_id(catalogue, ["name"])
    last = last_match(orders.withColumnRenamed("o_orderpriority", "name"), ["name"], "o_custkey", "o_orderkey")
    return latest.join(last, "name").select("name", "id", F.col("o_custkey").alias("last_custkey"))


_Q05_SQL = """
SELECT o_orderpriority AS name, CAST(max(o_orderkey) AS VARCHAR) AS id,
       arg_max(o_custkey, o_orderkey) AS last_custkey
FROM orders GROUP BY o_orderpriority"""


# ---------------------------------------------------------------- Q-06 ----
def q06_dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per (user, type), the greatest rank winning; ranks tie
    often and are null for one type, where the other columns decide."""
    events = table(spark, sf_dir, "events").withColumn(
        "rank", F.when(F.col("event_type") != "error", F.col("event_id") % 7))
    return keep_first(events.select("user_id", "event_type", "rank", "event_id", "ts", "value", "props"),
                      ["user_id", "event_type"], "rank")


_Q06_SQL = """
SELECT user_id, event_type, rank, event_id, ts, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY rank DESC NULLS LAST, event_id DESC) AS rn
  FROM (SELECT *, CASE WHEN event_type <> 'error' THEN event_id % 7 END AS rank FROM events))
WHERE rn = 1"""


# ---------------------------------------------------------------- Q-07 ----
def q07_extract_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R13 (G4-G7) on a projection of events with repeats and nulls."""
    ev = table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.nullif(F.col("event_type"), F.lit("error")).alias("kind"))
    return extract_profile(ev)


_Q07_SQL = """
WITH d AS (SELECT count(*) AS n FROM (SELECT DISTINCT user_id, event_type, NULLIF(event_type, 'error') FROM events))
SELECT count(*) AS "rows",
  count(*) - count(user_id) AS nulls_user_id,
  count(*) - count(event_type) AS nulls_event_type,
  count(*) - count(NULLIF(event_type, 'error')) AS nulls_kind,
  count(*) - (SELECT n FROM d) AS duplicate_rows,
  (SELECT n FROM d) AS distinct_rows
FROM events"""


# ---------------------------------------------------------------- Q-08 ----
# Two systems combined (R8 / R9): system A from ``customer``, system B (its
# own column names) from ``supplier``.
def _system_a(customer: DataFrame, funded: bool) -> DataFrame:
    e = F.expr
    cols = [
        e("lower(concat('lc-', c_custkey))").alias("LOAN_NUMBER"),
        F.lit(None).cast("string").alias("TBD"),
        e("CASE WHEN c_mktsegment = 'BUILDING' THEN 'null' ELSE c_mktsegment END").alias("NOTES"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.concat(F.lit("O'"), F.col("c_name")))
        .otherwise(F.col("c_name")).alias("BORROWER_FIRST_NAME"),
        F.concat(F.lit('"'), F.col("c_name"), F.lit('"')).alias("BORROWER_LAST_NAME"),
        e("concat(c_custkey, ' Pine St')").alias("STREET"),
        F.lit("CA").alias("STATE"),
        e("CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL WHEN c_mktsegment = 'HOUSEHOLD' THEN 'TBD' "
          "ELSE date_format(date_add(DATE'2024-01-01', c_nationkey), 'yyyy-MM-dd') END").alias("CLOSING_DATE"),
        e("date_format(date_add(DATE'2024-02-01', c_nationkey), 'M/d/yyyy')").alias("LOCK_EXPIRATION"),
        e("CASE WHEN c_mktsegment = 'FURNITURE' THEN 'n/a' "
          "ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) END").alias("LOAN_AMOUNT"),
        e("CAST(c_nationkey AS STRING)").alias("NOTE_RATE"),
        F.lit("null").alias("POINTS"),
        e("CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 2 AS STRING)").alias("WIRE_AMOUNT"),
        F.lit("Broker").alias("LO_BROKER"),
        e("date_format(date_add(DATE'2024-01-05', c_nationkey), 'M/d/yyyy')").alias("BP_DOC_REVIEW"),
        F.lit("yes").alias("APPROVED"),
        F.lit(None).cast("string").alias("CLEAR_TO_CLOSE"),
        e("date_format(date_add(DATE'2023-12-01', c_nationkey), 'yyyy-MM-dd')").alias("APPRAISAL_ORDERED"),
        F.lit("soon").alias("APPRAISAL_DUE"),
        F.lit("").alias("APPRAISAL_EXPIRATION"),
        e("date_format(date_add(DATE'2023-12-10', c_nationkey), 'yyyy-MM-dd HH:mm:ss')").alias("TITLE_ORDERED"),
        F.lit(None).cast("string").alias("TITLE_RECEIVED"),
        F.lit("1/2/2024").alias("DOCS_OUT"),
        F.lit("01/31/2024 14:30").alias("SIGNING_APPOINTMENT"),
        e("CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE concat('Fund ', c_nationkey) END").alias("FUND"),
        e("c_mktsegment").alias("LOAN_TYPE"),
        F.lit("High").alias("CLOSING_LIKELIHOOD"),
        F.lit("Investor").alias("OCCUPANCY"),
        e("CASE WHEN c_nationkey < 12 THEN 'First Lien' ELSE 'Second' END").alias("LIEN_POSITION"),
        F.lit("12").alias("LOAN_TERM"),
    ]
    if funded:
        cols.append(e("date_format(date_add(DATE'2024-03-01', c_nationkey), 'yyyy-MM-dd')").alias("FUNDED_DATE"))
    return customer.select(*cols)


def _system_b(supplier: DataFrame, funded: bool) -> DataFrame:
    e = F.expr
    cols = [
        e("concat('ls-', s_suppkey)").alias("LOAN_NUMBER"),
        e("s_name").alias("BORROWER_FIRST_NAME"),
        F.concat(F.lit('Mc"'), F.col("s_suppkey")).alias("BORROWER_LAST_NAME"),
        F.lit("7.5").alias("NOTE_RATE"),
        e("CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS STRING)").alias("TOTAL_LOAN_AMOUNT"),
        e("date_format(date_add(DATE'2024-01-01', s_nationkey), 'M/d/yyyy')").alias("EST_CLOSING_DATE"),
        e("concat(s_suppkey, ' Main St')").alias("SUBJECT_PROPERTY_ADDRESS"),
        e("CASE WHEN s_nationkey < 5 THEN 'First Lien' ELSE 'First' END").alias("LIEN_POSITION"),
        e("concat('Fund ', s_nationkey)").alias("LGC_FUND_SOURCE"),
        F.lit("Bridge").alias("LOAN_PROGRAM"),
        F.lit("Officer").alias("LOAN_OFFICER"),
        F.lit("bad date").alias("TITLE_ORDERED_DATE"),
        F.lit("2024-01-09").alias("TITLE_DOC_RECEIVED_DATE"),
        F.lit("2024-02-09").alias("LOCK_EXPIRATION_DATE"),
        e("CAST(s_nationkey AS STRING)").alias("ORIGINATION_CHARGE"),
        F.lit("2023-12-01").alias("APPRAISAL_ORDERED_DATE"),
        F.lit("12/15/2023").alias("APPRAISAL_ESTIMATED_DUE_DATE"),
        F.lit("NV").alias("SUBJECT_PROPERTY_STATE"),
        F.lit("2024-01-02").alias("UNDERWRITING_APPROVAL_DATE"),
        F.lit("null").alias("UNDERWRITING_CLEAR_TO_CLOSE_DATE"),
        e("CAST(CAST(s_acctbal AS DECIMAL(18,2)) + 1 AS STRING)").alias("TOTAL_WIRE_TRANSFER"),
        F.lit("2024-06-01").alias("UNDERWRITING_APPRAISAL_EXPIRED_DATE"),
        F.lit("Low").alias("CLOSING_LIKELIHOOD"),
        F.lit("Owner").alias("OCCUPANCY"),
        F.lit("24").alias("LOAN_TERM"),
        F.lit("ignored").alias("EXTRA_B_COLUMN"),
    ]
    if funded:
        cols.append(F.lit("2024-03-15").alias("FUNDED_DATE"))
    return supplier.select(*cols)


def q08_combine_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine_lip(_system_a(table(spark, sf_dir, "customer"), False),
                       _system_b(table(spark, sf_dir, "supplier"), False), AS_OF)


def q08b_combine_funded_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine_lip(_system_a(table(spark, sf_dir, "customer"), True),
                       _system_b(table(spark, sf_dir, "supplier"), True), AS_OF, funded=True)


def _q08_sql(funded: bool) -> str:
    fa = ", CAST(DATE '2024-03-01' + c_nationkey AS TIMESTAMP) AS FUNDED_DATE" if funded else ""
    fb = ", TIMESTAMP '2024-03-15 00:00:00'" if funded else ""
    quote = "" if funded else "''"
    dquote = "" if funded else '"'
    return f"""
SELECT upper('lc-' || c_custkey) AS LOAN_NUMBER, CAST(NULL AS VARCHAR) AS TBD,
  CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS NOTES,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'O{quote}' || c_name ELSE c_name END AS BORROWER_FIRST_NAME,
  '{dquote}' || c_name || '{dquote}' AS BORROWER_LAST_NAME,
  c_custkey || ' Pine St' AS STREET, 'CA' AS STATE{fa},
  CASE WHEN c_mktsegment IN ('MACHINERY', 'HOUSEHOLD') THEN NULL
       ELSE CAST(DATE '2024-01-01' + c_nationkey AS TIMESTAMP) END AS CLOSING_DATE,
  'High' AS CLOSING_LIKELIHOOD,
  strftime(DATE '2024-02-01' + c_nationkey, '%-m/%-d/%Y') AS LOCK_EXPIRATION,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) END AS LOAN_AMOUNT,
  CAST(c_nationkey AS DOUBLE) AS NOTE_RATE, CAST(NULL AS DOUBLE) AS POINTS,
  CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 2 AS DOUBLE) AS WIRE_AMOUNT,
  'Broker' AS LO_BROKER,
  CAST(DATE '2024-01-05' + c_nationkey AS TIMESTAMP) AS BP_DOC_REVIEW,
  'yes' AS APPROVED, CAST(NULL AS VARCHAR) AS CLEAR_TO_CLOSE,
  CAST(DATE '2023-12-01' + c_nationkey AS TIMESTAMP) AS APPRAISAL_ORDERED,
  CAST(NULL AS TIMESTAMP) AS APPRAISAL_DUE, CAST(NULL AS TIMESTAMP) AS APPRAISAL_EXPIRATION,
  CAST(DATE '2023-12-10' + c_nationkey AS TIMESTAMP) AS TITLE_ORDERED,
  CAST(NULL AS TIMESTAMP) AS TITLE_RECEIVED,
  TIMESTAMP '2024-01-02 00:00:00' AS DOCS_OUT, TIMESTAMP '2024-01-31 14:30:00' AS SIGNING_APPOINTMENT,
  CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE 'Fund ' || c_nationkey END AS FUND,
  c_mktsegment AS LOAN_TYPE, 'Investor' AS OCCUPANCY,
  CASE WHEN c_nationkey < 12 THEN 'First' ELSE 'Second' END AS LIEN_POSITION,
  '12' AS LOAN_TERM, '{AS_OF_PACIFIC_TEXT}' AS "timestamp"
FROM customer
UNION ALL
SELECT upper('ls-' || s_suppkey), NULL, NULL, s_name, 'Mc{dquote}' || s_suppkey, s_suppkey || ' Main St', 'NV'{fb},
  CAST(DATE '2024-01-01' + s_nationkey AS TIMESTAMP), 'Low', '2024-02-09',
  CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DOUBLE), 7.5, CAST(s_nationkey AS DOUBLE),
  CAST(CAST(s_acctbal AS DECIMAL(18,2)) + 1 AS DOUBLE), 'Officer', NULL, '2024-01-02', NULL,
  TIMESTAMP '2023-12-01 00:00:00', TIMESTAMP '2023-12-15 00:00:00', TIMESTAMP '2024-06-01 00:00:00',
  NULL, TIMESTAMP '2024-01-09 00:00:00', NULL, NULL,
  'Fund ' || s_nationkey, 'Bridge', 'Owner', 'First', '24', '{AS_OF_PACIFIC_TEXT}'
FROM supplier"""


# ---------------------------------------------------------------- Q-09 ----
def q09_sorted_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 + O2: first 1000 rows by closing date then fund, both ascending
    with nulls last, ties broken by the newest id (a top-k: each task keeps
    its own 1000, one merge)."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderdate")).alias("closing_date"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("fund"))
    return top_k_by(o, [F.col("closing_date").asc_nulls_last(), F.col("fund").asc_nulls_last(),
                        F.col("o_orderkey").desc()], 1000)


_Q09_SQL = """
SELECT o_orderkey, o_custkey, o_totalprice,
  CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END AS closing_date,
  NULLIF(o_orderpriority, '5-LOW') AS fund
FROM orders
ORDER BY closing_date ASC NULLS LAST, fund ASC NULLS LAST, o_orderkey DESC
LIMIT 1000"""


def q09b_full_sorted_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 over all rows: the position of each in the two-key order, nulls last."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_orderdate")).alias("closing_date"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("fund"))
    return add_surrogate_key(o, [F.col("closing_date").asc_nulls_last(), F.col("fund").asc_nulls_last(), F.col("o_orderkey").desc()],
                             "position")


_Q09B_SQL = """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END AS closing_date,
  NULLIF(o_orderpriority, '5-LOW') AS fund FROM orders)
SELECT *, row_number() OVER (ORDER BY closing_date ASC NULLS LAST, fund ASC NULLS LAST, o_orderkey DESC) AS position FROM o"""


# ---------------------------------------------------------------- Q-10 ----
# Active-loan report landed from orders ⟕ customer; the four alerts (A1-A4)
# each look at their own date heading.
ALERT_AS_OF = _dt.date(1996, 6, 15)


def landed_active_loans(orders: DataFrame, customer: DataFrame) -> DataFrame:
    e = F.expr
    j = orders.join(customer.select("c_custkey", "c_name", "c_mktsegment"),
                    F.col("o_custkey") == F.col("c_custkey"), "left")
    return j.select(
        e("concat('LN-', o_orderkey)").alias("Loan Number"),
        e("concat(o_orderkey, ' Cedar Ave')").alias("Property Address"),
        e("CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE concat('First', o_custkey) END")
        .alias("Borrower First Name"),
        F.col("c_name").alias("Borrower Last Name"),
        e("date_format(o_orderdate, 'MM/dd/yyyy')").alias("Current Loan Due Date"),
        e("date_format(date_add(o_orderdate, 10), 'MM/dd/yyyy')").alias("Builder's Risk Insurance Expiration"),
        e("CASE WHEN o_orderstatus = 'P' THEN 'unknown' "
          "ELSE date_format(date_add(o_orderdate, 20), 'MM/dd/yyyy') END").alias("Flood Insurance Expiration Date"),
        e("date_format(date_add(o_orderdate, -5), 'M/d/yyyy')").alias("Homeowners Insurance Expires Date"),
    )


def q10_expiring_in_30_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = landed_active_loans(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))
    return expiring_cases(loans, (MATURITY, BUILDERS_RISK, FLOOD, HOMEOWNERS), ALERT_AS_OF)


def _q10_sql() -> str:
    parts = []
    # Subjects and reasons, written out for the oracle.
    for subject, reason, shift, extra in (
            ("Maturity date expiring in 30 days for loan number: ", "Maturity Date: Expires in 30 days", 0, ""),
            ("Builder''s Risk Insurance expiring in 30 days for loan number: ",
             "Builder''s risk Insurance: Expires in 30 days", 10, ""),
            ("Flood insurance expiring in 30 days for loan number: ", "Flood Insurance: Expires in 30 days", 20,
             " AND o_orderstatus <> 'P'"),
            ("Homeowners Insurance expiring in 30 days for loan number: ", "Homeowners Insurance: Expires in 30 days", -5, "")):
        parts.append(f"""
SELECT '{subject}LN-' || o_orderkey AS Subject, 'LN-' || o_orderkey AS Description, '' AS RecordTypeId, '' AS OwnerId,
  '{reason}' AS Reason, 'LN-' || o_orderkey AS Loan_Number__c, o_orderkey || ' Cedar Ave' AS Address__Street__s,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE 'First' || o_custkey || ' ' || c_name END AS Borrower__c
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
WHERE date_diff('day', DATE '{ALERT_AS_OF}', CAST(o_orderdate AS DATE) + {shift}) = 30{extra}""")
    return "\nUNION ALL".join(parts)


# ---------------------------------------------------------------- Q-11 ----
TX_AS_OF = _dt.date(1998, 3, 31)


def q11_two_month_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts from customer, one transaction document per order."""
    accounts = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"))
    e = F.expr
    tx = table(spark, sf_dir, "orders").select(
        e("CAST(o_custkey AS STRING)").alias("account_id"),
        e("concat('LN-', o_orderkey)").alias("loanNumber"),
        F.col("o_orderpriority").alias("transactionDescription"),
        e("CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)").alias("debit"),
        e("CASE WHEN o_orderstatus = 'F' THEN '0.00' END").alias("credit"),
        F.col("o_orderstatus").alias("paymentType"),
        e("date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")").alias("transactionCreatedDate"),
        e("date_format(date_add(o_orderdate, 3), \"yyyy-MM-dd'T'HH:mm:ss\")").alias("transactionEffectiveDate"))
    return transaction_report(accounts, tx, TX_AS_OF)


_Q11_SQL = f"""
SELECT 'LN-' || o_orderkey AS loanNumber, o_orderpriority AS transactionDescription,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS debit,
  CASE WHEN o_orderstatus = 'F' THEN '0.00' END AS credit, o_orderstatus AS paymentType,
  strftime(o_orderdate, '%m/%d/%y') AS transactionCreatedDate,
  strftime(o_orderdate + INTERVAL 3 DAY, '%m/%d/%y') AS transactionEffectiveDate,
  '{AS_OF_PACIFIC_TEXT.replace("2024-01-15T04:00:00", "1998-03-30T16:00:00")}' AS "timestamp"
FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-01-31' AND DATE '1998-03-31'
  AND o_custkey IN (SELECT c_custkey FROM customer)"""


# ---------------------------------------------------------------- Q-12 ----
# Draw documents nested from orders (header) and lineitem (items): payee map
# by supplier name -> list of item lists (one list per line status).  Each
# document holds the lines of one order, as a landed draw does.
def nested_draws(orders: DataFrame, lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    e = F.expr
    item = F.struct(
        e("CAST(l_linenumber AS STRING)").alias("number"),
        e("concat('Part ', l_partkey)").alias("description"),
        F.col("l_returnflag").alias("subDescription"),
        e("CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)").alias("requested"),
        e("CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS STRING)").alias("retainage"),
        e("CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS STRING)")
        .alias("totalLessRetainage"))
    # One shuffle per draw, of the plain columns; the text is made behind it, in
    # all the session's partitions, as it is several times as long.  Payees and
    # their item lists are shaped inside each document with higher-order
    # functions, without a search where no payee comes twice.
    plain = ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus", "l_extendedprice", "l_discount", "s_name"]
    partitions = int(lineitem.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = (lineitem.join(supplier.select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
             .select(*plain).repartition(partitions, "l_orderkey")
             .select("l_orderkey", F.struct(F.col("s_name").alias("p"), F.col("l_linestatus").alias("st"),
                                            item.alias("it")).alias("x")))
    by_draw = lines.groupBy("l_orderkey").agg(F.collect_list("x").alias("xs")).select(
        "l_orderkey",
        F.expr("""map_from_entries(IF(size(array_distinct(xs.p)) = size(xs),
                    transform(xs, x -> named_struct('n', x.p, 'v', named_struct('items', array(IF(x.st IS NULL, slice(array(x.it), 1, 0), array(x.it)))))),
                    transform(array_distinct(xs.p), n -> named_struct('n', n, 'v',
                    named_struct('items', transform(array_distinct(transform(filter(xs, x -> x.p = n), x -> x.st)),
                      s -> transform(filter(xs, x -> x.p = n AND x.st = s), x -> x.it)))))))""").alias("payee"))
    return (orders.join(by_draw, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select(
                e("CAST(o_orderkey AS STRING)").alias("id"),
                e("concat('Customer#', o_custkey)").alias("requestedBy"),
                e("concat('Draw ', o_orderkey)").alias("name"),
                e("CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END").alias("type"),
                e("CAST(o_custkey AS STRING)").alias("containerNumber"),
                F.col("o_orderstatus").alias("status"),
                e("date_format(o_orderdate, 'yyyy-MM-dd')").alias("createdDate"),
                e("date_format(date_add(o_orderdate, 1), 'yyyy-MM-dd')").alias("submittedDate"),
                F.lit(None).cast("string").alias("approvedDate"),
                e("date_format(date_add(o_orderdate, 7), 'yyyy-MM-dd')").alias("effectiveDate"),
                F.lit("F1").alias("folderId"),
                F.to_json(F.struct("payee")).alias("lineItems")))


def q12_draw_item_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    draws = nested_draws(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"),
                         table(spark, sf_dir, "supplier"))
    return flatten_draws(draws)


_Q12_ITEMS = """
SELECT CAST(o_orderkey AS VARCHAR) AS draw_id, 'Customer#' || o_custkey AS requestedBy,
  'Draw ' || o_orderkey AS name, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS type,
  CAST(o_custkey AS VARCHAR) AS containerNumber, o_orderstatus AS status,
  strftime(o_orderdate, '%Y-%m-%d') AS createdDate,
  strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS submittedDate,
  CAST(NULL AS VARCHAR) AS approvedDate,
  strftime(o_orderdate + INTERVAL 7 DAY, '%Y-%m-%d') AS effectiveDate, 'F1' AS folderId,
  CAST(l_linenumber AS VARCHAR) AS "lineItems.number", s_name AS "payee.name",
  'Part ' || l_partkey AS "lineItems.description", l_returnflag AS "lineItems.subDescription",
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS "lineItems.amount",
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) AS "lineItems.retainage",
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS VARCHAR)
    AS "lineItems.totalLessRetainage"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey"""


# ---------------------------------------------------------------- Q-13 ----
# Draw report (R10): webhook runs made from events (one day, not FAILED,
# one flow), loan fields from customer, draws from orders/lineitem.
DRAW_AS_OF = _dt.datetime(2024, 1, 16, 9, 0, 0)
DRAW_AS_OF_PACIFIC_TEXT = "2024-01-16T01:00:00"


def runs_from_events(events: DataFrame) -> DataFrame:
    e = F.expr
    return events.select(
        e("lpad(CAST(event_id AS STRING), 12, '0')").alias("id"),
        e("CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN NULL ELSE 'COMPLETED' END").alias("state_type"),
        F.col("ts").alias("start_time"),
        e("CASE WHEN event_type = 'view' THEN 'other-flow' ELSE 'draw-flow' END").alias("flow_id"),
        e("CAST(user_id AS STRING)").alias("draw_id"),
        e("CAST(user_id AS STRING)").alias("loan_id"),
        F.col("event_type").alias("updated_status"))


def q13_draw_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = runs_from_events(table(spark, sf_dir, "events"))
    loans = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("loan_id"),
        F.concat(F.lit("LN-"), F.col("c_custkey")).alias("loanNumber"))

    def draws(ids: DataFrame) -> DataFrame:
        wanted = ids.select(F.col("id").cast("long").alias("k"))
        orders = table(spark, sf_dir, "orders").join(wanted, F.col("o_orderkey") == F.col("k"), "left_semi")
        lines = table(spark, sf_dir, "lineitem").join(wanted, F.col("l_orderkey") == F.col("k"), "left_semi")
        return nested_draws(orders, lines, table(spark, sf_dir, "supplier"))

    return draw_report(runs, loans, draws, DRAW_AS_OF, flow_ids=["draw-flow"])


_Q13_SQL = f"""
WITH ev AS (
  SELECT DISTINCT CAST(user_id AS VARCHAR) AS draw_id, CAST(user_id AS VARCHAR) AS loan_id, event_type AS updated_status
  FROM events
  WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'
    AND event_type NOT IN ('error', 'view')),
items AS ({_Q12_ITEMS})
SELECT ev.draw_id, ev.loan_id, ev.updated_status, 'LN-' || c.c_custkey AS loanNumber,
  '{DRAW_AS_OF_PACIFIC_TEXT}' AS "timestamp",
  i.requestedBy, i.name, i.type, i.containerNumber, i.status, i.createdDate, i.submittedDate,
  i.approvedDate, i.effectiveDate, i.folderId, i."lineItems.number", i."payee.name",
  i."lineItems.description", i."lineItems.subDescription", i."lineItems.amount",
  i."lineItems.retainage", i."lineItems.totalLessRetainage"
FROM ev LEFT JOIN customer c ON ev.loan_id = CAST(c.c_custkey AS VARCHAR)
LEFT JOIN items i ON ev.draw_id = i.draw_id"""


# ---------------------------------------------------------------- Q-14 ----
def q14_core_value_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven warehouse columns renamed by position, kept when the loan
    already has values (here: the customer has orders), as JSON bodies."""
    e = F.expr
    raw = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", e("concat('CS-', c_custkey)"),
        e("CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END"),
        e("CAST(c_acctbal AS DECIMAL(18,2))"), e("CAST(c_acctbal AS DECIMAL(18,2)) * 0.5"),
        e("date_add(DATE'2024-01-01', c_nationkey)"))
    existing = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("lg_loan_id"))
    return core_value_patches(raw, existing)


_Q14_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS target_id,
  json_object('lg_loan_id', CAST(c_custkey AS VARCHAR), 'lg_loan_number', c_name,
    'coreSystemLoanId', 'CS-' || c_custkey, 'coreSystemName', CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END,
    'coreSystemLoanAmount', CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR),
    'coreSystemLoanBalance', CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 0.5 AS VARCHAR),
    'coreSystemLoanBalanceLastUpdated', CAST(DATE '2024-01-01' + c_nationkey AS VARCHAR))::VARCHAR AS body
FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)"""


# ---------------------------------------------------------------- Q-15 ----
def q15_upsert_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 + V3: customers whose segment changed balance are updated,
    suppliers arrive as new customers; every other customer stays."""
    target = table(spark, sf_dir, "customer")
    changed = target.where(F.col("c_mktsegment") == "BUILDING").withColumn("c_acctbal", F.col("c_acctbal") + 100)
    new = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1000000).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"))
    return upsert(target, changed.unionByName(new), ["c_custkey"])


_Q15_SQL = """
SELECT c_custkey, c_name, c_nationkey,
  CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer
UNION ALL
SELECT s_suppkey + 1000000, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier"""


# ---------------------------------------------------------------- Q-16 ----
# Payroll documents: companies from nation (one page per region), workers
# from customer (pages of 50 per company, with the total), communications
# from orders (one document per worker page of 50).
PAGE_SIZE = 50


def payroll_documents(nation: DataFrame, customer: DataFrame, orders: DataFrame):
    e = F.expr
    company_docs = (nation.groupBy("n_regionkey").agg(F.collect_list(F.struct(
        e("CAST(n_nationkey AS STRING)").alias("companyId"), e("concat('D', n_nationkey)").alias("displayId"),
        F.col("n_name").alias("legalName"))).alias("content"))
        .select("content", F.lit(None).cast("string").alias("error"),
                F.lit(None).cast("string").alias("error_description")))
    totals = customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("total"))
    worker = F.struct(
        e("CAST(c_custkey AS STRING)").alias("workerId"), e("concat('E', c_custkey)").alias("employeeId"),
        e("CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL "
          "ELSE named_struct('givenName', concat('G', c_custkey), 'familyName', c_name) END").alias("name"),
        e("named_struct('statusType', 'ACTIVE')").alias("currentStatus"))
    worker_pages = (customer.groupBy("c_nationkey", F.floor(F.col("c_custkey") / PAGE_SIZE).alias("page"))
                    .agg(F.collect_list(worker).alias("content"))
                    .join(totals, "c_nationkey")
                    .select(F.col("c_nationkey").cast("string").alias("companyId"), "content",
                            F.struct(F.struct(F.col("total")).alias("pagination")).alias("metadata"),
                            F.lit(None).cast("string").alias("error"),
                            F.lit(None).cast("string").alias("error_description")))
    comm = F.struct(
        e("CAST(o_orderkey AS STRING)").alias("communicationId"),
        e("CASE o_orderpriority WHEN '2-HIGH' THEN 'PHONE' WHEN '3-MEDIUM' THEN 'email' ELSE 'EMAIL' END").alias("type"),
        e("CASE WHEN o_orderstatus = 'F' THEN 'PERSONAL' ELSE 'BUSINESS' END").alias("usageType"),
        e("concat('C', o_orderkey, '@Example.COM')").alias("uri"))
    communications = (orders.groupBy("o_custkey", F.floor(F.col("o_orderkey") / PAGE_SIZE).alias("page"))
                      .agg(F.collect_list(comm).alias("content"))
                      .select(F.col("o_custkey").cast("string").alias("workerId"), "content"))
    return company_docs, worker_pages, communications


def q16_payroll_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R12 without the table writes: V5 + V4 checks, then e-mail rows (N7,
    F7, C14) joined to workers (P10) and companies (P11) on the carried
    parent keys (J6)."""
    cd, wp, cm = payroll_documents(table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer"),
                                   table(spark, sf_dir, "orders"))
    assert_sound_documents(cd)
    assert_sound_documents(wp, ["companyId"])
    em = email_addresses(cm)
    w = workers(wp).withColumnRenamed("id", "worker_id")
    c = companies(cd)
    return (em.join(w, "worker_id").join(c, "company_id")
              .select("id", "worker_id", "type", "email", "employee_id", "first_name", "last_name",
                      "status", "company_id", "legal_name"))


_Q16_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS worker_id,
  CASE WHEN o_orderstatus = 'F' THEN 'PERSONAL' ELSE 'BUSINESS' END AS type,
  lower('C' || o_orderkey || '@Example.COM') AS email, 'E' || c_custkey AS employee_id,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE 'G' || c_custkey END AS first_name,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE c_name END AS last_name,
  'ACTIVE' AS status, CAST(n_nationkey AS VARCHAR) AS company_id, n_name AS legal_name
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderpriority NOT IN ('2-HIGH', '3-MEDIUM')"""


# ---------------------------------------------------------------- Q-17 ----
CASES_FROM = _dt.datetime(2024, 1, 25)


def q17_open_case_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C19 + J3: (loan, draw) pairs of late events become cases unless an
    earlier event already opened one with the same hash; null parts are
    spelled 'None' in the hash."""
    ev = table(spark, sf_dir, "events").select(
        F.col("ts"), F.col("user_id").cast("string").alias("Loan_Number__c"),
        F.expr("CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN 'view' WHEN 'click' THEN 'click' "
               "ELSE concat(event_type, '-', day(ts)) END").alias("Draw_ID__c"))
    since = F.lit(CASES_FROM.isoformat(sep=" ")).cast("timestamp_ntz")
    later = ev.where(F.col("ts") >= since).select(
        case_hash(F.col("Loan_Number__c"), F.col("Draw_ID__c")).alias("case_hash"), "Loan_Number__c", "Draw_ID__c")
    earlier = ev.where(F.col("ts") < since)
    return new_cases(later, earlier)


_Q17_SQL = """
WITH pairs AS (
  SELECT ts, CAST(user_id AS VARCHAR) AS l,
    CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN 'view' WHEN 'click' THEN 'click'
      ELSE event_type || '-' || day(ts) END AS d
  FROM events),
later AS (SELECT DISTINCT l, d FROM pairs WHERE ts >= TIMESTAMP '2024-01-25 00:00:00'),
earlier AS (SELECT DISTINCT l, d FROM pairs WHERE ts < TIMESTAMP '2024-01-25 00:00:00')
SELECT sha256(coalesce(l, 'None') || '-' || coalesce(d, 'None')) AS case_hash, l AS Loan_Number__c, d AS Draw_ID__c
FROM later
WHERE sha256(coalesce(l, 'None') || '-' || coalesce(d, 'None')) NOT IN
  (SELECT sha256(coalesce(l, 'None') || '-' || coalesce(d, 'None')) FROM earlier)"""


# ---------------------------------------------------------------- Q-18 ----
# The draw webhook as a stream: events are read as a file stream
# (availableNow), every call becomes (loan, status, draw); loans, draws and
# open cases are static tables derived from customer and orders.
def _draw_lookups(spark: SparkSession, sf_dir: str):
    """Loans, draws and the CRM's cases (all states) made from customer and orders."""
    e = F.expr
    customer = table(spark, sf_dir, "customer")
    loans = customer.select(
        e("CAST(c_custkey AS STRING)").alias("loan_id"), e("concat('LN-', c_custkey)").alias("loanNumber"),
        e("CASE WHEN c_acctbal > 5000 THEN array('Accounting', c_mktsegment) ELSE array(c_mktsegment) END")
        .alias("riskLabel"),
        e("named_struct('firstName', CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE concat('F', c_custkey) END,"
          " 'lastName', c_name)").alias("borrower"),
        e("concat(c_custkey, ' Birch Rd')").alias("propertyAddress"))
    draws = table(spark, sf_dir, "orders").select(
        e("CAST(o_orderkey AS STRING)").alias("id"),
        e("CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END").alias("type"))
    cases = customer.select(e("concat('LN-', c_custkey)").alias("Loan_Number__c"),
                            e("CAST(c_custkey AS STRING)").alias("Draw_ID__c"),
                            e("CASE WHEN c_mktsegment = 'BUILDING' THEN 'New' ELSE 'Closed' END").alias("Status"))
    return loans, draws, lambda: cases.where(F.col("Status") == "New")


def _draw_calls(events: DataFrame) -> DataFrame:
    status = (F.when(F.col("event_type") == "purchase", F.lit(" Draw Submit\n"))
              .when(F.col("event_type") == "view", F.lit("draw submit"))
              .when(F.col("event_type") == "click", F.lit("Draw Create"))
              .otherwise(F.col("event_type")))
    return events.select(F.col("user_id").cast("string").alias("loan_id"), status.alias("updated_status"),
                         F.col("user_id").cast("string").alias("draw_id"))


def _draw_event_stream(spark: SparkSession, sf_dir: str, draw_status: str = DRAW_SUBMIT):
    events_schema = table(spark, sf_dir, "events").schema
    stream = (spark.readStream.schema(events_schema).option("pathGlobFilter", "events.parquet")
              .parquet(sf_dir))
    loans, draws, open_cases = _draw_lookups(spark, sf_dir)
    root = scratch_path(spark, "draw-stream")
    q = start_draw_event_stream(spark, _draw_calls(stream), loans, draws, open_cases, f"{root}/cases", f"{root}/mails",
                                f"{root}/checkpoint", status=draw_status, record_type_id="RT-1", owner_id="OW-1")
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return root


def q18_draw_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _draw_event_stream(spark, sf_dir)
    return read_outbox(spark, f"{root}/cases", CASE_OUTBOX).drop("batch_id")


def q18b_draw_event_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _draw_event_stream(spark, sf_dir)
    return read_outbox(spark, f"{root}/mails", MAIL_OUTBOX).drop("batch_id")


def q18c_draw_create_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older variant, status 'draw create'."""
    root = _draw_event_stream(spark, sf_dir, DRAW_CREATE)
    return read_outbox(spark, f"{root}/mails", MAIL_OUTBOX).drop("batch_id")


def q18d_draw_event_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches (odd and even users), the first of them delivered twice,
    as after a lost commit: cases and mails with their batch, no doubles."""
    loans, draws, open_cases = _draw_lookups(spark, sf_dir)
    events = table(spark, sf_dir, "events")
    root = scratch_path(spark, "draw-replay")
    for batch_id in (0, 0, 1):
        batch = _draw_calls(events.where(F.col("user_id") % 2 == batch_id))
        process_batch(batch, batch_id, spark, loans, draws, open_cases, f"{root}/cases", f"{root}/mails")
    mails = read_outbox(spark, f"{root}/mails", MAIL_OUTBOX).select(F.lit("mail").alias("kind"), "batch_id", "loan_id", "subject")
    cases = read_outbox(spark, f"{root}/cases", CASE_OUTBOX).select(F.lit("case").alias("kind"), "batch_id", F.col("Draw_ID__c").alias("loan_id"), F.col("Subject").alias("subject"))
    return mails.unionByName(cases)


def q18e_draw_event_reopen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same calls in three batches: after the first the sender has
    delivered the cases of F orders and the CRM closed them, so the second
    batch opens these again; nothing more is delivered before the third."""
    loans, draws, open_cases = _draw_lookups(spark, sf_dir)
    calls = _draw_calls(table(spark, sf_dir, "events"))
    root = scratch_path(spark, "draw-reopen")
    closed = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("Draw_ID__c"))

    def delivered() -> DataFrame:
        queued = read_outbox(spark, f"{root}/cases", CASE_OUTBOX).where("batch_id = 0")
        return queued.join(closed, "Draw_ID__c", "left_semi").select("case_hash", "batch_id")

    for batch_id in (0, 1, 2):
        process_batch(calls, batch_id, spark, loans, draws, open_cases, f"{root}/cases", f"{root}/mails", delivered=delivered)
    return read_outbox(spark, f"{root}/cases", CASE_OUTBOX).select("case_hash", "batch_id", "Loan_Number__c", "Draw_ID__c")


_Q18_BASE = """
WITH ev AS (
  SELECT CAST(user_id AS VARCHAR) AS loan_id, CAST(user_id AS VARCHAR) AS draw_id,
    CASE event_type WHEN 'purchase' THEN ' Draw Submit' || chr(10) WHEN 'view' THEN 'draw submit'
      WHEN 'click' THEN 'Draw Create' ELSE event_type END AS updated_status
  FROM events),
lo AS (
  SELECT CAST(c_custkey AS VARCHAR) AS loan_id, 'LN-' || c_custkey AS loanNumber, c_custkey || ' Birch Rd' AS addr,
    CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE 'F' || c_custkey END AS fn, c_name AS ln,
    c_acctbal > 5000 AS accounting, c_mktsegment AS seg
  FROM customer),
dr AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS draw_id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS draw_type
  FROM orders),
en AS (
  SELECT ev.*, lo.*, dr.draw_type,
    lower(regexp_replace(updated_status, '^\\s+|\\s+$', '', 'g')) = 'draw submit' AS submit
  FROM ev LEFT JOIN lo USING (loan_id) LEFT JOIN dr USING (draw_id))"""

_Q18_SQL = _Q18_BASE + """,
cand AS (
  SELECT DISTINCT sha256(coalesce(loanNumber, 'None') || '-' || coalesce(draw_id, 'None')) AS case_hash,
    'Pending Draw Created in LG  Loan Number: ' || coalesce(loanNumber, 'None') AS Subject,
    loanNumber AS Description, 'RT-1' AS RecordTypeId, 'OW-1' AS OwnerId, 'Draw' AS Reason, loanNumber AS Loan_Number__c, addr AS Address__Street__s,
    draw_id AS Draw_ID__c, coalesce(fn, '') || ' ' || coalesce(ln, '') AS Borrower__c
  FROM en WHERE submit AND draw_type IS NOT NULL)
SELECT * FROM cand
WHERE case_hash NOT IN (SELECT sha256('LN-' || c_custkey || '-' || c_custkey) FROM customer WHERE c_mktsegment = 'BUILDING')"""

_Q18B_SQL = _Q18_BASE + """
SELECT loan_id, draw_id, 'Draw Change for ' || coalesce(loanNumber, 'None') AS subject,
  'Loan Number: ' || coalesce(loanNumber, 'None') || chr(10) || 'Risk Label(s): ' ||
  CASE WHEN accounting THEN '[''Accounting'', ''' || seg || ''']' ELSE '[''' || seg || ''']' END ||
  chr(10) || 'Updated Status: ' || updated_status AS body
FROM en WHERE submit AND accounting"""

_Q18C_SQL = _Q18B_SQL.replace("WHERE submit AND accounting", "WHERE lower(updated_status) = 'draw create' AND accounting")

_Q18D_SQL = _Q18_SQL.split("SELECT * FROM cand")[0] + """
SELECT 'mail' AS kind, CAST(loan_id AS BIGINT) % 2 AS batch_id, loan_id, 'Draw Change for ' || loanNumber AS subject
FROM en WHERE submit AND accounting
UNION ALL
SELECT 'case', CAST(Draw_ID__c AS BIGINT) % 2, Draw_ID__c, Subject FROM cand
WHERE case_hash NOT IN (SELECT sha256('LN-' || c_custkey || '-' || c_custkey) FROM customer WHERE c_mktsegment = 'BUILDING')"""

_Q18E_SQL = _Q18_SQL.split("SELECT * FROM cand")[0] + """,
fresh AS (SELECT case_hash, Loan_Number__c, Draw_ID__c FROM cand
  WHERE case_hash NOT IN (SELECT sha256('LN-' || c_custkey || '-' || c_custkey) FROM customer WHERE c_mktsegment = 'BUILDING'))
SELECT case_hash, CAST(0 AS BIGINT) AS batch_id, Loan_Number__c, Draw_ID__c FROM fresh
UNION ALL
SELECT case_hash, CAST(1 AS BIGINT), Loan_Number__c, Draw_ID__c FROM fresh
WHERE Draw_ID__c IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F')"""


# ---------------------------------------------------------------- Q-19 ----
# Outbound case messages (SOAP-shaped XML, default and prefixed namespaces)
# built from customer; Borrower__c is missing for one segment.
def case_messages(customer: DataFrame) -> DataFrame:
    borrower = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("")).otherwise(
        F.concat(F.lit("<sf:Borrower__c>"), F.col("c_name"), F.lit("</sf:Borrower__c>")))
    xml = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>'
              '<soapenv:Envelope xmlns:soapenv="http://schemas.xmlsoap.org/soap/envelope/"><soapenv:Body>'
              '<notifications xmlns="urn:example:outbound"><OrganizationId>ORG-'), F.col("c_nationkey"),
        F.lit("</OrganizationId><ActionId>ACT-1</ActionId><SessionId xsi:nil=\"true\" "
              "xmlns:xsi=\"http://www.w3.org/2001/XMLSchema-instance\"/><EnterpriseUrl>https://example.invalid/e/"),
        F.col("c_nationkey"), F.lit("</EnterpriseUrl><PartnerUrl>https://example.invalid/p/"), F.col("c_nationkey"),
        F.lit("</PartnerUrl><Notification><Id>N-"), F.col("c_custkey"),
        F.lit('</Id><sObject xsi:type="sf:Case" xmlns:sf="urn:example:sobject" '
              'xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance"><sf:Id>CASE-'), F.col("c_custkey"),
        F.lit("</sf:Id>"), borrower,
        F.lit("<sf:CaseNumber>"), F.lpad(F.col("c_custkey").cast("string"), 8, "0"),
        F.lit("</sf:CaseNumber><sf:RecordTypeId>RT-"), F.col("c_mktsegment"),
        F.lit("</sf:RecordTypeId><sf:Status>New</sf:Status></sObject></Notification></notifications>"
              "</soapenv:Body></soapenv:Envelope>"))
    # one segment sends a second notification, another a message that breaks off
    second = F.concat(F.lit("<Notification><Id>N2-"), F.col("c_custkey"), F.lit("</Id><sObject><Id>CASE2-"), F.col("c_custkey"),
                      F.lit("</Id><CaseNumber/></sObject></Notification></notifications>"))
    xml = (F.when(F.col("c_mktsegment") == "BUILDING", F.replace(xml, F.lit("</notifications>"), second))
           .when(F.col("c_mktsegment") == "HOUSEHOLD", F.substring_index(xml, "<sf:Status>", 1)).otherwise(xml))
    return customer.select(xml.alias("xml"))


def q19_xml_case_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return case_mail(case_fields(case_messages(table(spark, sf_dir, "customer"))))


def q19b_broken_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that cannot be read, counted by the organization they name."""
    broken = broken_messages(case_messages(table(spark, sf_dir, "customer")))
    org = F.regexp_extract("xml", "<OrganizationId>([^<]*)<", 1).alias("org_id")
    return broken.groupBy(org).agg(F.count("*").alias("messages"))


_Q19_SQL = """
WITH f AS (
  SELECT 'ORG-' || c_nationkey AS org_id, 'ACT-1' AS action_id,
    'https://example.invalid/e/' || c_nationkey AS enterprise_url,
    'https://example.invalid/p/' || c_nationkey AS partner_url,
    'N-' || c_custkey AS notification_id, 'CASE-' || c_custkey AS case_id,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_name END AS borrower,
    lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS case_number, 'RT-' || c_mktsegment AS record_type_id,
    'New' AS status, 0 AS position
  FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
  UNION ALL
  SELECT 'ORG-' || c_nationkey, 'ACT-1', 'https://example.invalid/e/' || c_nationkey,
    'https://example.invalid/p/' || c_nationkey, 'N2-' || c_custkey, 'CASE2-' || c_custkey, NULL, NULL, NULL, NULL, 1
  FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT *, ' SF CASE: ' || coalesce(case_number, 'None') AS subject,
  'Organization ID: ' || org_id || 'Action ID: ' || action_id || 'Enterprise URL: ' || enterprise_url ||
  'Partner URL: ' || partner_url || 'Notification ID: ' || notification_id || 'Case ID: ' || case_id ||
  'Borrower: ' || coalesce(borrower, 'None') || 'Case Number: ' || coalesce(case_number, 'None') ||
  'Record Type ID: ' || coalesce(record_type_id, 'None') || 'Status: ' || coalesce(status, 'None') AS body
FROM f"""

_Q19B_SQL = """
SELECT 'ORG-' || c_nationkey AS org_id, count(*) AS messages FROM customer
WHERE c_mktsegment = 'HOUSEHOLD' GROUP BY c_nationkey"""


# ---------------------------------------------------------------- Q-20 ----
def q20_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1, 2, 3, ... in name order, without a single-task window."""
    return add_surrogate_key(table(spark, sf_dir, "customer"), ["c_name"], "unique_id")


_Q20_SQL = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
  row_number() OVER (ORDER BY c_name, c_custkey, c_nationkey, c_acctbal, c_mktsegment) AS unique_id
FROM customer"""


# ---------------------------------------------------------------- Q-21 ----
def q21_label_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """per user, the set of event types as labels and membership tests.
    The set per user is bounded by the label domain and merged map-side."""
    labels = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("labels"))
    return labels.select("user_id", has_label("labels", "purchase").alias("has_purchase"),
                         has_label("labels", "error").alias("has_error"),
                         F.size("labels").alias("n_labels"))


_Q21_SQL = """
SELECT user_id, bool_or(event_type = 'purchase') AS has_purchase, bool_or(event_type = 'error') AS has_error,
  CAST(count(DISTINCT event_type) AS INTEGER) AS n_labels
FROM events GROUP BY user_id"""


# ---------------------------------------------------------------- Q-22 ----
def q22_append_without_blank_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4's row preparation: upload date filled (P13), blank keys dropped,
    null keys kept (K6, Q17)."""
    e = F.expr
    df = table(spark, sf_dir, "customer").select(
        e("CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '' WHEN 'MACHINERY' THEN NULL "
          "ELSE concat('LN-', c_custkey) END").alias("loan_number"),
        F.col("c_name").alias("borrower"),
        e("CASE WHEN c_nationkey < 5 THEN TIMESTAMP_NTZ'2023-12-31 08:00:00' END").alias("upload_date"))
    return prepare_append(df, AS_OF)


_Q22_SQL = f"""
SELECT loan_number, borrower, coalesce(upload_date, TIMESTAMP '{AS_OF}') AS upload_date FROM (
  SELECT CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '' WHEN 'MACHINERY' THEN NULL ELSE 'LN-' || c_custkey END AS loan_number,
    c_name AS borrower,
    CASE WHEN c_nationkey < 5 THEN TIMESTAMP '2023-12-31 08:00:00' END AS upload_date
  FROM customer)
WHERE loan_number IS NULL OR loan_number <> ''"""


# ---------------------------------------------------------------- Q-23 ----
def q23_pacific_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D10 + P12 + D9: UTC wall clock to Pacific, as value and as texts."""
    ev = table(spark, sf_dir, "events").select("event_id", utc_to_pacific("ts").alias("ts_pacific"))
    return ev.select("event_id", "ts_pacific",
                     F.date_format("ts_pacific", STAMP_FORMAT).alias("stamp"),
                     F.date_format("ts_pacific", "MM-yy").alias("month_folder"),
                     F.date_format("ts_pacific", "MMddyy").alias("day_suffix"))


_Q23_SQL = """
WITH p AS (SELECT event_id, timezone('America/Los_Angeles', timezone('UTC', ts)) AS ts_pacific FROM events)
SELECT event_id, ts_pacific, strftime(ts_pacific, '%Y-%m-%dT%H:%M:%S') AS stamp,
  strftime(ts_pacific, '%m-%y') AS month_folder, strftime(ts_pacific, '%m%d%y') AS day_suffix
FROM p"""


# ---------------------------------------------------------------- Q-24 ----
def landed_maturity(orders: DataFrame) -> DataFrame:
    e = F.expr
    return orders.select(
        e("concat('LN-', o_orderkey)").alias("Loan Number"),
        e("concat('Customer ', o_custkey)").alias("Borrower"),
        e("CASE WHEN o_orderstatus = 'P' THEN '' ELSE concat(o_orderkey, ' Oak St') END").alias("Property Address"),
        F.col("o_orderpriority").alias("Loan Program"),
        F.when(F.col("o_orderstatus") != "F", F.lit('  note "quoted",\nsecond line, ok \\" ')).alias("Pinned Note"),
        e("date_format(o_orderdate, 'MM/dd/yyyy')").alias("Loan Funded Date"),
        e("date_format(add_months(o_orderdate, 12), 'M/d/yyyy')").alias("Current Loan Due Date"))


def q24_dated_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 -> K1 at the K3 path under the shared checkpoint folder -> read
    back with the report's schema ('' and null both come back null)."""
    report = apply_spec(landed_maturity(table(spark, sf_dir, "orders")), MATURITY_DATES, AS_OF)
    root = scratch_path(spark, "reports")
    path = report_path(root, "maturity_dates", AS_OF, folder="loans")
    write_csv(report, path)
    return read_csv_report(spark, path, report.schema)


_Q24_SQL = f"""
SELECT 'LN-' || o_orderkey AS loan_number, 'Customer ' || o_custkey AS borrower,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey || ' Oak St' END AS property_address,
  o_orderpriority AS loan_program,
  CASE WHEN o_orderstatus <> 'F' THEN '  note "quoted",' || chr(10) || 'second line, ok \\" ' END AS pinned_note,
  o_orderdate AS loan_funded_date, CAST(o_orderdate + INTERVAL 12 MONTH AS TIMESTAMP) AS current_loan_due_date,
  '{AS_OF_PACIFIC_TEXT}' AS "timestamp"
FROM orders"""


QUERIES = {
    "cash_status_report": q01_cash_status_report,
    "exact_decimal_report": q02_exact_decimal_report,
    "half_even_round": q03_half_even_round,
    "bad_values_to_null": q04_bad_values_to_null,
    "latest_report_id": q05_latest_report_id,
    "dedupe_keep_first": q06_dedupe_keep_first,
    "extract_profile": q07_extract_profile,
    "combine_two_sources": q08_combine_two_sources,
    "combine_funded_sources": q08b_combine_funded_sources,
    "sorted_report": q09_sorted_report,
    "full_sorted_report": q09b_full_sorted_report,
    "expiring_in_30_days": q10_expiring_in_30_days,
    "two_month_transactions": q11_two_month_transactions,
    "draw_item_flatten": q12_draw_item_flatten,
    "draw_report": q13_draw_report,
    "core_value_patches": q14_core_value_patches,
    "upsert_dimension": q15_upsert_dimension,
    "payroll_flatten": q16_payroll_flatten,
    "open_case_anti_join": q17_open_case_anti_join,
    "draw_event_stream": q18_draw_event_stream,
    "draw_event_mail": q18b_draw_event_mail,
    "draw_create_mail": q18c_draw_create_mail,
    "draw_event_replay": q18d_draw_event_replay,
    "draw_event_reopen": q18e_draw_event_reopen,
    "xml_case_fields": q19_xml_case_fields,
    "xml_broken_messages": q19b_broken_messages,
    "surrogate_key": q20_surrogate_key,
    "label_membership": q21_label_membership,
    "append_without_blank_keys": q22_append_without_blank_keys,
    "pacific_stamp": q23_pacific_stamp,
    "dated_csv_roundtrip": q24_dated_csv_roundtrip,
}

ORACLE_SQL = {
    "cash_status_report": _q01_sql(),
    "exact_decimal_report": _Q02_SQL,
    "half_even_round": _Q03_SQL,
    "bad_values_to_null": _Q04_SQL,
    "latest_report_id": _Q05_SQL,
    "dedupe_keep_first": _Q06_SQL,
    "extract_profile": _Q07_SQL,
    "combine_two_sources": _q08_sql(False),
    "combine_funded_sources": _q08_sql(True),
    "sorted_report": _Q09_SQL,
    "full_sorted_report": _Q09B_SQL,
    "expiring_in_30_days": _q10_sql(),
    "two_month_transactions": _Q11_SQL,
    "draw_item_flatten": _Q12_ITEMS,
    "draw_report": _Q13_SQL,
    "core_value_patches": _Q14_SQL,
    "upsert_dimension": _Q15_SQL,
    "payroll_flatten": _Q16_SQL,
    "open_case_anti_join": _Q17_SQL,
    "draw_event_stream": _Q18_SQL,
    "draw_event_mail": _Q18B_SQL,
    "draw_create_mail": _Q18C_SQL,
    "draw_event_replay": _Q18D_SQL,
    "draw_event_reopen": _Q18E_SQL,
    "xml_case_fields": _Q19_SQL,
    "xml_broken_messages": _Q19B_SQL,
    "surrogate_key": _Q20_SQL,
    "label_membership": _Q21_SQL,
    "append_without_blank_keys": _Q22_SQL,
    "pacific_stamp": _Q23_SQL,
    "dated_csv_roundtrip": _Q24_SQL,
}
