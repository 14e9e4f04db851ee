"""Queries that land documents and tables first and read them back with the
library: Spark writes the driver's rows as the JSON, XML or table that the
services would leave, into the shared scratch folder, and the readers, plans
and table writes run on those.  Rows of a report land as many part documents,
so many tasks share one report."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmart.functions.numbers import to_double_strict
from loanmart.operators.dedupe import distinct_values
from loanmart.operators.latest import last_match, latest_report_id
from loanmart.operators.profile import duplicate_groups
from loanmart.operators.surrogate import add_surrogate_key
from loanmart.operators.upsert import duplicate_keys, rebucket, upsert_table
from loanmart.operators.validate import ValidationError, assert_pages_complete, error_documents, incomplete_pages, null_violations, observed_nulls, require_columns
from loanmart.plans import mart_queries as mart
from loanmart.plans.alerts import BUILDERS_RISK, FLOOD, HOMEOWNERS, MATURITY, expiring_cases
from loanmart.plans.draws import draw_events, draw_report, runs_of_days
from loanmart.plans.payroll import load_payroll, workers
from loanmart.plans.reports import CASH_STATUS, MATURITY_DATES, PORTFOLIO_FULL, loan_id_report, report_extract
from loanmart.plans.spec import apply_spec
from loanmart.plans.sync import core_value_patches
from loanmart.plans.transactions import transaction_report
from loanmart.session import scratch_path
from loanmart.sources import documents as docs
from loanmart.sources.sinks import append_outbox, append_table, create_table_if_absent, read_csv_report, replace_table, report_mail, report_path, write_csv
from loanmart.sources.tables import table, warehouse_table
from loanmart.streaming.case_messages import CASE_FIELDS, start_case_message_stream
from loanmart.streaming.draw_events import CASE_OUTBOX, read_event_files, start_draw_event_stream
from loanmart.streaming.history import first_within_watermark, late_rows, start_history_stream
from loanmart.streaming.outbox import read_outbox

#: Items of one landed document or page.
PART_ITEMS = 500


def land(df: DataFrame, path: str, *folders: str) -> None:
    """One JSON document per row, nulls included.  Headings come with every
    item, so the text is many times its table: files are compressed, and since
    one task reads each, of a bounded number of documents."""
    options = {"ignoreNullFields": "false", "compression": "lz4", "maxRecordsPerFile": "100000"}
    df.write.partitionBy(*folders).options(**options).json(path)


def landed(df: DataFrame, name: str) -> str:
    """The rows as documents in the shared scratch folder."""
    path = scratch_path(df.sparkSession, f"landed-{name}")
    land(df, path)
    return path


def parts(df: DataFrame, key: str, into: str) -> DataFrame:
    """The rows of ``df`` as arrays ``into``, PART_ITEMS per row: documents of a bounded size."""
    item = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != key])
    sized = df.select(item.alias("i"), F.col(key).alias("k"))
    return sized.groupBy(F.floor(F.col("k") / PART_ITEMS).alias("part")).agg(F.collect_list("i").alias(into)).select(into)


# ------------------------------------------------ report documents (S1, S2) --
def _landed_report(rows: DataFrame, key_expr: str, name: str, report: str) -> tuple[DataFrame, str]:
    """Landed part documents of a report's rows, under its newest id, and a catalogue."""
    spark = rows.sparkSession
    path = scratch_path(spark, "landed-reports")
    numbered = rows.withColumn("_k", F.expr(key_expr))
    inner = parts(numbered, "_k", "data")
    doc = inner.select(F.struct(F.struct(F.col("data")).alias("Current Report")).alias("data"))
    land(doc, f"{path}/10")
    catalogue = landed(spark.createDataFrame([("9", report), ("10", report), ("11", "another report")], "id string, name string"), "catalogue")
    return docs.read_catalogue(spark, catalogue, lines=True), path


def landed_cash_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As Q-01, from landed documents and a catalogue."""
    rows = mart.landed_cash_status(table(spark, sf_dir, "orders"))
    key = "coalesce(cast(substring(`Loan Number`, 4) as bigint), 0)"
    catalogue, path = _landed_report(rows, key, "cash", CASH_STATUS.name)
    return report_extract(spark, catalogue, path, CASH_STATUS, mart.AS_OF, lines=True, listed_only=True)


def landed_unknown_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 and G6 for a report whose columns are not known: per column how many
    rows have it, how many of them a value, and the longest one."""
    e = F.expr
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", e("concat('LN-', c_custkey)").alias("Loan Number"), e("CASE WHEN c_nationkey > 9 THEN concat('$ ', format_number(c_acctbal, 2)) END").alias("Loan Amount ($)"),
        F.col("c_name").alias("Borrower's Name"), F.col("c_mktsegment").alias("% Segment / Type"))
    spare = rows.where("c_custkey % 3 = 0").drop("Loan Amount ($)")  # documents without a column
    paths = [landed(parts(r, "c_custkey", "data").select(F.struct(F.struct("data").alias("Current Report")).alias("data")), "unknown") for r in (rows.where("c_custkey % 3 <> 0"), spare)]
    cells = docs.column_cells(docs.report_rows(spark, paths, lines=True))
    return cells.groupBy("column").agg(F.count("*").alias("rows"), F.count("value").alias("filled"), F.max(F.length("value")).cast("long").alias("longest"))


_UNKNOWN_SQL = """
WITH r AS (SELECT 'LN-' || c_custkey AS a, CASE WHEN c_nationkey > 9 THEN '$ ' || format('{:,.2f}', c_acctbal::DECIMAL(18,2)::DOUBLE) END AS b, c_name AS c, c_mktsegment AS d,
  c_custkey % 3 <> 0 AS whole FROM customer)
SELECT 'Loan Number' AS "column", count(*) AS rows, count(a) AS filled, max(length(a)) AS longest FROM r HAVING count(*) > 0
UNION ALL SELECT 'Loan Amount ($)', count(*), count(b), max(length(b)) FROM r WHERE whole HAVING count(*) > 0
UNION ALL SELECT 'Borrower''s Name', count(*), count(c), max(length(c)) FROM r HAVING count(*) > 0
UNION ALL SELECT '% Segment / Type', count(*), count(d), max(length(d)) FROM r HAVING count(*) > 0"""


# ------------------------------------------------------- full portfolio (R4) --
def _portfolio_rows(orders: DataFrame) -> DataFrame:
    e = F.expr
    price = "CAST(o_totalprice AS DECIMAL(18,2))"
    made = {c: e(f"concat(' ', '{c.replace(' ', '')}', '- ', o_orderstatus, ', ', o_orderpriority)") for c in PORTFOLIO_FULL.text}
    made |= {c: e(f"concat('$ ', format_number({price}, 2))") for c in PORTFOLIO_FULL.decimals}
    made |= {
        "% DISB": e(f"concat(CAST({price} * 0.001 AS STRING), ' %')"), "LTV": F.lit(""), "Zip": F.lit(None).cast("string"), "State": F.lit(" "),
        "CLTV": e("CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE '12.5' END"),
        "Loan Number": e("concat('LN-', o_orderkey)"), "Property Address": e("concat(o_orderkey, ' Oak St, Unit 1')"),
        "Loan Funded Date": e("date_format(o_orderdate, 'MM/dd/yyyy')"), "Current Loan Due Date": F.lit(""),
        "Original Loan Due Date": e("CASE WHEN o_orderstatus <> 'F' THEN date_format(date_add(o_orderdate, 30), 'M/d/yyyy') END"),
        "Loan Status Completed Date (Most Recent Change)": e("date_format(date_add(o_orderdate, 60), 'M/d/yyyy')")}
    rows = orders.select(*[made[c].alias(c) for c in PORTFOLIO_FULL.required()])
    totals = orders.groupBy("o_orderstatus").agg(F.count("*").cast("string").alias("Current Loan Amount")).drop("o_orderstatus")
    return rows.unionByName(totals, allowMissingColumns=True)


def portfolio_full_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 with D2 from landed documents, all of its columns."""
    rows = _portfolio_rows(table(spark, sf_dir, "orders"))
    catalogue, path = _landed_report(rows, "coalesce(cast(substring(`Loan Number`, 4) as bigint), 0)", "portfolio", PORTFOLIO_FULL.name)
    return report_extract(spark, catalogue, path, PORTFOLIO_FULL, mart.AS_OF, lines=True, listed_only=True)


# the report's columns and what they hold, in words of the oracle's own
_PORTFOLIO_TEXT = {
    "borrower_last_name": "BorrowerLastName", "loan_originator": "LoanOriginator", "loan_program": "LoanProgram", "loan_term_in_months": "LoanTerminMonths",
    "total_units": "TotalUnits", "investor": "Investor", "county": "County", "exception": "Exception", "current_loan_status": "CurrentLoanStatus",
    "additional_collateral_property": "AdditionalCollateralProperty", "funding_account": "FundingAccount", "outside_equity": "OutsideEquity"}
_PORTFOLIO_AMOUNTS = (
    "ltc", "as_permitted_ltv", "as_permitted_cltv", "current_interest_rate", "current_loan_amount", "total_principal_loan_paydown",
    "balance_to_finish_including_retainage", "appraised_value", "total_interest_reserve_amount_disbursed", "interest_reserve_balance",
    "collateral_holdback", "as_permitted_property_value")
_PORTFOLIO_SQL = f"""
SELECT 'LN-' || o_orderkey AS loan_number, o_orderkey || 'OakStUnit1' AS property_address, '' AS state, CAST(NULL AS VARCHAR) AS zip,
  {", ".join(f"'{text}-' || o_orderstatus || replace(o_orderpriority, ' ', '') AS {c}" for c, text in _PORTFOLIO_TEXT.items())},
  {", ".join(f"CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS {c}" for c in _PORTFOLIO_AMOUNTS)},
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.001 AS DECIMAL(38,18)) AS "%_disb", CAST(NULL AS DECIMAL(38,18)) AS ltv,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(12.5 AS DECIMAL(38,18)) END AS cltv,
  o_orderdate AS loan_funded_date, CAST(NULL AS TIMESTAMP) AS current_loan_due_date,
  CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderdate + INTERVAL 30 DAY AS TIMESTAMP) END AS original_loan_due_date,
  CAST(o_orderdate + INTERVAL 60 DAY AS DATE) AS loan_status_completed_date_most_recent_change, '{mart.AS_OF_PACIFIC_TEXT}' AS "timestamp"
FROM orders"""


# ------------------------------------------------ loan list, templates (S3, S4) --
def loan_id_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages of the loan list, active loans only."""
    e = F.expr
    loans = table(spark, sf_dir, "customer").select(
        "c_custkey", e("CAST(c_custkey AS STRING)").alias("id"), e("CASE WHEN c_nationkey > 2 THEN concat('LN ', c_custkey) END").alias("fileNumber"),
        e("CASE WHEN c_mktsegment = 'MACHINERY' THEN 'archive' ELSE 'active' END").alias("folder"),
        e("CASE WHEN c_acctbal < 0 THEN 'closed' ELSE 'active' END").alias("status"),
        e("CASE WHEN c_mktsegment <> 'BUILDING' THEN named_struct('firstName', CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN 'Jo Ann' END, 'lastName', c_name) END").alias("borrower"))
    path = landed(parts(loans, "c_custkey", "items").select(F.struct("items").alias("data")), "loans")
    return loan_id_report(docs.active_loans(docs.read_loan_list(spark, path, lines=True)), mart.AS_OF)


_LOAN_ID_SQL = f"""
SELECT CAST(c_custkey AS VARCHAR) AS land_gorilla_loan_id, 'LN ' || c_custkey AS loan_number,
  CASE WHEN c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE') THEN 'JoAnn' ELSE '' END AS first_name,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name ELSE '' END AS last_name_and_or_business, '{mart.AS_OF_PACIFIC_TEXT}' AS "timestamp"
FROM customer WHERE c_nationkey > 2 AND c_mktsegment <> 'MACHINERY' AND c_acctbal >= 0"""


def landed_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last template id of each name, by its place in the landed list."""
    orders = table(spark, sf_dir, "orders")
    item = F.struct(F.col("o_orderkey"), F.struct(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("name")).alias("i"))
    lists = orders.groupBy(F.pmod("o_custkey", F.lit(100)).alias("list"), F.floor(F.col("o_orderkey") / (PART_ITEMS * 100)).alias("part")).agg(F.sort_array(F.collect_list(item)).alias("x"))
    path = landed(lists.select(F.struct(F.col("x.i").alias("items")).alias("data")), "templates")
    last = last_match(docs.read_templates(spark, path, lines=True).withColumn("rank", F.struct(F.col("id").cast("long"), "pos")), ["name"], "id", "rank")
    return last.select("name", "id")


_TEMPLATE_SQL = "SELECT o_orderpriority AS name, CAST(max(o_orderkey) AS VARCHAR) AS id FROM orders GROUP BY 1"


# ----------------------------------------------------- transactions (S5, S6) --
def landed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts and one transaction document per account, landed;
    some accounts are not in the list, some ids are null."""
    e = F.expr
    customer = table(spark, sf_dir, "customer")
    listed = customer.where("c_mktsegment <> 'BUILDING'").select("c_custkey", e("CASE WHEN c_mktsegment <> 'MACHINERY' THEN CAST(c_custkey AS STRING) END").alias("id"))
    accounts = landed(parts(listed, "c_custkey", "items").select(F.struct("items").alias("data")), "accounts")
    tx = F.struct(e("concat('LN-', o_orderkey)").alias("loanNumber"), F.col("o_orderpriority").alias("transactionDescription"),
                  e("CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)").alias("debit"), e("CASE WHEN o_orderstatus = 'F' THEN '0.00' END").alias("credit"),
                  F.col("o_orderstatus").alias("paymentType"), e("date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")").alias("transactionCreatedDate"),
                  e("date_format(date_add(o_orderdate, 3), \"yyyy-MM-dd'T'HH:mm:ss\")").alias("transactionEffectiveDate"))
    pages = table(spark, sf_dir, "orders").groupBy("o_custkey", F.floor(F.col("o_orderkey") / PART_ITEMS).alias("page")).agg(F.collect_list(tx).alias("items"))
    path = landed(pages.select(F.col("o_custkey").cast("string").alias("account_id"), F.struct("items").alias("data")), "transactions")
    return transaction_report(docs.read_accounts(spark, accounts, lines=True), docs.read_transactions(spark, path, lines=True), mart.TX_AS_OF)


_TRANSACTION_SQL = mart._Q11_SQL.replace("SELECT c_custkey FROM customer", "SELECT c_custkey FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")


def transactions_without_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transaction report of a source that has neither credit nor
    effective date; the other listed fields come in their order."""
    orders = table(spark, sf_dir, "orders")
    accounts = orders.select(F.col("o_custkey").cast("string").alias("id"))
    tx = orders.select(F.col("o_orderstatus").alias("paymentType"), F.expr("CAST(o_custkey AS STRING)").alias("account_id"), F.lit("x").alias("unlisted"),
                       F.expr("date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\")").alias("transactionCreatedDate"), F.concat(F.lit("LN-"), "o_orderkey").alias("loanNumber"))
    return transaction_report(accounts, tx, mart.TX_AS_OF)


_FEW_FIELDS_SQL = f"""
SELECT 'LN-' || o_orderkey AS loanNumber, o_orderstatus AS paymentType, strftime(o_orderdate, '%m/%d/%y') AS transactionCreatedDate,
  '{mart.AS_OF_PACIFIC_TEXT.replace("2024-01-15T04:00:00", "1998-03-30T16:00:00")}' AS "timestamp"
FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-01-31' AND DATE '1998-03-31'"""


# ---------------------------------------------------- draw report (S7 to S10) --
def landed_draw_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As Q-13, from landed runs, loan fields and draw documents."""
    runs = _landed_runs(mart.runs_from_events(table(spark, sf_dir, "events")))
    loans = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("loan_id"), F.struct(F.struct(
        F.concat(F.lit("LN-"), F.col("c_custkey")).alias("loanNumber")).alias("fields")).alias("data"))
    loans = landed(loans, "loan-fields")
    drawn = landed(mart.nested_draws(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")), "draws")
    return draw_report(docs.read_runs(spark, runs, lines=True, by_day=True), docs.read_loan_fields(spark, loans, lines=True), docs.read_draws(spark, drawn, line_items_as_text=True, lines=True),
                       mart.DRAW_AS_OF, flow_ids=["draw-flow"])


def _landed_runs(runs: DataFrame) -> str:
    """Run documents in a folder for each UTC day of their start, one per line."""
    path = scratch_path(runs.sparkSession, "landed-runs")
    docs_of_day = runs.select("id", "flow_id", "state_type", F.date_format(F.col("start_time"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("start_time"),
                              F.struct("draw_id", "loan_id", "updated_status").alias("parameters"), F.to_date("start_time").alias("day"))
    land(docs_of_day, path, "day")
    return path


def history_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 landed by day: events of the day of the draw report, whose folder
    alone is read, and the runs of the days on which something failed, whose
    folders are found at run time."""
    path = _landed_runs(mart.runs_from_events(table(spark, sf_dir, "events")))
    runs = docs.read_runs(spark, path, lines=True, by_day=True)
    of_day = draw_events(runs, mart.DRAW_AS_OF, flow_ids=["draw-flow"]).select(F.lit("day").alias("kind"), "draw_id", "updated_status")
    busy = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.to_date("o_orderdate").alias("day"))
    counts = runs_of_days(runs, busy).groupBy("day").agg(F.count("*").alias("n"))
    return of_day.withColumn("n", F.lit(1).cast("long")).unionByName(counts.select(F.lit("busy").alias("kind"), F.col("day").cast("string").alias("draw_id"), "n"), allowMissingColumns=True)


_HISTORY_OF_DAYS_SQL = f"""
SELECT DISTINCT 'day' AS kind, CAST(user_id AS VARCHAR) AS draw_id, event_type AS updated_status, 1::BIGINT AS n FROM events
WHERE ts >= CAST('{mart.DRAW_AS_OF}' AS DATE) - INTERVAL 1 DAY AND ts < CAST('{mart.DRAW_AS_OF}' AS DATE) AND event_type NOT IN ('error', 'view')
UNION ALL
SELECT 'busy', CAST(CAST(ts AS DATE) AS VARCHAR), NULL, count(*) FROM events
WHERE CAST(ts AS DATE) IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'P') GROUP BY CAST(ts AS DATE)"""


# -------------------------------------------------- payroll (S11 to S13, K5, K7) --
def workers_of_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Worker pages landed in a folder for each company; the pages of
    two companies are read, complete, and no others."""
    _, pages, _ = mart.payroll_documents(table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"))
    path = scratch_path(spark, "landed-pages")
    land(pages, path, "companyId")
    some = docs.read_worker_pages(spark, path, lines=True, company_ids=["3", "14"])
    assert_pages_complete(some, ["companyId"])
    return workers(some).select("id", "employee_id", "last_name", "company_id")


_WORKERS_OF_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS id, 'E' || c_custkey AS employee_id, CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN c_name END AS last_name,
  CAST(c_nationkey AS VARCHAR) AS company_id FROM customer WHERE c_nationkey IN (3, 14)"""


def payroll_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages, loaded twice into real
    tables (the second time with other names), read back joined."""
    schema = f"payroll_{uuid.uuid4().hex}"
    customer = table(spark, sf_dir, "customer").where("c_mktsegment <> 'AUTOMOBILE'")
    for shown in (customer.where("c_nationkey < 20"), customer.withColumn("c_name", F.concat("c_name", F.lit("!")))):
        cd, wp, cm = mart.payroll_documents(table(spark, sf_dir, "nation"), shown, table(spark, sf_dir, "orders"))
        cd, wp, cm = landed(cd, "companies"), landed(wp, "workers"), landed(cm, "communications")
        load_payroll(spark, docs.read_companies(spark, cd, lines=True), docs.read_worker_pages(spark, wp, lines=True), docs.read_communications(spark, cm, lines=True), schema)
    w, m = warehouse_table(spark, f"{schema}.workers"), warehouse_table(spark, f"{schema}.email_addresses")
    out = m.join(w.select(F.col("id").alias("worker_id"), "employee_id", "last_name"), "worker_id", "left")
    companies = warehouse_table(spark, f"{schema}.companies").select(F.col("company_id").alias("id"), F.col("legal_name").alias("last_name"), F.lit("COMPANY").alias("type"))
    return out.unionByName(companies, allowMissingColumns=True)


_PAYROLL_SQL = """
SELECT CAST(o_custkey AS VARCHAR) AS worker_id, CAST(o_orderkey AS VARCHAR) AS id,
  CASE WHEN o_orderstatus = 'F' THEN 'PERSONAL' ELSE 'BUSINESS' END AS type, lower('C' || o_orderkey || '@Example.COM') AS email,
  'E' || c_custkey AS employee_id, c_name || '!' AS last_name
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'AUTOMOBILE') ON o_custkey = c_custkey
WHERE o_orderpriority NOT IN ('2-HIGH', '3-MEDIUM')
UNION ALL SELECT NULL, CAST(n_nationkey AS VARCHAR), 'COMPANY', NULL, NULL, n_name FROM nation"""


# ----------------------------------------------------------- table writes (K*) --
def append_table_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads into one table, created by the first, which
    is run again as after a failure; read back."""
    name = f"loans_{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "customer").select(
        F.expr("CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '' WHEN 'MACHINERY' THEN NULL ELSE concat('LN-', c_custkey) END").alias("loan_number"), "c_nationkey")
    for _ in range(2):
        append_table(spark, rows.where("c_nationkey < 10"), name, mart.AS_OF)
    append_table(spark, rows.where("c_nationkey >= 5"), name, mart.DRAW_AS_OF)
    return warehouse_table(spark, name)


_APPEND_SQL = f"""
WITH r AS (SELECT CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '' WHEN 'MACHINERY' THEN NULL ELSE 'LN-' || c_custkey END AS loan_number, c_nationkey FROM customer)
SELECT loan_number, c_nationkey, TIMESTAMP '{mart.AS_OF}' AS upload_date FROM r WHERE c_nationkey < 10 AND (loan_number IS NULL OR loan_number <> '')
UNION ALL
SELECT loan_number, c_nationkey, TIMESTAMP '{mart.DRAW_AS_OF}' FROM r WHERE c_nationkey >= 5 AND (loan_number IS NULL OR loan_number <> '')"""


def upsert_table_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made by DDL, loaded, then updated and extended in
    the buckets that the second load touches, laid out anew, and updated again."""
    name = f"customers_{uuid.uuid4().hex}"
    customer = table(spark, sf_dir, "customer")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in customer.schema.fields)
    create_table_if_absent(spark, f"{name}_empty", ddl)
    upsert_table(spark, name, customer.where("c_nationkey <> 3"), ["c_custkey"], ddl=ddl)
    changed = customer.where("c_nationkey IN (3, 4)").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    upsert_table(spark, name, changed.where("c_nationkey = 3"), ["c_custkey"])
    rebucket(spark, name, ["c_custkey"], 24)
    upsert_table(spark, name, changed, ["c_custkey"])
    return warehouse_table(spark, name).unionByName(warehouse_table(spark, f"{name}_empty"))


_UPSERT_SQL = """SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_nationkey IN (3, 4) THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer"""


def case_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1-A4 into the case outbox table (K8), two days in a row, the first day
    twice as after a failure, and core
    values read from a table (S15, S20) as PATCH rows (K9) beside them."""
    name = f"outbox_{uuid.uuid4().hex}"
    loans = mart.landed_active_loans(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))
    for day in (mart.ALERT_AS_OF, mart.ALERT_AS_OF, mart.ALERT_AS_OF + _dt.timedelta(days=1)):
        cases = expiring_cases(loans, (MATURITY, BUILDERS_RISK, FLOOD, HOMEOWNERS), day).select("Reason", "Loan_Number__c")
        append_outbox(cases, f"{name}_cases", day.isoformat())
    e = F.expr
    raw = table(spark, sf_dir, "customer").select("c_custkey", "c_name", e("concat('CS-', c_custkey)").alias("a"), F.col("c_mktsegment").alias("b"),
                                                  e("1").alias("c"), e("2").alias("d"), e("CAST(NULL AS STRING)").alias("f"))
    append_outbox(raw, f"{name}_core", "1")
    append_outbox(table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("lg_loan_id")), f"{name}_existing", "1")
    append_outbox(core_value_patches(warehouse_table(spark, f"{name}_core"), warehouse_table(spark, f"{name}_existing")), f"{name}_patches", "1")
    cases = warehouse_table(spark, f"{name}_cases").select(F.lit("case").alias("kind"), F.col("Reason").alias("what"), F.col("Loan_Number__c").alias("target"))
    patches = warehouse_table(spark, f"{name}_patches").select(F.lit("patch").alias("kind"), F.get_json_object("body", "$.coreSystemLoanBalanceLastUpdated").alias("what"), F.col("target_id").alias("target"))
    return cases.unionByName(patches)


_CASE_OUTBOX_SQL = f"""
WITH d AS (SELECT unnest([DATE '{mart.ALERT_AS_OF}', DATE '{mart.ALERT_AS_OF}' + 1]) AS day),
a AS (SELECT unnest([0, 10, 20, -5]) AS shift, unnest(['Maturity Date: Expires in 30 days', 'Builder''s risk Insurance: Expires in 30 days',
  'Flood Insurance: Expires in 30 days', 'Homeowners Insurance: Expires in 30 days']) AS reason)
SELECT 'case' AS kind, reason AS what, 'LN-' || o_orderkey AS target FROM orders, d, a
WHERE date_diff('day', CAST(day AS DATE), CAST(o_orderdate AS DATE) + shift) = 30 AND (shift <> 20 OR o_orderstatus <> 'P')
UNION ALL
SELECT 'patch', NULL, CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)"""


def csv_no_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report named with the time of day; a second write to the same
    path is refused and leaves the first as it is; the mail row names the file."""
    root = scratch_path(spark, "reports")
    path = report_path(root, "transactions", mart.AS_OF, with_time=True)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    write_csv(orders, path, overwrite=False)
    try:
        write_csv(orders.limit(1), path, overwrite=False)
        refused = False
    except Exception as error:  # the refusal of the writer, nothing else
        if "PATH_ALREADY_EXISTS" not in str(error):
            raise
        refused = True
    mail = report_mail(spark, "Transactions", "attached", path)
    rows = spark.read.option("header", True).schema("o_orderkey long, o_orderstatus string").csv(path)
    sums = rows.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys")).withColumn("refused", F.lit(refused))
    return sums.unionByName(mail.select("subject", F.substring_index("attachment_path", "/", -2).alias("attachment")), allowMissingColumns=True)


_CSV_SQL = """
SELECT o_orderstatus, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, true AS refused, NULL AS subject, NULL AS attachment FROM orders GROUP BY 1
UNION ALL SELECT NULL, NULL, NULL, NULL, 'Transactions', '01-24/transactions_011524_120000.csv'"""


def dated_csv_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maturity report as one file at its dated path,
    written by many tasks, overwritten once, read back with its schema; the
    rows and nulls seen while it was written beside what the file holds."""
    report = apply_spec(mart.landed_maturity(table(spark, sf_dir, "orders")), MATURITY_DATES, mart.AS_OF)
    path = report_path(scratch_path(spark, "reports"), "maturity_dates", mart.AS_OF, folder="loans")
    write_csv(report.limit(1), path, single_file=True)
    watched, seen = observed_nulls(report)
    write_csv(watched, path, single_file=True)
    back = read_csv_report(spark, path, report.schema)
    nulls = seen.nulls()
    told = spark.createDataFrame([("seen", seen.rows, nulls.get("pinned_note", 0)), ("/".join(path.split("/")[-2:]), 1, None)], "loan_number string, n long, nulls long")
    file = spark.read.text(path).select(F.input_file_name().alias("f")).distinct().agg(F.count("*").alias("n")).select(F.lit("files").alias("loan_number"), "n")
    return back.unionByName(told, allowMissingColumns=True).unionByName(file, allowMissingColumns=True)


_CSV_FILE_SQL = f"""
SELECT *, NULL::BIGINT AS n, NULL::BIGINT AS nulls FROM ({mart._Q24_SQL})
UNION ALL BY NAME SELECT 'seen' AS loan_number, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS nulls FROM orders
UNION ALL BY NAME SELECT '01-24/maturity_dates_011524.csv' AS loan_number, 1 AS n
UNION ALL BY NAME SELECT 'files' AS loan_number, 1 AS n"""


def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of other columns, created or replaced by its fixed
    DDL, filled with rows that number themselves."""
    name = f"kept_{uuid.uuid4().hex}"
    customer = table(spark, sf_dir, "customer")
    customer.select("c_name").write.saveAsTable(name)
    replace_table(spark, name, "unique_id BIGINT, loan_number STRING NOT NULL, borrower STRING")
    rows = customer.select(F.concat(F.lit("LN-"), F.lpad(F.col("c_custkey").cast("string"), 12, "0")).alias("loan_number"), F.col("c_name").alias("borrower"))
    add_surrogate_key(rows, ["loan_number"], "unique_id").select("unique_id", "loan_number", "borrower").write.insertInto(name)
    return warehouse_table(spark, name)


_REPLACED_SQL = """
SELECT row_number() OVER (ORDER BY c_custkey) AS unique_id, 'LN-' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS loan_number, c_name AS borrower FROM customer"""


# ------------------------------------------------------------ streams (S16-S18) --
def landed_draw_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Webhook calls and open cases landed as JSON, then the stream."""
    loans, draws, _ = mart._draw_lookups(spark, sf_dir)
    calls = landed(mart._draw_calls(table(spark, sf_dir, "events")), "calls")
    cases = landed(table(spark, sf_dir, "customer").select(F.expr("concat('LN-', c_custkey)").alias("Loan_Number__c"), F.expr("CAST(c_custkey AS STRING)").alias("Draw_ID__c"),
                                                           F.expr("CASE WHEN c_mktsegment = 'BUILDING' THEN 'New' ELSE 'Closed' END").alias("Status")), "cases")
    root = scratch_path(spark, "landed-stream")
    q = start_draw_event_stream(spark, read_event_files(spark, calls), loans, draws, lambda: docs.read_open_cases(spark, cases, lines=True), f"{root}/cases", f"{root}/mails", f"{root}/checkpoint")
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return read_outbox(spark, f"{root}/cases", CASE_OUTBOX).select("case_hash", "Subject", "Draw_ID__c", "Borrower__c")


_DRAW_STREAM_SQL = mart._Q18_SQL.replace("SELECT * FROM cand", "SELECT case_hash, Subject, Draw_ID__c, Borrower__c FROM cand")


def landed_case_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The XML messages of all customers landed one behind the
    other in large files, which the stream's tasks share, cut into messages
    and read into the mail and the error outbox."""
    root = scratch_path(spark, "landed-messages")
    mart.case_messages(table(spark, sf_dir, "customer")).write.option("lineSep", " ").text(f"{root}/in")
    return _message_outboxes(spark, root, f"{root}/in", end_tag=docs.XML_END)


def landed_all_case_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The XML messages of all customers landed one per line, read as
    a stream into the mail and the error outbox."""
    root = scratch_path(spark, "landed-all-messages")
    mart.case_messages(table(spark, sf_dir, "customer")).write.text(f"{root}/in")
    return _message_outboxes(spark, root, f"{root}/in")


def _message_outboxes(spark: SparkSession, root: str, path: str, end_tag: str | None = None) -> DataFrame:
    q = start_case_message_stream(spark, path, f"{root}/mail", f"{root}/error", f"{root}/checkpoint", whole_files=False, end_tag=end_tag)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    mails = read_outbox(spark, f"{root}/mail", ", ".join(f"{n} string" for n, _, _ in CASE_FIELDS) + ", position int, subject string, body string")
    errors = read_outbox(spark, f"{root}/error", "xml string")
    batch = docs.read_xml_messages(spark, path, whole_files=False, end_tag=end_tag)
    counts = [df.agg(F.lit(kind).alias("subject"), F.count("*").cast("int").alias("position")) for kind, df in (("broken", errors), ("landed", batch))]
    return mails.select("notification_id", "case_number", "position", "subject").unionByName(counts[0], allowMissingColumns=True).unionByName(counts[1], allowMissingColumns=True)


_MESSAGES_SQL = """
SELECT 'N-' || c_custkey AS notification_id, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS case_number, 0 AS position, ' SF CASE: ' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS subject
FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
UNION ALL SELECT 'N2-' || c_custkey, NULL, 1, ' SF CASE: None' FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT NULL, NULL, CAST(count(*) AS INTEGER), 'broken' FROM customer WHERE c_mktsegment = 'HOUSEHOLD'
UNION ALL SELECT NULL, NULL, CAST(count(*) AS INTEGER), 'landed' FROM customer"""


def history_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5 as a stream over all events: the newest event of each user and kind."""
    root = scratch_path(spark, "history")
    events = spark.readStream.schema(table(spark, sf_dir, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    q = start_history_stream(spark, events, ["user_id", "event_type"], "event_id", "ts", _dt.timedelta(days=1), f"{root}/out", f"{root}/late", f"{root}/checkpoint")
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return read_outbox(spark, f"{root}/out", table(spark, sf_dir, "events").schema).drop("batch_id")


_HISTORY_SQL = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1"""


def history_keys_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5 in Spark's state store: the keys of all landed events, each once; a
    replay of those older than the watermark, landed later, is dropped and counted."""
    root = scratch_path(spark, "history-keys")
    events = table(spark, sf_dir, "events")
    delay, keys, late = _dt.timedelta(days=1), ["user_id", "event_type"], 0
    newest = events.agg(F.max("ts")).first()[0]
    old = F.col("ts") < F.lit((newest - 2 * delay).isoformat(sep=" ")).cast(events.schema["ts"].dataType)
    for landing in (events, events.where(old)):
        landing.write.mode("append").parquet(f"{root}/in")
        stream = first_within_watermark(spark.readStream.schema(events.schema).parquet(f"{root}/in"), keys, "ts", delay)
        q = stream.select(*keys).writeStream.trigger(availableNow=True).option("checkpointLocation", f"{root}/checkpoint").start(f"{root}/out", format="parquet")
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        late += late_rows(q)
    return spark.read.parquet(f"{root}/out").select(*keys, F.lit(1).cast("long").alias("n")).unionByName(
        spark.createDataFrame([("late", late)], "event_type string, n long"), allowMissingColumns=True)


_HISTORY_KEYS_SQL = """
SELECT DISTINCT user_id, event_type, 1::BIGINT AS n FROM events
UNION ALL SELECT NULL, 'late', count(*) FROM events WHERE ts < (SELECT max(ts) FROM events) - INTERVAL 2 DAY"""


# ---------------------------------------------------------- checks that fail (V*) --
def failing_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1-V6 on inputs that break them: what each check names, as rows."""
    customer = table(spark, sf_dir, "customer")
    nulls = null_violations(customer.select(F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), F.col("c_name").alias("name")), ["segment", "name"])
    keys = duplicate_keys(table(spark, sf_dir, "orders"), ["o_custkey"])
    _, pages, _ = mart.payroll_documents(table(spark, sf_dir, "nation"), customer, table(spark, sf_dir, "orders"))
    short = pages.withColumn("content", F.expr("CASE WHEN cast(companyId AS INT) % 5 = 0 THEN slice(content, 1, size(content) - 1) ELSE content END"))
    bad = incomplete_pages(short, ["companyId"])
    failed = pages.withColumn("error", F.expr("CASE WHEN companyId = '7' THEN 'denied' END")).withColumn("error_description", F.lit("no token"))
    told = []
    for check, error, run in (("V1", ValidationError, lambda: require_columns(customer, ["c_name", "loan_id"])),
                              ("V6", LookupError, lambda: latest_report_id(customer.select(F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("id")), "no such report"))):
        try:
            run()
        except error as failure:
            told.append((check, str(failure), 1))
    rows = [spark.createDataFrame(told, "check string, what string, n long"),
            nulls.select(F.lit("V2").alias("check"), F.col("column").alias("what"), F.col("nulls").alias("n")),
            keys.select(F.lit("V3").alias("check"), F.col("o_custkey").cast("string").alias("what"), F.col("n")),
            bad.select(F.lit("V4").alias("check"), F.col("companyId").alias("what"), (F.col("want") - F.col("got") > 0).cast("long").alias("n")),
            error_documents(failed).groupBy(F.lit("V5").alias("check"), F.concat_ws(": ", "error", "error_description").alias("what")).agg(F.count("*").alias("n"))]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


_CHECKS_SQL = """
SELECT 'V1' AS "check", 'missing required columns: [''loan_id'']' AS what, 1::BIGINT AS n
UNION ALL SELECT 'V6', 'no report named ''no such report'' in the catalogue', 1
UNION ALL SELECT 'V2' AS "check", 'segment' AS what, count(*) AS n FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT 'V3', CAST(o_custkey AS VARCHAR), count(*) FROM orders GROUP BY o_custkey HAVING count(*) > 1
UNION ALL SELECT 'V4', CAST(c_nationkey AS VARCHAR), 1 FROM customer WHERE c_nationkey % 5 = 0 GROUP BY c_nationkey
UNION ALL SELECT 'V5', 'denied: no token', count(DISTINCT floor(c_custkey / 50)) FROM customer WHERE c_nationkey = 7 HAVING count(*) > 0"""


def duplicate_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fully repeated rows, each once, with their number."""
    return duplicate_groups(table(spark, sf_dir, "events").select("user_id", "event_type"))


_LISTING_SQL = "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL HAVING count(*) > 1"


def distinct_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct non-null amounts, as text, to doubles that must parse."""
    text = table(spark, sf_dir, "lineitem").select(F.expr("CASE WHEN l_linenumber < 6 THEN CAST(CAST(l_quantity AS DECIMAL(18,2)) AS STRING) END").alias("q"))
    return distinct_values(text, "q").select("q", to_double_strict("q").alias("value"))


_STRICT_SQL = """
SELECT DISTINCT CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS q, CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS value
FROM lineitem WHERE l_linenumber < 6"""

QUERIES = {
    "landed_cash_status": landed_cash_status,
    "landed_unknown_report": landed_unknown_report,
    "history_of_days": history_of_days,
    "workers_of_companies": workers_of_companies,
    "portfolio_full_report": portfolio_full_report,
    "loan_id_list": loan_id_list,
    "landed_templates": landed_templates,
    "landed_transactions": landed_transactions,
    "transactions_without_fields": transactions_without_fields,
    "landed_draw_report": landed_draw_report,
    "payroll_tables": payroll_tables,
    "append_table": append_table_twice,
    "upsert_table_twice": upsert_table_twice,
    "case_outbox": case_outbox,
    "csv_no_overwrite": csv_no_overwrite,
    "dated_csv_file": dated_csv_file,
    "replaced_table": replaced_table,
    "landed_draw_stream": landed_draw_stream,
    "landed_case_messages": landed_case_messages,
    "landed_all_case_messages": landed_all_case_messages,
    "history_stream": history_stream,
    "history_keys_stream": history_keys_stream,
    "failing_checks": failing_checks,
    "duplicate_listing": duplicate_listing,
    "distinct_strict": distinct_strict,
}

ORACLE_SQL = {
    "landed_cash_status": mart.ORACLE_SQL["cash_status_report"],
    "landed_unknown_report": _UNKNOWN_SQL,
    "history_of_days": _HISTORY_OF_DAYS_SQL,
    "workers_of_companies": _WORKERS_OF_SQL,
    "portfolio_full_report": _PORTFOLIO_SQL,
    "loan_id_list": _LOAN_ID_SQL,
    "landed_templates": _TEMPLATE_SQL,
    "landed_transactions": _TRANSACTION_SQL,
    "transactions_without_fields": _FEW_FIELDS_SQL,
    "landed_draw_report": mart.ORACLE_SQL["draw_report"],
    "payroll_tables": _PAYROLL_SQL,
    "append_table": _APPEND_SQL,
    "upsert_table_twice": _UPSERT_SQL,
    "case_outbox": _CASE_OUTBOX_SQL,
    "csv_no_overwrite": _CSV_SQL,
    "dated_csv_file": _CSV_FILE_SQL,
    "replaced_table": _REPLACED_SQL,
    "landed_draw_stream": _DRAW_STREAM_SQL,
    "landed_case_messages": _MESSAGES_SQL,
    "landed_all_case_messages": _MESSAGES_SQL,
    "history_stream": _HISTORY_SQL,
    "history_keys_stream": _HISTORY_KEYS_SQL,
    "failing_checks": _CHECKS_SQL,
    "duplicate_listing": _LISTING_SQL,
    "distinct_strict": _STRICT_SQL,
}
