"""Pipeline goldens on hand-written landed documents (FIXTURES.md A/B):
report specs, two-system combine, alerts, transactions, draw report,
payroll load and core-value sync."""

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loanmart.plans.alerts import BUILDERS_RISK, FLOOD, MATURITY, expiring_cases
from loanmart.plans.draws import draw_report
from loanmart.plans.lip import combine_lip
from loanmart.plans.payroll import email_addresses, load_payroll, workers
from loanmart.plans.reports import CASH_STATUS, LOAN_IDS, WATCHLIST, report_extract
from loanmart.plans.spec import apply_spec
from loanmart.plans.sync import core_value_patches
from loanmart.plans.transactions import transaction_report
from loanmart.sources.documents import (
    read_catalogue, read_communications, read_companies, read_loan_fields, read_loan_list,
    read_report_document, read_runs, read_draws, read_worker_pages, report_rows_schema,
)

AS_OF = dt.datetime(2024, 1, 15, 12, 0)


def write_json(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(obj, f)


def cash_row(**kw):
    row = {c: "x" for c in CASH_STATUS.required()}
    for c in CASH_STATUS.decimals:
        row[c] = "$ 1.00"
    for c in CASH_STATUS.timestamps:
        row[c] = "01/02/2024"
    row.pop("Builders Risk Insurance Expiration")
    row["Builder's Risk Insurance Expiration"] = "01/02/2024"
    row.update(kw)
    return row


def test_cash_status_report_end_to_end(spark, tmpdir_path):
    root = f"{tmpdir_path}/reports"
    write_json(f"{root}/catalogue.json", [
        {"id": "9", "name": "Capital Cash Status -  Combined"}, {"id": "10", "name": "Capital Cash Status -  Combined"},
        {"id": "11", "name": "Maturity Dates"}])
    rows = [
        cash_row(**{"Loan Number": "LN1", "Current Loan Amount": "$ 1,234.50", "LTV": "12.5 %",
                    "Appraised Value": "1.00005", "Collateral Holdback": "1.00015", "Interest Reserve Balance": "abc",
                    "Loan Funded Date": "", "Property Address": None, "Extra": "kept"}),
        cash_row(**{"Loan Number": "", "Total Units": "3"}),
        cash_row(**{"Loan Number": None, "Current Loan Amount": "$ 99,999.00"}),
    ]
    write_json(f"{root}/10/doc.json", {"data": {"Current Report": {"data": rows}}})
    out = report_extract(spark, read_catalogue(spark, f"{root}/catalogue.json"), root, CASH_STATUS, AS_OF)
    got = {r.loan_number: r for r in out.collect()}
    assert set(got) == {"LN1", ""}
    r = got["LN1"]
    assert r.current_loan_amount == Decimal("1234.5000") and r.ltv == Decimal("12.5000")
    assert r.appraised_value == Decimal("1.0000") and r.collateral_holdback == Decimal("1.0002")
    assert r.interest_reserve_balance is None and r.loan_funded_date is None
    assert r.builders_risk_insurance_expiration == dt.datetime(2024, 1, 2)
    assert r.property_address is None and r.Extra == "kept" and r.timestamp == "2024-01-15T04:00:00"
    assert "%_disb" in out.columns


def test_watchlist_cleans_names_and_parses_raw_dates(spark):
    cols = list(dict.fromkeys(WATCHLIST.required()))
    row = {c: "1" for c in cols}
    row.update({"Loan Number": "L 1", "Property Address": "12 Oak St, Unit 4", "Loan Funded Date": "1/2/2024",
                "Estimated Payoff Date": None, "Current Loan Due Date": "1/3/2024", "Original Loan Due Date": "",
                "Current Loan Amount": "$ 1,000.123456", "% DISB": "nan"})
    df = spark.createDataFrame([tuple(row[c] for c in cols)], ", ".join(f"`{c}` string" for c in cols))
    r = apply_spec(df, WATCHLIST).first()
    assert r.loan_number == "L1" and r.property_address == "12OakStUnit4"
    assert r.current_loan_amount == Decimal("1000.123456") and r["%_disb"] is None
    assert r.loan_funded_date == dt.datetime(2024, 1, 2) and r.original_loan_due_date is None


def test_missing_listed_column_fails(spark):
    df = spark.createDataFrame([("1",)], "`Loan Number` string")
    with pytest.raises(ValueError, match="lacks columns"):
        apply_spec(df, WATCHLIST)


def test_loan_id_list_from_nested_items(spark, tmpdir_path):
    write_json(f"{tmpdir_path}/loans/p1.json", {"data": {"items": [
        {"id": "101", "fileNumber": "F 1", "borrower": {"firstName": "Ann Marie", "lastName": "Lee"}},
        {"id": "102", "fileNumber": "F2"}]}})
    items = read_loan_list(spark, f"{tmpdir_path}/loans")
    landed = items.select(F.col("id").alias("Land Gorilla Loan ID"), F.col("fileNumber").alias("Loan Number"),
                          F.coalesce("borrower.firstName", F.lit("")).alias("First Name"),
                          F.coalesce("borrower.lastName", F.lit("")).alias("Last Name / Business"))
    got = sorted(tuple(r) for r in apply_spec(landed, LOAN_IDS).collect())
    assert got == [("101", "F 1", "AnnMarie", "Lee"), ("102", "F2", "", "")]


def test_combine_two_systems(spark):
    from loanmart.plans.lip import A_COLUMNS, B_COLUMNS, B_RENAMES
    inv = {v: k for k, v in B_RENAMES.items()}
    a_row = {c: None for c in A_COLUMNS}
    a_row.update({"LOAN_NUMBER": "ab1", "CLOSING_DATE": "2024-02-01", "FUND": "F2", "LIEN_POSITION": "First Lien",
                  "LOAN_AMOUNT": "null", "NOTES": "null", "POINTS": "1.5"})
    a2 = dict(a_row, LOAN_NUMBER="ab2", CLOSING_DATE=None, FUND="F1")
    a3 = dict(a_row, LOAN_NUMBER="ab3", CLOSING_DATE="2024-02-01", FUND=None)
    b_row = {inv.get(c, c): None for c in B_COLUMNS}
    b_row.update({"LOAN_NUMBER": "b1", "EST_CLOSING_DATE": "1/15/2024", "LGC_FUND_SOURCE": "F9",
                  "TOTAL_LOAN_AMOUNT": "250000", "LIEN_POSITION": "Second"})
    a = spark.createDataFrame([tuple(r[c] for c in A_COLUMNS) for r in (a_row, a2, a3)],
                              ", ".join(f"{c} string" for c in A_COLUMNS))
    bcols = list(b_row)
    b = spark.createDataFrame([tuple(b_row[c] for c in bcols)], ", ".join(f"{c} string" for c in bcols))
    out = combine_lip(a, b, AS_OF).collect()
    assert [r.LOAN_NUMBER for r in out] == ["B1", "AB1", "AB3", "AB2"]
    first = out[1]
    assert first.LIEN_POSITION == "First" and first.LOAN_AMOUNT is None and first.NOTES is None
    assert first.POINTS == 1.5 and out[0].LOAN_AMOUNT == 250000.0 and out[0].TBD is None


def test_alerts_exactly_30_days(spark):
    rows = [("L29", "2/13/2024"), ("L30", "2/14/2024"), ("L30b", "02/14/2024"), ("L31", "2/15/2024"), ("Lnull", None)]
    df = spark.createDataFrame([(n, f"{n} St", "Ann" if n != "L30b" else None, "Lee", d, d, d) for n, d in rows],
                               "`Loan Number` string, `Property Address` string, `Borrower First Name` string, "
                               "`Borrower Last Name` string, `Current Loan Due Date` string, "
                               "`Builder's Risk Insurance Expiration` string, `Flood Insurance Expiration Date` string")
    m = expiring_cases(df, MATURITY, dt.date(2024, 1, 15)).collect()
    assert sorted(r.Loan_Number__c for r in m) == ["L30", "L30b"]
    by = {r.Loan_Number__c: r for r in m}
    assert by["L30"].Borrower__c == "Ann Lee" and by["L30b"].Borrower__c is None
    assert by["L30"].Subject == "Maturity date expiring in 30 days for loan number: L30"
    assert len(expiring_cases(df, BUILDERS_RISK, dt.date(2024, 1, 15)).collect()) == 2
    bad = df.withColumn("Flood Insurance Expiration Date", F.lit("soon"))
    assert expiring_cases(bad, FLOOD, dt.date(2024, 1, 15)).count() == 0


def test_transactions_two_calendar_months(spark):
    acc = spark.createDataFrame([("A1",), (None,)], "id string")
    tx = spark.createDataFrame([
        ("A1", "L1", "d", "1", None, "p", "2024-01-31T10:00:00.000Z", "2024-02-01T00:00:00"),
        ("A1", "L2", "d", "1", None, "p", "2024-01-30T23:59:59.000Z", "2024-02-01T00:00:00"),
        ("A2", "L3", "d", "1", None, "p", "2024-03-01T00:00:00.000Z", "2024-03-02T00:00:00"),
        ("A1", "L4", "d", "1", None, "p", "2024-03-31T08:00:00.000Z", "2024-04-02T00:00:00"),
    ], "account_id string, loanNumber string, transactionDescription string, debit string, credit string, "
       "paymentType string, transactionCreatedDate string, transactionEffectiveDate string")
    got = sorted((r.loanNumber, r.transactionCreatedDate, r.transactionEffectiveDate)
                 for r in transaction_report(acc, tx, dt.date(2024, 3, 31)).collect())
    assert got == [("L1", "01/31/24", "02/01/24"), ("L4", "03/31/24", "04/02/24")]


def test_draw_report_from_landed_history(spark, tmpdir_path):
    runs = [
        {"id": "r1", "state_type": "COMPLETED", "start_time": "2024-01-15T00:00:00Z",
         "parameters": {"draw_id": "11", "loan_id": "L1", "updated_status": "Draw Submit"}},
        {"id": "r2", "state_type": "COMPLETED", "start_time": "2024-01-15T10:00:00Z",
         "parameters": {"draw_id": "11", "loan_id": "L1", "updated_status": "Draw Submit"}},
        {"id": "r3", "state_type": "FAILED", "start_time": "2024-01-15T11:00:00Z",
         "parameters": {"draw_id": "12", "loan_id": "L2", "updated_status": "Draw Submit"}},
        {"id": "r4", "state_type": None, "start_time": "2024-01-15T23:59:59Z",
         "parameters": {"draw_id": "99", "loan_id": "L9", "updated_status": "Draw Create"}},
        {"id": "r5", "state_type": "COMPLETED", "start_time": "2024-01-16T00:00:00Z",
         "parameters": {"draw_id": "13", "loan_id": "L1", "updated_status": "Draw Submit"}},
    ]
    for r in runs:
        write_json(f"{tmpdir_path}/runs/{r['id']}.json", r)
    write_json(f"{tmpdir_path}/loans/L1.json", {"loan_id": "L1", "data": {"fields": {"loanNumber": "LN-1"}}})
    write_json(f"{tmpdir_path}/draws/11.json", {"id": "11", "type": "Std", "lineItems": {"payee": {
        "Acme": {"items": [[{"number": "1", "requested": "10"}, {"number": "2", "requested": "20"}]]}}}})
    out = draw_report(read_runs(spark, f"{tmpdir_path}/runs"), read_loan_fields(spark, f"{tmpdir_path}/loans"),
                      read_draws(spark, f"{tmpdir_path}/draws"), dt.datetime(2024, 1, 16, 8, 0))
    got = sorted((r.draw_id, r.loanNumber, r["lineItems.number"], r["lineItems.amount"]) for r in out.collect())
    assert got == [("11", "LN-1", "1", "10"), ("11", "LN-1", "2", "20"), ("99", None, None, None)]


def test_payroll_load_upserts_three_tables(spark, tmpdir_path):
    p = tmpdir_path
    write_json(f"{p}/companies/c.json", {"content": [{"companyId": "C1", "displayId": "D1", "legalName": "Co One"}]})
    write_json(f"{p}/workers/C1-0.json", {"companyId": "C1", "metadata": {"pagination": {"total": 3}}, "content": [
        {"workerId": "W1", "employeeId": "E1", "name": {"givenName": "Ann", "familyName": "Lee"},
         "currentStatus": {"statusType": "ACTIVE"}},
        {"workerId": "W2", "employeeId": "E2", "name": {"givenName": "Bo", "familyName": "Ma"},
         "currentStatus": {"statusType": "ACTIVE"}}]})
    write_json(f"{p}/workers/C1-1.json", {"companyId": "C1", "metadata": {"pagination": {"total": 3}}, "content": [
        {"workerId": "W3", "employeeId": "E3", "name": {"givenName": "Cy", "familyName": "Ng"},
         "currentStatus": {"statusType": "TERMINATED"}}]})
    write_json(f"{p}/comms/W1.json", {"workerId": "W1", "content": [
        {"communicationId": "M1", "type": "EMAIL", "usageType": "PERSONAL", "uri": "Ann@Example.COM"},
        {"communicationId": "M2", "type": "PHONE", "usageType": "MOBILE", "uri": "555"},
        {"communicationId": "M3", "type": "email", "usageType": "WORK", "uri": "x@y.z"}]})
    write_json(f"{p}/comms/W2.json", {"workerId": "W2", "content": []})
    spark.sql("CREATE DATABASE IF NOT EXISTS payroll_t")
    args = (read_companies(spark, f"{p}/companies"), read_worker_pages(spark, f"{p}/workers"),
            read_communications(spark, f"{p}/comms"))
    load_payroll(spark, *args, schema="payroll_t")
    load_payroll(spark, *args, schema="payroll_t")
    assert spark.table("payroll_t.workers").count() == 3
    assert [tuple(r) for r in spark.table("payroll_t.email_addresses").collect()] == [
        ("M1", "W1", "PERSONAL", "ann@example.com")]
    assert spark.table("payroll_t.companies").first().legal_name == "Co One"
    nameless = read_worker_pages(spark, f"{p}/workers").limit(1).withColumn(
        "content", F.expr("transform(content, w -> named_struct('workerId', w.workerId, 'employeeId', w.employeeId, "
                          "'name', CAST(NULL AS struct<givenName:string,familyName:string>), "
                          "'currentStatus', w.currentStatus))"))
    assert workers(nameless).first().first_name is None
    assert email_addresses(read_communications(spark, f"{p}/comms")).count() == 1


def test_core_value_patches(spark):
    raw = spark.createDataFrame([(1, "LN1", "S1", "core", 10.5, 3.25, "2024-01-01"),
                                 (2, "LN2", "S2", "core", None, 1.0, "2024-01-02")],
                                "a bigint, b string, c string, d string, e double, f double, g string")
    existing = spark.createDataFrame([("1",), ("1",)], "lg_loan_id string")
    rows = core_value_patches(raw, existing).collect()
    assert [r.target_id for r in rows] == ["1"]
    body = json.loads(rows[0].body)
    assert body["lg_loan_number"] == "LN1" and body["coreSystemLoanAmount"] == "10.5"


def test_report_schema_reader(spark, tmpdir_path):
    write_json(f"{tmpdir_path}/r/1.json", {"data": {"Current Report": {"data": [{"Loan Number": "1", "% DISB": "5 %"}]}}})
    df = read_report_document(spark, f"{tmpdir_path}/r", ["Loan Number", "% DISB"])
    assert df.columns == ["Loan Number", "% DISB"] and df.first()["% DISB"] == "5 %"
    assert report_rows_schema(["a"]).simpleString().startswith("struct<data:struct<Current Report")


def test_loan_id_report_and_template_and_mail(spark, tmpdir_path):
    from loanmart.operators.latest import template_id
    from loanmart.plans.reports import loan_id_report
    from loanmart.sources.documents import read_templates
    from loanmart.sources.sinks import report_mail, report_path
    write_json(f"{tmpdir_path}/l/p.json", {"data": {"items": [
        {"id": "7", "fileNumber": "F7", "borrower": {"firstName": "Jo Ann"}}, {"id": "8", "fileNumber": None}]}})
    rows = loan_id_report(read_loan_list(spark, f"{tmpdir_path}/l"), AS_OF).collect()
    assert [(r.land_gorilla_loan_id, r.loan_number, r.first_name, r.last_name_and_or_business, r.timestamp)
            for r in rows] == [("7", "F7", "JoAnn", "", "2024-01-15T04:00:00")]
    write_json(f"{tmpdir_path}/t/t.json", {"data": {"items": [
        {"id": "1", "name": "AccountingAllActiveLoans"}, {"id": "2", "name": "Other"},
        {"id": "3", "name": "AccountingAllActiveLoans"}]}})
    assert template_id(read_templates(spark, f"{tmpdir_path}/t"), "AccountingAllActiveLoans") == "3"
    path = report_path("/reports", "lip_combined", AS_OF)
    assert path == "/reports/01-24/lip_combined_011524.csv"
    assert report_path("/r", "draws", AS_OF, folder="f", with_time=True) == "/r/f/01-24/draws_011524_120000.csv"
    assert report_mail(spark, "s", "b", path).first().attachment_path == path


def test_a_combined_report_is_sorted_before_it_is_parsed(spark):
    from loanmart.plans import mart_queries as mart
    customer = spark.createDataFrame([(i, f"C{i}", i % 25, 1.5, "BUILDING") for i in range(40)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    supplier = spark.createDataFrame([(1, "S1", 3, 2.5)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")
    got = mart.combine_lip(mart._system_a(customer, True), mart._system_b(supplier, True), mart.AS_OF, funded=True)
    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    try:
        spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
        above, below = got._jdf.queryExecution().optimizedPlan().toString().lower().split("sort [")
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", before)
    dates = [c.lower() for c in ("APPRAISAL_ORDERED", "APPRAISAL_DUE", "TITLE_ORDERED", "SIGNING_APPOINTMENT")]
    assert all(f" as {c}#" in above and f"gettimestamp({c}#" not in below for c in dates) and "gettimestamp" in above and "gettimestamp" in below
    keys = [(r.CLOSING_DATE, r.FUND) for r in got.collect()]
    assert len(keys) == 41 and keys == sorted(keys, key=lambda k: (k[0] is None, k[0], k[1] is None, k[1] or ""))


def test_landed_documents_are_small_files_read_back_whole(spark):
    import glob
    import os
    from loanmart.plans.landed_queries import landed, parts
    rows = spark.range(3000).select("id", *[F.concat(F.lit("$ "), F.col("id")).alias(f"a long heading {i}") for i in range(20)], F.lit(None).cast("string").alias("none"))
    docs = parts(rows, "id", "data")
    path = landed(docs, "test")
    size = sum(os.path.getsize(f) for f in glob.glob(f"{path.removeprefix('file:')}/part-*"))
    text = docs.select(F.sum(F.length(F.to_json(F.struct("data"), {"ignoreNullFields": "false"})))).first()[0]
    assert 0 < size < text / 3
    back = spark.read.schema(docs.schema).json(path).select(F.explode("data").alias("r")).select("r.*")
    assert sorted(back.collect()) == sorted(rows.drop("id").collect())


def test_draws_are_shuffled_as_plain_columns(spark):
    from loanmart.operators.nested import flatten_draws
    from loanmart.plans.mart_queries import nested_draws
    orders = spark.createDataFrame([(i, 7, "O", None, "5-LOW") for i in range(3)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string")
    line = [(0, 1, 0, 1, 10.0, 0.1, "N", "O"), (0, 2, 1, 2, 20.0, 0.0, "N", None), (1, 3, 0, 1, 30.0, None, "A", "O"), (1, 4, 0, 2, 40.0, 0.05, "A", "F"), (1, 5, 1, 3, 50.0, 0.1, None, "F"), (1, 6, 0, 4, 60.0, 0.1, "R", None)]
    lineitem = spark.createDataFrame(line, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string")
    supplier = spark.createDataFrame([(0, "Zero"), (1, "One")], "s_suppkey long, s_name string")
    draws = nested_draws(orders, lineitem, supplier)
    below = draws._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression [")[1]
    assert "Part " not in below
    got = sorted((r["draw_id"], r["payee.name"], r["lineItems.number"], r["lineItems.amount"], r["lineItems.retainage"], r["lineItems.totalLessRetainage"]) for r in flatten_draws(draws).collect())
    # a line without a status is in no list
    assert got == [("0", "Zero", "1", "10.00", "1.0000", "9.0000"), ("1", "One", "3", "50.00", "5.0000", "45.0000"), ("1", "Zero", "1", "30.00", None, None), ("1", "Zero", "2", "40.00", "2.0000", "38.0000")]
