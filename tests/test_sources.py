"""Landed sources and sinks: VARIANT reports, history and pages read by
folder, many XML messages in a file, one CSV file, checks of the writing pass."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from loanmart.operators.validate import ValidationError, observed_errors, observed_nulls
from loanmart.plans.draws import draw_events, runs_of_days
from loanmart.plans.payroll import load_payroll
from loanmart.plans.reports import CASH_STATUS, report_extract
from loanmart.plans.transactions import transaction_report
from loanmart.sources import documents as docs
from loanmart.sources.sinks import CSV_OPTIONS, read_csv_report, report_path, write_csv


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def plan(df):
    return df._jdf.queryExecution().toString()


# ------------------------------------------------------- unknown report columns
def test_report_of_unknown_columns_is_read_once(spark, tmpdir_path):
    rows = [{"Loan Number": "1", "Builder's %": "5 %", "Say \"x\"": None}, {"Loan Number": None, "Amount": 1.25, "Deep": {"a": [1]}}]
    write(f"{tmpdir_path}/r/a.json", json.dumps({"data": {"Current Report": {"data": rows}}}))
    found = docs.report_rows(spark, f"{tmpdir_path}/r")
    assert found.schema.simpleString() == "struct<row:variant>" and plan(found).count("Scan json") <= 1
    got = docs.named_columns(found, ["Loan Number", "Builder's %", "Missing"]).collect()
    assert [tuple(r)[:3] for r in got] == [("1", "5 %", None), (None, None, None)]
    assert [json.loads(r.other_columns) for r in got] == [{'Say "x"': None}, {"Amount": 1.25, "Deep": {"a": [1]}}]
    cells = {(r.column, r.value) for r in docs.column_cells(found).collect()}
    assert cells == {("Loan Number", "1"), ("Builder's %", "5 %"), ('Say "x"', None), ("Loan Number", None), ("Amount", "1.25"), ("Deep", '{"a":[1]}')}
    lines = f"{tmpdir_path}/l/a.json"
    write(lines, "\n".join(json.dumps({"data": {"Current Report": {"data": [r]}}}) for r in rows))
    assert docs.report_rows(spark, lines, lines=True).count() == 2


def test_listed_columns_need_no_second_read(spark, tmpdir_path):
    names = [{"Builders Risk Insurance Expiration": "Builder's Risk Insurance Expiration"}.get(c, c) for c in CASH_STATUS.required()]
    write(f"{tmpdir_path}/r/7/a.json", json.dumps({"data": {"Current Report": {"data": [dict.fromkeys(names, None) | {"Loan Number": "L 1", "LTV": "12.5 %", "Extra": "x"}]}}}))
    catalogue = spark.createDataFrame([("7", CASH_STATUS.name)], "id string, name string")
    whole, listed = (report_extract(spark, catalogue, f"{tmpdir_path}/r", CASH_STATUS, dt.datetime(2024, 1, 15), listed_only=x) for x in (False, True))
    assert set(whole.columns) - set(listed.columns) == {"Extra"}
    assert listed.select(sorted(listed.columns)).collect() == whole.drop("Extra").select(sorted(listed.columns)).collect()


# ------------------------------------------------- folders that are not read
def _runs(root):
    for day in range(10, 20):
        row = {"id": f"r{day}", "flow_id": "f", "state_type": "COMPLETED", "start_time": f"2024-01-{day}T12:00:00Z",
               "parameters": {"draw_id": str(day), "loan_id": "L", "updated_status": "Draw Submit"}}
        write(f"{root}/day=2024-01-{day}/a.json", json.dumps(row))


def test_history_reads_the_folder_of_the_day(spark, tmpdir_path):
    _runs(tmpdir_path)
    runs = docs.read_runs(spark, tmpdir_path, lines=True, by_day=True)
    events = draw_events(runs, dt.datetime(2024, 1, 16, 8))
    assert [r.draw_id for r in events.collect()] == ["15"]
    assert "PartitionFilters: [isnotnull(day" in plan(events)
    # a broken file of another day is never opened
    write(f"{tmpdir_path}/day=2024-01-12/b.json", "no JSON")
    assert draw_events(docs.read_runs(spark, tmpdir_path, lines=True, by_day=True), dt.datetime(2024, 1, 16, 8)).count() == 1
    days = spark.createDataFrame([(dt.date(2024, 1, 11), 1), (dt.date(2024, 1, 18), 1), (dt.date(2024, 1, 12), 0)], "day date, wanted int").where("wanted = 1")
    path = f"{tmpdir_path}-days"
    days.write.parquet(path)
    some = runs_of_days(docs.read_runs(spark, tmpdir_path, lines=True, by_day=True), spark.read.parquet(path).where("wanted = 1"))
    assert "dynamicpruning" in plan(some)
    assert sorted(r.draw_id for r in some.collect()) == ["11", "18"]


def test_pages_of_wanted_companies(spark, tmpdir_path):
    for company in ("A", "B", "C"):
        page = {"metadata": {"pagination": {"total": 1}}, "content": [{"workerId": f"W{company}"}]}
        write(f"{tmpdir_path}/companyId={company}/0.json", json.dumps(page))
    write(f"{tmpdir_path}/companyId=B/1.json", "no JSON")
    got = docs.read_worker_pages(spark, tmpdir_path, lines=True, company_ids=["A", "C"])
    assert "PartitionFilters: [companyId" in plan(got)
    assert sorted(r.companyId for r in got.collect()) == ["A", "C"]


# --------------------------------------------------------- many messages a file
def test_one_file_of_many_messages_is_read_by_many_tasks(spark, tmpdir_path):
    whole = '<?xml version="1.0"?>\n<soapenv:Envelope xmlns:soapenv="u"><soapenv:Body><n>%d</n></soapenv:Body></soapenv:Envelope>'
    broken = '<?xml version="1.0"?><soapenv:Envelope xmlns:soapenv="u"><soapenv:Body><n>%d'
    text = "".join((broken if i % 10 == 3 else whole) % i + ("\n" if i % 2 else "") for i in range(3000)) + "\n"
    write(f"{tmpdir_path}/all.xml", text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        got = docs.read_xml_messages(spark, f"{tmpdir_path}/all.xml", end_tag=docs.XML_END)
        assert len({r.p for r in got.select(F.spark_partition_id().alias("p")).distinct().collect()}) > 5
        rows = [r.xml for r in got.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [(broken if i % 10 == 3 else whole) % i for i in range(3000)]
    assert sorted(rows) == sorted(x[x.index("<soapenv"):] for x in want)
    write(f"{tmpdir_path}/cut.xml", whole % 1 + broken % 2)
    last = docs.read_xml_messages(spark, f"{tmpdir_path}/cut.xml", end_tag=docs.XML_END).collect()
    assert len(last) == 2  # what broke off at the end stays a message, no sound one
    write(f"{tmpdir_path}/empty.xml", "")
    assert docs.read_xml_messages(spark, f"{tmpdir_path}/empty.xml", end_tag=docs.XML_END).count() == 0


# ----------------------------------------------------------------- one CSV file
def test_one_dated_csv_file(spark, tmpdir_path):
    path = report_path(tmpdir_path, "loans", dt.datetime(2024, 1, 15), folder="f")
    df = spark.range(1000).repartition(7).select(F.col("id"), F.concat(F.lit('a "quoted", \n note '), "id").alias("pinned note"))
    write_csv(df, path, single_file=True)
    assert os.path.isfile(path) and open(path).read().startswith('id,pinned note\n')
    assert [x for x in os.listdir(os.path.dirname(path)) if not x.startswith(".")] == [os.path.basename(path)]
    assert sorted(read_csv_report(spark, path, df.schema).collect()) == sorted(df.collect())
    with pytest.raises(FileExistsError):
        write_csv(df, path, overwrite=False, single_file=True)
    write_csv(df.limit(0), path, single_file=True)
    assert open(path).read() == "id,pinned note\n"


def test_records_with_line_breaks_are_read_by_many_tasks(spark, tmpdir_path):
    path = f"{tmpdir_path}/notes.csv"
    long = "\n".join('a "long", note\r' for _ in range(600))  # longer than some splits
    notes = F.when(F.col("id") % 200 == 7, F.lit(long)).when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit(' "q",\n\nline "" \\" \t'), "id", F.lit(" ")))
    df = spark.range(4000).repartition(3).select(notes.alias("note, `pinned`"), F.col("id").cast("double").alias("n"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("at"),
                                                 F.when(F.col("id") % 3 == 0, F.concat(F.lit("x\r"), "id")).when(F.col("id") % 3 == 1, F.lit("end\r")).alias("last"))
    write_csv(df, path, single_file=True)
    want = sorted(df.collect(), key=lambda r: r.n)
    whole = spark.read.options(**CSV_OPTIONS).option("multiLine", True).schema(df.schema).csv(path)
    assert sorted(whole.collect(), key=lambda r: r.n) == want
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in (3001, 50_000, 1 << 27):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
            back = read_csv_report(spark, path, df.schema)
            assert sorted(back.collect(), key=lambda r: r.n) == want and back.schema == whole.schema
            tasks = back.select(F.spark_partition_id().alias("p")).distinct().count()
            assert tasks > 5 or split > 3001
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    write_csv(df, f"{tmpdir_path}/parts")  # a folder of files, a header each
    assert sorted(read_csv_report(spark, f"{tmpdir_path}/parts", df.schema).collect(), key=lambda r: r.n) == want
    write_csv(df.limit(0), path, single_file=True)
    assert read_csv_report(spark, path, df.schema).count() == 0


# ------------------------------------------------- checks of the writing pass
def test_checks_ride_on_the_write(spark, tmpdir_path):
    df = spark.createDataFrame([(1, None), (2, "b"), (None, None)], "a int, b string")
    watched, seen = observed_nulls(df)
    watched.write.parquet(f"{tmpdir_path}/w")
    assert seen.rows == 3 and seen.nulls() == {"a": 1, "b": 2}
    with pytest.raises(ValidationError):
        seen.assert_not_null()
    some, seen = observed_nulls(df, ["a"], F.col("b").isNotNull())
    some.count(), some.write.format("noop").mode("overwrite").save()
    assert seen.rows == 1 and seen.nulls() == {}
    seen.assert_not_null()
    failed, errors = observed_errors(spark.createDataFrame([(None, None), ("denied", "no token")], "error string, error_description string"))
    failed.write.format("noop").mode("overwrite").save()
    with pytest.raises(ValidationError, match="denied: no token"):
        errors.assert_no_errors()


def _payroll(spark, pages, company="C1", error=None):
    companies = spark.createDataFrame([([(company, "D1", "One")], error, None)], docs.COMPANY_SCHEMA)
    mails = spark.createDataFrame([("W1", [("M1", "EMAIL", "WORK", "A@b.c")], None, None)], docs.COMMUNICATION_SCHEMA)
    return companies, spark.createDataFrame(pages, docs.WORKER_SCHEMA), mails


def _page(workers, total, company="C1"):
    return (company, [(w, f"E{w}", ("G", "F"), ("ACTIVE",)) for w in workers], ((total,),), None, None)


@pytest.mark.parametrize("pages,options", [
    ([_page(["W1"], 2)], {}), ([_page([], 1), _page(["W1"], 1, "C2")], {}), ([_page(["W1", "W1"], 2)], {}), ([_page([None], 1)], {}),
    ([_page(["W1"], 1)], {"error": "denied"}), ([_page(["W1"], 1)], {"company": None})])
def test_payroll_loads_nothing_unless_all_checks_pass(spark, pages, options):
    schema = f"p_{os.urandom(6).hex()}"
    with pytest.raises(ValueError):
        load_payroll(spark, *_payroll(spark, pages, **options), schema=schema)
    assert not spark.catalog.databaseExists(schema) or not spark.catalog.tableExists(f"{schema}.workers")


def test_payroll_counts_empty_pages(spark):
    schema = f"p_{os.urandom(6).hex()}"
    load_payroll(spark, *_payroll(spark, [_page([], 1), _page(["W1"], 1), _page([], 0, "C2"), ("C3", None, None, None, None)]), schema=schema)
    assert [r.id for r in spark.table(f"{schema}.workers").collect()] == ["W1"]


def test_transactions_keep_the_fields_that_exist(spark):
    tx = spark.createDataFrame([("A", "2024-03-01T00:00:00", "L1", 1)], "account_id string, transactionCreatedDate string, loanNumber string, other int")
    got = transaction_report(spark.createDataFrame([("A",)], "id string"), tx, dt.date(2024, 3, 31))
    assert got.columns == ["loanNumber", "transactionCreatedDate", "timestamp"] and got.first().transactionCreatedDate == "03/01/24"
    with pytest.raises(ValidationError):
        transaction_report(spark.createDataFrame([("A",)], "id string"), tx.drop("transactionCreatedDate"), dt.date(2024, 3, 31))
