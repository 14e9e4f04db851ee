"""Stream tests: file source, availableNow, fresh checkpoint per run,
restart, duplicate events in one batch and across batches."""

import datetime
import json
import os
import shutil

from loanmart.streaming.case_messages import start_case_message_stream
from loanmart.streaming.draw_events import process_batch, read_event_files, start_draw_event_stream
from loanmart.streaming.history import first_within_watermark, late_rows, start_history_stream
from loanmart.streaming.state import KEPT_VERSIONS


def land(path, name, rows):
    os.makedirs(path, exist_ok=True)
    tmp = os.path.join(path, f".{name}.tmp")
    with open(tmp, "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")
    shutil.move(tmp, os.path.join(path, name))


def lookups(spark):
    loans = spark.createDataFrame(
        [("L1", "LN-1", ["Accounting"], ("Ann", "Lee"), "1 Oak"), ("L2", "LN-2", ["Rehab"], (None, "Ma"), "2 Elm")],
        "loan_id string, loanNumber string, riskLabel array<string>, "
        "borrower struct<firstName:string,lastName:string>, propertyAddress string")
    draws = spark.createDataFrame([("D1", "Std"), ("D2", "Std"), ("D3", None), ("D4", "Std")], "id string, type string")
    return loans, draws


def run(spark, events_dir, root, open_cases):
    loans, draws = lookups(spark)
    q = start_draw_event_stream(spark, read_event_files(spark, events_dir), loans, draws, open_cases,
                                f"{root}/cases", f"{root}/mails", f"{root}/ckpt")
    q.awaitTermination()
    assert q.exception() is None


def test_draw_event_stream_dedupes_in_and_across_batches(spark, tmpdir_path):
    events = f"{tmpdir_path}/events"
    root = f"{tmpdir_path}/out"

    def open_cases():
        return spark.createDataFrame([("LN-2", "D4", "New"), ("LN-1", "D2", "Closed")],
                                     "Loan_Number__c string, Draw_ID__c string, Status string").where("Status = 'New'")

    land(events, "a.json", [
        {"loan_id": "L1", "updated_status": "Draw Submit", "draw_id": "D1"},
        {"loan_id": "L1", "updated_status": " draw submit\n", "draw_id": "D1"},
        {"loan_id": "L1", "updated_status": "Draw Create", "draw_id": "D2"},
        {"loan_id": "L2", "updated_status": "Draw Submit", "draw_id": "D3"},
        {"loan_id": "L2", "updated_status": "Draw Submit", "draw_id": "D4"},
    ])
    run(spark, events, root, open_cases)
    cases = spark.read.parquet(f"{root}/cases")
    assert [(r.Loan_Number__c, r.Draw_ID__c) for r in cases.collect()] == [("LN-1", "D1")]
    assert cases.first().Subject == "Pending Draw Created in LG  Loan Number: LN-1"
    assert cases.first().Borrower__c == "Ann Lee"
    mails = spark.read.parquet(f"{root}/mails")
    assert mails.count() == 2
    assert mails.first().body == "Loan Number: LN-1\nRisk Label(s): ['Accounting']\nUpdated Status: Draw Submit" \
        or mails.first().body.startswith("Loan Number: LN-1\nRisk Label(s): ['Accounting']\nUpdated Status: ")

    # restart on the same checkpoint: nothing is re-emitted
    run(spark, events, root, open_cases)
    assert spark.read.parquet(f"{root}/cases").count() == 1

    # a later file repeats the case and adds a new one
    land(events, "b.json", [
        {"loan_id": "L1", "updated_status": "Draw Submit", "draw_id": "D1"},
        {"loan_id": "L2", "updated_status": "Draw Submit", "draw_id": "D2"},
    ])
    run(spark, events, root, open_cases)
    got = sorted((r.Loan_Number__c, r.Draw_ID__c, r.batch_id) for r in spark.read.parquet(f"{root}/cases").collect())
    assert [(a, b) for a, b, _ in got] == [("LN-1", "D1"), ("LN-2", "D2")]
    assert got[0][2] != got[1][2]


def test_case_message_stream(spark, tmpdir_path):
    msgs = f"{tmpdir_path}/msgs"
    os.makedirs(msgs)
    for i, borrower in enumerate(["<sf:Borrower__c>Lee</sf:Borrower__c>", ""]):
        with open(f"{msgs}/m{i}.xml", "w") as f:
            f.write('<?xml version="1.0"?><s:Envelope xmlns:s="urn:s"><s:Body><notifications xmlns="urn:n">'
                    f'<OrganizationId>O{i}</OrganizationId><ActionId>A</ActionId><EnterpriseUrl>E</EnterpriseUrl>'
                    f'<PartnerUrl>P</PartnerUrl><Notification><Id>N{i}</Id><sObject xmlns:sf="urn:x">'
                    f'<sf:Id>C{i}</sf:Id>{borrower}<sf:CaseNumber>000{i}</sf:CaseNumber>'
                    '<sf:RecordTypeId>R</sf:RecordTypeId><sf:Status>New</sf:Status></sObject></Notification>'
                    '</notifications></s:Body></s:Envelope>')
    out = f"{tmpdir_path}/mail"
    with open(f"{msgs}/m2.xml", "w") as f:
        f.write("<broken><a>")
    q = start_case_message_stream(spark, msgs, out, f"{tmpdir_path}/errors", f"{tmpdir_path}/ckpt")
    q.awaitTermination()
    rows = {r.case_id: r for r in spark.read.parquet(out).collect()}
    assert rows["C0"].borrower == "Lee" and rows["C1"].borrower is None
    assert rows["C0"].subject == " SF CASE: 0000"
    assert rows["C1"].body.startswith("Organization ID: O1Action ID: A")
    assert "Borrower: NoneCase Number: 0001" in rows["C1"].body
    assert len(rows) == 2
    assert [r.xml for r in spark.read.parquet(f"{tmpdir_path}/errors").collect()] == ["<broken><a>"]


def test_all_case_messages_are_landed(spark):
    import __spark_entry__ as entry
    sf = "/root/testdata/sf0.001"
    customers = spark.read.parquet(f"{sf}/customer.parquet").count()
    got = entry.queries()["landed_all_case_messages"](spark, sf).collect()
    assert [r.position for r in got if r.subject == "landed"] == [customers]
    assert len({r.notification_id for r in got if r.position == 0}) + sum(r.position for r in got if r.subject == "broken") >= customers


def test_history_stream_keeps_newest_and_sets_late_rows_aside(spark, tmpdir_path):
    path, out, late = (f"{tmpdir_path}/{x}" for x in ("hist", "out", "late"))
    schema = "id string, ts timestamp_ntz, draw_id string"

    def run():
        q = start_history_stream(spark, spark.readStream.schema(schema).json(path), ["draw_id"], "id", "ts",
                                 datetime.timedelta(days=1), out, late, f"{tmpdir_path}/hckpt")
        q.awaitTermination()
        assert q.exception() is None

    land(path, "a.json", [
        {"id": "1", "ts": "2024-01-15 10:00:00", "draw_id": "D1"},
        {"id": "2", "ts": "2024-01-15 10:05:00", "draw_id": "D1"},
        {"id": "3", "ts": "2024-01-15 10:06:00", "draw_id": None}])
    run()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["2", "3"]
    land(path, "b.json", [
        {"id": "4", "ts": "2024-01-15 12:00:00", "draw_id": "D1"},
        {"id": "5", "ts": "2024-01-13 12:00:00", "draw_id": "D9"},
        {"id": "6", "ts": "2024-01-15 12:00:00", "draw_id": "D2"}])
    run()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["2", "3", "6"]
    assert [r.id for r in spark.read.parquet(late).collect()] == ["5"]


def test_replayed_batch_leaves_the_same_rows(spark, tmpdir_path):
    loans, draws = lookups(spark)
    batch = spark.createDataFrame([("L1", "Draw Submit", "D1"), ("L1", "Draw Submit", "D3"), ("L9", "Draw Submit", "D2")],
                                  "loan_id string, updated_status string, draw_id string")
    none = spark.createDataFrame([], "Loan_Number__c string, Draw_ID__c string")
    for _ in range(2):
        process_batch(batch, 5, spark, loans, draws, lambda: none, f"{tmpdir_path}/c", f"{tmpdir_path}/m",
                      record_type_id="RT", owner_id="OW")
    cases = spark.read.parquet(f"{tmpdir_path}/c").collect()
    assert sorted((r.Loan_Number__c or "", r.Draw_ID__c, r.RecordTypeId, r.OwnerId) for r in cases) == [("", "D2", "RT", "OW"), ("LN-1", "D1", "RT", "OW")]
    assert spark.read.parquet(f"{tmpdir_path}/m").count() == 2


def test_batches_read_no_earlier_output(spark, tmpdir_path, monkeypatch):
    """After the first batch, cases and history come from the snapshots alone."""
    loans, draws = lookups(spark)
    none = spark.createDataFrame([], "Loan_Number__c string, Draw_ID__c string")
    call = "loan_id string, updated_status string, draw_id string"
    gone = []

    def batch(rows, batch_id):
        process_batch(spark.createDataFrame(rows, call), batch_id, spark, loans, draws, lambda: none, f"{tmpdir_path}/c", f"{tmpdir_path}/m",
                      delivered=lambda: spark.createDataFrame(gone, "case_hash string, batch_id long"))

    batch([("L1", "Draw Submit", "D1")], 0)

    def refuse(*_, **__):
        raise AssertionError("earlier output is read")

    monkeypatch.setattr("loanmart.streaming.draw_events.read_outbox", refuse)
    batch([("L1", "Draw Submit", "D1"), ("L2", "Draw Submit", "D2")], 1)
    batch([("L1", "Draw Submit", "D1"), ("L2", "Draw Submit", "D2")], 1)
    for i in range(2, 7):
        batch([("L1", "Draw Submit", "D1")], i)
    queued = [(r.case_hash, r.batch_id) for r in spark.read.parquet(f"{tmpdir_path}/c").orderBy("batch_id").collect()]
    assert [b for _, b in queued] == [0, 1]
    assert len([x for x in os.listdir(f"{tmpdir_path}/c_pending") if x.startswith("version=")]) == KEPT_VERSIONS
    gone.append(queued[0])
    batch([("L1", "Draw Submit", "D1"), ("L2", "Draw Submit", "D2")], 7)
    assert sorted(r.batch_id for r in spark.read.parquet(f"{tmpdir_path}/c").collect()) == [0, 1, 7]


def test_history_in_the_state_store(spark, tmpdir_path):
    path, out = f"{tmpdir_path}/hist", f"{tmpdir_path}/out"
    late = []

    def run():
        rows = spark.readStream.schema("id string, ts timestamp, draw_id string").json(path)
        q = (first_within_watermark(rows, ["draw_id"], "ts", datetime.timedelta(days=1)).writeStream.trigger(availableNow=True)
             .option("checkpointLocation", f"{tmpdir_path}/ckpt").start(out, format="parquet"))
        q.awaitTermination()
        late.append(late_rows(q))
        return sorted(r.draw_id for r in spark.read.parquet(out).collect())

    land(path, "a.json", [{"id": "1", "ts": "2024-01-15 10:00:00", "draw_id": "D1"}, {"id": "2", "ts": "2024-01-15 10:05:00", "draw_id": "D1"}])
    assert run() == ["D1"]
    land(path, "b.json", [{"id": "3", "ts": "2024-01-15 12:00:00", "draw_id": "D1"}, {"id": "4", "ts": "2024-01-13 12:00:00", "draw_id": "D9"},
                          {"id": "5", "ts": "2024-01-15 12:00:00", "draw_id": "D2"}])
    assert run() == ["D1", "D2"] and late == [0, 1]
