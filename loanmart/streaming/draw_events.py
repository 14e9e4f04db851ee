"""Draw-event stream -> case and e-mail outboxes.

Each webhook call of the source is one event row here.  Lookups are
stream-static joins; the open-case check is an anti-join on the case hash
against the CRM's open cases and the cases that this stream has queued and
the sender has not delivered yet, so a later event sees earlier ones (Q14),
also within one micro-batch.  A delivered case counts as long as the CRM has
it open; once closed there, a new event opens a new case.

The cases that wait for delivery are the stream's state, a snapshot per batch
(``streaming.state``): a batch reads neither the outbox nor deliveries older
than the oldest of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmart.functions.text import case_hash, full_name, has_label, status_is
from loanmart.operators.joins import anti_join
from loanmart.sources.documents import DRAW_EVENT_SCHEMA
from loanmart.streaming.outbox import read_batch, read_outbox, write_batch
from loanmart.streaming.state import read_state, write_state

# Statuses, label and texts of the draw webhook.
DRAW_SUBMIT = "draw submit"
DRAW_CREATE = "draw create"
ACCOUNTING_LABEL = "Accounting"
CASE_SUBJECT = "Pending Draw Created in LG  Loan Number: %s"
CASE_REASON = "Draw"
MAIL_SUBJECT = "Draw Change for %s"
MAIL_BODY = "Loan Number: %s\nRisk Label(s): %s\nUpdated Status: %s"
CASE_OUTBOX = ("case_hash string, Subject string, Description string, RecordTypeId string, OwnerId string, Reason string,"
               " Loan_Number__c string, Address__Street__s string, Draw_ID__c string, Borrower__c string")
PENDING = T.StructType([T.StructField("case_hash", T.StringType()), T.StructField("batch_id", T.LongType()),
                        T.StructField("Loan_Number__c", T.StringType()), T.StructField("Draw_ID__c", T.StringType())])
MAIL_OUTBOX = "loan_id string, draw_id string, subject string, body string"


def enrich(events: DataFrame, loans: DataFrame, draws: DataFrame) -> DataFrame:
    """Event ⟕ loan fields (S9) ⟕ draw type (S10).  Both lookup tables
    hold one row per id; AQE broadcasts them when they are small."""
    lk = loans.select("loan_id", "loanNumber", "riskLabel", "propertyAddress",
                      F.col("borrower.firstName").alias("_first"), F.col("borrower.lastName").alias("_last"))
    dk = draws.select(F.col("id").cast("string").alias("draw_id"), F.col("type").alias("draw_type"))
    return events.join(lk, "loan_id", "left").join(dk, "draw_id", "left")


def case_candidates(enriched: DataFrame, status: str = DRAW_SUBMIT, record_type_id: str = "", owner_id: str = "") -> DataFrame:
    """F8 + F10 + P14 + C17 + C19: case rows for the wanted status with a
    known draw type, keyed by the case hash.  The two CRM ids come from
    configuration."""
    return (enriched.where(status_is("updated_status", status) & F.col("draw_type").isNotNull())
            .select(
                case_hash(F.col("loanNumber"), F.col("draw_id")).alias("case_hash"),
                F.format_string(CASE_SUBJECT, F.coalesce(F.col("loanNumber"), F.lit("None"))).alias("Subject"),
                F.col("loanNumber").alias("Description"),
                F.lit(record_type_id).alias("RecordTypeId"),
                F.lit(owner_id).alias("OwnerId"),
                F.lit(CASE_REASON).alias("Reason"),
                F.col("loanNumber").alias("Loan_Number__c"),
                F.col("propertyAddress").alias("Address__Street__s"),
                F.col("draw_id").alias("Draw_ID__c"),
                full_name(F.col("_first"), F.col("_last"), default_blank=True).alias("Borrower__c")))


def new_cases(candidates: DataFrame, open_cases: DataFrame) -> DataFrame:
    """J3 + Q14: one case per hash (the smallest row, deterministic), minus
    hashes of open cases.  The grouping is a partial aggregate: a hot loan
    is reduced in every task before the shuffle."""
    cols = [c for c in candidates.columns if c != "case_hash"]
    one = (candidates.groupBy("case_hash").agg(F.min(F.struct(*cols)).alias("_c"))
           .select("case_hash", *[F.col("_c")[c].alias(c) for c in cols]))
    open_hashes = open_cases.select(case_hash(F.col("Loan_Number__c"), F.col("Draw_ID__c")).alias("case_hash"))
    return anti_join(one, open_hashes, ["case_hash"])


def _py_list_text(arr) -> F.Column:
    """Python's text of a list of strings, e.g. ['Accounting', None]."""
    quoted = F.transform(arr, lambda x: F.coalesce(F.concat(F.lit("'"), x, F.lit("'")), F.lit("None")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def mail_rows(enriched: DataFrame, status: str = DRAW_SUBMIT) -> DataFrame:
    """W2/W3 + F9 (+Q25: array membership only): label 'Accounting' and the
    wanted status.  A missing loan number reads None, as in the cases."""
    loan = F.coalesce(F.col("loanNumber"), F.lit("None"))
    return (enriched.where(has_label("riskLabel", ACCOUNTING_LABEL) & status_is("updated_status", status))
            .select(F.col("loan_id"), F.col("draw_id"),
                    F.format_string(MAIL_SUBJECT, loan).alias("subject"),
                    F.format_string(MAIL_BODY, loan, _py_list_text(F.col("riskLabel")),
                                    F.col("updated_status")).alias("body")))


def pending_cases(spark: SparkSession, batch_id: int, case_path: str, state_path: str,
                  delivered: Callable[[], DataFrame] | None = None) -> DataFrame:
    """Cases queued before ``batch_id`` and not delivered: the last snapshot
    without what has been delivered since its oldest case was queued.  An
    outbox that has no snapshot yet is read once."""
    pending = read_state(spark, state_path, PENDING, batch_id)
    if pending is None:
        pending = read_outbox(spark, case_path, CASE_OUTBOX, before=batch_id).select(*PENDING.names)
    oldest = pending.agg(F.min("batch_id")).first()[0]
    if delivered is None or oldest is None:
        return pending
    gone = delivered().where(F.col("batch_id") >= oldest).select("case_hash", F.col("batch_id").cast("long").alias("batch_id")).distinct()
    return pending.join(gone, ["case_hash", "batch_id"], "left_anti").select(*PENDING.names)


def process_batch(batch: DataFrame, batch_id: int, spark: SparkSession, loans: DataFrame, draws: DataFrame,
                  open_cases: Callable[[], DataFrame], case_path: str, mail_path: str,
                  status: str = DRAW_SUBMIT, delivered: Callable[[], DataFrame] | None = None,
                  record_type_id: str = "", owner_id: str = "", state_path: str | None = None) -> None:
    """One micro-batch.  ``open_cases`` gives the CRM's open cases,
    ``delivered`` the outbox rows ``(case_hash, batch_id)`` that the sender has
    delivered (None: none yet; best partitioned by ``batch_id``).  Each sink
    holds a folder per batch, which a replay overwrites; only earlier batches
    count as queued.  ``state_path`` holds the snapshots of waiting cases
    (else beside the cases)."""
    state_path = state_path or f"{case_path.rstrip('/')}_pending"
    enriched = enrich(batch, loans, draws).persist()
    pending = pending_cases(spark, batch_id, case_path, state_path, delivered).persist()
    known = open_cases().select("Loan_Number__c", "Draw_ID__c").unionByName(pending.select("Loan_Number__c", "Draw_ID__c"))
    write_batch(mail_rows(enriched, status), mail_path, batch_id)
    write_batch(new_cases(case_candidates(enriched, status, record_type_id, owner_id), known), case_path, batch_id)
    queued = read_batch(spark, case_path, CASE_OUTBOX, batch_id).withColumn("batch_id", F.lit(batch_id).cast("long"))
    write_state(pending.unionByName(queued.select(*PENDING.names)), state_path, batch_id)
    enriched.unpersist()
    pending.unpersist()


def start_draw_event_stream(spark: SparkSession, events: DataFrame, loans: DataFrame, draws: DataFrame,
                            open_cases: Callable[[], DataFrame], case_path: str, mail_path: str,
                            checkpoint: str, status: str = DRAW_SUBMIT, available_now: bool = True, **kw):
    """W1 + W2 (status 'draw submit') or W3 ('draw create') as one streaming
    query.  ``events`` is a streaming DataFrame with loan_id, updated_status
    and draw_id (file source of landed calls, or Kafka); further arguments go
    to ``process_batch``."""
    writer = (events.writeStream
              .foreachBatch(lambda df, bid: process_batch(df, bid, spark, loans, draws, open_cases,
                                                          case_path, mail_path, status, **kw))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def read_event_files(spark: SparkSession, path: str) -> DataFrame:
    """Landed webhook calls as a file stream."""
    return spark.readStream.schema(DRAW_EVENT_SCHEMA).json(path)
