"""Case XML messages -> e-mail rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmart.sources.documents import split_messages
from loanmart.streaming.outbox import write_batch

# Fixed values: (output name, element path by local name, label in the mail).
CASE_FIELDS = (
    ("org_id", ("OrganizationId",), "Organization ID"),
    ("action_id", ("ActionId",), "Action ID"),
    ("enterprise_url", ("EnterpriseUrl",), "Enterprise URL"),
    ("partner_url", ("PartnerUrl",), "Partner URL"),
    ("notification_id", ("Notification", "Id"), "Notification ID"),
    ("case_id", ("sObject", "Id"), "Case ID"),
    ("borrower", ("Borrower__c",), "Borrower"),
    ("case_number", ("CaseNumber",), "Case Number"),
    ("record_type_id", ("RecordTypeId",), "Record Type ID"),
    ("status", ("Status",), "Status"),
)
MAIL_SUBJECT = " SF CASE: %s"


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# The outbound-message shape (Envelope/Body/notifications/
# Notification/sObject) with the fields read from it.
MESSAGE_SCHEMA = T.StructType([T.StructField("Body", T.StructType([T.StructField("notifications", T.StructType(
    _strings("OrganizationId", "ActionId", "EnterpriseUrl", "PartnerUrl")
    + [T.StructField("Notification", T.ArrayType(T.StructType(
        _strings("Id") + [T.StructField("sObject", T.StructType(
            _strings("Id", "Borrower__c", "CaseNumber", "RecordTypeId", "Status")))])))]))])),
    T.StructField("_broken", T.StringType())])
# Where each field is, in the message (m) or in one of its notifications (n).
_PATHS = {
    "org_id": "m.Body.notifications.OrganizationId", "action_id": "m.Body.notifications.ActionId",
    "enterprise_url": "m.Body.notifications.EnterpriseUrl", "partner_url": "m.Body.notifications.PartnerUrl",
    "notification_id": "n.Id", "case_id": "n.sObject.Id", "borrower": "n.sObject.Borrower__c",
    "case_number": "n.sObject.CaseNumber", "record_type_id": "n.sObject.RecordTypeId", "status": "n.sObject.Status",
}


def _parsed(messages: DataFrame, xml_col: str) -> DataFrame:
    """Each message parsed once (``from_xml`` with namespaces ignored, the way
    the source looks elements up by local name)."""
    options = {"ignoreNamespace": "true", "rowTag": "Envelope", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    return messages.select(F.col(xml_col).alias("xml"), F.from_xml(F.col(xml_col), MESSAGE_SCHEMA, options).alias("m"))


def _sound() -> Column:
    return F.col("m._broken").isNull() & F.coalesce(F.size("m.Body.notifications.Notification") > 0, F.lit(False))


def _fields(parsed: DataFrame) -> DataFrame:
    rows = parsed.where(_sound()).select("m", F.posexplode("m.Body.notifications.Notification").alias("position", "n"))
    return rows.select(*[F.nullif(F.col(_PATHS[name]), F.lit("")).alias(name) for name, _, _ in CASE_FIELDS], "position")


def case_fields(messages: DataFrame, xml_col: str = "xml") -> DataFrame:
    """The ten fields (missing or empty -> null) of each notification of
    each message, with its ``position`` in the message from 0 (the source
    looks at the first).  Messages that are broken or hold no notification
    are left to ``broken_messages``."""
    return _fields(_parsed(messages, xml_col))


def broken_messages(messages: DataFrame, xml_col: str = "xml") -> DataFrame:
    """Messages (``xml``) that are no well-formed message with a notification."""
    return _parsed(messages, xml_col).where(~_sound()).select("xml")


def case_mail(fields: DataFrame) -> DataFrame:
    """Subject and the labelled body (labels run together, as sent)."""
    parts = []
    for name, _, label in CASE_FIELDS:
        parts += [F.lit(f"{label}: "), F.coalesce(F.col(name), F.lit("None"))]
    return fields.select("*", F.format_string(MAIL_SUBJECT, F.coalesce(F.col("case_number"), F.lit("None"))).alias("subject"),
                         F.concat(*parts).alias("body"))


def process_messages(batch: DataFrame, batch_id: int, mail_path: str, error_path: str) -> None:
    """One micro-batch to the mail and the error outbox, each message parsed
    once for both; a replay overwrites the batch's own folders."""
    parsed = _parsed(batch, "xml").persist()
    write_batch(case_mail(_fields(parsed)), mail_path, batch_id)
    write_batch(parsed.where(~_sound()).select("xml"), error_path, batch_id)
    parsed.unpersist()


def start_case_message_stream(spark: SparkSession, path: str, mail_path: str, error_path: str, checkpoint: str,
                              available_now: bool = True, whole_files: bool = True, end_tag: str | None = None):
    """Text stream of messages (one per file, or else one per line, or with
    ``end_tag`` many per file) -> mail outbox; what cannot be read goes to the
    error outbox."""
    if end_tag is not None:
        msgs = split_messages(spark.readStream.option("lineSep", end_tag).text(path).withColumnRenamed("value", "xml"), end_tag)
    else:
        msgs = spark.readStream.option("wholetext", whole_files).text(path).withColumnRenamed("value", "xml")
    writer = (msgs.writeStream.foreachBatch(lambda df, bid: process_messages(df, bid, mail_path, error_path))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
