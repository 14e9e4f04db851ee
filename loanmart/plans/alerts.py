"""Expiry alerts (A1-A4): loans whose date is exactly N days after ``as_of``
become case rows for the case outbox (K8)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmart.functions.dates import days_until, parse_timestamp, try_parse_timestamp
from loanmart.functions.text import full_name


@dataclass(frozen=True)
class AlertSpec:
    date_column: str                 # heading holding the expiry date
    subject: str                     # format text, %s = loan number
    reason: str
    record_type_id: str = ""         # from configuration, never hard-coded ids
    owner_id: str = ""
    days: int = 30
    coerce: bool = False             # D4 (flood): bad dates -> null
    date_format: str = "M/d/yyyy"


# The four alert kinds, their date headings and texts.
MATURITY = AlertSpec("Current Loan Due Date",
                     "Maturity date expiring in 30 days for loan number: %s",
                     "Maturity Date: Expires in 30 days")
BUILDERS_RISK = AlertSpec("Builder's Risk Insurance Expiration",
                          "Builder's Risk Insurance expiring in 30 days for loan number: %s",
                          "Builder's risk Insurance: Expires in 30 days")
FLOOD = AlertSpec("Flood Insurance Expiration Date",
                  "Flood insurance expiring in 30 days for loan number: %s",
                  "Flood Insurance: Expires in 30 days", coerce=True)
HOMEOWNERS = AlertSpec("Homeowners Insurance Expires Date",
                       "Homeowners Insurance expiring in 30 days for loan number: %s",
                       "Homeowners Insurance: Expires in 30 days")

CASE_COLUMNS = ("Subject", "Description", "RecordTypeId", "OwnerId", "Reason",
                "Loan_Number__c", "Address__Street__s", "Borrower__c")


def _due(spec: AlertSpec, as_of) -> Column:
    raw = F.col(f"`{spec.date_column}`")
    due = (try_parse_timestamp(raw, (spec.date_format,)) if spec.coerce
           else parse_timestamp(raw, spec.date_format))
    return F.coalesce(days_until(due, as_of) == spec.days, F.lit(False))


def expiring_cases(loans: DataFrame, spec: AlertSpec | Sequence[AlertSpec], as_of) -> DataFrame:
    """D1/D4 -> D6 -> F3 -> P14 (+C17, C18), for one alert or several in one
    pass over the loans: each row gets the array of its due alerts, exploded.
    ``loans`` has the report headings Loan Number, Property Address, Borrower
    First/Last Name and the specs' date headings as text."""
    specs = [spec] if isinstance(spec, AlertSpec) else list(spec)
    alerts = F.array(*[F.when(_due(s, as_of), F.struct(
        F.format_string(s.subject, F.col("`Loan Number`")).alias("Subject"),
        F.lit(s.record_type_id).alias("RecordTypeId"), F.lit(s.owner_id).alias("OwnerId"),
        F.lit(s.reason).alias("Reason"))) for s in specs])
    due = loans.withColumn("_alert", F.explode(F.filter(alerts, lambda a: a.isNotNull())))
    return (due
            .select(
                F.col("_alert.Subject").alias("Subject"),
                F.col("`Loan Number`").alias("Description"),
                F.col("_alert.RecordTypeId").alias("RecordTypeId"),
                F.col("_alert.OwnerId").alias("OwnerId"),
                F.col("_alert.Reason").alias("Reason"),
                F.col("`Loan Number`").alias("Loan_Number__c"),
                F.col("`Property Address`").alias("Address__Street__s"),
                full_name(F.col("`Borrower First Name`"), F.col("`Borrower Last Name`")).alias("Borrower__c")))
