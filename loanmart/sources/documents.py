"""Readers for landed JSON/XML documents.

The fetch from the remote services is outside Spark; what lands is one file
per call.  Every reader takes a directory (or glob), so the loops over pages,
accounts and workers become one multi-file scan split across executors.
Schemas are explicit where the shape is known: no inference pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmart.operators.nested import DRAW_SCHEMA

S = T.StringType()


def _struct(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, S) for n in names])


def _items(item: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("data", T.StructType([
        T.StructField("items", T.ArrayType(item))]))])


# Field names of the landed documents, in the schemas below.
CATALOGUE_SCHEMA = _struct("id", "name")
LOAN_LIST_SCHEMA = _items(T.StructType([
    T.StructField("id", S), T.StructField("fileNumber", S), T.StructField("folder", S), T.StructField("status", S),
    T.StructField("borrower", _struct("firstName", "lastName"))]))
ACCOUNT_SCHEMA = _items(_struct("id"))
# Transaction fields kept by the transaction report.
TRANSACTION_FIELDS = ("loanNumber", "transactionDescription", "debit", "credit", "paymentType",
                      "transactionCreatedDate", "transactionEffectiveDate")
# One document per account; ``account_id`` is the landing envelope.
TRANSACTION_SCHEMA = T.StructType([T.StructField("account_id", S), *_items(_struct(*TRANSACTION_FIELDS)).fields])
RUN_SCHEMA = T.StructType([
    T.StructField("id", S), T.StructField("flow_id", S), T.StructField("state_type", S),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("parameters", _struct("draw_id", "loan_id", "updated_status"))])
LOAN_FIELDS_SCHEMA = T.StructType([
    T.StructField("loan_id", S),
    T.StructField("data", T.StructType([T.StructField("fields", T.StructType([
        T.StructField("loanNumber", S), T.StructField("riskLabel", T.ArrayType(S)),
        T.StructField("borrower", _struct("firstName", "lastName")),
        T.StructField("propertyAddress", S)]))]))])
COMPANY_SCHEMA = T.StructType([T.StructField("content", T.ArrayType(_struct("companyId", "displayId", "legalName"))),
                               T.StructField("error", S), T.StructField("error_description", S)])
WORKER_SCHEMA = T.StructType([
    T.StructField("companyId", S),
    T.StructField("content", T.ArrayType(T.StructType([
        T.StructField("workerId", S), T.StructField("employeeId", S),
        T.StructField("name", _struct("givenName", "familyName")),
        T.StructField("currentStatus", _struct("statusType"))]))),
    T.StructField("metadata", T.StructType([T.StructField("pagination", T.StructType([
        T.StructField("total", T.LongType())]))])),
    T.StructField("error", S), T.StructField("error_description", S)])
COMMUNICATION_SCHEMA = T.StructType([
    T.StructField("workerId", S),
    T.StructField("content", T.ArrayType(_struct("communicationId", "type", "usageType", "uri"))),
    T.StructField("error", S), T.StructField("error_description", S)])
OPEN_CASE_SCHEMA = _struct("Loan_Number__c", "Draw_ID__c", "Status")
DRAW_EVENT_SCHEMA = _struct("loan_id", "updated_status", "draw_id")


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None, lines: bool = False) -> DataFrame:
    """One document per file, or with ``lines`` one per line: files of lines
    are split over tasks, and hold as many documents as one likes."""
    reader = spark.read.option("multiLine", not lines).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("primitivesAsString", True)
    return reader.json(path)


def report_rows_schema(columns: Sequence[str]) -> T.StructType:
    """S1 document schema for a report whose rows have ``columns`` (all text)."""
    return T.StructType([T.StructField("data", T.StructType([T.StructField(
        "Current Report", T.StructType([T.StructField("data", T.ArrayType(_struct(*columns)))]))]))])


def read_report_document(spark: SparkSession, path: str,
                         columns: Sequence[str] | None = None, lines: bool = False) -> DataFrame:
    """Rows at ``data.'Current Report'.data``, every value as text.  A
    report may be landed as one document or, with ``lines``, as many part
    documents, one per line, which many tasks share."""
    schema = report_rows_schema(columns) if columns else None
    if schema is None:
        # Column set unknown: one inference pass, every value read as text.
        doc = read_json(spark, path, lines=lines)
    else:
        doc = read_json(spark, path, schema, lines)
    rows = doc.select(F.explode(F.col("data.`Current Report`.data")).alias("r")).select("r.*")
    return rows.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in rows.columns])


def report_rows(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """S1 where the columns are not known: each row of a report as one VARIANT
    ``row``.  The documents are read once and no schema is inferred.  A
    document (a line, with ``lines``) must fit a VARIANT, 128 MB."""
    doc = spark.read.option("multiLine", not lines).option("mode", "FAILFAST").option("singleVariantColumn", "doc").json(path)
    rows = F.variant_get("doc", "$.data['Current Report'].data", "array<variant>")
    return doc.select(F.explode(rows).alias("row"))


def _variant_path(name: str) -> str:
    """The path of a key, whatever characters it holds."""
    quote = '"' if "'" in name else "'"
    return f"$[{quote}{name}{quote}]"


def named_columns(rows: DataFrame, columns: Sequence[str], rest: str | None = "other_columns") -> DataFrame:
    """The named columns of VARIANT rows as text, null where a row lacks one;
    ``rest`` (None: left out) holds the other keys and values as JSON text."""
    out = [F.variant_get("row", _variant_path(c), "string").alias(c) for c in columns]
    if rest is not None:
        others = F.map_filter(F.variant_get("row", "$", "map<string,variant>"), lambda k, _: ~k.isin(list(columns)))
        out.append(F.to_json(others).alias(rest))
    return rows.select(*out)


def column_cells(rows: DataFrame) -> DataFrame:
    """VARIANT rows as ``(column, value)``, a row for each key of each; JSON null is null."""
    cells = rows.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("row").outer()))
    return cells.select(F.col("key").alias("column"), F.col("value").cast("string").alias("value"))


def read_catalogue(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Report catalogue, list of {id, name}."""
    return read_json(spark, path, CATALOGUE_SCHEMA, lines)


def read_templates(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """S3: ``data.items[]{id,name}`` with the item position (for G2)."""
    doc = read_json(spark, path, _items(_struct("id", "name")), lines)
    return doc.select(F.posexplode("data.items").alias("pos", "t")).select("pos", "t.id", "t.name")


def read_loan_list(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Loan items with nested borrower, folder and status."""
    return read_json(spark, path, LOAN_LIST_SCHEMA, lines).select(F.explode("data.items").alias("l")).select("l.*")


def active_loans(loans: DataFrame) -> DataFrame:
    """loans whose folder and status are both 'active'."""
    return loans.where((F.col("folder") == "active") & (F.col("status") == "active"))


def read_accounts(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """GL accounts, ``id`` only."""
    return read_json(spark, path, ACCOUNT_SCHEMA, lines).select(F.explode("data.items.id").alias("id"))


def read_transactions(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """All landed transaction documents (one per account) in one scan."""
    return (read_json(spark, path, TRANSACTION_SCHEMA, lines)
            .select("account_id", F.explode("data.items").alias("t")).select("account_id", "t.*"))


def read_runs(spark: SparkSession, path: str, lines: bool = False, by_day: bool = False) -> DataFrame:
    """Flow-run history with parameters flattened.  ``by_day``: landed in
    folders ``day=yyyy-MM-dd`` by the UTC day of the start time; the column
    ``day`` then prunes the folders that are read."""
    schema = T.StructType([*RUN_SCHEMA.fields, T.StructField("day", T.DateType())]) if by_day else RUN_SCHEMA
    return read_json(spark, path, schema, lines).select("id", "flow_id", "state_type", "start_time", "parameters.*", *(["day"] if by_day else []))


def read_loan_fields(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Loan fields per loan id."""
    return read_json(spark, path, LOAN_FIELDS_SCHEMA, lines).select("loan_id", "data.fields.*")


def read_draws(spark: SparkSession, path: str, line_items_as_text: bool = False, lines: bool = False) -> DataFrame:
    """Draw documents.  ``line_items_as_text`` reads ``lineItems`` as raw
    JSON text, to be parsed by ``from_json`` (N1)."""
    schema = DRAW_SCHEMA
    if line_items_as_text:
        schema = T.StructType([f if f.name != "lineItems" else T.StructField("lineItems", S)
                               for f in DRAW_SCHEMA.fields])
    return read_json(spark, path, schema, lines)


def read_companies(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """S11 (raw pages, for V5)."""
    return read_json(spark, path, COMPANY_SCHEMA, lines)


def read_worker_pages(spark: SparkSession, path: str, lines: bool = False, company_ids: Sequence[str] | None = None) -> DataFrame:
    """S12, O4 (raw pages, for V4/V5); ``companyId`` is the landing envelope, a
    field of the pages or the folder ``companyId=...`` they landed in.
    ``company_ids`` wants the pages of some companies only, which in the
    second form leaves the folders of the others unread."""
    pages = read_json(spark, path, WORKER_SCHEMA, lines)
    return pages if company_ids is None else pages.where(F.col("companyId").isin(list(company_ids)))


def read_communications(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """S13 (raw documents, for V5); ``workerId`` is the landing envelope."""
    return read_json(spark, path, COMMUNICATION_SCHEMA, lines)


def read_open_cases(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Open cases (Status 'New') with the two key fields."""
    return (read_json(spark, path, OPEN_CASE_SCHEMA, lines)
            .where(F.col("Status") == "New").select("Loan_Number__c", "Draw_ID__c"))


#: Fixed value: the tag that closes a case message.
XML_END = "</soapenv:Envelope>"


def split_messages(text: DataFrame, end_tag: str = XML_END, xml_col: str = "xml") -> DataFrame:
    """Messages of text that was cut behind each ``end_tag``: one row each.  A
    message that broke off has no end of its own; what was cut there holds it
    and the whole one after it, and is cut again where the next one opens."""
    opening = end_tag.replace("</", "<").rstrip(">")
    pieces = F.split(F.concat(F.col(xml_col), F.lit(end_tag)), rf"(?=\Q{opening}\E[\s>])")
    messages = text.select(F.explode(pieces).alias(xml_col)).where(F.col(xml_col).startswith(opening))
    # the declaration of the next message is not part of the one that broke off
    return messages.select(F.regexp_replace(F.rtrim(xml_col), r"\s*<\?xml[^>]*\?>\s*$", "").alias(xml_col))


def read_xml_messages(spark: SparkSession, path: str, whole_files: bool = True, end_tag: str | None = None) -> DataFrame:
    """XML messages as one string column ``xml``: one per file, or else
    one per line; with ``end_tag`` any number per file, which many tasks read."""
    if end_tag is not None:
        return split_messages(spark.read.option("lineSep", end_tag).text(path).withColumnRenamed("value", "xml"), end_tag)
    return spark.read.text(path, wholetext=whole_files).withColumnRenamed("value", "xml")
