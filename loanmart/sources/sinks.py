"""Sinks (K1-K4, K6-K11).

CSV reports are written by executors straight to the shared store (no
driver-side bytes); tables are appended or replaced through the catalog;
cases, PATCH bodies and e-mails become rows of outbox tables that a small
sender drains, so delivery is idempotent and restartable.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmart.sources.records import csv_records
from loanmart.sources.tables import LOAD

# Date patterns of report paths (K3).
MONTH_FOLDER_FORMAT = "%m-%y"
DAY_SUFFIX_FORMAT = "%m%d%y"
TIME_SUFFIX_FORMAT = "%m%d%y_%H%M%S"
# A quote inside a field is doubled, outer blanks and line breaks stay.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
               "ignoreTrailingWhiteSpace": False}


def report_path(root: str, name: str, as_of: _dt.datetime, folder: str | None = None,
                with_time: bool = False) -> str:
    """K3: ``root/[folder/]MM-yy/name_MMddyy[_HHmmss].csv``."""
    month = as_of.strftime(MONTH_FOLDER_FORMAT)
    suffix = as_of.strftime(TIME_SUFFIX_FORMAT if with_time else DAY_SUFFIX_FORMAT)
    parts = [root.rstrip("/")] + ([folder] if folder else []) + [month, f"{name}_{suffix}.csv"]
    return "/".join(parts)


def write_csv(df: DataFrame, path: str, overwrite: bool = True, single_file: bool = False) -> None:
    """K1/K2: header, no index, empty strings written empty.  ``overwrite``
    False (K2) refuses an existing path.  The path becomes a folder of parts
    with a header each, or with ``single_file`` one file with one header."""
    if single_file:
        _write_csv_file(df, path, overwrite)
        return
    (df.write.options(**CSV_OPTIONS).option("emptyValue", "")
        .mode("overwrite" if overwrite else "errorifexists").csv(path))


def _write_csv_file(df: DataFrame, path: str, overwrite: bool) -> None:
    """All tasks write parts beside the path, without header; they are joined
    behind a header part, in order, and the whole takes the path's name at the
    end, so that no reader sees a part of it."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs_path = jvm.org.apache.hadoop.fs.Path
    target = fs_path(path)
    fs = target.getFileSystem(conf)
    if not overwrite and fs.exists(target):
        raise FileExistsError(path)
    work = f"{path}.parts-{uuid.uuid4().hex}"
    options = CSV_OPTIONS | {"header": False, "emptyValue": ""}
    header = spark.createDataFrame([tuple(df.columns)], ", ".join(f"c{i} string" for i in range(len(df.columns))))
    header.coalesce(1).write.options(**options).csv(f"{work}/header")
    df.write.options(**options).csv(f"{work}/rows")
    names = [sorted((str(f.getPath().toString()) for f in fs.listStatus(fs_path(f"{work}/{d}")) if f.getPath().getName().startswith("part-") and f.getLen() > 0)) for d in ("header", "rows")]
    whole = fs_path(f"{work}/whole")
    _join_files(spark, fs, [fs_path(n) for part in names for n in part], whole)
    if fs.exists(target):
        if not overwrite:
            raise FileExistsError(path)
        fs.delete(target, True)
    if not fs.rename(whole, target):
        raise OSError(f"cannot rename {whole.toString()} to {path}")
    fs.delete(fs_path(work), True)


def _join_files(spark: SparkSession, fs, parts: list, whole) -> None:
    """One file of all parts: by the file system's own concat (HDFS moves
    blocks, no bytes), else copied through a buffer, never held as a whole."""
    jvm = spark._jvm
    if len(parts) > 1 and fs.getScheme() == "hdfs":
        fs.rename(parts[0], whole)
        rest = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts) - 1)
        for i, p in enumerate(parts[1:]):
            rest[i] = p
        fs.concat(whole, rest)
        return
    out = fs.create(whole)
    try:
        for p in parts:
            source = fs.open(p)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
            finally:
                source.close()
    finally:
        out.close()


def read_csv_report(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a K1 report back with its typed schema (the round trip of Q-24).
    Many tasks share a file, whatever line breaks its fields hold."""
    columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in (CSV_OPTIONS | {"header": False, "multiLine": True, "lineSep": "\n"}).items()}
    records = csv_records(spark, path).where(F.col("record") != "")
    return records.select(F.from_csv("record", columns, options).alias("r")).select("r.*")


def without_blank_keys(df: DataFrame, key: str = "loan_number") -> DataFrame:
    """K6 (Q17): drop incoming rows whose key is '' (nulls kept, as in SQL),
    only when the column exists."""
    if key not in df.columns:
        return df
    return df.where(F.col(key).isNull() | (F.col(key) != ""))


def with_upload_date(df: DataFrame, as_of) -> DataFrame:
    """``upload_date`` set when absent, nulls filled when present."""
    from loanmart.functions.dates import ts_literal
    stamp = ts_literal(as_of)
    if "upload_date" in df.columns:
        return df.withColumn("upload_date", F.coalesce(F.col("upload_date").cast("timestamp_ntz"), stamp))
    return df.withColumn("upload_date", stamp)


def prepare_append(df: DataFrame, as_of) -> DataFrame:
    """What K4 appends: P13 then K6."""
    return without_blank_keys(with_upload_date(df, as_of))


def write_load(spark: SparkSession, df: DataFrame, table: str, load_id: str) -> None:
    """The rows of one load, in a partition of their own: the same load run
    again takes the place of its first try, whatever that left, and touches no
    other.  The first load creates the table; a later one may lack columns
    (null) but brings no new ones."""
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {LOAD} STRING) USING parquet PARTITIONED BY ({LOAD})")
    fields = spark.read.table(table).schema.fields
    if fields[-1].name != LOAD:
        raise ValueError(f"{table} is not partitioned by load")
    unknown = set(df.columns) - {f.name for f in fields}
    if unknown:
        raise ValueError(f"{table} has no columns {sorted(unknown)}")
    rows = df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields[:-1]])
    quoted = load_id.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({LOAD} = '{quoted}') SELECT * FROM {{rows}}", rows=rows)


def append_table(spark: SparkSession, df: DataFrame, table: str, as_of, load_id: str | None = None) -> None:
    """K4 (+K6, P13): append, creating the table on first write.  ``load_id``
    names the load (else its time does), so that a retried load counts once."""
    write_load(spark, prepare_append(df, as_of), table, load_id or as_of.isoformat())


def create_table_if_absent(spark: SparkSession, table: str, ddl_columns: str) -> None:
    """K7: fixed DDL, e.g. ``"id STRING NOT NULL, name STRING"``."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl_columns}) USING parquet")


def replace_table(spark: SparkSession, table: str, ddl_columns: str) -> None:
    """K7, create or replace: an empty table of this DDL, whatever was there.
    The session catalog replaces no parquet table in one step, so the old one
    is dropped first."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    create_table_if_absent(spark, table, ddl_columns)


def append_outbox(df: DataFrame, table: str, load_id: str) -> None:
    """Delivery rows of one load to an outbox table; a retried load
    takes the place of its first try."""
    write_load(df.sparkSession, df, table, load_id)


def patch_bodies(df: DataFrame, id_col: str) -> DataFrame:
    """K9 + P15: one JSON body per row, keyed by the row's id.  Null fields are
    sent as null: they clear the value in the target."""
    return df.select(F.col(id_col).alias("target_id"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"}).alias("body"))


def report_mail(spark: SparkSession, subject: str, body: str, attachment_path: str) -> DataFrame:
    """The outbox row for a report e-mail; the attachment is the K1/K2
    output at ``attachment_path`` (the sender reads and encodes it)."""
    return spark.createDataFrame([(subject, body, attachment_path)],
                                 "subject string, body string, attachment_path string")
