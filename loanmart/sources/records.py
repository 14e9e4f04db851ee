"""CSV records that hold line breaks, read by many tasks.

Spark's ``multiLine`` reads a file in one task, as a line does not tell whether
it lies inside a quoted field.  Here each split of a file is read as lines; one
pass counts the quotes of each split, which tells whether the next one begins
inside a field, and a second joins the lines of each record.  Only the records
cut by an end of a split, two pieces a split at most, are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Pieces of a split: whole records, the end of a record that an earlier split
# began, the beginning of one that goes on in the next.
WHOLE, END, BEGIN = 0, 1, 2
PIECES = pa.schema([("file", pa.string()), ("block", pa.int64()), ("kind", pa.int32()), ("header", pa.bool_()), ("record", pa.string())])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of splits, in order, as the pieces of their records."""
    at, inside, kind, header, held = None, 0, WHOLE, False, []  # held: lines of a record not ended yet

    def piece(kind: int, header: bool, records: pa.Array) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_arrays([pa.array([at[0]] * n, pa.string()), pa.array([at[1]] * n, pa.int64()), pa.array([kind] * n, pa.int32()),
                                           pa.array([header] * n, pa.bool_()), records.cast(pa.string())], schema=PIECES)

    def rest() -> Iterator[pa.RecordBatch]:
        if held:
            yield piece(END if kind == END else BEGIN, header, pa.array(["\n".join(held)]))
            held.clear()

    for batch in batches:
        files, blocks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("file", "block"))
        edges = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        for lo, hi in zip([0, *edges], [*edges, batch.num_rows]):
            if hi == lo:
                continue
            if at != (files[lo], int(blocks[lo])):
                yield from rest()
                before = batch.column("quotes_before")[int(lo)].as_py()
                if before is None:
                    raise RuntimeError(f"{files[lo]} was split anew between two scans of it; read it again")
                at, inside = (files[lo], int(blocks[lo])), before % 2
                kind, header = END if inside else WHOLE, at[1] == 0
            lines = batch.column("value").slice(lo, hi - lo)
            open_after = (inside + np.cumsum(pc.count_substring(lines, '"').to_numpy(zero_copy_only=False))) % 2
            inside, ends = int(open_after[-1]), np.flatnonzero(open_after == 0) + 1
            begin = 0
            if len(ends) and (held or header or kind == END):  # the one record that is like no other
                begin = int(ends[0])
                yield piece(kind, header, pa.array(["\n".join([*held, *lines.slice(0, begin).to_pylist()])]))
                held.clear()
                kind, header, ends = WHOLE, False, ends[1:]
            if len(ends):
                lists = pa.ListArray.from_arrays(pa.array([begin, *ends], pa.int32()), lines)
                yield piece(WHOLE, False, pc.binary_join(lists, "\n"))
                begin = int(ends[-1])
            held += lines.slice(begin).to_pylist()
    yield from rest()


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files, without their headers, as text ``record``:
    lines that end inside a quoted field are joined to those after them.  Every
    field that holds a quote must be quoted, as ``write_csv`` leaves it."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    quotes = F.sum(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "block").agg(quotes.alias("quotes")).select(
        "file", "block", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("quotes_before"))
    # a broadcast join leaves the lines in their order
    pieces = lines.join(F.broadcast(blocks), ["file", "block"], "left").mapInArrow(_pieces, "file string, block long, kind int, header boolean, record string")
    cut = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)
    joined = (pieces.where(F.col("kind") != WHOLE)
              .withColumn("n", F.count(F.when(F.col("kind") == BEGIN, 1)).over(cut))
              .groupBy("file", "n").agg(F.sort_array(F.collect_list(F.struct("block", "kind", "record"))).alias("p"), F.bool_or("header").alias("header"))
              .select("header", F.array_join("p.record", "\n").alias("record")))
    return pieces.where(F.col("kind") == WHOLE).select("header", "record").unionByName(joined).where(~F.col("header")).select("record")
