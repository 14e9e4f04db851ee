"""What the operators of this subpackage share: reading tables, scratch
tables on the shared folder, blocks of whole documents inside a task, and
connected components over an edge table."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmart.session import checkpoint_dir

#: Text bytes that a task works on at once (one longer document is a block of its own).
BLOCK_BYTES = 4 << 20
#: Bytes of an Arrow batch between the JVM and Python; rows may be very long.
BATCH_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, unless the session already does."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(str(spark.conf.get(key, str(2**31 - 1))).rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage, so
    that a lost executor costs no more than a read."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def release() -> None:
    """Give memory that a task has freed back to the system: Python workers
    stay idle for a while after it, beside those of the next stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def text_blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows with at most ``limit`` bytes of text, in input order."""
    held: list[pa.RecordBatch] = []
    size = 0

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        col = batch.column(column)
        lengths = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy(zero_copy_only=False)
        start = 0
        for i, n in enumerate(lengths.tolist()):
            if size and size + n > limit:
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield joined()
                held, size, start = [], 0, i
            size += n
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if sum(b.num_rows for b in held):
        yield joined()
    held = []
    release()


def read_binary(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column of packed numbers, and where each row's begin and end."""
    _, offsets, data = column.buffers()
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    at = np.frombuffer(offsets, dtype=wide)[column.offset: column.offset + len(column) + 1].astype(np.int64) if offsets is not None else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0]: at[-1]].tobytes() if data is not None else b""
    return np.frombuffer(raw, dtype=kind), (at - at[0]) // np.dtype(kind).itemsize


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``), ``id``, ``body`` (the
    text, empty for null) and ``version``, which names a text together with the id."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), body.alias("body")).withColumn("version", F.xxhash64("body"))


def row_text(text_col: str) -> Column:
    """The text inside ``row``: after a join of ``keyed`` rows, so that a
    shuffle moves each text once."""
    return F.coalesce(F.col("row")[text_col].cast("string"), F.lit(""))


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of an undirected edge table ``(a, b)`` of any type
    with an order: ``(id, component)`` for every id that has an edge to
    another, component = smallest id.

    Alternating large-star and small-star rounds: each round is one or two
    shuffles with map-side combination, no list of neighbours is ever held,
    and the edge table is rewritten each round so the plan does not grow.
    The number of rounds is logarithmic in the diameter.
    """
    spark = edges.sparkSession
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-edges")
    n = edges.count()
    while n:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        # large star: every larger neighbour of a points to the least of a's neighbourhood
        low = low.select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = edges.join(low, edges.b == low.n).select("a", F.col("m").alias("b"))
        large = written(large.where("a <> b").distinct(), f"{name}-large")
        # small star: a's smaller neighbours point to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(least, "a")
        small = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(least.select("a", F.col("m").alias("b")))
        new = written(small.distinct(), f"{name}-small")
        changed = new.join(edges, ["a", "b"], "left_anti").limit(1).count() or new.count() != n
        edges, n = new, new.count()
        if not changed:
            break
    stars = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return stars.unionByName(roots)
