"""Exact dedup: a binomial tree of sorted digest runs.

Every partition reduces its rows to a sorted run of records ``(digest, sha,
length, keep, count)``.  The runs are then exchanged in binomial rounds: the
partition number is a word of k bits, and a round replaces b of them with the
matching bits of the record's digest, so that 2**b partitions swap slices of
their runs.  Each receiver merges the slices (Spark's external sort) and keeps
one record per text: the row that stays and the number of rows.  After
ceil(k / b) rounds a partition owns one digest prefix.

A text with copies in every partition reaches a partition as at most 2**b
records in any round, so no task ever holds a hot group.

``digest`` is a 64-bit hash that orders and routes the runs; it alone never
decides that texts are equal.  Every merge verifies a digest hit with the
SHA-256 and the byte length of the whole texts, and records that differ in
either stay apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, shuffle_partitions, written

RUN = "home int, digest long, sha binary, length long, keep long, count long"
_RUN_ARROW = pa.schema([("home", pa.int32()), ("digest", pa.int64()), ("sha", pa.binary()),
                        ("length", pa.int64()), ("keep", pa.int64()), ("count", pa.int64())])
#: The null id: smaller than any other, so that it stays only among nulls.
_NO_ID = -(2**63)


def merge_run(batches: Iterator[pa.RecordBatch], largest: bool) -> Iterator[pa.RecordBatch]:
    """One record per (digest, sha, length) of a sorted run, batch by batch."""
    pick = np.maximum if largest else np.minimum
    last: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch]).cast(_RUN_ARROW)
        if last is not None:
            rows = pa.concat_tables([last, rows])
        rows = rows.combine_chunks()
        digest = rows["digest"].to_numpy()
        length = rows["length"].to_numpy()
        sha = np.frombuffer(b"".join(rows["sha"].to_pylist()), dtype="V32")
        new = np.ones(len(digest), dtype=bool)
        new[1:] = (digest[1:] != digest[:-1]) | (length[1:] != length[:-1]) | (sha[1:] != sha[:-1])
        starts = np.flatnonzero(new)
        keep = pick.reduceat(rows["keep"].to_numpy(), starts)
        count = np.add.reduceat(rows["count"].to_numpy(), starts)
        out = rows.take(pa.array(starts))
        out = out.set_column(4, "keep", pa.array(keep)).set_column(5, "count", pa.array(count)).cast(_RUN_ARROW)
        last = out.slice(len(starts) - 1)
        yield from out.slice(0, len(starts) - 1).combine_chunks().to_batches()
    if last is not None:
        yield from last.combine_chunks().to_batches()


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, digest, sha, length)`` per row; a null text counts as empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("digest"),
                       F.unhex(F.sha2(text, 256)).alias("sha"), F.octet_length(text).cast("long").alias("length"))


def tree_merge(hashed: DataFrame, largest: bool = True, bits: int = 3) -> DataFrame:
    """One record per distinct text of a table of ``digests``: ``(digest, sha,
    length, keep, count)``, merged in binomial rounds of 2**bits partitions."""
    k = max(1, (shuffle_partitions(hashed.sparkSession) - 1).bit_length())
    order = ["digest", "length", "sha"]

    def merged(df: DataFrame) -> DataFrame:
        return df.sortWithinPartitions(*order).mapInArrow(lambda it: merge_run(it, largest), RUN)

    no_id = F.lit(_NO_ID if largest else 2**63 - 1)
    runs = merged(hashed.select(F.pmod(F.spark_partition_id(), F.lit(1 << k)).alias("home"), *order[:1], "sha", "length",
                                F.coalesce("id", no_id).alias("keep"), F.lit(1).cast("long").alias("count")))

    def swapped(low: int, width: int) -> Column:
        """``home`` with bits [low, low + width) taken from the digest."""
        mask = ((1 << width) - 1) << low
        return (F.col("home").bitwiseAND(F.lit((1 << k) - 1 - mask)) + F.col("digest").bitwiseAND(F.lit(mask)).cast("int")).cast("int")

    done = 0
    while done < k:
        width = min(bits, k - done)
        runs = runs.withColumn("home", swapped(done, width)).repartitionById(1 << k, F.col("home"))
        runs = merged(runs)
        done += width
    return runs.select("digest", "sha", "length", F.nullif(F.col("keep"), no_id).alias("keep"), "count")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = True) -> DataFrame:
    """One row per row of ``docs``, dropped ones too: ``(id, keep_id,
    group_size, kept, text_sha256)``.

    Texts are equal when their whole UTF-8 bytes are; null counts as empty.
    Of equal texts the row with the largest id stays (``largest=False``: the
    smallest).  A null id loses to any other and is kept only when the whole
    group has null ids (``keep_id`` null).  Rows that repeat the id that stays
    are all marked kept; group_size counts rows.  Other columns of ``docs``
    are ignored, an empty table gives an empty result.
    """
    bound_batches(docs.sparkSession)
    hashed = written(digests(docs, id_col, text_col), "exact-digests")
    many = tree_merge(hashed, largest).where("count > 1")
    out = hashed.join(many, ["digest", "sha", "length"], "left")
    alone = F.col("count").isNull()
    keep = F.when(alone, F.col("id")).otherwise(F.col("keep"))
    return out.select(F.col("id").alias(id_col), keep.alias("keep_id"), F.coalesce("count", F.lit(1).cast("long")).alias("group_size"),
                      F.col("id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
