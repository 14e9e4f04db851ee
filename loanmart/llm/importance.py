"""Target-distribution importance resampling over hashed n-grams.

A feature's bucket is the CRC-32 of its bytes.  Instead of hashing every
n-gram, a block of documents is scanned once: its words, separated by one
blank, form a normalised stream, and the CRC register after every byte of it
is kept.  The CRC of any n-gram follows from two of these prefixes, because
the register is linear over GF(2): shifting the first prefix by the n-gram's
length and adding it to the second cancels all that stands before.

The scan leaves each document's distinct buckets and their frequencies in a
scratch table; counts over the corpus, weights and scores come from that
table, so no text is read twice.  The corpus counts, one number per bucket,
are the only thing that the driver sees.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, read_binary, release, text_blocks, written
from .segments import Block, offsets_of, ragged, text_block

#: Fixed value: the reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
ONES = np.uint32(0xFFFFFFFF)
#: Bytes of a lane; the lanes of a block are scanned side by side.
LANE = 1024
FEATURES = "doc_id long, n_words long, n_features long, buckets binary, times binary"
_FEATURES = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("buckets", pa.binary()), ("times", pa.binary())])
COUNTS = "bucket int, n long"
_COUNTS = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])
WEIGHTS = "doc_id long, n_words long, n_features long, weight long"
_WEIGHTS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])


@lru_cache(maxsize=1)
def _word_bytes() -> np.ndarray:
    """By byte: 0 outside words, else the byte with A-Z lower-cased."""
    out = np.zeros(256, dtype=np.uint8)
    for b in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
        out[b] = b
    out[0x41:0x5B] = np.arange(0x61, 0x7B)
    return out


# ------------------------------------------------------------- CRC by prefixes
@lru_cache(maxsize=1)
def _step() -> np.ndarray:
    """The register's change by its low byte, one byte of input later."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), out >> np.uint32(1))
    return out


def _apply(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A linear map of registers, given as a table per byte of the register."""
    return table[0][x & np.uint32(255)] ^ table[1][(x >> np.uint32(8)) & np.uint32(255)] ^ table[2][(x >> np.uint32(16)) & np.uint32(255)] ^ table[3][x >> np.uint32(24)]


@lru_cache(maxsize=64)
def _shift_table(power: int) -> np.ndarray:
    """The map that feeds 2**power zero bytes, as four tables."""
    if power:
        half = _shift_table(power - 1)
        return np.stack([_apply(half, half[k]) for k in range(4)])
    x = np.arange(256, dtype=np.uint32)
    step = _step()
    out = []
    for k in range(4):
        v = x << np.uint32(8 * k)
        out.append(step[v & np.uint32(255)] ^ (v >> np.uint32(8)))
    return np.stack(out)


def shift(register: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Registers after so many zero bytes each."""
    out = register.astype(np.uint32)
    for power in range(int(zeros.max()).bit_length() if len(zeros) else 0):
        at = np.flatnonzero((zeros >> power) & 1)
        if len(at):
            out[at] = _apply(_shift_table(power), out[at])
    return out


def prefixes(stream: np.ndarray) -> np.ndarray:
    """The register (from zero) before the first and after every byte of the stream."""
    n = len(stream)
    lanes = -(-n // LANE)
    padded = np.zeros(lanes * LANE, dtype=np.uint8)
    padded[:n] = stream
    by_place = np.ascontiguousarray(padded.reshape(lanes, LANE).T).astype(np.uint32)
    out = np.empty((LANE, lanes), dtype=np.uint32)
    step, state = _step(), np.zeros(lanes, dtype=np.uint32)
    for k in range(LANE):
        state = step[(state ^ by_place[k]) & np.uint32(255)] ^ (state >> np.uint32(8))
        out[k] = state
    # what stands before a lane, shifted through it, is added to each of its prefixes
    carry = np.zeros(lanes, dtype=np.uint32)
    whole = _shift_table(LANE.bit_length() - 1)
    for k in range(1, lanes):
        carry[k] = out[-1, k - 1] ^ _apply(whole, carry[k - 1: k])[0]
    for k in range(LANE):
        carry = _apply(_shift_table(0), carry)
        out[k] ^= carry
    return np.concatenate([np.zeros(1, dtype=np.uint32), np.ascontiguousarray(out.T).reshape(-1)[:n]])


def crc_of(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of the stream's bytes ``start .. end``, each from two prefixes."""
    return prefix[end] ^ shift(prefix[start] ^ ONES, end - start) ^ ONES


def word_stream(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of a block's documents, lower-cased, one blank after each;
    their starts and ends in that stream, and the number of words by document."""
    low = _word_bytes()[block.data]
    inside = low > 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = block.offsets[:-1][block.sizes > 0]
    first[starts] = inside[starts]
    begin = np.flatnonzero(first)
    kept = low[inside]
    # a word ends where the next begins, counted in word bytes only
    at = np.cumsum(inside, dtype=np.int64)[begin] - 1 if len(begin) else begin
    size = np.diff(np.append(at, len(kept)))
    start = at + np.arange(len(begin))
    stream = np.full(len(kept) + len(begin), 0x20, dtype=np.uint8)
    stream[ragged(size, start)] = kept
    per_doc = np.bincount(np.searchsorted(block.offsets, begin, "right") - 1, minlength=block.rows)
    return stream, start, start + size, per_doc


def features(block: Block, buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By document: words and features (n-grams of 1 to ``longest`` words);
    then document, bucket and frequency of every distinct bucket of a document."""
    stream, start, end, words = word_stream(block)
    prefix = prefixes(stream)
    doc = np.repeat(np.arange(block.rows), words)
    n_features = np.zeros(block.rows, dtype=np.int64)
    found = []
    for n in range(1, longest + 1):
        last = np.arange(n - 1, len(start))
        whole = doc[last] == doc[: len(last)] if n > 1 else np.ones(len(last), dtype=bool)
        first, last = last[whole] - (n - 1), last[whole]
        crc = crc_of(prefix, start[first], end[last])
        found.append(doc[first] * buckets + crc % np.uint32(buckets))
        n_features += np.maximum(words - (n - 1), 0)
    pair, times = np.unique(np.concatenate(found), return_counts=True)
    return words, n_features, pair // buckets, pair % buckets, times


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def document_features(docs: DataFrame, buckets: int, longest: int, id_col: str, text_col: str) -> DataFrame:
    """Per document its counts of words and features, its distinct buckets and their frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, "text"):
            words, n_features, doc, bucket, times = features(text_block(batch.column("text")), buckets, longest)
            per_doc = offsets_of(np.bincount(doc, minlength=batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(words, pa.int64()), pa.array(n_features),
                                              _binary(bucket.astype(_kind(buckets)), per_doc), _binary(times.astype("<u4"), per_doc)], schema=_FEATURES)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, FEATURES)


def _binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Runs of values as a binary column."""
    at = (offsets * values.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(at), pa.py_buffer(values)])


def bucket_counts(table: DataFrame, buckets: int) -> np.ndarray:
    """Occurrences of every bucket over all documents of a feature table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            bucket, _ = read_binary(batch.column("buckets"), _kind(buckets))
            times, _ = read_binary(batch.column("times"), "<u4")
            np.add.at(total, bucket, times.astype(np.int64))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], schema=_COUNTS)

    summed = table.select("buckets", "times").mapInArrow(run, COUNTS).groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for row in summed.collect():  # at most one row per bucket
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) by bucket: in thousandths, how
    much likelier a bucket is in the target than in the corpus."""
    n = len(corpus)
    up = (target + 1).astype(np.float64) * float(int(corpus.sum()) + n)
    down = (corpus + 1).astype(np.float64) * float(int(target.sum()) + n)
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def document_weights(table: DataFrame, gain: np.ndarray) -> DataFrame:
    """Per document the sum of its features' gains."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket, offsets = read_binary(batch.column("buckets"), _kind(buckets))
            times, _ = read_binary(batch.column("times"), "<u4")
            total = np.concatenate([[0], np.cumsum(gain[bucket] * times.astype(np.int64))])[offsets]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_words", "n_features")), pa.array(np.diff(total), pa.int64())], schema=_WEIGHTS)
        release()

    return table.mapInArrow(run, WEIGHTS)


def ranked(rows: DataFrame, draw: int) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, 3 ... for the first ``draw`` eligible ones by
    score (largest first), doc_id (smallest first, null last), n_features; null
    for the others.

    Eligible rows are range-partitioned in that order and written; each is
    numbered within its partition, and the counts of earlier partitions, one
    row per partition, are added.
    """
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc()]
    some = rows.where("eligible").repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    some = written(some.sortWithinPartitions("part", *order).withColumn("place", F.monotonically_increasing_id()), "importance-order")
    firsts = some.groupBy("part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = firsts.select("part", "first", before.alias("before"))
    rank = F.col("place") - F.col("first") + F.col("before") + 1
    numbered = some.join(F.broadcast(starts), "part").withColumn("rank", F.when(rank <= draw, rank))
    columns = ["doc_id", "n_features", "weight", "score"]
    return numbered.select(*columns, "rank").unionByName(rows.where("NOT eligible").select(*columns, F.lit(None).cast("long").alias("rank")))


def importance_resample(docs: DataFrame, target: DataFrame, buckets: int = 10_000, longest: int = 1, percent: int = 10, least_words: int = 20,
                        seed: int = 2024, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` per row of ``docs``: how much
    its n-grams of up to ``longest`` words resemble the target's, that weight
    with Gumbel noise from the id, and the rank among the ``percent`` % of the
    documents of at least ``least_words`` words that are drawn (null: not drawn).

    Words are runs of digits, letters A-Z (lower-cased) and characters beyond
    ASCII.  A null or empty text has no words, weight 0, and is not drawn
    unless ``least_words`` is 0.  Rows are documents: repeats of an id or a
    text count each; rows of one id share their noise, a null id has the noise
    of an empty one and comes last among ties.  An empty target or corpus
    counts 0 everywhere.  Other columns are ignored.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    table = written(document_features(docs, buckets, longest, id_col, text_col), "importance-features")
    wanted = document_features(target.select(F.lit(0).alias("id"), F.col(target_col).alias("text")), buckets, longest, "id", "text")
    gain = gains(bucket_counts(table, buckets), bucket_counts(wanted, buckets))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    rows = document_weights(table, gain).withColumn("score", F.col("weight") + noise).withColumn("eligible", F.col("n_words") >= least_words)
    rows = written(rows, "importance-scores")
    return ranked(rows, percent * rows.where("eligible").count() // 100)


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that ``importance_resample`` draws, all their columns.
    ``docs`` needs an id per row: of an id that repeats, all rows come if one is drawn."""
    drawn = importance_resample(docs, target, id_col=id_col, **options).where("rank IS NOT NULL").select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(drawn, F.col(id_col).cast("long").eqNullSafe(F.col("_drawn")), "left_semi")
