"""Audit of how filters interact: what each step of every order of the
filters removes, in one pass over the documents.

A document's outcome in all orders depends only on which filters it fails, its
mask.  Every mask stands for one big integer: a field for each step of each
order (5 filters: 120 orders of 5 steps, 600 steps), six counters in a field,
holding 0 or 1.  The integers of a part's documents are summed, task by task
and then part by part, and the sum is unpacked.  A counter has as many bits as
the number of all documents, so none can run over into its neighbour.

Whether a text is a repeat is settled before by its SHA-256: rows meet by
digest only as counts, so a text that stands in a third of all rows is a few
rows per digest.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, release, text_blocks, written

#: Counters of a field, lowest first.
COUNTERS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
FILTERS = "ABCDE"
#: The filter that needs the whole table; the others are bits 0 to 3 of a mask.
REPEATED = FILTERS.index("E")
#: Parts that a task holds sums of before it passes them on.
HELD_PARTS = 256
SALTS = 64
_NOT_UPPER = bytes(b for b in range(256) if not 0x41 <= b <= 0x5A)
_MARKS = re.compile(rb"[#$%&*|]")
ROW = "doc_id long, part string, mask int, digest binary"
_ROW = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("digest", pa.binary())])
PACKED = "part string, salt int, total binary"
_PACKED = pa.schema([("part", pa.string()), ("salt", pa.int32()), ("total", pa.binary())])
STEP = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
_STEP = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *((c, pa.int64()) for c in (*COUNTERS, "shapley"))])


def failures(text: bytes) -> int:
    """The mask of the filters that look at one text: A under 100 words, B
    100 distinct < 80 words, C 100 capitals > 10 code points, D any of #$%&*|."""
    words = text.split()  # bytes: at [\x20\x09-\x0D] only
    points = len(text) if text.isascii() else len(text.decode())
    return (
        (len(words) < 100)
        | (100 * len(set(words)) < 80 * len(words)) << 1
        | (100 * len(text.translate(None, _NOT_UPPER)) > 10 * points) << 2
        | (_MARKS.search(text) is not None) << 3
    )


# ------------------------------------------------------------ packed counters
def orders() -> list[str]:
    return ["".join(p) for p in itertools.permutations(FILTERS)]


def pack_outcomes(mask: int, good: bool, toxic: bool, width: int) -> int:
    """The big integer of a document: its outcome at every step of every order,
    first step lowest, counters of ``width`` bits."""
    out, at = 0, 0
    for order in orders():
        gone = False
        for letter in order:
            fails = bool(mask >> FILTERS.index(letter) & 1)
            removed = fails and not gone
            redundant = fails and gone
            gone |= fails
            alone = fails and mask & (mask - 1) == 0
            for bit in (not gone, removed, redundant, alone, removed and good, removed and toxic):
                out |= bit << at
                at += width
    return out


def unpack(total: int, width: int) -> list[tuple]:
    """``(order, step, counters..., shapley)`` of a sum."""
    n_bytes = (width * len(COUNTERS) * len(FILTERS) * len(orders()) + 7) // 8
    raw, low = total.to_bytes(n_bytes, "little"), (1 << width) - 1

    def counter(k: int) -> int:
        a, b = k * width // 8, -(-(k + 1) * width // 8)
        return int.from_bytes(raw[a:b], "little") >> (k * width - 8 * a) & low

    rows, shapley = [], dict.fromkeys(FILTERS, 0)
    for i, order in enumerate(orders()):
        for step, letter in enumerate(order):
            field = (i * len(FILTERS) + step) * len(COUNTERS)
            values = [counter(field + c) for c in range(len(COUNTERS))]
            shapley[letter] += values[COUNTERS.index("removed")]
            rows.append((order, step + 1, *values))
    return [(*r, shapley[r[0][r[1] - 1]]) for r in rows]


def _bytes(n: int) -> bytes:
    return n.to_bytes((n.bit_length() + 7) // 8, "little")


def _summed(rows: Iterator[tuple[str, int, int]], hold: int) -> Iterator[pa.RecordBatch]:
    """Sums by (part, salt) of ``(part, salt, integer)``, passed on whenever ``hold`` of them are held."""
    total: dict[tuple[str, int], int] = {}

    def batch() -> pa.RecordBatch:
        keys, values = zip(*total.items()) if total else ((), ())
        parts, salts = zip(*keys) if keys else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(parts, pa.string()), pa.array(salts, pa.int32()), pa.array(map(_bytes, values), pa.binary())], schema=_PACKED)

    for part, salt, n in rows:
        if (part, salt) not in total and len(total) >= hold:
            yield batch()
            total = {}
        total[part, salt] = total.get((part, salt), 0) + n
    yield batch()


# ------------------------------------------------------------------- in Spark
def masks(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """Per document the mask of the filters A to D and the digest of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, "text"):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(map(failures, texts), pa.int32()),
                                              pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())], schema=_ROW)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, ROW)


def outcomes(rows: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """``(part, mask, good, toxic, n)``: counts of documents by mask with
    filter E in it, one row for each text and kind of document."""
    label = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    kind = ["digest", "part", "mask", "good", "toxic"]
    told = rows.join(label, "doc_id", "left").select("doc_id", "digest", "part", "mask", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")))
    by_id = told.groupBy("doc_id", *kind).agg(F.count("*").alias("n"))
    # rows of a kind with the smallest id of all may be the first of their text; a null id is neither before nor after any
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    unknown = F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0))
    kinds = written(by_id.groupBy(*kind).agg(F.sum("n").alias("n"), least.alias("least"), unknown.alias("unknown")), "audit-kinds")
    first = kinds.groupBy("digest").agg(F.min("least.doc_id").alias("first"))
    kinds = kinds.join(first, "digest")
    fresh = F.col("unknown") + F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    split = F.array(F.struct(F.col("mask").alias("mask"), fresh.alias("n")),
                    F.struct((F.col("mask") + (1 << REPEATED)).alias("mask"), (F.col("n") - fresh).alias("n")))
    return kinds.select("part", "good", "toxic", F.explode(split).alias("s")).select("part", "good", "toxic", "s.mask", "s.n").where("n > 0")


def packed_sums(rows: DataFrame, width: int) -> DataFrame:
    """``(part, salt, total)``: sums of the integers of ``(part, mask, good, toxic, n)``."""

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, int] = {}
        salt = TaskContext.get().partitionId() % SALTS

        def integers() -> Iterator[tuple[str, int, int]]:
            for batch in batches:
                for part, *outcome, n in zip(*(batch.column(c).to_pylist() for c in ("part", "mask", "good", "toxic", "n"))):
                    key = tuple(outcome)
                    if key not in known:
                        known[key] = pack_outcomes(*key, width)
                    yield part, salt, n * known[key]

        yield from _summed(integers(), HELD_PARTS)
        release()

    return rows.mapInArrow(start, PACKED)


def added(sums: DataFrame, last: bool) -> DataFrame:
    """Sums of sums, by part and salt, and at ``last`` by part alone."""

    def run(table: pa.Table) -> pa.Table:
        total = sum((int.from_bytes(b, "little") for chunk in table["total"].chunks for b in (v.as_py() for v in chunk)), 0)
        return pa.table([pa.array([table["part"][0].as_py()], pa.string()), pa.array([0 if last else table["salt"][0].as_py()], pa.int32()),
                         pa.array([_bytes(total)], pa.binary())], schema=_PACKED)

    return sums.groupBy("part", *([] if last else ["salt"])).applyInArrow(run, PACKED)


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """A row per part (value of ``part_col``; null counts as the empty string),
    order of the five filters and step, with counts of the part's documents:
    ``kept`` after the step, ``removed`` there, ``redundant`` (failing its
    filter, but removed earlier), ``unique_fails`` (failing its filter only),
    ``good_lost`` and ``toxic_lost`` (removed there and rated quality 1, toxic
    1), and ``shapley`` (what its filter removes, summed over all orders).

    Filters: A under 100 words; B 100 distinct words < 80 words; C 100 capitals
    A-Z > 10 code points; D any of #$%&*|; E the text stands under a smaller id
    of the table.  Words are case-sensitive runs without [\\x20\\x09-\\x0D].  A
    null text is empty.  Rows are documents: of rows that share the smallest id
    of a text none fails E, and a row with a null id neither fails it nor makes
    others fail.  An id rated more than once is good or toxic if any of its
    ratings says so; null ratings and ratings of null or absent ids count
    nothing.  An empty table gives no rows; other columns are ignored.
    """
    bound_batches(docs.sparkSession)
    rows = written(masks(docs, id_col, text_col, part_col), "audit-masks")
    width = max(1, rows.count().bit_length())
    sums = packed_sums(outcomes(rows, labels, id_col), width)
    total = added(added(sums, last=False), last=True)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw in zip(batch.column("part").to_pylist(), batch.column("total").to_pylist()):
                found = [(part, *row) for row in unpack(int.from_bytes(raw, "little"), width)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), _STEP.types)], schema=_STEP)

    return total.mapInArrow(steps, STEP)
