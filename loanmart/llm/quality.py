"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document has a latent score z = w . x over hashed text features, and the
grades 0 < 1 < .. < K share w: P(grade <= k) = logistic(t_k - z) with ordered
thresholds t_0 < t_1 < ..  One model gives the expected grade and the tail
probability P(grade >= k) by which documents are selected.

The weights are fitted on a bounded sample of the rated documents
(``sample_rows``, those of the smallest hashes of their ids; this is the only
thing that is sampled, and what the driver gets is their hashed features, at
most ``DIM`` numbers a document).  Every document of the table is scored, on
its whole text, in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from .common import bound_batches, text_blocks
from .segments import offsets_of, ragged, text_block, word_segments

#: Number of hashed features.
DIM = 1 << 16
#: Rated documents that the model is fitted on, at most.
SAMPLE_ROWS = 8192
STEPS, RATE, DECAY = 100, 0.3, 1e-5
#: Marks at the ends of words that are not part of them.
MARKS = ".,;:!?\"'()[]{}*#$%&|-_"
SCORED = "id long, expected_grade double, tail_probability double"
_SCORED = pa.schema([("id", pa.int64()), ("expected_grade", pa.float64()), ("tail_probability", pa.float64())])


def _hash(name: str) -> int:
    return xxhash.xxh32_intdigest(name.encode(), 1) % DIM


def word_features(word: str) -> list[int]:
    """Hashed features of a word: itself, its beginnings, the marks after it, shouting."""
    core = word.strip(MARKS).lower()
    names = [f"word:{core}", f"four:{core[:4]}", f"five:{core[:5]}"] if core else []
    tail = word[len(word.rstrip("!*#$%&|?;:-_")):]
    if tail:
        names.append(f"tail:{tail[:3]}")
    if len(core) > 1 and word.upper() == word and word.lower() != word:
        names.append("shout")
    return [_hash(n) for n in names]


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document the number of its features; all features and their values.
    A value is the logarithm of 1 + the document's distinct words with the
    feature; a document's values have length 1 together."""
    block = text_block(column)
    seg = word_segments(block)
    words: dict[str, int] = {}
    flat, sizes = [], []
    for a, b in zip(seg.start[seg.first].tolist(), seg.end[seg.first].tolist()):
        own = block.raw(a, b).decode().split()
        sizes.append(len(own))
        flat += [words.setdefault(w, len(words)) for w in own]
    sizes = np.array(sizes, dtype=np.int64)
    per = sizes[seg.which] if len(sizes) else sizes
    word = np.array(flat, dtype=np.int64)[ragged(per, offsets_of(sizes)[:-1][seg.which])] if len(sizes) else per
    total = np.bincount(seg.doc, weights=per, minlength=block.rows)
    width = max(1, len(words))
    pair = np.unique(np.repeat(seg.doc, per) * width + word)
    doc, word = pair // width, pair % width
    distinct = np.bincount(doc, minlength=block.rows)
    lists = [word_features(w) for w in words]
    count = np.array([len(x) for x in lists], dtype=np.int64)
    ids = np.array([i for x in lists for i in x], dtype=np.int64)
    per = count[word] if len(word) else word
    feature = ids[ragged(per, offsets_of(count)[:-1][word])] if len(word) else word
    # how much of a text is repetition
    share = np.array([_hash(f"distinct:{int(8 * d / n) if n else -1}") for d, n in zip(distinct.tolist(), total.tolist())], dtype=np.int64)
    key, times = np.unique(np.concatenate([np.repeat(doc, per), np.arange(block.rows)]) * DIM + np.concatenate([feature, share]), return_counts=True)
    doc, value = key // DIM, np.log1p(times)
    norm = np.sqrt(np.bincount(doc, weights=value * value, minlength=block.rows))
    return np.bincount(doc, minlength=block.rows), key % DIM, value / norm[doc]


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class OrdinalModel:
    """Shared weights and ordered thresholds."""
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, per_doc: np.ndarray, ids: np.ndarray, values: np.ndarray) -> np.ndarray:
        doc = np.repeat(np.arange(len(per_doc)), per_doc)
        return np.bincount(doc, weights=values * self.weights[ids], minlength=len(per_doc))

    def tails(self, z: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. K, a row per score."""
        return _logistic(z[:, None] - self.thresholds[None, :])


def fit_ordinal(per_doc: np.ndarray, ids: np.ndarray, values: np.ndarray, grade: np.ndarray, grades: int) -> OrdinalModel:
    """Maximum likelihood by full-batch Adam; thresholds are a first one and
    the logarithms of the gaps to the next, so they stay in order."""
    n, cuts = len(grade), grades - 1
    doc = np.repeat(np.arange(n, dtype=np.int32), per_doc)
    share = (np.bincount(grade, minlength=grades) + 1.0) / (n + grades)
    edge = np.log(np.cumsum(share)[:-1] / (1 - np.cumsum(share)[:-1]))
    theta = np.concatenate([np.zeros(DIM), edge[:1], np.log(np.maximum(np.diff(edge), 1e-3))])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    rows = np.arange(n)
    for step in range(1, STEPS + 1):
        w, gaps = theta[:DIM], np.exp(theta[DIM + 1:])
        t = theta[DIM] + np.concatenate([[0], np.cumsum(gaps)])
        z = np.bincount(doc, weights=values * w[ids], minlength=n)
        below = np.zeros((n, grades + 1))  # P(grade <= k - 1), k = 0 .. K + 1
        below[:, 1:-1], below[:, -1] = _logistic(t[None, :] - z[:, None]), 1
        slope = below * (1 - below)
        chance = np.maximum(below[rows, grade + 1] - below[rows, grade], 1e-12)
        up, down = slope[rows, grade + 1] / chance, slope[rows, grade] / chance
        at = np.zeros((n, grades + 1))
        at[rows, grade + 1] += up
        at[rows, grade] -= down
        by_cut = at[:, 1:-1].sum(axis=0) / n
        later = np.cumsum(by_cut[::-1])[::-1]
        grad = np.concatenate([np.bincount(ids, weights=values * (down - up)[doc], minlength=DIM) / n - DECAY * w, later[:1], later[1:] * gaps])
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        theta = theta + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return OrdinalModel(theta[:DIM], theta[DIM] + np.concatenate([[0], np.cumsum(np.exp(theta[DIM + 1:]))])[:cuts])


def fit(docs: DataFrame, ratings: DataFrame, grades: int, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel | None:
    """The model of ``ratings (id, grade)``; None if no document is rated.  Of
    several ratings of a document the lowest counts; rows with a null id or
    grade, or of documents that are not there, count for nothing."""
    rated = ratings.where("id IS NOT NULL AND grade IS NOT NULL").groupBy("id").agg(F.min("grade").cast("int").alias("grade"))
    # ratings of absent documents take no place in the sample
    rated = rated.join(docs.select(F.col(id_col).cast("long").alias("id")).distinct(), "id", "left_semi")
    sample = rated.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(sample), "id")
    # a document counts once, whatever its rows
    rows = rows.groupBy("id", "grade").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, "text"):
            per_doc, ids, values = features(batch.column("text"))
            at = offsets_of(per_doc).tolist()
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.int64()), batch.column("grade").cast(pa.int32()), pa.array([ids[a:b].astype("<u2").tobytes() for a, b in zip(at, at[1:])], pa.binary()),
                                              pa.array([values[a:b].astype("<f4").tobytes() for a, b in zip(at, at[1:])], pa.binary())], names=["id", "grade", "ids", "parts"])

    got = rows.mapInArrow(run, "id long, grade int, ids binary, parts binary").toArrow().sort_by("id")
    if not got.num_rows:
        return None
    ids = [np.frombuffer(b, dtype="<u2") for b in got["ids"].to_pylist()]
    values = np.concatenate([np.frombuffer(b, dtype="<f4") for b in got["parts"].to_pylist()])
    return fit_ordinal(np.array([len(x) for x in ids]), np.concatenate(ids), values, np.clip(got["grade"].to_numpy(), 0, grades - 1), grades)


def score(docs: DataFrame, model: OrdinalModel | None, grade: int, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """``(id, expected_grade, tail_probability)`` per row, the tail being
    P(grade >= ``grade``); without a model both are null.  With ``carry`` all
    columns of ``docs`` stay in front, as they are."""
    bound_batches(docs.sparkSession)

    def scored(column: pa.Array) -> list[pa.Array]:
        if model is None:
            return [pa.nulls(len(column), pa.float64())] * 2
        tails = model.tails(model.score(*features(column)))
        return [pa.array(tails.sum(axis=1)), pa.array(tails[:, grade - 1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), *scored(batch.column("text"))], names=[batch.schema.names[0], *_SCORED.names[1:]])

    text = F.col(text_col).cast("string").alias("text")
    if not carry:
        return docs.select(F.col(id_col).cast("long").alias("id"), text).mapInArrow(run, SCORED)
    whole = docs.select(F.struct("*").alias("row"), text)
    schema = StructType([whole.schema["row"]]).add("expected_grade", DoubleType()).add("tail_probability", DoubleType())
    return whole.mapInArrow(run, schema)


def corpus_ratings(labels: DataFrame) -> DataFrame:
    """Grades of the table ``labels (doc_id, quality, toxic)``: 0 toxic, 1 low
    quality, 2 good.  A null flag is no evidence against a document."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 2)
    return labels.select(F.col("doc_id").cast("long").alias("id"), grade.alias("grade"))


def classify(docs: DataFrame, labels: DataFrame, least: float = 0.7, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: ``(doc_id, expected_grade, tail_probability,
    kept)``, kept if P(grade = good) is at least ``least``.

    A null or empty text is scored by its one feature, "no words".  Rows are
    scored each on their own; a null id stays null.  Without any rated
    document there is no evidence and every row is kept, its scores null.
    """
    out = score(docs, fit(docs, corpus_ratings(labels), 3, sample_rows), 2)
    return out.select(F.col("id").alias("doc_id"), "expected_grade", "tail_probability", (F.coalesce("tail_probability", F.lit(1.0)) >= least).alias("kept"))


def select_good(docs: DataFrame, labels: DataFrame, least: float = 0.7, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs``, with its columns, that ``classify`` keeps."""
    out = score(docs, fit(docs, corpus_ratings(labels), 3, sample_rows), 2, carry=True)
    return out.where(F.coalesce("tail_probability", F.lit(1.0)) >= least).select("row.*")
