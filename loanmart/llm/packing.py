"""Harmonic packing of tokenized documents into fixed-length sequences.

A length l belongs to the reciprocal class k = capacity // l, i.e. to
(capacity / (k + 1), capacity / k]; a bin of class k takes exactly k documents.
A document of at most ``capacity`` tokens goes into its class whole; a longer
one gives whole sequences first and its remainder then.  What a full bin still
has room for, at most capacity / (k + 1) tokens for k > 1, is filled with
tokens cut off a filler: whenever there is none, the next document becomes it.
So all sequences are full, about a fifth of the tokens are cut, and the other
documents stay whole.

A worker (task) fills the bins of its own partition and needs nothing from any
other.  What its last, unfilled bins hold is laid end to end, cut into
sequences, and the rest of that by its binary digits: a sequence of a power of
two of tokens is a length of its own and needs no padding either.

No shuffle: the operator is one pass over the documents, and a task holds a
block of texts, a filler and at most one open bin per class.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, text_blocks
from .segments import Block, after_white, offsets_of, ragged, text_block, word_segments

#: The vocabulary of byte_bpe_50k.json as ranks.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
SPECIAL = {"<|endoftext|>": 50256}
PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
_PIECE = pa.schema([(c.split()[0], pa.int64()) for c in PIECE.split(", ")])


@lru_cache(maxsize=1)
def encoder(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding, and the bytes of every id."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    size = np.zeros(max(*ranks.values(), *SPECIAL.values()) + 1, dtype=np.int64)
    for piece, i in [*ranks.items(), *((k.encode(), i) for k, i in SPECIAL.items())]:
        size[i] = len(piece)
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL), size


def encode_block(block: Block, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, and their number per text; each distinct segment is
    encoded once.  No token holds white space after another character, so a
    text's ids are those of its segments."""
    enc, size = encoder(path)
    seg = word_segments(block)
    if not len(seg.start):
        return np.zeros(0, np.uint32), np.zeros(block.rows, np.int64)
    start, end = seg.start[seg.first], seg.end[seg.first]
    lead = block.data[start]
    plain = ((lead == 32) | (lead == 10)) & ~after_white(block.data, end)
    ids, counts = [], np.zeros(len(start), dtype=np.int64)
    # segments that start with white space and end without can be encoded in one text
    joined = block.data[ragged(end[plain] - start[plain], start[plain])].tobytes().decode()
    got = np.asarray(enc.encode_to_numpy(joined, allowed_special="all"))
    stop = np.cumsum(end[plain] - start[plain])
    done = np.cumsum(size[got])
    last = np.searchsorted(done, stop)
    if len(stop) and (done[-1] != stop[-1] or (done[last] != stop).any()):
        raise ValueError("a token crosses a segment")
    counts[plain] = np.diff(last, prepend=-1)
    ids.append(got)
    order = [np.flatnonzero(plain)]
    for i in np.flatnonzero(~plain).tolist():
        one = np.asarray(enc.encode_to_numpy(block.raw(start[i], end[i]).decode(), allowed_special="all"))
        ids.append(one)
        counts[i] = len(one)
        order.append([i])
    order = np.concatenate(order)
    offsets = np.zeros(len(start), dtype=np.int64)
    offsets[order] = offsets_of(counts[order])[:-1]
    per = counts[seg.which]
    out = np.concatenate(ids)[ragged(per, offsets[seg.which])]
    return out.astype(np.uint32), np.bincount(seg.doc, weights=per, minlength=block.rows).astype(np.int64)


def with_end(ids: np.ndarray, counts: np.ndarray, end: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The same with the id ``end`` after every document."""
    out = np.full(len(ids) + len(counts), end, dtype="<u4")
    out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
    return out, counts + 1


class Bins:
    """The open bins of one worker, the filler, and the bins that wait for one.
    A piece is ``(doc, start, ids, doc_tokens)``."""

    def __init__(self, worker: int, capacity: int):
        self.capacity, self.next = capacity, worker << 32
        self.open: dict[int, list[tuple]] = {}
        self.filler: tuple | None = None
        self.waiting: list[list[tuple]] = []
        self.ready: list[tuple] = []

    def close(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            self.ready.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next, at))
            at += len(ids)
        self.next += 1

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        """A document's ids: whole sequences, and what remains."""
        total, start = len(ids), 0
        for start in range(self.capacity, total + 1, self.capacity):
            self.close([(doc, start - self.capacity, ids[start - self.capacity: start], total)])
        if start == total:
            return
        piece = (doc, start, ids[start:].copy(), total)
        if self.filler is None:
            self.filler = piece
        else:
            k = self.capacity // (total - start)
            held = self.open.setdefault(k, [])
            held.append(piece)
            if len(held) == k:
                self.waiting.append(self.open.pop(k))
        self.fill()

    def fill(self) -> None:
        while self.waiting:
            room = self.capacity - sum(len(p[2]) for p in self.waiting[-1])
            if room and self.filler is None:
                return
            if room:
                head, self.filler = cut(self.filler, room)
                self.waiting[-1].append(head)
            if room == 0 or len(head[2]) == room:
                self.close(self.waiting.pop())

    def finish(self) -> None:
        """Close what is left, all of it in full sequences but for the last tokens."""
        left = [p for held in [*self.waiting, *self.open.values()] for p in held] + [self.filler] * (self.filler is not None)
        self.waiting, self.open, self.filler = [], {}, None
        rest = sum(len(p[2]) for p in left)
        held: list[tuple] = []
        while rest:
            room = self.capacity if rest >= self.capacity else 1 << (rest.bit_length() - 1)
            rest -= room
            while room:
                head, tail = cut(left.pop(0), room)
                left[:0] = [tail] if tail else []
                held.append(head)
                room -= len(head[2])
            self.close(held)
            held = []

    def take(self) -> pa.RecordBatch:
        cols = list(zip(*self.ready)) or [()] * len(_PIECE)
        self.ready = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=_PIECE)


def cut(piece: tuple, length: int) -> tuple[tuple, tuple | None]:
    """The first ``length`` ids of a piece, and the others (None if there are none)."""
    doc, start, ids, total = piece
    return (doc, start, ids[:length], total), (doc, start + length, ids[length:], total) if len(ids) > length else None


def pack(docs: DataFrame, capacity: int = 1024, path: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents in sequences of at most ``capacity`` tokens,
    see PIECE: ``start`` counts a document's ids before the piece, ``length``
    its ids, ``ids_crc32`` is the CRC-32 of the ids as little-endian unsigned
    32-bit numbers, ``doc_tokens`` the document's ids with the id 0 that ends
    every document, ``offset`` the place in the sequence, gapless from 0.

    A null or empty text is the one id 0.  Documents are rows: repeated ids
    and texts are packed as often as they come; a null id stays null.  The
    strings of special tokens inside texts become those tokens, as the
    library does by default.  Other columns are ignored.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(TaskContext.get().partitionId(), capacity)
        for batch in text_blocks(batches, "text"):
            ids, counts = with_end(*encode_block(text_block(batch.column("text")), path))
            at = 0
            for doc, total in zip(batch.column("id").to_pylist(), counts.tolist()):
                bins.add(doc, ids[at: at + total])
                at += total
            yield bins.take()
        bins.finish()
        yield bins.take()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, PIECE)
