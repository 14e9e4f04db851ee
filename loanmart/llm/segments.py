"""Splitting a block of texts into segments, vectorised over its bytes.

A segment is a run of white space with the run of other characters after it.
Natural text repeats most of its segments, so the operators handle every
distinct segment of a block once and gather the results back.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

_PRIME = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)
#: ASCII characters that some tokenizer may call white space.
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True


@lru_cache(maxsize=1)
def _powers(bits: int) -> np.ndarray:
    out = np.full(1 << bits, _PRIME, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


@dataclass
class Block:
    """Texts of a block: bytes, offsets of the documents in them."""
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.offsets)

    def raw(self, start: int, end: int) -> bytes:
        return self.data[start:end].tobytes()


def text_block(column: pa.Array) -> Block:
    """A string column as a block; nulls are empty."""
    column = pa.compute.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0]: offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return Block(data, offsets - offsets[0])


def after_white(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before byte ``at`` is white space (of
    any Unicode kind); ``at`` is at least 1."""
    def back(n: int) -> np.ndarray:
        return np.where(at >= n, data[np.maximum(at - n, 0)], 0)

    p1 = back(1)
    found = _WHITE[p1]
    if not (p1 >= 0x80).any():
        return found
    p2, p3 = back(2), back(3)
    found |= (p2 == 0xC2) & ((p1 == 0x85) | (p1 == 0xA0))
    found |= (p3 == 0xE2) & (p2 == 0x80) & ((p1 >= 0x80) & (p1 <= 0x8A) | (p1 == 0xA8) | (p1 == 0xA9) | (p1 == 0xAF))
    found |= (p3 == 0xE2) & (p2 == 0x81) & (p1 == 0x9F)
    found |= (p3 == 0xE3) & (p2 == 0x80) & (p1 == 0x80)
    found |= (p3 == 0xE1) & (p2 == 0x9A) & (p1 == 0x80)
    return found


@dataclass
class Segments:
    """Segments in text order, and the distinct ones among them."""
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # per distinct segment: its first occurrence
    which: np.ndarray  # per segment: its distinct one


def cut(block: Block, mark: np.ndarray) -> Segments:
    """Segments that start where ``mark`` (bool per byte) says, and at every document."""
    n = len(block.data)
    mark[block.offsets[:-1][block.sizes > 0]] = True
    start = np.flatnonzero(mark)
    end = np.append(start[1:], n) if len(start) else start
    doc = np.searchsorted(block.offsets, start, "right") - 1
    size = end - start
    if len(start):
        # a segment's hash: random numbers of its bytes times powers of their places
        place = np.arange(n, dtype=np.int32) - np.repeat(start.astype(np.int32), size)
        term = _powers(max(8, int(size.max()).bit_length()))[place]
        term *= _BYTE[block.data]
        key = np.add.reduceat(term, start) + size.astype(np.uint64)
    else:
        key = np.zeros(0, dtype=np.uint64)
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    return Segments(start, end, doc, first, which)


def word_segments(block: Block) -> Segments:
    """Cut before every blank or line feed that follows a character other than white space."""
    data = block.data
    mark = (data == 32) | (data == 10)
    at = np.flatnonzero(mark)
    at = at[at > 0]
    mark[:1] = False
    mark[at[after_white(data, at)]] = False
    return cut(block, mark)


def ragged(counts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Indices of runs ``offsets[i] .. offsets[i] + counts[i]``, one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(offsets - (ends - counts), counts) + np.arange(total)


def offsets_of(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
