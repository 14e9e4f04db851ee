"""Language-model scores by online logistic context mixing.

A text is the sequence of its tokens: words, each closed by a blank, and one
end, a line feed.  The model predicts this stream bit by bit.

A token's first bit says whether it is the one that has followed the hashed
context of the two tokens before most often (no bit where these are new); an
adaptive map gives its odds by how often and how surely.  If not, the token's
bytes follow, eight bits each.  Several predictors look at hashed contexts of
a byte: the last one, two, three and five bytes back to the beginning of the
word and the kind of token before it, and the whole word so far.  Each gives
the odds that its context has seen in all training documents.  The log-odds
are added up with weights from a set that a gate selects by how much the
contexts have seen; the weights are learned online, each bit first predicted
without its own occurrence and then learned.  Another adaptive map refines
the mixed probability by what followed such predictions.  The bits of all its
tokens make a text's score.

The bytes' contexts do not cross a word but for the kind of the token before,
so equal words after equal kinds cost equal bits, and that work is done once
per distinct pair ("unit") of the corpus:

1. Blocks of documents give their distinct units and the sequence of their
   tokens; units meet in shards by a hash of the word, where the training
   counts of all blocks are added.
2. Shards send what follows each of their contexts to context shards, which
   add it up over the corpus and answer every shard for its own contexts.
   In the same way blocks send which token follows each two tokens, and learn
   for each whether it was the one to expect.
3. Every shard runs the online mixer over its training units; weights and
   map are averaged over the shards (a few thousand numbers).
4. Every shard scores its units, the bits return to the blocks, and each
   block adds up its documents.

Counts cover the whole corpus and grow with it.  Shards are sized by the
bytes of text.  A word or a pair of tokens, however frequent, is one entry per
block, a byte's context one entry per shard.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, release, text_blocks, written
from .segments import Block, offsets_of, text_block

#: Text bytes of a block, and of what a shard's units are drawn from on average.
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 8 << 20
#: Kinds of the token before: none or the end of a sentence; other punctuation; else.
KINDS = 3
#: Bytes that a context looks back; None: the whole word so far.
ORDERS = (1, 2, 3, 5, None)
#: Added to either count of a bit.
PRIOR = 0.4
#: Gates: by what the word so far has been followed by, and the last five bytes.
_SEEN = (1, 2, 3, 6, 16, 64)
_FEW = (1, 4)
GATES = (len(_SEEN) + 1) * 2 * (len(_FEW) + 1)
#: The refining map: by the word so far, the bit's place and the half steps of its log-odds.
STEPS = 24
MAP = (len(_SEEN) + 1) * 8 * STEPS
MAP_SHARE = 0.3
RATE = 0.08
START = 0.25
#: Positions that are predicted before the weights are learned from them, and that are scored at once.
STRIDE = 4096
#: Gates of the expected token: 0 where the two tokens before are new, else by
#: how often they were seen (powers of two) and the share of the expected one (tenths).
OFTEN, SHARE = 8, 11
EXPECTED = 1 + OFTEN * SHARE
HIT = 128
#: Of a key of what follows two tokens: bits of their hash within its place
#: (places grow with the corpus), bits of the token's hash.
CONTEXT_BITS, TOKEN_BITS = 28, 24
_PRIME = 0x9E3779B97F4A7C15
_MASK = 0xFFFFFFFFFFFFFFFF
_BYTE = np.random.default_rng(13).integers(1, 2**63, 256, dtype=np.uint64)
#: White space [\x20\x09-\x0D], and bytes with A-Z lower-cased.
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

BLOCK = "block long, shard int, words binary, word_of binary, kinds binary, train binary, docs array<long>, held array<boolean>, n_bytes array<long>, per_doc binary, tokens binary, hashes binary, heads binary"
_BLOCK = pa.schema([("block", pa.int64()), ("shard", pa.int32()), *((c, pa.binary()) for c in ("words", "word_of", "kinds", "train")), ("docs", pa.list_(pa.int64())),
                    ("held", pa.list_(pa.bool_())), ("n_bytes", pa.list_(pa.int64())), *((c, pa.binary()) for c in ("per_doc", "tokens", "hashes", "heads"))])
UNITS = "shard int, block long, words binary, word_of binary, kinds binary, train binary, index binary, tokens long, types long"
_UNITS = pa.schema([("shard", pa.int32()), ("block", pa.int64()), *((c, pa.binary()) for c in ("words", "word_of", "kinds", "train", "index")), ("tokens", pa.int64()), ("types", pa.int64())])
SENT = "place int, shard int, edges binary, n binary"
_SENT = pa.schema([("place", pa.int32()), ("shard", pa.int32()), ("edges", pa.binary()), ("n", pa.binary())])
FOLLOW = "place int, block long, keys binary, n binary"
_FOLLOW = pa.schema([("place", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("n", pa.binary())])
MET = "block long, place int, codes binary, own_codes binary, went binary"
_MET = pa.schema([("block", pa.int64()), ("place", pa.int32()), ("codes", pa.binary()), ("own_codes", pa.binary()), ("went", pa.binary())])
ANSWER = "shard int, place int, sizes binary, next binary, n binary"
_ANSWER = pa.schema([("shard", pa.int32()), ("place", pa.int32()), ("sizes", pa.binary()), ("next", pa.binary()), ("n", pa.binary())])
TRAINED = "shard int, words binary, word_of binary, kinds binary, train binary, answers array<struct<place:int,sizes:binary,next:binary,n:binary>>, learned binary"
_TRAINED = pa.schema([("shard", pa.int32()), *((c, pa.binary()) for c in ("words", "word_of", "kinds", "train")),
                      ("answers", pa.list_(pa.struct([("place", pa.int32()), ("sizes", pa.binary()), ("next", pa.binary()), ("n", pa.binary())]))), ("learned", pa.binary())])
SCORED = "shard int, counts binary, bits binary, own_bits binary"
_SCORED = pa.schema([("shard", pa.int32()), *((c, pa.binary()) for c in ("counts", "bits", "own_bits"))])
REPLY = "block long, shard int, counts binary, bits binary, own_bits binary"
_REPLY = pa.schema([("block", pa.int64()), ("shard", pa.int32()), *((c, pa.binary()) for c in ("counts", "bits", "own_bits"))])
SCORE = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"
_SCORE = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                    ("base_score", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64()), ("bits_per_byte", pa.float64())])


def _packed(values: np.ndarray | bytes, kind: str = "") -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.astype(kind).tobytes() if kind else values)


def _raw(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _unpacked(packed: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(_raw(packed), dtype=kind)


def _planes(values: np.ndarray, kind: str) -> bytes:
    """Numbers, byte by byte of all of them: the upper bytes pack well."""
    return _packed(np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(len(values), np.dtype(kind).itemsize).T).tobytes())


def _unplaned(packed: bytes, kind: str) -> np.ndarray:
    raw, size = _raw(packed), np.dtype(kind).itemsize
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(size, len(raw) // size)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _packed_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys, as differences."""
    return _planes(np.diff(keys, prepend=np.uint64(0)), "<u8")


def _unpacked_keys(packed: bytes) -> np.ndarray:
    return np.cumsum(_unplaned(packed, "<u8"), dtype=np.uint64)


def _place(hashes: np.ndarray, places: int) -> np.ndarray:
    """One of ``places`` ranges of 64-bit hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(places)) >> np.uint64(32)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique`` with the inverse, sorting the distinct keys only."""
    codes, own = pd.factorize(keys)
    order = np.argsort(own)
    rank = np.empty(len(own), dtype=np.int32)
    rank[order] = np.arange(len(own))
    return own[order], rank[codes]


def _runs(place: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Runs of equal ``place`` along ``order``, which sorts them."""
    used, first = np.unique(place[order], return_index=True)
    for p, a, b in zip(used.tolist(), first.tolist(), [*first[1:].tolist(), len(order)]):
        yield int(p), order[a:b]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * len(schema), schema.types)], schema=schema)


# ------------------------------------------------------ documents and units
@lru_cache(maxsize=1)
def _powers(bits: int) -> np.ndarray:
    out = np.full(1 << bits, _PRIME, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


#: What kind of a token a word is for the one after it, by its last byte.
_KIND_AFTER = np.full(256, 2, dtype=np.int64)
_KIND_AFTER[list(b".!?")] = 0
_KIND_AFTER[list(b",;:)-\"'")] = 1


def block_units(block: Block) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """The distinct tokens of a block (the end, empty, comes first), per document
    its number of tokens, the unit (token * KINDS + kind before) of each token
    in order, and per document the bytes of its stream."""
    solid = ~_WHITE[block.data]
    edge = np.diff(solid.view(np.int8), prepend=0) != 0
    edge[block.offsets[:-1][block.sizes > 0]] = True
    edge = np.append(np.flatnonzero(edge), len(solid))
    begin, size = edge[:-1], np.diff(edge)
    word = solid.take(begin) if len(begin) else np.zeros(0, dtype=bool)
    begin, size = begin[word], size[word]
    data, at = _LOWER[block.data[solid]], np.cumsum(size) - size
    # a word's hash: random numbers of its bytes times powers of their places
    place = np.arange(len(data)) - np.repeat(at, size)
    key = np.add.reduceat(_BYTE[data] * _powers(int(size.max()).bit_length()).take(place), at) if len(at) else np.zeros(0, np.uint64)
    codes, own = pd.factorize(key + size.astype(np.uint64))
    seen = np.empty(len(own), dtype=np.int64)
    seen[codes[::-1]] = np.arange(len(codes))[::-1]
    raw = data.tobytes()
    words = [b"", *(raw[a: a + n] for a, n in zip(at.take(seen).tolist(), size.take(seen).tolist()))]
    doc = np.searchsorted(block.offsets, begin, "right") - 1
    counts = np.bincount(doc, minlength=block.rows) + 1
    ends = np.cumsum(counts)
    tokens = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
    tokens[np.arange(len(codes)) + doc] = codes + 1
    starts = ends - counts
    kind = np.append(0, _KIND_AFTER[data.take((at + size - 1).take(seen))]) if len(own) else np.zeros(1, dtype=np.int64)
    before = np.zeros(len(tokens), dtype=np.int64)
    before[1:] = kind.take(tokens[:-1])
    before[starts] = 0
    n_bytes = np.bincount(doc, size + 1, minlength=block.rows).astype(np.int64) + 1
    return words, counts, tokens * KINDS + before, n_bytes


def blocks(docs: DataFrame, shards: int) -> DataFrame:
    """Per block one row with its documents and their units, and one per shard
    with the part of its units there; units are numbered through the parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, batch in enumerate(text_blocks(batches, "text", BLOCK_BYTES)):
            name = (TaskContext.get().partitionId() << 32) + k
            words, per_doc, unit, n_bytes = block_units(text_block(batch.column("text")))
            held = batch.column("held").to_numpy(zero_copy_only=False)
            out = np.repeat(held, per_doc)
            times = np.bincount(unit, minlength=len(words) * KINDS)
            train = np.bincount(unit[~out], minlength=len(times))
            own = np.flatnonzero(times)
            # training occurrences, and whether there are others
            train = 2 * train[own] + (times > train)[own]
            hashes = np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words))[own // KINDS]
            shard = hashes % shards
            order = np.argsort(shard, kind="stable")
            rank = np.zeros(len(times), dtype=np.uint32)
            rank[own[order]] = np.arange(len(order))
            rows = []
            for s, part in _runs(shard, order):
                tokens, word_of = np.unique(own[part] // KINDS, return_inverse=True)
                rows.append((name, s, _packed(b"\n".join([words[i] for i in tokens])), _packed(word_of, "<u4"), _packed(own[part] % KINDS, "u1"),
                             _planes(train[part], "<u8"), *[None] * 7))
            # units of one word stand together: its hash is written once, where they begin
            heads = np.diff(own[order] // KINDS, prepend=-1) != 0
            rows.append((name, None, None, None, None, None, batch.column("id").to_pylist(), held.tolist(), n_bytes.tolist(),
                         _packed(per_doc, "<u4"), _planes(rank.take(unit), "<u4"), _packed(hashes[order[heads]], "<u4"), _packed(heads, "u1")))
            yield _batch(rows, _BLOCK)

    return docs.mapInArrow(run, BLOCK)


def merge_units(parts: DataFrame) -> DataFrame:
    """Per shard one row with its distinct units and their training counts, and
    per part of a block one with the numbers of its units there."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["block", "words", "word_of", "kinds", "train"]).to_pylist()
        known: dict[bytes, int] = {}
        found = []
        for row in rows:
            ids = np.array([known.setdefault(w, len(known)) for w in _raw(row["words"]).split(b"\n")], dtype=np.int64)
            found.append(ids[_unpacked(row["word_of"], "<u4")] * KINDS + _unpacked(row["kinds"], "u1"))
        words = sorted(known)
        place = np.empty(len(words), dtype=np.int64)
        place[[known[w] for w in words]] = np.arange(len(words))
        found = [place[u // KINDS] * KINDS + u % KINDS for u in found]
        units = np.unique(np.concatenate(found))
        train, held = np.zeros(len(units), dtype=np.int64), np.zeros(len(units), dtype=bool)
        out = []
        for row, u in zip(rows, found):
            at = np.searchsorted(units, u)
            seen = _unplaned(row["train"], "<u8").astype(np.int64)
            train[at] += seen >> 1
            held[at] |= seen & 1 > 0
            out.append((None, row["block"], None, None, None, None, _packed(at, "<u4"), None, None))
        types = np.count_nonzero(np.bincount(units // KINDS, train))
        out.append((None, None, _packed(b"\n".join(words)), _packed(units // KINDS, "<u4"), _packed(units % KINDS, "u1"), _planes(2 * train + held, "<u8"), None, int(train.sum()), int(types)))
        shard = table["shard"][0].as_py()
        return pa.Table.from_batches([_batch([(shard, *r[1:]) for r in out], _UNITS)])

    return parts.groupBy("shard").applyInArrow(run, UNITS)


# ----------------------------------------------------------- expected tokens
def follow_keys(row: dict, places: int) -> tuple[np.ndarray, np.ndarray]:
    """Per token of a block the place that counts what follows the two tokens
    before it, and a key: CONTEXT_BITS of their hash, TOKEN_BITS of the token's own."""
    word = np.cumsum(_unpacked(row["heads"], "u1"), dtype=np.int64) - 1
    own = _unpacked(row["hashes"], "<u4").astype(np.uint64).take(word).take(_unplaned(row["tokens"], "<u4"))
    starts = offsets_of(_unpacked(row["per_doc"], "<u4"))[:-1]
    none = np.uint64(1 << 40)
    one, two = np.full(len(own), none), np.full(len(own), none)
    one[1:] = own[:-1]
    one[starts] = none
    two[1:] = one[:-1]
    two[starts] = none
    h = _mixed(one * np.uint64(_PRIME) + _mixed(two + np.uint64(1)))
    local = h & np.uint64((1 << CONTEXT_BITS) - 1)
    return _place(h, places), local << np.uint64(TOKEN_BITS) | _mixed(own) >> np.uint64(64 - TOKEN_BITS)


def distinct_follows(row: dict, places: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (place, key) pairs of a block in order, and which each token has."""
    place, key = follow_keys(row, places)
    if places <= 1 << (64 - CONTEXT_BITS - TOKEN_BITS):
        order = np.argsort(place << np.uint64(CONTEXT_BITS + TOKEN_BITS) | key)
    else:
        order = np.argsort(key)
        order = order[np.argsort(place[order], kind="stable")]
    place, key = place[order], key[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (key[1:] != key[:-1])
    which = np.empty(len(order), dtype=np.int64)
    which[order] = np.cumsum(new) - 1
    return place[new], key[new], which


def send_follows(whole: DataFrame, places: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                place, key, which = distinct_follows(row, places)
                held = np.repeat(np.array(row["held"], dtype=bool), _unpacked(row["per_doc"], "<u4"))
                n = np.bincount(which[~held], minlength=len(key))
                n = 2 * n + (np.bincount(which, minlength=len(key)) > n)  # training occurrences, and whether there are others
                yield _batch([(p, row["block"], _packed_keys(key[part]), _packed(n[part], "<u4")) for p, part in _runs(place, np.arange(len(place)))], _FOLLOW)
        release()

    return whole.select("block", "held", "per_doc", "tokens", "hashes", "heads").mapInArrow(run, FOLLOW)


def _often_gate(total: np.ndarray, top: np.ndarray) -> np.ndarray:
    often = np.minimum(np.log2(np.maximum(total, 1)).astype(np.int64), OFTEN - 1)
    return np.where(total > 0, 1 + often * SHARE + 10 * top // np.maximum(total, 1), 0)


def expected(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sorted distinct keys with their training counts: each one's code
    (gate, and HIT if it is the expected one), its code when one occurrence of
    its own is not counted, and by the gate of the latter how many training
    occurrences were expected (0) or not (1)."""
    context = keys >> np.uint64(TOKEN_BITS)
    first = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(keys) else np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
    total, top = np.add.reduceat(n, first), np.maximum.reduceat(n, first)
    # of equally frequent ones the first key is the expected one
    at = np.flatnonzero(n == top[of])
    best = at[np.unique(of[at], return_index=True)[1]]
    rest = n.copy()
    rest[best] = -1
    second = np.maximum.reduceat(rest, first)
    at = np.flatnonzero((rest == second[of]) & (rest >= 0))
    runner = np.full(len(first), -1)
    own, where = np.unique(of[at], return_index=True)
    runner[own] = at[where]
    mine = np.arange(len(keys)) == best[of]
    codes = _often_gate(total[of], top[of]) + HIT * (mine & (n > 0))
    # without one occurrence of its own the expected one may give way to the runner-up
    less = top[of] - mine
    stays = mine & ((less > second[of]) | ((less == second[of]) & (best[of] < runner[of])))
    stays &= less > 0
    gate = _often_gate(total[of] - 1, np.where(mine, np.maximum(less, second[of]), top[of]))
    went = np.bincount(2 * gate + ~stays, n, minlength=2 * EXPECTED).reshape(EXPECTED, 2)
    return codes.astype(np.uint8), (gate + HIT * stays).astype(np.uint8), went


def answer_follows(sent: DataFrame) -> DataFrame:
    """To every block the codes of its keys, and per place the counts by gate."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        asked = [_unpacked_keys(r["keys"]) for r in rows]
        keys, at = np.unique(np.concatenate(asked), return_inverse=True)
        sent = [_unpacked(r["n"], "<u4") for r in rows]
        n = np.bincount(at, (np.concatenate(sent) >> 1).astype(np.float64), minlength=len(keys)).astype(np.int64)
        codes, own, went = expected(keys, n)
        at = np.split(at, np.cumsum([len(a) for a in asked])[:-1])
        # a code that no token of the block needs is 0
        out = [(r["block"], r["place"], _packed(codes[a] * (m & 1), "u1"), _packed(own[a] * (m > 1), "u1"), None) for r, a, m in zip(rows, at, sent)]
        release()
        return pa.Table.from_batches([_batch([*out, (None, rows[0]["place"], None, None, _packed(went, "<f8"))], _MET)])

    return sent.groupBy("place").applyInArrow(run, MET)


# ------------------------------------------------------------------- contexts
@dataclass
class Stream:
    """The bytes of a shard's units: per byte the byte, its unit and its place in the unit."""
    data: np.ndarray
    unit: np.ndarray
    place: np.ndarray
    kind: np.ndarray  # per unit
    train: np.ndarray  # per unit: occurrences in training rows
    held: np.ndarray  # per unit: whether a held-out row has it
    word_of: np.ndarray  # per unit


def stream_of(row: dict) -> Stream:
    words = [w + b" " if w else b"\n" for w in _raw(row["words"]).split(b"\n")]
    word_of = _unpacked(row["word_of"], "<u4").astype(np.int64)
    joined = np.frombuffer(b"".join(words), dtype=np.uint8)
    offsets = offsets_of(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
    size = np.diff(offsets)[word_of]
    ends = np.cumsum(size)
    unit = np.repeat(np.arange(len(word_of), dtype=np.int32), size)
    place = np.arange(len(unit)) - np.repeat(ends - size, size)
    seen = _unplaned(row["train"], "<u8").astype(np.int64)
    return Stream(joined[offsets[:-1][word_of][unit] + place], unit, place, _unpacked(row["kinds"], "u1"), seen >> 1, seen & 1 > 0, word_of)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def context_edges(s: Stream) -> Iterator[np.ndarray]:
    """Per predictor every byte's edge: the hash of the context in the upper 56
    bits, the byte in the lower 8."""
    h, back, n = np.zeros(len(s.data), dtype=np.uint64), 0, len(s.data)
    before = np.concatenate([np.zeros(max(filter(None, ORDERS)), dtype=np.uint16), s.data.astype(np.uint16) + 8])
    kind = s.kind.take(s.unit).astype(np.uint16) + 1
    for k, order in enumerate(ORDERS):
        if order is None:
            # the word so far: its bytes times powers of their places
            power = np.full(int(s.place.max(initial=0)) + 1, _PRIME, dtype=np.uint64)
            power[0] = 1
            term = (s.data.astype(np.uint64) + np.uint64(1)) * np.cumprod(power).take(s.place)
            total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(term)])
            h = total[:-1] - total.take(np.arange(n) - s.place) + s.place.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        while order is not None and back < order:
            back += 1
            symbol = before[len(before) - n - back: len(before) - back]
            h = (h + np.where(s.place >= back, symbol, kind * (s.place == back - 1))) * np.uint64(_PRIME)
        yield _mixed(h + np.uint64((k + 1) * 0xA0761D6478BD642F & _MASK)) & np.uint64(_MASK ^ 255) | s.data


def shard_edges(s: Stream) -> tuple[list[np.ndarray], np.ndarray]:
    """Per predictor the number of every byte's edge, and the distinct edges of
    all predictors in order."""
    found = [_distinct(edges) for edges in context_edges(s)]
    edges = np.concatenate([own for own, _ in found])
    order = np.argsort(edges)
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.arange(len(order))
    bases = offsets_of(np.array([len(own) for own, _ in found]))
    return [rank[a:b].take(at) for (_, at), a, b in zip(found, bases[:-1], bases[1:])], edges[order]


def edge_counts(s: Stream, which: list[np.ndarray], n: int) -> np.ndarray:
    """How often the training documents have each of the ``n`` edges."""
    weight = s.train.astype(np.float64).take(s.unit)
    return sum(np.bincount(w, weight, minlength=n) for w in which).astype(np.int64)


def dealt(edges: np.ndarray, places: int) -> Iterator[tuple[int, slice]]:
    """Sorted edges by the context shard they go to."""
    place = _place(edges & np.uint64(_MASK ^ 255), places)
    used, first = np.unique(place, return_index=True)
    for p, a, b in zip(used.tolist(), first.tolist(), [*first[1:].tolist(), len(edges)]):
        yield p, slice(a, b)


def send_edges(shards: DataFrame, places: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s = stream_of(row)
                which, edges = shard_edges(s)
                seen = edge_counts(s, which, len(edges))
                yield _batch([(p, row["shard"], _packed_keys(edges[part]), _planes(seen[part], "<u8")) for p, part in dealt(edges, places)], _SENT)
        release()

    return shards.select("shard", "words", "word_of", "kinds", "train").mapInArrow(run, SENT)


def answer_edges(sent: DataFrame) -> DataFrame:
    """To every shard, for each distinct context of its edges in order: how
    many bytes have followed, these, and how often."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        asked = [_unpacked_keys(r["edges"]) for r in rows]
        edges, at = np.unique(np.concatenate(asked), return_inverse=True)
        n = np.bincount(at, np.concatenate([_unplaned(r["n"], "<u8") for r in rows]).astype(np.float64), minlength=len(edges)).astype(np.int64)
        edges, n = edges[n > 0], n[n > 0]
        context, following = edges >> np.uint64(8), (edges & np.uint64(255)).astype(np.uint8)
        out = []
        for row, own in zip(rows, asked):
            wanted = np.unique(own >> np.uint64(8))
            a, b = np.searchsorted(context, wanted), np.searchsorted(context, wanted, "right")
            pick = np.repeat(a - (np.cumsum(b - a) - (b - a)), b - a) + np.arange(int((b - a).sum()))
            out.append((row["shard"], row["place"], _packed(b - a, "<u2"), _packed(following[pick], "u1"), _planes(n[pick], "<u8")))
        return pa.Table.from_batches([_batch(out, _ANSWER)])

    return sent.groupBy("place").applyInArrow(run, ANSWER)


def node_totals(edges: np.ndarray, places: int, answers: dict[int, dict]) -> np.ndarray:
    """``[edge, d]``: how often the edge's context was followed by a byte that
    shares the first ``d`` bits of the edge's byte (0: by any, 8: by that byte)."""
    out = np.zeros((len(edges), 9), dtype=np.float32)
    for p, part in dealt(edges, places):
        row, mine = answers[p], np.arange(part.start, part.stop)
        sizes, following = _unpacked(row["sizes"], "<u2").astype(np.int64), _unpacked(row["next"], "u1").astype(np.int64)
        total = np.concatenate([[0], np.cumsum(_unplaned(row["n"], "<u8").astype(np.int64))])
        _, context = np.unique(edges[mine] >> np.uint64(8), return_inverse=True)
        ends = np.cumsum(sizes)
        lo, hi = (ends - sizes)[context], ends[context]
        byte = (edges[mine] & np.uint64(255)).astype(np.int64)
        out[mine, 0] = total[hi] - total[lo]
        # a context that one byte alone has followed is decided by that byte
        one = np.flatnonzero(hi - lo == 1)
        same = byte[one] ^ following[lo[one]]
        for d in range(1, 9):
            out[mine[one], d] = np.where(same >> (8 - d) == 0, out[mine[one], 0], 0)
        many = np.flatnonzero(hi - lo > 1)
        key = np.repeat(np.arange(len(sizes)), sizes) * 256 + following
        for d in range(1, 9):
            low = context[many] * 256 + (byte[many] >> (8 - d) << (8 - d))
            out[mine[many], d] = total[np.searchsorted(key, low + (1 << (8 - d)))] - total[np.searchsorted(key, low)]
    return out


# --------------------------------------------------------------------- mixing
@dataclass
class Model:
    """Weights by gate and predictor, and how often bits went as the refined
    prediction of a step said (0) or not (1)."""
    weights: np.ndarray
    refined: np.ndarray

    @classmethod
    def first(cls) -> "Model":
        return cls(np.full((GATES, len(ORDERS)), START), np.zeros((MAP, 2)))


@dataclass
class Views:
    """What the edges of a shard say of the eight bits on their way: the
    log-odds of the bit taken, and the gate's part by the whole word so far and
    by the last five bytes.  The gates do not depend on the bit itself."""
    odds: np.ndarray
    by_word: np.ndarray
    by_five: np.ndarray


def _class(n: np.ndarray, bounds: tuple[int, ...]) -> np.ndarray:
    """How many of the bounds a number reaches."""
    return sum((n >= np.float32(b)).astype(np.uint8) for b in bounds)


def views(totals: np.ndarray, without: int) -> Views:
    """Views of edges from their node totals, ``without`` so many occurrences of their own."""
    totals = np.maximum(totals - np.float32(without), 0) if without else totals
    node, taken = totals[:, :-1], totals[:, 1:]
    odds = np.log((taken + np.float32(PRIOR)) / (node - taken + np.float32(PRIOR)))
    alike = (taken == 0) | (taken == node)
    return Views(odds, 2 * _class(node, _SEEN) + alike, _class(node, _FEW))


def _gates(v: Views, which: list[np.ndarray], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gate and map row of the bits of some bytes."""
    word = v.by_word.take(which[-1].take(at), axis=0).astype(np.int64)
    return word * (len(_FEW) + 1) + v.by_five.take(which[-2].take(at), axis=0), (word >> 1) * 8 + np.arange(8)


def _mix(weights: np.ndarray, gate: np.ndarray, odds: list[np.ndarray]) -> np.ndarray:
    """The sum of log-odds, with the gate's weights."""
    return sum(np.ascontiguousarray(w, dtype=np.float32).take(gate) * o for w, o in zip(weights.T, odds))


def _map_place(row: np.ndarray, dot: np.ndarray) -> np.ndarray:
    """Where a bit's mixed log-odds fall in the flat map."""
    return 2 * (row * STEPS + np.minimum(2 * np.abs(dot), STEPS - 1).astype(np.int64)) + (dot < 0)


def train(which: list[np.ndarray], totals: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One online run over a shard's bytes, ``weight`` occurrences each, in an
    order fixed by their number: predict without the occurrence itself, then
    learn.  Gives the learned weights, the mass behind each gate, and the map's counts."""
    model, squares, mass = Model.first(), np.full((GATES, len(ORDERS)), 1e-3), np.zeros(GATES)
    v, refined = views(totals, 1), np.zeros(2 * MAP)
    some = np.flatnonzero(weight > 0)
    some = some[np.random.default_rng(11).permutation(len(some))]
    for a in range(0, len(some), STRIDE):
        at = some[a: a + STRIDE]
        gate, row = _gates(v, which, at)
        odds = [v.odds.take(w.take(at), axis=0) for w in which]
        dot = _mix(model.weights, gate, odds)
        # the share of frequent words is damped: a step is not to follow one word alone
        much, flat = np.repeat(np.sqrt(weight[at]), 8), gate.ravel()
        error = much / (1 + np.exp(dot.ravel()))
        slope = np.stack([np.bincount(flat, error * o.ravel(), minlength=GATES) for o in odds], axis=1)
        slope /= np.maximum(np.bincount(flat, much, minlength=GATES), 1)[:, None]
        squares += slope**2
        model.weights += RATE * slope / np.sqrt(squares)
        often = np.repeat(weight[at], 8)
        mass += np.bincount(flat, often, minlength=GATES)
        refined += np.bincount(_map_place(row, dot).ravel(), often * (dot.ravel() != 0), minlength=2 * MAP)
    return model.weights, mass, refined.reshape(MAP, 2)


def unit_bits(s: Stream, which: list[np.ndarray], totals: np.ndarray, model: Model, without: int, wanted: np.ndarray) -> np.ndarray:
    """Bits of every wanted unit: the sum over its bytes' bits of -log2 of the
    refined probability, ``without`` so many occurrences of its own; else 0."""
    some = np.flatnonzero(wanted[s.unit])
    cost, v = np.zeros(len(s.data)), views(totals, without)
    went = ((model.refined + 0.5) / (model.refined.sum(axis=1, keepdims=True) + 1)).astype(np.float32).ravel()
    for a in range(0, len(some), 4 * STRIDE):
        at = some[a: a + 4 * STRIDE]
        gate, row = _gates(v, which, at)
        dot = _mix(model.weights, gate, [v.odds.take(w.take(at), axis=0) for w in which])
        mapped = np.where(dot == 0, np.float32(0.5), went.take(_map_place(row, dot)))
        p = (1 - MAP_SHARE) / (1 + np.exp(-np.clip(dot, -40, 40))) + MAP_SHARE * mapped
        cost[at] = -np.log2(p).sum(axis=1, dtype=np.float64)
    return np.bincount(s.unit, cost, minlength=len(s.kind))


def train_shards(shards: DataFrame, answers: DataFrame, places: int) -> DataFrame:
    """Per shard its units, the answers to its contexts, and what it learned."""

    def run(own: pa.Table, got: pa.Table) -> pa.Table:
        row = own.to_pylist()[0]
        answers = got.select(["place", "sizes", "next", "n"]).to_pylist()
        s = stream_of(row)
        which, edges = shard_edges(s)
        weights, mass, refined = train(which, node_totals(edges, places, {a["place"]: a for a in answers}), s.train[s.unit].astype(np.float64))
        learned = np.concatenate([(weights * mass[:, None]).ravel(), mass, refined.ravel()])
        release()
        return pa.Table.from_batches([_batch([(row["shard"], row["words"], row["word_of"], row["kinds"], row["train"], answers, _packed(learned, "<f8"))], _TRAINED)])

    columns = ["shard", "words", "word_of", "kinds", "train"]
    return shards.select(*columns).groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(run, TRAINED)


def summed(packed: DataFrame, length: int) -> np.ndarray:
    """The sum of a column of packed arrays of ``length`` doubles each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                total += _unpacked(raw, "<f8")
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["i", "v"])

    total = np.zeros(length)
    for row in packed.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():  # at most ``length`` rows
        total[row.i] = row.v
    return total


def averaged(trained: DataFrame) -> Model:
    """The model of all shards: weights averaged by the mass behind them, the
    map's counts added.  Rounded, so that the order of the sums does not show."""
    n = GATES * len(ORDERS)
    total = summed(trained.select("learned"), n + GATES + 2 * MAP)
    mass = total[n: n + GATES, None]
    weights = np.where(mass > 0, total[:n].reshape(GATES, -1) / np.maximum(mass, 1), START)
    return Model(np.round(weights, 6), np.round(total[n + GATES:].reshape(MAP, 2), 3))


def score_units(trained: DataFrame, model: Model, places: int) -> DataFrame:
    """Per shard the training count of each unit's token, the unit's bits where
    a held-out row has it, and its bits without one occurrence where a training
    row has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s = stream_of(row)
                which, edges = shard_edges(s)
                totals = node_totals(edges, places, {a["place"]: a for a in row["answers"]})
                bits, own = unit_bits(s, which, totals, model, 0, s.held), unit_bits(s, which, totals, model, 1, s.train > 0)
                counts = np.bincount(s.word_of, s.train).astype(np.int64)[s.word_of]
                yield _batch([(row["shard"], _planes(counts, "<u8"), _planes(bits, "<f4"), _planes(own, "<f4"))], _SCORED)
        release()

    return trained.drop("learned").mapInArrow(run, SCORED)


def replies(scored: DataFrame, index: DataFrame) -> DataFrame:
    """The scored units of a block's part, in its order."""

    def run(own: pa.Table, asked: pa.Table) -> pa.Table:
        row = own.to_pylist()[0]
        counts, bits, less = _unplaned(row["counts"], "<u8"), _unplaned(row["bits"], "<f4"), _unplaned(row["own_bits"], "<f4")
        out = []
        for block, raw in zip(asked["block"].to_pylist(), asked["index"].to_pylist()):
            at = _unpacked(raw, "<u4")
            out.append((block, row["shard"], _planes(counts[at], "<u8"), _planes(bits[at], "<f4"), _planes(less[at], "<f4")))
        return pa.Table.from_batches([_batch(out, _REPLY)])

    return scored.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(run, REPLY)


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_of: int = 10) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    n_bytes, bits_per_byte)`` per row.

    The model learns from the rows whose crc32 of the id as text is not
    divisible by ``held_of``; the others are held out.  Tokens: A-Z
    lower-cased words without [\\x20\\x09-\\x0D], then one end.  ``n_known``
    tokens stand in the ``train_tokens`` tokens of the training rows.
    ``base_score`` is the log10 probability of the tokens by their training
    counts, 0.1 added to each and to one unseen token; ``score`` that of the
    context-mixing model, whose bits per byte of the token stream (words, a
    blank after each, a line feed) come last.  It scores a token of a training
    row as if that occurrence had not been seen, so that rows compare.

    A null text is empty and has its end alone.  Rows are documents: repeats of
    an id or a text count each; a null id counts as an empty one and is held
    out (its crc32 is 0).  Without training rows the base score is 0 and every
    bit costs one.  Other columns are ignored.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    text = F.col(text_col).cast("string")
    held = F.crc32(F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")).cast("binary")) % held_of == 0
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), held.alias("held"))
    shards = int(docs.agg(F.sum(F.octet_length(text))).first()[0] or 0) // SHARD_BYTES + 1
    table = written(blocks(rows, shards), "lm-blocks")
    units = written(merge_units(table.where("shard IS NOT NULL").select("block", "shard", "words", "word_of", "kinds", "train")), "lm-units")
    own, index = units.where("block IS NULL"), units.where("block IS NOT NULL").select("shard", "block", "index")
    tokens, types = (int(v or 0) for v in own.agg(F.sum("tokens"), F.sum("types")).first())
    trained = written(train_shards(own, answer_edges(send_edges(own, shards)), shards), "lm-shards")
    got = replies(score_units(trained, averaged(trained), shards), index).select("block", F.lit(0).alias("what"), F.col("shard").alias("place"), "counts", "bits", "own_bits")
    whole = table.where("shard IS NULL").select("block", "docs", "held", "n_bytes", "per_doc", "tokens", "hashes", "heads")
    met = written(answer_follows(send_follows(whole, shards)), "lm-expected")
    went = summed(met.where("block IS NULL").select("went"), 2 * EXPECTED).reshape(EXPECTED, 2) + 0.5
    flag = -np.log2(went / went.sum(axis=1, keepdims=True))
    flag[0] = 0
    codes = met.where("block IS NOT NULL").select("block", F.lit(1).alias("what"), "place", F.lit(None).cast("binary").alias("counts"), F.col("codes").alias("bits"), F.col("own_codes").alias("own_bits"))
    smooth = tokens + 0.1 * (types + 1)

    def total(block: pa.Table, parts: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        parts = sorted(zip(*(parts[c].to_pylist() for c in ("what", "place", "counts", "bits", "own_bits"))), key=lambda r: r[:2])
        units, codes = [r[2:] for r in parts if r[0] == 0], [r[3:] for r in parts if r[0] == 1]
        counts = np.concatenate([_unplaned(c, "<u8") for c, _, _ in units]).astype(np.float64)
        unit, follow = _unplaned(row["tokens"], "<u4"), distinct_follows(row, shards)[2]
        held = np.repeat(np.array(row["held"], dtype=bool), _unpacked(row["per_doc"], "<u4"))

        def told(full: list[bytes], own: list[bytes], kind: str, at: np.ndarray) -> np.ndarray:
            """Of every token, by whether its row is held out or trained on."""
            return np.where(held, *(np.concatenate([_unplaned(r, kind) for r in raw]).take(at) for raw in (full, own)))

        bits = told([b for _, b, _ in units], [b for _, _, b in units], "<f4", unit).astype(np.float64)
        code = told([c for c, _ in codes], [c for _, c in codes], "u1", follow)
        miss = code < HIT
        cost = flag[code % HIT, miss.astype(np.int64)] + np.where(miss, bits, 0)
        per_doc = _unpacked(row["per_doc"], "<u4").astype(np.int64)
        known, base, cost = (np.add.reduceat(v, offsets_of(per_doc)[:-1]) for v in ((counts[unit] > 0).astype(np.int64), np.log10((counts[unit] + 0.1) / smooth), cost))
        n_bytes = np.array(row["n_bytes"], dtype=np.int64)
        release()
        return pa.Table.from_arrays([pa.array(row["docs"], pa.int64()), pa.array(row["held"], pa.bool_()), pa.array(per_doc), pa.array(known), pa.array(np.full(len(n_bytes), tokens)),
                                     pa.array(base), pa.array(-cost * np.log10(2)), pa.array(n_bytes), pa.array(cost / n_bytes)], schema=_SCORE)

    return whole.groupBy("block").cogroup(got.unionByName(codes).groupBy("block")).applyInArrow(total, SCORE)
