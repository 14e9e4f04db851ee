"""SentencePiece (BPE) encoding and decoding by suffix-array matching.

The distinct words of a block of texts are concatenated and indexed by a
suffix array (suffixes sorted by their first characters, as many as the
longest piece has).  Every piece of the vocabulary is binary-searched in it;
the range found are its occurrences, so each gives edges (position, length,
piece).  Edges are placed by position, and the words are relaxed over them:
of the edges that join two neighbouring symbols the best-scored, leftmost one
is contracted, in all words at once, until none is left.  Characters that no
piece covers become their bytes.  Ids of a text are those of its words; no
piece holds a blank after another character, so words do not depend on their
neighbours.  Long words are cut where the words around the cut end a symbol;
a cut holds if its two symbols, put together, stay two (a sequence of symbols
is the one that contraction leaves just when that is so for all neighbours),
else the parts are joined again.  Words are indexed a bounded number of
characters at a time, so a text without blanks needs no more memory than any
other.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from .common import bound_batches, text_blocks
from .segments import Block, Segments, cut, offsets_of, ragged, text_block

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
ENCODED = "doc_id long, n_tokens long, ids_crc32 long, decoded_crc32 long, round_trip boolean"
_ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("decoded_crc32", pa.int64()), ("round_trip", pa.bool_())])
IDS = "doc_id long, ids array<int>"
#: Words of more symbols are cut in parts of about half as many, and relaxed one
#: by one with a queue where they cannot be; characters to either side of a cut.
LONG_WORD, AROUND = 256, 32
#: Characters that are indexed at once, unless one uncut word has more.
INDEXED = 1 << 20
_NONE = np.iinfo(np.int64).max


class Pieces:
    """Vocabulary: pieces as rows of character ranks, scores as ranks, bytes."""

    def __init__(self, path: str):
        model = model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("a BPE model with byte fallback, a dummy prefix and no normalization is wanted")
        normal = [(i, p) for i, p in enumerate(model.pieces) if p.type == 1]
        text = [p.piece for _, p in normal]
        if any("\n" in t or SPACE in t.lstrip(SPACE) for t in text):
            raise ValueError("a piece crosses words")
        self.ids = np.array([i for i, _ in normal], dtype=np.int64)
        self.size = np.array([len(t) for t in text], dtype=np.int64)
        self.longest = int(self.size.max())
        scores, rank = np.unique([-p.score for _, p in normal], return_inverse=True)
        self.rank = rank.astype(np.int64)  # the best score first
        chars = sorted({c for t in text for c in t})
        self.code = np.zeros(0x110000, dtype=np.uint16)  # 0: in no piece
        self.code[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        rows = np.zeros((len(text), self.longest), dtype=np.uint16)
        for k, t in enumerate(text):
            rows[k, : len(t)] = self.code[[ord(c) for c in t]]
        self.rows = rows
        self.byte = np.zeros(256, dtype=np.int64)
        raw = [b""] * len(model.pieces)
        for i, p in enumerate(model.pieces):
            if p.type == 6:
                self.byte[int(p.piece[3:5], 16)] = i
                raw[i] = bytes([int(p.piece[3:5], 16)])
            elif p.type == 1:
                raw[i] = p.piece.replace(SPACE, " ").encode()
        self.raw_size = np.array([len(b) for b in raw], dtype=np.int64)
        self.raw_at = offsets_of(self.raw_size)[:-1]
        self.raw = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.single = np.full(len(chars) + 1, -1, dtype=np.int64)  # code of a character -> id of its piece
        one = self.size == 1
        self.single[rows[one, 0]] = self.ids[one]


@lru_cache(maxsize=1)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _keys(rows: np.ndarray, fill: int = 0, size: np.ndarray | None = None) -> list[np.ndarray]:
    """Rows of 16-bit codes as sortable 64-bit words; beyond ``size`` codes are ``fill``."""
    n, width = rows.shape
    wide = np.full((n, -(-width // 4) * 4), 0, dtype=np.uint16)
    wide[:, :width] = rows
    if size is not None and fill:
        wide[np.arange(wide.shape[1]) >= size[:, None]] = fill
    return [wide[:, j: j + 4].astype(">u2").copy().view(">u8")[:, 0].astype(np.uint64) for j in range(0, wide.shape[1], 4)]


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions of ``text`` (16-bit codes) sorted by their first ``depth``
    codes, and the sorted codes as 64-bit words."""
    depth = -(-depth // 4) * 4
    padded = np.concatenate([text, np.zeros(depth, dtype=np.uint16)]).astype(np.uint64)
    n = len(text)
    four = padded[:-3] << np.uint64(48) | padded[1:-2] << np.uint64(32) | padded[2:-1] << np.uint64(16) | padded[3:]
    keys = [four[j: j + n] for j in range(0, depth, 4)]
    order = np.lexsort(keys[::-1])
    return order, [k[order] for k in keys]


def search(sorted_keys: list[np.ndarray], wanted: list[np.ndarray], right: bool) -> np.ndarray:
    """Binary search of all ``wanted`` keys at once."""
    n = len(sorted_keys[0])
    low, high = np.zeros(len(wanted[0]), dtype=np.int64), np.full(len(wanted[0]), n, dtype=np.int64)
    for _ in range(max(1, n.bit_length()) + 1):
        open_ = low < high
        mid = (low + high) >> 1
        at = np.minimum(mid, n - 1)
        less = np.full(len(low), right)
        tied = np.ones(len(low), dtype=bool)
        for keys, want in zip(sorted_keys, wanted):
            have = keys[at]
            less = np.where(tied, np.where(have == want, less, have < want), less)
            tied &= have == want
        low, high = np.where(open_ & less, mid + 1, low), np.where(open_ & ~less, mid, high)
    return low


def edges(text: np.ndarray, vocab: Pieces) -> np.ndarray:
    """``[position, length] -> index of the piece + 1`` for every occurrence of every piece."""
    order, keys = suffix_array(text, vocab.longest)
    low = search(keys, _keys(vocab.rows), False)
    high = search(keys, _keys(vocab.rows, 0xFFFF, vocab.size), True)
    count = high - low
    at = order[ragged(count, low)]
    out = np.zeros((len(text), vocab.longest + 1), dtype=np.int32)
    piece = np.repeat(np.arange(len(count)), count)
    out[at, vocab.size[piece]] = piece + 1
    return out


def relax(size: np.ndarray, word: np.ndarray, at: np.ndarray, edge: np.ndarray, vocab: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Contract edges in all words at once: symbols are given by their start
    ``at``, ``size`` and ``word`` (ascending); returns the remaining starts and sizes."""
    rank = np.concatenate([[_NONE], vocab.rank])
    done_at, done_size = [], []
    while len(at):
        joint = size[:-1] + size[1:]
        fits = (word[:-1] == word[1:]) & (joint <= vocab.longest)
        score = np.full(len(at), _NONE)
        i = np.flatnonzero(fits)
        score[i] = rank[edge[at[i], joint[i]]]
        starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        # the best score and, among equals, the leftmost
        key = np.where(score == _NONE, _NONE, score * (1 << 32) + np.arange(len(at)))
        best = np.minimum.reduceat(key, starts)
        live = np.repeat(best != _NONE, np.diff(np.append(starts, len(at))))
        done_at.append(at[~live])
        done_size.append(size[~live])
        pick = best[best != _NONE] & ((1 << 32) - 1)
        size = size.copy()
        size[pick] += size[pick + 1]
        live[pick + 1] = False
        size, word, at = size[live], word[live], at[live]
    if not done_at:
        return at, size
    at, size = np.concatenate(done_at), np.concatenate(done_size)
    order = np.argsort(at, kind="stable")
    return at[order], size[order]


def relax_long(start: int, end: int, edge: np.ndarray, vocab: Pieces) -> tuple[list[int], list[int]]:
    """The same for one long word, with a queue of edges."""
    n = end - start
    size, after, before = [1] * n, list(range(1, n + 1)), list(range(-1, n - 1))
    queue: list[tuple[int, int, int, int]] = []

    def offer(a: int) -> None:
        b = after[a] if a >= 0 else n
        if a >= 0 and b < n and (both := size[a] + size[b]) <= vocab.longest and (e := int(edge[start + a, both])):
            heapq.heappush(queue, (int(vocab.rank[e - 1]), a, size[a], size[b]))

    for a in range(n):
        offer(a)
    while queue:
        _, a, x, y = heapq.heappop(queue)
        b = after[a]
        if size[a] != x or b >= n or size[b] != y:
            continue
        size[a] += y
        size[b] = 0
        after[a] = after[b]
        if after[a] < n:
            before[after[a]] = a
        offer(a)
        offer(before[a])
    at = [i for i in range(n) if size[i]]
    return [start + i for i in at], [size[i] for i in at]


def word_cuts(block: Block) -> Segments:
    """Cut before every run of blanks, and around line feeds (in no piece)."""
    data = block.data
    mark = np.zeros(len(data), dtype=bool)
    at = np.flatnonzero(data == 32)
    at = at[at > 0]
    blank = data[at - 1] == 32
    far = np.maximum(at - 3, 0)
    blank |= (data[at - 1] == 0x81) & (data[np.maximum(at - 2, 0)] == 0x96) & (data[far] == 0xE2) & (at >= 3)  # U+2581 itself
    mark[at[~blank]] = True
    line = np.flatnonzero(data == 10)
    mark[line] = True
    mark[line[line + 1 < len(data)] + 1] = True
    return cut(block, mark)


def cut_long(words: list[str], vocab: Pieces) -> tuple[list[str], list[int]]:
    """The words in parts, and the word of each part."""
    parts, owner = [], []
    for k, word in enumerate(words):
        if len(word) <= LONG_WORD:
            parts.append(word)
            owner.append(k)
            continue
        targets = range(LONG_WORD // 2, len(word) - LONG_WORD // 4, LONG_WORD // 2)
        around = [word[p - AROUND: p + AROUND] for p in targets]
        middle: dict[str, int] = {}  # of each distinct one the place of the symbol that begins next to its middle
        distinct = list(dict.fromkeys(around))
        for a, b in chunks(distinct):
            at, _, owns = symbols(distinct[a:b], vocab)[:3]
            first = np.searchsorted(owns, np.arange(b - a))
            best = np.minimum.reduceat(np.abs(at - AROUND) * 4 * AROUND + at, first) % (4 * AROUND)
            middle.update(zip(distinct[a:b], best.tolist()))
        cuts = [p - AROUND + middle[w] for p, w in zip(targets, around)]
        own = [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)]) if a < b]
        parts += own
        owner += [k] * len(own)
    return parts, owner


def chunks(words: list[str]) -> list[tuple[int, int]]:
    """Runs of words of INDEXED characters or so."""
    group = np.cumsum([len(w) + 1 for w in words]) // INDEXED
    edge = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(words)]
    return list(zip(edge, edge[1:]))


def encode_all(words: list[str], vocab: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of any number of words of any length, one after the other, and their number per word."""
    parts, owner = cut_long(words, vocab)
    done: list[tuple[np.ndarray, int, int] | None] = [None] * len(parts)  # ids, characters of the first and last symbol
    todo = list(range(len(parts)))
    while todo:
        for a, b in chunks([parts[i] for i in todo]):
            some = todo[a:b]
            for i, got in zip(some, encode_words([parts[i] for i in some], vocab)):
                done[i] = got
        # cuts within words whose symbols would have been joined
        seams = [i for i in range(1, len(parts)) if owner[i] == owner[i - 1]]
        pairs = [parts[i - 1][len(parts[i - 1]) - done[i - 1][2]:] + parts[i][: done[i][1]] for i in seams]
        wrong = set()
        distinct = list(dict.fromkeys(pairs))
        if distinct:
            size = symbols(distinct, vocab)[1:3]
            count = dict(zip(distinct, np.bincount(size[1], minlength=len(distinct)).tolist()))
            head = dict(zip(distinct, size[0][np.flatnonzero(np.diff(size[1], prepend=-1))].tolist()))
            wrong = {i for i, p in zip(seams, pairs) if count[p] != 2 or head[p] != done[i - 1][2]}
        todo = []
        if wrong:
            new_parts, new_owner, new_done = [], [], []
            for i, part in enumerate(parts):
                if i in wrong:
                    new_parts[-1] += part
                    new_done[-1] = None
                else:
                    new_parts.append(part)
                    new_owner.append(owner[i])
                    new_done.append(done[i])
            parts, owner, done = new_parts, new_owner, new_done
            todo = [i for i, d in enumerate(done) if d is None]
    counts = np.bincount(owner, weights=[len(d[0]) for d in done], minlength=len(words)).astype(np.int64)
    return np.concatenate([d[0] for d in done]), counts


def symbols(words: list[str], vocab: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the symbols of all words in order their place in the word, their size,
    their word, the id of their piece (-1: none), and their first character."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    points = np.frombuffer("\0".join(words).replace(" ", SPACE).encode("utf-32-le"), dtype=np.uint32)
    starts = offsets_of(sizes + 1)[:-1]
    text = vocab.code[points]
    text[starts[1:] - 1] = 0
    edge = edges(text, vocab)
    short = sizes <= LONG_WORD
    at = ragged(sizes[short], starts[short])
    at, size = relax(np.ones(len(at), dtype=np.int64), np.repeat(np.flatnonzero(short), sizes[short]), at, edge, vocab)
    for k in np.flatnonzero(~short).tolist():
        more = relax_long(int(starts[k]), int(starts[k] + sizes[k]), edge, vocab)
        at, size = np.append(at, more[0]), np.append(size, more[1])
    order = np.argsort(at, kind="stable")
    at, size = at[order], size[order]
    word = np.searchsorted(starts, at, "right") - 1
    found = np.where(size > 1, vocab.ids[np.maximum(edge[at, size], 1) - 1], vocab.single[text[at]])
    return at - starts[word], size, word, found, points[at]


def encode_words(words: list[str], vocab: Pieces) -> Iterator[tuple[np.ndarray, int, int]]:
    """Per word its ids and the characters of its first and last symbol."""
    _, size, word, found, point = symbols(words, vocab)
    ids, counts = found, np.ones(len(found), dtype=np.int64)
    lost = np.flatnonzero(found < 0)
    if len(lost):
        raw = [chr(c).encode() for c in point[lost].tolist()]
        counts[lost] = [len(b) for b in raw]
        ids = np.repeat(found, counts)
        ids[ids < 0] = vocab.byte[np.frombuffer(b"".join(raw), dtype=np.uint8)]
    first = np.searchsorted(word, np.arange(len(words) + 1))
    at = offsets_of(counts)[first].tolist()
    head, tail = size[first[:-1]].tolist(), size[first[1:] - 1].tolist()
    for a, b, x, y in zip(at, at[1:], head, tail):
        yield ids[a:b], x, y


def encode_block(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a column (null: empty), and their number per text."""
    vocab = pieces(path)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    # the dummy prefix; an empty text has none
    text = lambda t: pa.scalar(t, pa.large_string())
    column = pc.if_else(pc.equal(column, text("")), text(""), pc.binary_join_element_wise(text(" "), column, text("")))
    block = text_block(column)
    seg = word_cuts(block)
    if not len(seg.start):
        return np.zeros(0, dtype="<u4"), np.zeros(block.rows, dtype=np.int64)
    words = [block.raw(a, b).decode() for a, b in zip(seg.start[seg.first].tolist(), seg.end[seg.first].tolist())]
    ids, counts = encode_all(words, vocab)
    per = counts[seg.which]
    out = ids[ragged(per, offsets_of(counts)[:-1][seg.which])]
    return out.astype("<u4"), np.bincount(seg.doc, weights=per, minlength=block.rows).astype(np.int64)


def decode_block(ids: np.ndarray, counts: np.ndarray, path: str) -> list[bytes]:
    """Texts (UTF-8) of ragged ids, without the dummy prefix."""
    vocab = pieces(path)
    size = vocab.raw_size[ids]
    data = vocab.raw[ragged(size, vocab.raw_at[ids])]
    total = offsets_of(size)[offsets_of(counts)]
    raw = data.tobytes()
    return [raw[a + (a < b and raw[a] == 32): b] for a, b in zip(total[:-1].tolist(), total[1:].tolist())]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    bound_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, path: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)`` per row.  A null text is empty and has no ids; ids of
    rows are never merged, a null id stays null, other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, "text"):
            ids, counts = encode_block(batch.column("text"), path)
            lists = pa.ListArray.from_arrays(pa.array(offsets_of(counts), pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists], names=["doc_id", "ids"])

    return _rows(docs, id_col, text_col).mapInArrow(run, IDS)


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """``(doc_id, text)`` of rows ``(doc_id, ids)``; null ids are empty.  Bytes
    that are no UTF-8 become U+FFFD; a literal U+2581 comes back as a blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = pc.fill_null(batch.column("ids").cast(pa.list_(pa.int32())), pa.scalar([], pa.list_(pa.int32())))
            counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = decode_block(lists.flatten().to_numpy(zero_copy_only=False), counts, path)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([t.decode(errors="replace") for t in texts], pa.string())], names=["doc_id", "text"])

    bound_batches(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def encode_round_trip(docs: DataFrame, path: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, decode its ids, and return per row ``(doc_id,
    n_tokens, ids_crc32, decoded_crc32, round_trip)``: the CRC-32 of the ids
    (little-endian, unsigned, 32 bits) and of the decoded text, and whether
    that text is the original.  See ``encode`` for nulls and repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, "text"):
            ids, counts = encode_block(batch.column("text"), path)
            at = (4 * offsets_of(counts)).tolist()
            view = memoryview(ids).cast("B")
            texts = decode_block(ids, counts, path)
            want = pc.fill_null(batch.column("text").cast(pa.large_string()), "").cast(pa.large_binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([
                batch.column("id").cast(pa.int64()), pa.array(counts, pa.int64()), pa.array([zlib.crc32(view[a:b]) for a, b in zip(at, at[1:])], pa.int64()),
                pa.array([zlib.crc32(t) for t in texts], pa.int64()), pa.array([a == b for a, b in zip(texts, want)], pa.bool_())], schema=_ENCODED)

    return _rows(docs, id_col, text_col).mapInArrow(run, ENCODED)
