"""Token counts without token ids: pieces are counted once per distinct
pre-token, and a document's count is the sum over its pre-token frequencies.

1. Every task splits its documents into pre-tokens (the tokenizer's own
   normalization and pattern) and keeps, per block of documents, a dictionary
   of pre-tokens and the documents' frequencies over it.
2. The dictionaries, dealt to shards by a hash of the pre-token, meet in their
   shard, where the pieces of each distinct pre-token are counted once.
3. The counts return to their blocks, are joined to the frequencies there, and
   frequencies times counts are summed by document.

Dictionaries and frequencies travel as compressed arrays, a row per block and
shard.  A word that stands in every document is one entry per block, however
often it occurs, so no shard is hot.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, pre_tokenizers

from .common import bound_batches, text_blocks, written
from .segments import offsets_of, ragged, text_block, word_segments

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: The tokenizer's pattern of pre-tokens (a fixed value of its file).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKEN = regex.compile(PATTERN)
#: Characters whose case, composition and kind the tokenizer's own code decides:
#: Unicode versions differ beyond the Latin letters.
BEYOND = re.compile("[\u0250-\U0010ffff]")
BLOCK = "block long, shard int, dictionary binary, docs array<long>, n_bytes array<long>, per_doc binary, words binary, times binary"
_BLOCK = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("dictionary", pa.binary()), ("docs", pa.list_(pa.int64())),
                    ("n_bytes", pa.list_(pa.int64())), ("per_doc", pa.binary()), ("words", pa.binary()), ("times", pa.binary())])
PIECES = "block long, shard int, pieces binary"
_PIECES = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("pieces", pa.binary())])
COUNT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
_COUNT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])
#: Text bytes of a block; larger blocks repeat fewer dictionary entries.
BLOCK_BYTES = 8 << 20
#: Text bytes whose dictionaries make up a shard, on average: it is loaded whole.
SHARD_BYTES = 8 << 20


@lru_cache(maxsize=1)
def counter(path: str) -> tuple[Tokenizer, re.Pattern, Callable[[str], list[str]]]:
    """The tokenizer for single pre-tokens, the pattern of its added tokens,
    and its own way from a text to pre-tokens."""
    full = Tokenizer.from_file(path)
    added = "|".join(re.escape(t.content) for t in full.get_added_tokens_decoder().values())
    normal, split = full.normalizer, pre_tokenizers.Split(Regex(PATTERN), "removed", invert=True)
    full.normalizer = None
    full.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return full, re.compile(f"({added})"), lambda text: [w for w, _ in split.pre_tokenize_str(normal.normalize_str(text))]


def pre_tokens(text: str, path: str) -> list[str]:
    """Pre-tokens of a text in order; an added token is one of its own."""
    _, added, own = counter(path)
    out: list[str] = []
    for i, part in enumerate(added.split(text) if "|" in text else [text]):
        if i % 2:
            out.append(part)
        elif part.isascii():
            out += PRE_TOKEN.findall(part.lower())
        elif BEYOND.search(part):
            out += own(part)
        else:
            out += PRE_TOKEN.findall(unicodedata.normalize("NFC", part).lower())
    return out


def _packed(values: np.ndarray | bytes, kind: str = "") -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.astype(kind).tobytes() if kind else values)


def _unpacked(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=kind)


def frequencies(column: pa.Array, path: str) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: its distinct pre-tokens, and by document the number of
    distinct ones, their places in that list, their frequencies; bytes."""
    block = text_block(column)
    seg = word_segments(block)
    places: dict[str, int] = {}
    flat, counts = [], []
    for a, b in zip(seg.start[seg.first].tolist(), seg.end[seg.first].tolist()):
        words = pre_tokens(block.raw(a, b).decode(), path)
        counts.append(len(words))
        flat += [places.setdefault(w, len(places)) for w in words]
    counts = np.array(counts, dtype=np.int64)
    per = counts[seg.which] if len(counts) else counts
    place = np.array(flat, dtype=np.int64)[ragged(per, offsets_of(counts)[:-1][seg.which])] if len(counts) else per
    size = max(1, len(places))
    pair, times = np.unique(np.repeat(seg.doc, per) * size + place, return_counts=True)
    per_doc = np.bincount(pair // size, minlength=block.rows)
    return list(places), per_doc, pair % size, times, block.sizes


def dictionaries(docs: DataFrame, shards: int, path: str, id_col: str, text_col: str) -> DataFrame:
    """Per block a row with its documents' frequencies, and one for each shard
    with the part of its dictionary there (joined by line feeds, which no
    pre-token holds); places count through the parts in shard order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, batch in enumerate(text_blocks(batches, "text", BLOCK_BYTES)):
            name = (TaskContext.get().partitionId() << 32) + k
            words, per_doc, place, times, sizes = frequencies(batch.column("text"), path)
            shard = np.fromiter((zlib.crc32(w.encode()) % shards for w in words), dtype=np.int64, count=len(words))
            order = np.argsort(shard, kind="stable")
            rank = np.empty(len(order), dtype=np.int64)
            rank[order] = np.arange(len(order))
            used, start = np.unique(shard[order], return_index=True)
            rows = [(name, s, _packed("\n".join([words[i] for i in order[a:b]]).encode()), None, None, None, None, None)
                    for s, a, b in zip(used.tolist(), start.tolist(), [*start[1:].tolist(), len(order)])]
            rows.append((name, None, None, batch.column("id").to_pylist(), sizes.tolist(), _packed(per_doc, "<u4"), _packed(rank[place] if len(place) else place, "<u4"), _packed(times, "<u4")))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _BLOCK.types)], schema=_BLOCK)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, BLOCK)


def count_pieces(parts: DataFrame, path: str) -> DataFrame:
    """``(block, shard, pieces)`` of ``(block, shard, dictionary)``: the pieces
    of each entry, counted once per distinct pre-token of the shard."""

    def run(table: pa.Table) -> pa.Table:
        tokenizer, known, out = counter(path)[0], {}, []
        for block, shard, raw in zip(*(table[c].to_pylist() for c in ("block", "shard", "dictionary"))):
            words = zstandard.ZstdDecompressor().decompress(raw).decode().split("\n")
            new = [w for w in words if w not in known]
            for at in range(0, len(new), 10_000):
                some = new[at: at + 10_000]
                known.update(zip(some, map(len, tokenizer.encode_batch_fast(some, add_special_tokens=False))))
            out.append((block, shard, _packed(np.array([known[w] for w in words]), "<u4")))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _PIECES.types)], schema=_PIECES)

    return parts.groupBy("shard").applyInArrow(run, PIECES)


def token_counts(docs: DataFrame, path: str = TOKENIZER, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` per row: the tokens that the
    tokenizer gives for the whole text, without begin, end or padding.

    A null text is empty and has 0 tokens.  The string of a special token
    inside a text counts as that one token, as in the library.  Rows with the
    same id or text are counted each on its own, a null id stays null, other
    columns are ignored.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    shards = int(docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0) // SHARD_BYTES + 1
    table = written(dictionaries(docs, shards, path, id_col, text_col), "token-dictionaries")
    pieces = count_pieces(table.where("shard IS NOT NULL").select("block", "shard", "dictionary"), path)
    blocks = table.where("shard IS NULL").select("block", "docs", "n_bytes", "per_doc", "words", "times")

    def total(block: pa.Table, pieces: pa.Table) -> pa.Table:
        parts = sorted(zip(pieces["shard"].to_pylist(), pieces["pieces"].to_pylist()))
        n = np.concatenate([np.zeros(0, np.int64), *(_unpacked(raw, "<u4") for _, raw in parts)])
        row = block.to_pylist()[0]
        per_doc = _unpacked(row["per_doc"], "<u4")
        tokens = n[_unpacked(row["words"], "<u4")] * _unpacked(row["times"], "<u4")
        tokens = np.diff(np.concatenate([[0], np.cumsum(tokens)])[offsets_of(per_doc)])
        return pa.Table.from_arrays([pa.array(row["docs"], pa.int64()), pa.array(row["n_bytes"], pa.int64()),
                                     pa.array(tokens, pa.int64()), pa.array(tokens > limit)], schema=_COUNT)

    return blocks.groupBy("block").cogroup(pieces.groupBy("block")).applyInArrow(total, COUNT)
