"""Substring dedup by MinHash banding of paragraphs.

Paragraphs of a document are its lines, and passages of ``WINDOW`` words that
start at content-defined anchors (words whose hash is the least among their
neighbours).  A passage that was copied into other surroundings has the same
anchors there, so the same paragraphs, wherever lines begin.

1. Equal paragraphs (lines and passages) are one class.  A block of documents
   sends the hashes of its distinct classes, with the smallest and largest id
   that has them, to shards, and gets back those of several documents.
2. Lines get a MinHash signature over their five-word shingles, cut into bands
   that are tuned to find pairs at the threshold with high recall.  Band keys
   travel in the same way; back come the buckets where different lines meet.
   Passages need no bands: around an edited word other passages of a copy are
   still equal, and step 5 finds the whole of it from any of them.
3. Line classes that meet in a bucket are verified by the exact Jaccard
   similarity of their shingles; a spanning forest of the verified links
   leaves a bucket, and buckets of very many classes are split into pairs of
   blocks.
4. Classes linked directly or by others are one cluster.  A cluster that
   reaches over several documents stays in the one of the smallest id and is
   removed from the others.
5. Touching removed paragraphs of one keeper are a run.  Its two ends are
   aligned with the keeper's text word by word and extended as long as they
   equal it but for edits: up to HOP words changed, added or left out, if at
   least HOP_MATCH equal words follow.  So words before the first and after the
   last anchor, those of gaps between anchors, and near-equal passages, whose
   edit distance to the keeper's is at most a fifth of their words, go whole.

What is shuffled for all paragraphs are compressed arrays, a row per block and
shard; a passage that stands in every document is one entry per block.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, components, keyed, row_text, shuffle_partitions, text_blocks, written
from .segments import Block, offsets_of, ragged, text_block

SHINGLE, THRESHOLD = 5, 0.8
#: Words of a passage.
WINDOW = 16
#: An anchor is the least of so many words to either side.
REACH = 6
#: Wanted share of the pairs at the threshold that meet in a band, and the most bands.
RECALL, MOST_BANDS = 0.98, 4
#: Classes of a bucket that one block holds.
BUCKET_BLOCK = 1024
NO_ID = -(2**63)
#: Words that an edit changes, adds or leaves out at most, and equal words that must follow it.
HOP, HOP_MATCH = 2, 8
_HOPS = sorted(((i, j) for i in range(HOP + 1) for j in range(HOP + 1) if i or j), key=lambda h: (max(h), abs(h[0] - h[1]), h))
#: Ends of one class that one task compares with the keeper's, and text bytes of a shard.
END_BLOCK, SHARD_BYTES = 1024, 8 << 20
#: Bytes beside the end of a run that are compared first, and their growth while all of them are equal.
CONTEXT, GROWTH = 512, 16
#: Bytes of the next run that are looked at too, for the words that follow an edit.
LOOK = 192
#: Rows of a block: "block" (its paragraphs), "class" (hashes and ids for a shard), "band" (band keys for a shard).
BLOCK = ("block long, kind string, shard int, keys binary, lows binary, highs binary, ids array<long>, versions array<long>, per_doc binary, starts binary,"
         " stops binary, classes binary, class_shards binary, lines binary, hashes binary, band_shards binary")
_BLOCK = pa.schema([("block", pa.int64()), ("kind", pa.string()), ("shard", pa.int32()), *((c, pa.binary()) for c in ("keys", "lows", "highs")),
                    ("ids", pa.list_(pa.int64())), ("versions", pa.list_(pa.int64())),
                    *((c, pa.binary()) for c in ("per_doc", "starts", "stops", "classes", "class_shards", "lines", "hashes", "band_shards"))])
ANSWER = "block long, kind string, shard int, numbers binary, lows binary, highs binary"
_ANSWER = pa.schema([("block", pa.int64()), ("kind", pa.string()), ("shard", pa.int32()), *((c, pa.binary()) for c in ("numbers", "lows", "highs"))])
SPAN = "id long, version long, start long, stop long, label long, low long, high long, hash binary, buckets array<long>"
_SPAN = pa.schema([*((c, pa.int64()) for c in ("id", "version", "start", "stop", "label", "low", "high")), ("hash", pa.binary()), ("buckets", pa.list_(pa.int64()))])
CONTEXT_ROW = "label long, left boolean, keeper boolean, id long, version long, low long, lo long, hi long, beside binary, more boolean"
_CONTEXT_ROW = pa.schema([("label", pa.int64()), ("left", pa.bool_()), ("keeper", pa.bool_()), *((c, pa.int64()) for c in ("id", "version", "low", "lo", "hi")), ("beside", pa.binary()), ("more", pa.bool_())])
EDGE = "a binary, b binary"
_EDGE = pa.schema([("a", pa.binary()), ("b", pa.binary())])

_RANDOM = np.random.default_rng(11)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_ODD = _RANDOM.integers(1, 2**62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def tune_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_BANDS) -> tuple[int, int]:
    """Bands and rows per band: as many rows as still find a pair at the
    threshold with the wanted recall, 1 - (1 - s**rows)**bands."""
    fits = [(r, b) for r in range(1, 9) for b in range(1, most + 1) if 1 - (1 - threshold**r) ** b >= recall]
    if not fits:
        raise ValueError("no bands reach the recall")
    rows = max(r for r, _ in fits)
    return min(b for r, b in fits if r == rows), rows


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_table(block: Block) -> tuple[np.ndarray, ...]:
    """Words (split at ASCII white space): start, end, document, line, hash (A-Z lower-cased)."""
    data = block.data
    solid = ~_BLANK[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[block.offsets] = True
    before = np.concatenate([[False], solid[:-1]])
    start = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.concatenate([solid[1:], [False]])
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    doc = np.searchsorted(block.offsets, start, "right") - 1
    line = np.cumsum(data == 10)[start] if len(start) else start
    size = end - start
    place = ragged(size, start)
    rel = np.arange(len(place)) - np.repeat(np.cumsum(size) - size, size)
    term = mix(_BYTE[_LOWER[data[place]]] + rel.astype(np.uint64) * _ODD[0])
    hashed = mix(np.add.reduceat(term, np.cumsum(size) - size)) if len(start) else np.zeros(0, np.uint64)
    return start, end, doc, line, hashed


def paragraphs(doc: np.ndarray, line: np.ndarray, hashed: np.ndarray, window: int = WINDOW, reach: int = REACH, shortest: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and whether it is a line, of every
    paragraph: lines of at least ``shortest`` words, and passages of ``window``
    words from the anchors on."""
    n = len(doc)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])]))
    size = np.diff(np.append(first, n))
    long_line = size >= shortest
    ahead = np.concatenate([hashed, np.zeros(2, dtype=np.uint64)])
    value = mix(hashed * _ODD[1] + ahead[1: n + 1] * _ODD[2] + ahead[2:] * _ODD[3])
    least = np.ones(n, dtype=bool)
    for d in range(1, min(reach, n - 1) + 1):
        same = doc[d:] == doc[:-d]
        least[d:] &= ~same | (value[d:] < value[:-d])
        least[:-d] &= ~same | (value[:-d] <= value[d:])
    anchor = np.flatnonzero(least)
    anchor = anchor[anchor + window <= n]
    anchor = anchor[doc[anchor] == doc[anchor + window - 1]]
    is_line = np.arange(long_line.sum() + len(anchor)) < long_line.sum()
    return np.concatenate([first[long_line], anchor]), np.concatenate([size[long_line], np.full(len(anchor), window)]), is_line


def class_hashes(hashed: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 128-bit hash (n, 2) of the words of every paragraph."""
    if not len(at):
        return np.zeros((0, 2), np.uint64)
    begin = np.cumsum(size) - size
    words = hashed[ragged(size, at)]
    rel = (np.arange(len(words)) - np.repeat(begin, size)).astype(np.uint64)
    return np.stack([mix(np.add.reduceat(mix(words + rel * _ODD[k]), begin)) for k in (4, 5)], axis=1)


def band_keys(hashed: np.ndarray, at: np.ndarray, size: np.ndarray, bands: int, rows: int, shingle: int = SHINGLE) -> np.ndarray:
    """Band keys (n, bands) of the MinHash signature of every paragraph."""
    keys = np.zeros((len(at), bands), dtype=np.uint64)
    if not len(at):
        return keys
    grams = np.zeros(len(hashed), dtype=np.uint64)
    for k in range(shingle):
        grams[: len(hashed) - k] += hashed[k:] * _ODD[8 + k]
    grams = mix(grams)
    count = size - shingle + 1
    begin = np.cumsum(count) - count
    grams = grams[ragged(count, at)]
    for b in range(bands):
        for r in range(rows):
            keys[:, b] = mix(keys[:, b] * _ODD[6] + np.minimum.reduceat(mix(grams * _ODD[16 + b * rows + r]), begin))
        keys[:, b] += np.uint64(b)
    return mix(keys)


def _zip(values: np.ndarray, kind: str) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.astype(kind)).tobytes())


def _unzip(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=kind)


def _by_shard(shard: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order by shard, and ``(shard, start, stop)`` of the runs in it."""
    order = np.argsort(shard, kind="stable")
    used, first = np.unique(shard[order], return_index=True)
    return order, list(zip(used.tolist(), first.tolist(), [*first[1:].tolist(), len(order)]))


def block_paragraphs(rows: DataFrame, shards: int, bands: int, band_rows: int) -> DataFrame:
    """See BLOCK: per block its paragraphs, and its classes and band keys dealt to shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, batch in enumerate(text_blocks(batches, "body")):
            name = (TaskContext.get().partitionId() << 32) + k
            block = text_block(batch.column("body"))
            start, end, doc, line, hashed = word_table(block)
            at, size, is_line = paragraphs(doc, line, hashed)
            if not len(at):
                continue
            order = np.argsort(at, kind="stable")
            at, size, is_line = at[order], size[order], is_line[order]
            own, ids = doc[at], batch.column("id")
            whole = class_hashes(hashed, at, size)
            _, first, which = np.unique(whole.view("V16").ravel(), return_index=True, return_inverse=True)
            owner = pa.compute.fill_null(ids, NO_ID).to_numpy(zero_copy_only=False)[own]
            low, high = np.full(len(first), np.iinfo(np.int64).max), np.full(len(first), NO_ID)
            np.minimum.at(low, which, owner)
            np.maximum.at(high, which, owner)
            one = whole[first]
            shard = (one[:, 0] % np.uint64(shards)).astype(np.int64)
            order, runs = _by_shard(shard)
            one, low, high = one[order], low[order], high[order]
            keys = np.empty(len(one), dtype=[("a", "<u8"), ("b", "<u4")])
            keys["a"], keys["b"] = one[:, 0], one[:, 1].astype(np.uint32)
            out = [dict(block=name, kind="class", shard=s, keys=keys[a:b].tobytes(), lows=_zip(low[a:b], "<i8"), highs=_zip(high[a:b] - low[a:b], "<i8")) for s, a, b in runs]
            flat = band_keys(hashed, at[is_line], size[is_line], bands, band_rows).ravel()
            band_shard = (flat % np.uint64(shards)).astype(np.int64)
            order, runs = _by_shard(band_shard)
            pair = np.empty(len(flat), dtype=[("a", "<u4"), ("b", "<u4")])
            pair["a"], pair["b"] = flat[order] >> np.uint64(32), np.repeat(whole[is_line, 1], bands)[order].astype(np.uint32)
            out += [dict(block=name, kind="band", shard=s, keys=pair[a:b].tobytes()) for s, a, b in runs]
            base = block.offsets[own]
            out.append(dict(block=name, kind="block", ids=ids.to_pylist(), versions=batch.column("version").to_pylist(), per_doc=_zip(np.bincount(own, minlength=block.rows), "<u4"),
                            starts=_zip(start[at] - base, "<u4"), stops=_zip(end[at + size - 1] - base, "<u4"), classes=_zip(which, "<u4"), class_shards=_zip(shard, "<u4"),
                            lines=_zip(np.packbits(is_line), "u1"), hashes=np.ascontiguousarray(whole[is_line]).astype("<u8").tobytes(), band_shards=_zip(band_shard, "<u4")))
            yield pa.RecordBatch.from_pylist(out, schema=_BLOCK)

    return rows.select("id", "version", "body").mapInArrow(run, BLOCK)


def shared_classes(parts: DataFrame) -> DataFrame:
    """Of each class a block sent: its number in the shard if it stands in
    several documents, else 0; and the ids, for those that do."""

    def run(table: pa.Table) -> pa.Table:
        raw = table["keys"].to_pylist()
        low = np.concatenate([_unzip(b, "<i8") for b in table["lows"].to_pylist()])
        high = low + np.concatenate([_unzip(b, "<i8") for b in table["highs"].to_pylist()])
        keys = np.frombuffer(b"".join(raw), dtype=[("a", "<u8"), ("b", "<u4")])
        _, which = np.unique(keys, return_inverse=True)
        least, most = np.full(which.max() + 1, np.iinfo(np.int64).max), np.full(which.max() + 1, NO_ID)
        np.minimum.at(least, which, low)
        np.maximum.at(most, which, high)
        shared = least < most
        number = np.where(shared, np.cumsum(shared), 0)[which]
        at = offsets_of(np.array([len(b) // 12 for b in raw])).tolist()
        out = []
        for block, shard, a, b in zip(table["block"].to_pylist(), table["shard"].to_pylist(), at, at[1:]):
            some = which[a:b][number[a:b] > 0]
            out.append(dict(block=block, kind="class", shard=shard, numbers=_zip(number[a:b], "<u4"), lows=_zip(least[some], "<i8"), highs=_zip(most[some], "<i8")))
        return pa.Table.from_pylist(out, schema=_ANSWER)

    return parts.groupBy("shard").applyInArrow(run, ANSWER)


def shared_buckets(parts: DataFrame) -> DataFrame:
    """Of each band key a block sent: the number of its bucket in the shard if
    different classes meet in it, else 0."""

    def run(table: pa.Table) -> pa.Table:
        raw = table["keys"].to_pylist()
        pairs = np.frombuffer(b"".join(raw), dtype=[("a", "<u4"), ("b", "<u4")])
        _, which = np.unique(pairs["a"], return_inverse=True)
        least, most = np.full(which.max() + 1, 2**32 - 1, dtype=np.uint32), np.zeros(which.max() + 1, dtype=np.uint32)
        np.minimum.at(least, which, pairs["b"])
        np.maximum.at(most, which, pairs["b"])
        mixed = least < most
        number = np.where(mixed, np.cumsum(mixed), 0)[which]
        at = offsets_of(np.array([len(b) // 8 for b in raw])).tolist()
        return pa.Table.from_pylist([dict(block=block, kind="band", shard=shard, numbers=_zip(number[a:b], "<u4"))
                                     for block, shard, a, b in zip(table["block"].to_pylist(), table["shard"].to_pylist(), at, at[1:])], schema=_ANSWER)

    return parts.groupBy("shard").applyInArrow(run, ANSWER)


def candidates(blocks: DataFrame, answers: DataFrame, bands: int) -> DataFrame:
    """See SPAN: the paragraphs that stand in several documents, and the lines
    that meet others in a bucket; ``label`` names the class, ``low`` and
    ``high`` are its ids, ``hash`` and ``buckets`` are null but for such lines."""

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        got: dict[str, list[dict]] = {"class": [], "band": []}
        for x in sorted(answers.to_pylist(), key=lambda x: x["shard"]):
            got[x["kind"]].append(x)
        # classes were sent in shard order
        shard = _unzip(row["class_shards"], "<u4").astype(np.int64)
        order = np.argsort(shard, kind="stable")
        number = np.concatenate([_unzip(x["numbers"], "<u4") for x in got["class"]]).astype(np.int64)
        label, low, high = (np.zeros(len(shard), dtype=np.int64) for _ in range(3))
        label[order] = np.where(number > 0, (shard[order] << 32) + number, 0)
        some = order[number > 0]
        low[some] = np.concatenate([_unzip(x["lows"], "<i8") for x in got["class"]])
        high[some] = np.concatenate([_unzip(x["highs"], "<i8") for x in got["class"]])
        which = _unzip(row["classes"], "<u4")
        label, low, high = label[which], low[which], high[which]
        doc = np.repeat(np.arange(len(row["ids"])), _unzip(row["per_doc"], "<u4"))
        is_line = np.unpackbits(_unzip(row["lines"], "u1"))[: len(which)].astype(bool)
        bucket = np.zeros((len(which), bands), dtype=np.int64)
        if got["band"]:
            shard = _unzip(row["band_shards"], "<u4").astype(np.int64)
            flat = np.empty(len(shard), dtype=np.int64)
            flat[np.argsort(shard, kind="stable")] = np.concatenate([_unzip(x["numbers"], "<u4") for x in got["band"]])
            bucket[is_line] = np.where(flat > 0, (shard << 32) + flat, 0).reshape(-1, bands)
        meets = bucket.any(axis=1)
        pick = np.flatnonzero((label > 0) | meets)
        ids = np.array([NO_ID if i is None else i for i in row["ids"]], dtype=np.int64)[doc]
        low, high = np.where(label > 0, low, ids), np.where(label > 0, high, ids)
        line_hash = np.zeros(len(which), dtype="V16")
        line_hash[is_line] = np.frombuffer(row["hashes"], dtype="V16")
        meets = meets[pick]
        return pa.Table.from_arrays([
            pa.array(ids[pick], mask=ids[pick] == NO_ID), pa.array(np.array(row["versions"], dtype=np.int64)[doc[pick]]), pa.array(_unzip(row["starts"], "<u4")[pick].astype(np.int64)),
            pa.array(_unzip(row["stops"], "<u4")[pick].astype(np.int64)), pa.array(label[pick]), pa.array(low[pick]), pa.array(high[pick]),
            pa.array([h.tobytes() if m else None for h, m in zip(line_hash[pick], meets)], pa.binary()),
            pa.array([[b for b in x if b] if m else None for x, m in zip(bucket[pick].tolist(), meets)], pa.list_(pa.int64()))], schema=_SPAN)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, SPAN)


def shingles(text: str, size: int = SHINGLE) -> frozenset:
    """Five-word shingles, A-Z lower-cased; a shorter text is one shingle."""
    words = text.encode().lower().split()
    return frozenset(zip(*(words[k:] for k in range(size)))) if len(words) >= size else frozenset([tuple(words)])


def jaccard(a: frozenset, b: frozenset) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both) if a or b else 1.0


def similar_forest(sets: list[frozenset], threshold: float) -> list[tuple[int, int]]:
    """A spanning forest of the pairs with a Jaccard similarity of at least
    ``threshold``: a newcomer is compared with each group's first member, then
    with its others, until the group has it."""
    groups: list[list[int]] = []
    links = []
    for i, own in enumerate(sets):
        joined: list[int] | None = None
        rest = []
        for members in groups:
            hit = next((j for j in members if threshold * len(own) <= len(sets[j]) <= len(own) / threshold and jaccard(own, sets[j]) >= threshold), None)
            if hit is None:
                rest.append(members)
                continue
            links.append((hit, i))
            joined = members if joined is None else joined + members
        groups = [*rest, [i] if joined is None else [*joined, i]]
    return links


def verified(rows: DataFrame, threshold: float) -> DataFrame:
    """Edges ``(a, b)`` between the hashes of rows ``(bucket, hash, text)`` of one bucket."""
    size = rows.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET_BLOCK)
    size = size.select("bucket", F.ceil(F.col("n") / BUCKET_BLOCK).cast("int").alias("blocks"))
    rows = rows.join(size, "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("hash"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "hash", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "low", "high", "hash", "text"))))
        for _, group in itertools.groupby(stream, key=lambda r: r[:3]):
            group = list(group)
            links = similar_forest([shingles(r[4]) for r in group], threshold)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([group[i][3] for i, _ in links], pa.binary()), pa.array([group[j][3] for _, j in links], pa.binary())], schema=_EDGE)

    return rows.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high").mapInArrow(run, EDGE)


def class_texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(hash, text)`` of paragraphs ``(hash, id, version, start, stop)`` of documents ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(p["hash"], body[p["start"]: p["stop"]].decode()) for body, parts in zip(batch.column("body").cast(pa.binary()).to_pylist(), batch.column("parts").to_pylist()) for p in parts]
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in out], pa.binary()), pa.array([t for _, t in out], pa.string())], names=["hash", "text"])

    parts = wanted.groupBy("id", "version").agg(F.collect_list(F.struct("start", "stop", "hash")).alias("parts"))
    same = F.col("r.id").eqNullSafe(F.col("p.id")) & (F.col("r.version") == F.col("p.version"))
    found = rows.alias("r").join(parts.alias("p"), same).select("body", "parts").mapInArrow(run, "hash binary, text string")
    return found.groupBy("hash").agg(F.first("text").alias("text"))


def equal_words(mine: bytes, his: bytes, left: bool, mine_more: bool, his_more: bool) -> tuple[int, bool]:
    """How many bytes of ``mine`` beside a run hold the words that equal those of
    ``his`` (A-Z lower-cased), counted from the run, single edits included; and
    whether the texts that ``more`` says go on may hold further ones."""
    a, b = ([(m.start(), m.end()) for m in re.finditer(rb"[^\t-\r ]+", t)] for t in (mine, his))
    if left:
        a, b = a[::-1], b[::-1]
    # the last word of a text that goes on may be a part of one
    a, b = a[: len(a) - mine_more], b[: len(b) - his_more]
    x, y = [mine[p:q].lower() for p, q in a], [his[p:q].lower() for p, q in b]

    def run(i: int, j: int, most: int) -> int:
        """Equal words from the places i and j on, ``most`` of them at most."""
        n = 0
        while n < most and i + n < len(x) and j + n < len(y) and x[i + n] == y[j + n]:
            n += 1
        return n

    i = j = 0
    while True:
        n = run(i, j, len(x))
        i, j = i + n, j + n
        far = (mine_more and i == len(x)) or (his_more and j == len(y))
        hop = None
        for di, dj in _HOPS if i < len(x) and j < len(y) else []:
            n = run(i + di, j + dj, HOP_MATCH)
            # words beyond what is seen of a text may still be equal
            far = far or (n < HOP_MATCH and ((mine_more and i + di + n >= len(x)) or (his_more and j + dj + n >= len(y))))
            if n == HOP_MATCH:
                hop, far = (di, dj), False
                break
        if hop is None:
            break
        i, j = i + hop[0], j + hop[1]
    return (0 if not i else len(mine) - a[i - 1][0] if left else a[i - 1][1]), bool(far)


def contexts(rows: DataFrame, ends: DataFrame, size: int) -> DataFrame:
    """See CONTEXT_ROW: ``ends (label, left, keeper, id, version, low, start, stop,
    lo, hi, room)`` with the ``size`` bytes, or ``room`` if that is less, beside
    ``start .. stop`` in documents ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (body, parts) in enumerate(zip(batch.column("body").cast(pa.binary()), batch.column("parts"))):
                raw, out = body.as_py(), []
                for p in parts.as_py():
                    reach = size if p["room"] is None else min(size, p["room"])
                    a, b = (max(0, p["start"] - reach), p["start"]) if p["left"] else (p["stop"], p["stop"] + reach)
                    more = reach == size and (a > 0 if p["left"] else b < len(raw))
                    out.append({**{c: p[c] for c in ("label", "left", "keeper", "low", "lo", "hi")}, "id": batch.column("id")[k].as_py(), "version": batch.column("version")[k].as_py(),
                                "beside": raw[a:b], "more": more})
                yield pa.RecordBatch.from_pylist(out, schema=_CONTEXT_ROW)

    parts = ends.groupBy("id", "version").agg(F.collect_list(F.struct("label", "left", "keeper", "low", "start", "stop", "lo", "hi", "room")).alias("parts"))
    same = F.col("r.id").eqNullSafe(F.col("p.id")) & (F.col("r.version") == F.col("p.version"))
    found = rows.alias("r").join(parts.alias("p"), same).select("r.id", "r.version", "body", "parts")
    return found.mapInArrow(run, CONTEXT_ROW)


def extended(rows: DataFrame, equal: DataFrame) -> DataFrame:
    """``(id, version, start, stop, label, low)``: the runs of touching removed
    spans of one keeper (``low``) that go on, to either side, as far as their
    words equal those beside the keeper's span of the same class."""
    gone = F.coalesce("id", F.lit(NO_ID)) != F.col("low")
    one = Window.partitionBy("id", "version", "low").orderBy("start", "stop", "label")
    spans = equal.where(gone).select("id", "version", "low", "start", "stop", "label")
    before = F.max("stop").over(one.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("first", F.coalesce(before + 1 < F.col("start"), F.lit(True)).cast("int")).withColumn("run", F.sum("first").over(one.rowsBetween(Window.unboundedPreceding, 0)))
    runs = spans.groupBy("id", "version", "low", "run").agg(F.min(F.struct("start", "stop", "label")).alias("l"), F.max(F.struct("stop", "start", "label")).alias("r"))
    # what lies beyond the next run of the keeper is that run's own
    near = Window.partitionBy("id", "version", "low").orderBy("run")
    runs = runs.withColumns({"lroom": F.col("l.start") - F.lag("r.stop").over(near) + LOOK, "rroom": F.lead("l.start").over(near) - F.col("r.stop") + LOOK})
    runs = runs.select("id", "version", "low", F.col("l.start").alias("lo"), F.col("r.stop").alias("hi"), F.explode(F.array(*[
        F.struct(F.lit(side == "l").alias("left"), F.col(f"{side}room").alias("room"), *[F.col(f"{side}.{c}").alias(c) for c in ("label", "start", "stop")]) for side in "lr"])).alias("end"))
    ends = written(runs.select("id", "version", "low", "lo", "hi", "end.*").withColumn("keeper", F.lit(False)), "paragraph-ends")
    out, size = None, CONTEXT

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("beside", "theirs", "left", "more", "their_more")]
            got = [equal_words(*row) for row in zip(*cols)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "version", "low", "label", "left", "lo", "hi")), pa.array([n for n, _ in got], pa.int64()), pa.array([m for _, m in got], pa.bool_())],
                                             names=["id", "version", "low", "label", "left", "lo", "hi", "n", "far"])

    while ends is not None:
        kept = equal.where(~gone).join(ends.select("label").distinct(), "label", "left_semi").groupBy("label").agg(F.min(F.struct("id", "version", "start", "stop")).alias("at"))
        kept = kept.select("label", "at.*").withColumn("left", F.explode(F.array(F.lit(True), F.lit(False)))).withColumn("keeper", F.lit(True))
        both = written(contexts(rows, ends.unionByName(kept, allowMissingColumns=True), size), "paragraph-contexts")
        theirs = both.where("keeper").groupBy("label", "left").agg(F.first(F.struct("beside", "more")).alias("k")).select("label", "left", F.col("k.beside").alias("theirs"), F.col("k.more").alias("their_more"))
        # a class with very many ends is compared in parts, each with a copy of the keeper's text
        hot = both.where("NOT keeper").groupBy("label", "left").agg(F.ceil(F.count("*") / END_BLOCK).cast("int").alias("parts"))
        hot = written(hot.where("parts > 1"), "paragraph-hot")
        theirs = theirs.join(hot, ["label", "left"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
        mine = both.where("NOT keeper").drop("keeper").join(hot, ["label", "left"], "left")
        mine = mine.withColumn("part", F.pmod(F.xxhash64("id", "version", "lo"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
        pairs = mine.join(theirs, ["label", "left", "part"])
        got = written(pairs.mapInArrow(grown, "id long, version long, low long, label long, left boolean, lo long, hi long, n long, far boolean"), "paragraph-grown")
        new = got.where("n > 0 AND NOT far")
        out = new if out is None else out.unionByName(new)
        # those whose whole context is equal see more of it
        far = got.where("far").select("id", "version", "low", "label", "left", "lo", "hi").distinct()
        size *= GROWTH
        key = ["id", "version", "low", "label", "left", "lo", "hi"]
        match = [ends[c].eqNullSafe(far[c]) for c in key]
        ends = written(ends.join(far, match, "left_semi"), "paragraph-ends") if far.limit(1).count() else None
    ends = [F.when(F.col("left"), F.col("lo") - F.col("n")).otherwise(F.col("lo")).alias("start"), F.when(~F.col("left"), F.col("hi") + F.col("n")).otherwise(F.col("hi")).alias("stop")]
    return out.select("id", "version", *ends, "label", "low")


def beyond(runs: DataFrame, lines: DataFrame) -> DataFrame:
    """The ``runs`` that do not lie within one of ``lines (id, version, start, stop)``."""
    both = runs.withColumn("line", F.lit(0)).unionByName(lines.withColumn("line", F.lit(1)), allowMissingColumns=True)
    at = Window.partitionBy("id", "version").orderBy("start", F.col("line").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    covered = F.max(F.when(F.col("line") == 1, F.col("stop"))).over(at)
    return both.withColumn("covered", covered).where("line = 0 AND (covered IS NULL OR covered < stop)").select(*runs.columns)


def repeated_spans(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The paragraphs that stand, alike, in several documents: ``(id, version,
    start, stop, cluster, keep_id, removed)``, bytes ``start .. stop`` of the
    text.  ``keep_id`` is the cluster's smallest id; its document keeps all of
    its paragraphs of the cluster, from the others they are ``removed``.
    Where a run of removed paragraphs goes on in the keeper's words, beyond a
    removed line, the run as far as they are equal but for edits is one more
    row, in the cluster of its end.

    Paragraphs are alike when they are equal (A-Z lower-cased, white space
    aside) or linked by pairs with a Jaccard similarity of five-word shingles
    of at least ``threshold``.  A null or empty text, and one whose lines
    are all of fewer than SHINGLE words and that has fewer than WINDOW, has no
    paragraphs.  Rows with the same id are one document; a
    null id is smaller than any other.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    bands, band_rows = tune_bands(threshold)
    rows = keyed(docs, id_col, text_col)
    shards = max(shuffle_partitions(spark), int(docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0) // SHARD_BYTES + 1)
    table = written(block_paragraphs(rows, shards, bands, band_rows), "paragraphs")
    parts = table.select("block", "kind", "shard", "keys", "lows", "highs")
    answers = shared_classes(parts.where("kind = 'class'")).unionByName(shared_buckets(parts.where("kind = 'band'")))
    blocks = table.where("kind = 'block'").drop("kind", "shard", "keys", "lows", "highs")
    spans = written(candidates(blocks, answers, bands), "paragraph-candidates")
    equal, meeting = spans.where("buckets IS NULL"), spans.where("buckets IS NOT NULL")
    # one row per class of lines that meet others
    place = F.struct("id", "version", "start", "stop")
    classes = meeting.groupBy("hash").agg(F.first("buckets").alias("buckets"), F.min(place).alias("at"), F.min("low").alias("low"), F.max("high").alias("high"))
    classes = written(classes, "paragraph-classes")
    edges = verified(classes.select(F.explode("buckets").alias("bucket"), "hash").join(class_texts(rows, classes.select("hash", "at.*")), "hash"), threshold)
    linked = components(edges, "paragraph").withColumnRenamed("id", "hash")
    member = classes.select("hash", "low", "high").join(linked, "hash", "left").withColumn("cluster", F.coalesce("component", "hash"))
    cluster = member.groupBy("cluster").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high")
    named = member.select("hash", "cluster").join(cluster, "cluster")
    near = meeting.drop("low", "high").join(named, "hash").withColumn("cluster", F.lower(F.hex("cluster")))
    order = F.coalesce("id", F.lit(NO_ID))
    runs = beyond(extended(rows, spans.where("label > 0")), near.where(order != F.col("low")).select("id", "version", "start", "stop"))
    equal = equal.unionByName(runs, allowMissingColumns=True)
    out = equal.withColumn("cluster", F.lower(F.hex("label"))).unionByName(near, allowMissingColumns=True)
    return out.select("id", "version", "start", "stop", "cluster", F.nullif(F.col("low"), F.lit(NO_ID)).alias("keep_id"), (order != F.col("low")).alias("removed"))


def _without(text: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.Series:
    """Texts without the byte ranges and the blanks after them; null where there are none."""
    out = []
    for t, a, b in zip(text, starts, stops):
        if t is None or a is None:
            out.append(None)
            continue
        raw, at, kept = t.encode(), 0, []
        for s, e in sorted(zip(a, b)):
            if s > at:
                kept.append(raw[at:s])
            at = max(at, e)
            while raw[at: at + 1] == b" ":
                at += 1
        kept.append(raw[at:])
        out.append(b"".join(kept).decode())
    return pd.Series(out, dtype=object)


def remove_repeats(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, same columns, without its repeated paragraphs (see
    ``repeated_spans``); a document that is left without a word goes."""
    spans = repeated_spans(docs, threshold, id_col, text_col).where("removed")
    cuts = written(spans.groupBy("id", "version").agg(F.collect_set(F.struct("start", "stop")).alias("cuts")), "paragraph-cuts")
    rows = keyed(docs, id_col, text_col)
    same = F.col("r.id").eqNullSafe(F.col("c.id")) & (F.col("r.version") == F.col("c.version"))
    got = rows.drop("body").alias("r").join(cuts.alias("c"), same, "left")
    without = F.pandas_udf(_without, "string")
    new = without(F.when(F.col("cuts").isNotNull(), row_text(text_col)), F.col("cuts.start"), F.col("cuts.stop"))
    got = got.select("row", "cuts", new.alias("left_text")).where("cuts IS NULL OR left_text RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'")
    cols = [F.coalesce("left_text", F.col("row")[c]).alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    return got.select(*cols)
