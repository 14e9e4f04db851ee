"""Line dedup with a sharded minimal perfect hash.

Documents are read in blocks; a block's distinct line keys give a 128-bit
hash, the number of its documents and the largest id among them.  Summed over
blocks, the distinct hashes are dealt to shards of bounded size.  A shard is a
minimal perfect hash (levels of bit arrays; a key's number is the rank of its
first uncontested bit) that indexes two compact arrays, a 32-bit fingerprint
and a one-byte count, and the id that keeps the line for the counts that
reach the limit.

Documents probe the arrays: a block sends the hashes of its distinct lines to
the shards and gets back those over the limit.  No line text is shuffled, and
a line that stands in every document is one probe per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, keyed, row_text, text_blocks, written

#: Line hashes of one shard, on average.
SHARD_LINES = 1 << 18
#: The id of a line whose documents all have null ids.
_NO_ID = -(2**63)
LINE = "block long, id long, version long, h1 long, h2 long, docs long, last long, lines binary"
_LINE = pa.schema([("block", pa.int64()), ("id", pa.int64()), ("version", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("docs", pa.int64()),
                   ("last", pa.int64()), ("lines", pa.binary())])
INDEX = "shard int, sizes array<long>, bits array<binary>, prints binary, counts binary, last binary"
_INDEX = pa.schema([("shard", pa.int32()), ("sizes", pa.list_(pa.int64())), ("bits", pa.list_(pa.binary())), ("prints", pa.binary()),
                    ("counts", pa.binary()), ("last", pa.binary())])
HIT = "block long, h1 long, h2 long, last long"
_HIT = pa.schema([(c, pa.int64()) for c in ("block", "h1", "h2", "last")])
DROP = "id long, version long, drops binary"
_DROP = pa.schema([("id", pa.int64()), ("version", pa.int64()), ("drops", pa.binary())])


def line_key(line: bytes) -> bytes:
    """A line (UTF-8) without white space [\\x20\\x09-\\x0D] at its ends, A-Z lower-cased."""
    return line.strip().lower()


def long_enough(key: bytes, least: int) -> bool:
    """At least ``least`` code points."""
    return len(key) >= least and (len(key) >= 4 * least or key.isascii() or len(key.decode()) >= least)


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys: bit arrays of twice the
    remaining keys, level by level."""

    def __init__(self, sizes: list[int], bits: list[bytes]):
        self.sizes = sizes
        self.bits = [np.unpackbits(np.frombuffer(b, dtype=np.uint8))[:n] for n, b in zip(sizes, bits)]
        self.rank, base = [], 0
        for b in self.bits:
            total = np.cumsum(b, dtype=np.int64)
            self.rank.append(base + total - 1)
            base += int(total[-1]) if len(total) else 0

    @staticmethod
    def place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
        x = h1 + h2 * np.uint64(2 * level + 1) + np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> "PerfectHash":
        sizes, bits, level = [], [], 0
        while len(h1):
            if level > 200:
                raise ValueError("the keys are not distinct")
            size = max(8, 2 * len(h1))
            at = cls.place(h1, h2, level, size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(np.packbits(alone).tobytes())
            left = ~alone[at]
            h1, h2, level = h1[left], h2[left], level + 1
        return cls(sizes, bits)

    def lookup(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The numbers of keys; -1 or any number for a key that is not in it."""
        out = np.full(len(h1), -1, dtype=np.int64)
        left = np.arange(len(h1))
        for level, size in enumerate(self.sizes):
            at = self.place(h1[left], h2[left], level, size)
            hit = self.bits[level][at] == 1
            out[left[hit]] = self.rank[level][at[hit]]
            left = left[~hit]
        return out


def _prints(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return ((h1 * np.uint64(0x9E3779B97F4A7C15) ^ h2) >> np.uint64(32)).astype("<u4")


def _u64(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64) if isinstance(column, pa.Array) else column.to_numpy().view(np.uint64)


def block_lines(rows: DataFrame, least: int) -> DataFrame:
    """Per block: a row for each distinct line hash, and one for each text with its hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, batch in enumerate(text_blocks(batches, "body")):
            name = (TaskContext.get().partitionId() << 32) + k
            seen: dict[bytes, list[int]] = {}
            texts = []
            for doc, version, text in zip(batch.column("id").to_pylist(), batch.column("version").to_pylist(), batch.column("body").cast(pa.binary()).to_pylist()):
                own = {xxhash.xxh3_128_digest(key) for line in text.split(b"\n") if long_enough(key := line_key(line), least)}
                order = _NO_ID if doc is None else doc
                for h in own:
                    got = seen.setdefault(h, [0, order])
                    got[0] += 1
                    got[1] = max(got[1], order)
                if own:
                    texts.append((doc, version, b"".join(own)))
            words = np.frombuffer(b"".join(seen), dtype="<i8").reshape(-1, 2)
            n, m = len(words), len(texts)
            ids, versions, lines = zip(*texts) if texts else ((), (), ())
            none = lambda count, t: pa.nulls(count, t)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, name)), none(n, pa.int64()), none(n, pa.int64()), pa.array(words[:, 0].copy()), pa.array(words[:, 1].copy()),
                                              pa.array([v[0] for v in seen.values()], pa.int64()), pa.array([v[1] for v in seen.values()], pa.int64()), none(n, pa.binary())], schema=_LINE)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, name)), pa.array(ids, pa.int64()), pa.array(versions, pa.int64()),
                                              *(none(m, pa.int64()) for _ in range(4)), pa.array(lines, pa.binary())], schema=_LINE)

    return rows.select("id", "version", "body").mapInArrow(run, LINE)


def build_index(lines: DataFrame, shards: int, min_docs: int) -> DataFrame:
    """The sharded index (see INDEX) of rows ``(h1, h2, docs, last)``."""

    def build(table: pa.Table) -> pa.Table:
        h1, h2 = _u64(table["h1"]), _u64(table["h2"])
        n, last = table["docs"].to_numpy(), table["last"].to_numpy()
        mph = PerfectHash.build(h1, h2)
        order = np.argsort(mph.lookup(h1, h2))
        n, last = n[order], last[order]
        row = [table["shard"][0].as_py(), mph.sizes, [np.packbits(b).tobytes() for b in mph.bits], _prints(h1, h2)[order].tobytes(),
               np.minimum(n, 255).astype(np.uint8).tobytes(), last[n >= min_docs].astype("<i8").tobytes()]
        return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(row, _INDEX.types)], schema=_INDEX)

    if not 1 <= min_docs <= 255:
        raise ValueError("counts are one byte: min_docs must be 1 to 255")
    stats = lines.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))
    return stats.withColumn("shard", F.pmod(F.col("h1"), F.lit(shards)).cast("int")).groupBy("shard").applyInArrow(build, INDEX)


def probe(lines: DataFrame, index: DataFrame, shards: int, min_docs: int) -> DataFrame:
    """``(block, h1, h2, last)`` of the probes ``(block, h1, h2)`` whose count reaches ``min_docs``."""

    def look(probes: pa.Table, own: pa.Table) -> pa.Table:
        if not probes.num_rows or not own.num_rows:
            return _HIT.empty_table()
        row = own.to_pylist()[0]
        prints, counts = np.frombuffer(row["prints"], dtype="<u4"), np.frombuffer(row["counts"], dtype=np.uint8)
        place = np.cumsum(counts >= min_docs) - 1
        h1, h2 = _u64(probes["h1"]), _u64(probes["h2"])
        at = PerfectHash(row["sizes"], row["bits"]).lookup(h1, h2)
        hit = np.flatnonzero((at >= 0) & (prints[at] == _prints(h1, h2)) & (counts[at] >= min_docs))
        last = np.frombuffer(row["last"], dtype="<i8")[place[at[hit]]]
        got = probes.select(["block", "h1", "h2"]).take(pa.array(hit))
        return pa.Table.from_arrays([*(c.combine_chunks() for c in got.columns), pa.array(last.copy())], schema=_HIT)

    dealt = lines.select("block", "h1", "h2", F.pmod(F.col("h1"), F.lit(shards)).cast("int").alias("shard"))
    return dealt.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(look, HIT)


def dropped_lines(texts: DataFrame, hits: DataFrame) -> DataFrame:
    """``(id, version, drops)``: the line hashes that each text loses."""

    def match(table: pa.Table, hits: pa.Table) -> pa.Table:
        hashes = np.stack([hits["h1"].to_numpy(), hits["h2"].to_numpy()], axis=1).astype("<i8")
        keeper = dict(zip((h.tobytes() for h in hashes), hits["last"].to_pylist()))
        out = []
        for doc, version, lines in zip(*(table[c].to_pylist() for c in ("id", "version", "lines"))):
            own = [h for i in range(0, len(lines), 16) if (last := keeper.get(h := lines[i: i + 16])) is not None and last != (_NO_ID if doc is None else doc)]
            if own:
                out.append((doc, version, b"".join(own)))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [(), (), ()], _DROP.types)], schema=_DROP)

    found = texts.select("block", "id", "version", "lines").groupBy("block").cogroup(hits.groupBy("block")).applyInArrow(match, DROP)
    return found.groupBy("id", "version").agg(F.first("drops").alias("drops"))


def _without(text: pd.Series, drops: pd.Series) -> pd.DataFrame:
    """Texts without the lines whose hashes are in ``drops``; null where there are none."""
    kept, dropped = [], []
    for t, d in zip(text, drops):
        if d is None:
            kept.append(None)
            dropped.append(0)
            continue
        gone = {d[i: i + 16] for i in range(0, len(d), 16)}
        lines = t.encode().split(b"\n")
        stay = [x for x in lines if xxhash.xxh3_128_digest(line_key(x)) not in gone]
        kept.append(b"\n".join(stay).decode())
        dropped.append(len(lines) - len(stay))
    return pd.DataFrame({"kept": kept, "dropped": dropped})


def line_dedup(docs: DataFrame, min_docs: int = 3, min_points: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` as ``row`` (a struct of all its columns) with
    ``kept_text``, ``n_lines`` (before) and ``n_dropped``.

    Texts are cut at \\n (a null or empty text is one empty line).  A line's
    key is the line without white space [\\x20\\x09-\\x0D] at both ends, A-Z
    lower-cased.  Keys of at least ``min_points`` code points that stand in at
    least ``min_docs`` rows are dropped everywhere but in the rows of the
    largest id that has them; a repeated line in that document stays
    repeated.  Rows are documents: repeats of an id or a text count each.  A
    null id is smaller than any other.
    """
    bound_batches(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    table = written(block_lines(rows, min_points), "line-blocks")
    lines, texts = table.where("h1 IS NOT NULL"), table.where("lines IS NOT NULL")
    shards = lines.count() // SHARD_LINES + 1
    index = written(build_index(lines, shards, min_docs), "line-index")
    hits = probe(lines, index, shards, min_docs)
    drops = written(dropped_lines(texts, hits), "line-drops")
    without = F.pandas_udf(_without, "kept string, dropped long")
    joined = rows.drop("body").alias("k").join(drops.alias("d"), F.col("k.id").eqNullSafe(F.col("d.id")) & (F.col("k.version") == F.col("d.version")), "left")
    body = row_text(text_col)
    got = joined.select("row", without(F.when(F.col("drops").isNotNull(), body), F.col("drops")).alias("got"))
    n_lines = (F.octet_length(body) - F.octet_length(F.replace(body, F.lit("\n"), F.lit(""))) + 1).cast("long")
    return got.select("row", F.coalesce(F.col("got.kept"), body).alias("kept_text"), n_lines.alias("n_lines"), F.col("got.dropped").alias("n_dropped"))


def drop_common_lines(docs: DataFrame, min_docs: int = 3, min_points: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, same rows and columns, its texts without the lines that
    ``line_dedup`` drops; a text that loses nothing stays as it is."""
    got = line_dedup(docs, min_docs, min_points, id_col, text_col)
    text = F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("row")[text_col])
    return got.select(*(text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))
