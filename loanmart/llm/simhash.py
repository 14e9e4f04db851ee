"""SimHash near-dedup by the generalised pigeonhole principle.

The 64 bits are grouped into m partitions with thresholds t_1 .. t_m (each at
least -1) such that the sum of (t_i + 1) is max_distance + 1: two fingerprints
within max_distance then agree within t_i in at least one partition.
Correlated bits are put together, so that the partitions are as independent
as they can be, and m and the thresholds are those of least cost by dynamic
programming over the candidates estimated for each partition and threshold.

Only distinct fingerprints are compared.  Each is sent to its own key in every
partition and probes the keys within t_i flipped bits.  What meets at a key is
verified over all 64 bits inside the task, and only a spanning forest of the
verified links leaves it; keys with very many fingerprints are split into
pairs of blocks, so that no task holds more than two blocks of a key.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, components, keyed, text_blocks, written

BITS = 64
#: Fingerprints that the candidate estimates are made from (those of the smallest hashes).
SAMPLE = 4096
#: Fingerprints of a key that one block holds.
KEY_BLOCK = 4096
#: Cost of shuffling one signature, in verified candidate pairs.
SIGNATURE_COST = 50
PROBE = "part int, key long, own boolean, fp long"
_PROBE = pa.schema([("part", pa.int32()), ("key", pa.int64()), ("own", pa.bool_()), ("fp", pa.int64())])
EDGE = "a long, b long"
_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of a UTF-8 text: A-Z lower-cased, words split at ASCII
    white space, shingles with repeats; a bit is set if over half of the
    shingles' XXH64 have it.  No words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - size + 1
    one = xxhash.xxh64_intdigest
    hashes = np.fromiter((one(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[size - 1:].tolist())), dtype=np.uint64, count=n)
    total = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        total += np.unpackbits(hashes[at: at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", versions: bool = False) -> DataFrame:
    """``(id, fp)`` per row, ``fp`` as a signed 64-bit number; a null text has
    fingerprint 0.  With ``versions`` also ``version`` (see ``keyed``)."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, "text"):
            got = np.array([fingerprint(t or b"", shingle) for t in batch.column("text").cast(pa.binary()).to_pylist()], dtype=np.uint64)
            out = {"id": batch.column("id"), "fp": pa.array(got.view(np.int64))} | ({"version": batch.column("version")} if versions else {})
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    if versions:
        rows = keyed(docs, id_col, text_col).select("id", F.col("body").alias("text"), "version")
    return rows.mapInArrow(run, "id long, fp long" + (", version long" if versions else ""))


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_correlation(fps: DataFrame) -> np.ndarray:
    """|phi| of every two bits over all fingerprints; what reaches the driver is 64 x 64 counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS), dtype=np.int64)
        n = 0
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint64)
            n += len(values)
            for at in range(0, len(values), 1 << 16):
                bits = _bits(values[at: at + (1 << 16)]).astype(np.float32)
                both += (bits.T @ bits).round().astype(np.int64)
        i, j = np.meshgrid(np.arange(BITS), np.arange(BITS), indexing="ij")
        yield pa.RecordBatch.from_arrays([pa.array(np.append(i.ravel(), -1)), pa.array(np.append(j.ravel(), -1)), pa.array(np.append(both.ravel(), n))], names=["i", "j", "n"])

    rows = fps.select("fp").mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    count = {(r.i, r.j): r.n for r in rows}
    n = count.get((-1, -1), 0)
    if not n:
        return np.zeros((BITS, BITS))
    both = np.array([[count[i, j] for j in range(BITS)] for i in range(BITS)]) / n
    p = both.diagonal()
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    return np.abs(np.divide(both - np.outer(p, p), spread, out=np.zeros_like(both), where=spread > 0))


def group_bits(corr: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of nearly equal width; each is grown by the bit most correlated with it."""
    left, out = set(range(BITS)), []
    for k in range(m):
        width = (BITS - sum(map(len, out))) // (m - k)
        rest = sorted(left)
        own = [max(rest, key=lambda b: (max((corr[b, c] for c in rest if c != b), default=0), -b))]
        left.remove(own[0])
        while len(own) < width:
            own.append(max(sorted(left), key=lambda b: corr[b, own].sum()))
            left.remove(own[-1])
        out.append(sorted(own))
    return out


def part_values(values: np.ndarray, part: list[int]) -> np.ndarray:
    """The bits of a partition as a number."""
    out = np.zeros(len(values), dtype=np.uint64)
    for k, b in enumerate(part):
        out |= ((values >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def near_share(values: np.ndarray, width: int, most: int) -> list[float]:
    """Estimated share of pairs within 0, 1, .. ``most`` bits; never below that of uniform bits."""
    count = np.zeros(width + 1)
    for at in range(0, len(values), 256):
        count += np.bincount(np.bitwise_count(values[at: at + 256, None] ^ values[None, :]).ravel(), minlength=width + 1)
    count[0] -= len(values)
    share = np.cumsum(count) / max(1, len(values) * (len(values) - 1))
    ball = np.cumsum([comb(width, k) for k in range(width + 1)]) / 2.0**width
    return np.maximum(share, ball)[: most + 1].tolist()


def allocate(cost: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with sum (t_i + 1) = ``total`` and least cost;
    ``cost[i][t + 1]`` is that of partition i with threshold t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (c, chosen) in best.items():
            for s, extra in enumerate(row[: total - used + 1]):
                if used + s not in step or c + extra < step[used + s][0]:
                    step[used + s] = (c + extra, [*chosen, s - 1])
        best = step
    return best[total]


def plan(corr: np.ndarray, sample: np.ndarray, n: int, max_distance: int) -> list[tuple[list[int], int]]:
    """Partitions and thresholds of least estimated cost for n fingerprints."""
    options = []
    for m in range(1, max_distance + 2):
        parts = group_bits(corr, m)
        cost = []
        for part in parts:
            near = near_share(part_values(sample, part), len(part), max_distance)
            ball = np.cumsum([comb(len(part), k) for k in range(max_distance + 1)])
            cost.append([0.0] + [n * float(ball[t]) * SIGNATURE_COST + n * n / 2 * near[t] for t in range(max_distance + 1)])
        c, chosen = allocate(cost, max_distance + 1)
        options.append((c, [(p, t) for p, t in zip(parts, chosen) if t >= 0]))
    return min(options, key=lambda o: o[0])[1]


def linked(values: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (two index arrays) of the links among distinct values:
    what is found is taken out, so a dense group costs little more than its size."""
    left = np.arange(len(values))
    a, b = [], []
    while len(left):
        todo, left = [left[:1]], left[1:]
        while todo and len(left):
            front = todo.pop()
            near = np.bitwise_count(values[front][:, None] ^ values[left][None, :]) <= max_distance
            hit = near.any(axis=0)
            if hit.any():
                found = left[hit]
                a.append(front[near[:, hit].argmax(axis=0)])
                b.append(found)
                left = left[~hit]
                todo += [found[k: k + 64] for k in range(0, len(found), 64)]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def verify_runs(batches: Iterator[pa.RecordBatch], max_distance: int) -> Iterator[pa.RecordBatch]:
    """Links among the rows of a key, in a partition sorted by key: columns
    k1, k2 (the key), own, fp.  A key without an own row is only probed."""
    held: list[tuple[np.ndarray, ...]] = []

    def edges(k1: np.ndarray, k2: np.ndarray, own: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        fp = fp.view(np.uint64)
        new = np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(fp)))
        some = np.logical_or.reduceat(own, start) & (size > 1)
        run = np.cumsum(new) - 1
        small = some & (size <= 8)
        a, b = [], []
        for d in range(1, 8):
            near = (run[d:] == run[:-d]) & small[run[d:]]
            i = np.flatnonzero(near)
            i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= max_distance]
            a.append(fp[i])
            b.append(fp[i + d])
        for k in np.flatnonzero(some & (size > 8)).tolist():
            values = np.unique(fp[start[k]: start[k] + size[k]])
            x, y = linked(values, max_distance)
            a.append(values[x])
            b.append(values[y])
        x, y = np.concatenate(a), np.concatenate(b)
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], schema=_EDGE)

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2", "own", "fp"))
        k1, k2 = cols[0], cols[1]
        last = int(np.flatnonzero((k1 != k1[-1]) | (k2 != k2[-1]))[-1]) + 1 if (k1[0], k2[0]) != (k1[-1], k2[-1]) else 0
        same = held and (held[0][0][0], held[0][1][0]) == (k1[0], k2[0])
        if held and (last or not same):
            yield edges(*(np.concatenate(c) for c in zip(*held, *([tuple(c[:last] for c in cols)] if last else []))))
            held = []
        elif last:
            yield edges(*(c[:last] for c in cols))
        held.append(tuple(c[last:] for c in cols))
    if held:
        yield edges(*(np.concatenate(c) for c in zip(*held)))


def links(fps: DataFrame, max_distance: int = 3) -> DataFrame:
    """Edges ``(a, b)`` over distinct fingerprints ``(fp)``: a forest whose
    components are those of all pairs within ``max_distance`` bits."""
    n = fps.count()
    sample = fps.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toPandas()["fp"].to_numpy(dtype=np.int64).view(np.uint64)
    chosen = plan(bit_correlation(fps), sample, n, max_distance)

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy()
            for k, (part, t) in enumerate(chosen):
                key = part_values(values.view(np.uint64), part)
                for flips in range(t + 1):
                    for bits in combinations(range(len(part)), flips):
                        other = key ^ np.uint64(sum(1 << b for b in bits))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), k, np.int32)), pa.array(other.view(np.int64)),
                                                          pa.array(np.full(len(key), not flips)), pa.array(values)], schema=_PROBE)

    rows = fps.select("fp").mapInArrow(probes, PROBE)
    # keys with more than a block of fingerprints are dealt to pairs of blocks
    heavy = rows.groupBy("part", "key").agg(F.count("*").alias("n")).where(F.col("n") > KEY_BLOCK)
    heavy = heavy.select("part", "key", F.ceil(F.col("n") / KEY_BLOCK).cast("int").alias("blocks"))
    rows = rows.join(heavy, ["part", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    rows = rows.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = F.least("block", "other").cast("long") * (1 << 31) + F.greatest("block", "other")
    rows = rows.select((F.col("key")).alias("k1"), (pair * 8 + F.col("part")).alias("k2"), "own", "fp")
    rows = rows.repartition("k1", "k2").sortWithinPartitions("k1", "k2")
    return rows.mapInArrow(lambda it: verify_runs(it, max_distance), EDGE)


def group_names(hashed: DataFrame, max_distance: int) -> DataFrame:
    """``(fp, component, component_id)`` of the fingerprints of ``hashed``."""
    distinct = written(hashed.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    found = components(links(distinct, max_distance), "simhash").withColumnRenamed("id", "fp")
    grouped = distinct.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    names = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    return grouped.join(names, "component").select("fp", "component", "component_id")


def simhash_groups(docs: DataFrame, shingle: int = 3, max_distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row: the fingerprint as 16
    lower-case hex digits, and the smallest id among the documents that links
    of at most ``max_distance`` differing bits reach, the document included.

    Empty and null texts have fingerprint 0 and link like any other; texts of
    fewer words than a shingle are one shingle.  Rows that repeat an id or a
    text are rows of their own.  A null id stays null and is nobody's
    component id unless all of a group's ids are null.
    """
    hashed = written(fingerprints(docs, shingle, id_col, text_col), "simhash")
    out = hashed.join(group_names(hashed, max_distance).drop("component"), "fp")
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs``, same columns, of each group (see ``simhash_groups``):
    the one of the smallest id, of several texts with that id the one of the
    smallest fingerprint and text hash, of equal rows any one."""
    hashed = written(fingerprints(docs, shingle, id_col, text_col, versions=True), "simhash")
    found = hashed.join(group_names(hashed, max_distance).drop("component_id"), "fp")
    stay = found.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "fp", "version")).alias("s")).select("s.id", "s.version")
    times = hashed.groupBy("id", "version").agg(F.count("*").alias("n")).where("n > 1")
    same = F.col("s.id").eqNullSafe(F.col("t.id")) & (F.col("s.version") == F.col("t.version"))
    stay = written(stay.alias("s").join(times.alias("t"), same, "left").select("s.id", "s.version", "n"), "simhash-stay")

    def rows(some: DataFrame) -> DataFrame:
        own = F.col("r.id").eqNullSafe(F.col("s.id")) & (F.col("r.version") == F.col("s.version"))
        return keyed(docs, id_col, text_col).drop("body").alias("r").join(some.alias("s"), own, "left_semi")

    out = rows(stay.where("n IS NULL")).select("row")
    repeated = stay.where("n IS NOT NULL")
    if repeated.limit(1).count():
        out = out.unionByName(rows(repeated).groupBy("id", "version").agg(F.first("row").alias("row")).select("row"))
    return out.select("row.*")
