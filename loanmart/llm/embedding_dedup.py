"""Embedding near-dedup with a robust-pruned flat graph.

1. Equal vectors are one node that carries their number and smallest id.
2. Centroids, fitted on a bounded sample of the nodes, give overlapping
   shards: a node belongs to its ``OVERLAP`` nearest centroids, the nearest is
   its home.  Shards beyond ``BLOCK`` nodes are dealt to pairs of blocks, so a
   task holds two blocks at most and no two nodes of a shard are kept apart.
3. Every shard (or pair of blocks) builds a flat graph: a node's nearest
   neighbours there, robust-pruned, and the lists of all shards are united.
4. Every node searches its home shard, together with the close neighbours that
   the united lists name outside of it, over these lists, their reverse and a few
   random long links: greedy from medoids, then expanding over all nodes that
   are nearly in range until none is left.
   Nodes whose nearest POOL of a shard are all in range are crowded: lists
   cannot name all their links.  They and all that links of the lists reach
   from them do not search; they are compared with each other exactly, with
   every block that can hold a neighbour (a bound from the centroids).
5. What is found is verified by the cosine in double precision.  A task
   returns each node's number of links and a spanning forest of them, never
   the pairs.
6. Recall is audited: the links of some nodes, a bounded number, are held
   against those by comparison with all nodes.  Below ``RECALL`` the search is
   done again with twice the overlap and beam, and in the end it raises.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, components, written

#: Nodes that the centroids are fitted on, nodes per centroid, and the most centroids.
SAMPLE, SHARD, MOST_CENTROIDS, ROUNDS = 32768, 1024, 4096, 8
OVERLAP = 3
#: Nodes of one block of a shard.
BLOCK = 4096
#: Degree, candidates before pruning, pruning slack, width of the search, medoids to start from, random long links.
DEGREE, POOL, ALPHA, BEAM, MEDOIDS, FAR = 32, 48, 1.2, 32, 8, 12
#: Crowded nodes per centroid of theirs, and nodes of one block of them.
CROWD, CROWD_BLOCK = 64, 8192
#: Links that one step of the expansion looks at.
EXPANDED = 1 << 20
#: Nodes this much below the threshold are still expanded.
SLACK = 0.05
#: Least recall, audited nodes of all and of those with links, and by what overlap and beam grow.
RECALL, AUDITED, WIDER = 0.9, 128, (1, 2, 4)
MEMBER = "shard int, home boolean, node long, vector binary, copies long"
_MEMBER = pa.schema([("shard", pa.int32()), ("home", pa.bool_()), ("node", pa.int64()), ("vector", pa.binary()), ("copies", pa.int64())])
LIST = "node long, near array<long>, close array<long>, linked array<long>, crowded boolean"
_LIST = pa.schema([("node", pa.int64()), *((c, pa.list_(pa.int64())) for c in ("near", "close", "linked")), ("crowded", pa.bool_())])
FOUND = "node long, links long, other long"
_FOUND = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])
UNIT = "low int, high int, own int, node long, vector binary, copies long"
_UNIT = pa.schema([("low", pa.int32()), ("high", pa.int32()), ("own", pa.int32()), ("node", pa.int64()), ("vector", pa.binary()), ("copies", pa.int64())])


def _values(column) -> Column:
    """Components as doubles; a negative zero equals a zero."""
    return F.transform(column, lambda x: x.cast("double") + F.lit(0.0))


def unit_nodes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(node, least, v, vector, copies)``: distinct valid vectors ``v`` under a
    number of their own, with their smallest id, and as double unit vectors in
    binary.  The numbers hold for one evaluation: write the frame before use."""
    v = _values(F.col(vector_col))
    bad = v.isNull() | F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.when(~F.coalesce(bad, F.lit(True)), v).alias("v"))
    rows = rows.where("v IS NOT NULL AND id IS NOT NULL").where(F.exists("v", lambda x: x != 0))

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = TaskContext.get().partitionId() << 40
        for batch in batches:
            out = []
            for v in batch.column("v").to_pylist():
                x = np.array(v, dtype=np.float64)
                x = x / np.abs(x).max()
                out.append((x / np.sqrt(x @ x)).tobytes())
            names = pa.array(np.arange(name, name + batch.num_rows), pa.int64())
            name += batch.num_rows
            yield pa.RecordBatch.from_arrays([names, batch.column("least"), batch.column("v"), pa.array(out, pa.binary()), batch.column("copies")], names=["node", "least", "v", "vector", "copies"])

    groups = rows.groupBy("v").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    return groups.select("least", "v", "copies").mapInArrow(unit, "node long, least long, v array<double>, vector binary, copies long")


def matrix(column) -> np.ndarray:
    raw = column.to_pylist()
    width = max(map(len, raw), default=0)
    if any(len(r) != width for r in raw):
        raise ValueError("vectors of different lengths")
    return np.frombuffer(b"".join(raw), dtype=np.float64).reshape(len(raw), width // 8)


def centroids(nodes: DataFrame, n: int, size: int | None = None) -> np.ndarray:
    """Spherical k-means over a bounded sample (the smallest hashes of the vectors), one centroid per ``size`` nodes."""
    sample = matrix(nodes.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE).toArrow()["vector"])
    k = min(MOST_CENTROIDS, -(-n // (size or SHARD)), len(sample))
    centre = sample[:k].copy()
    for _ in range(ROUNDS):
        best = np.concatenate([(sample[a: a + 1024] @ centre.T).argmax(axis=1) for a in range(0, len(sample), 1024)])
        total = np.zeros_like(centre)
        np.add.at(total, best, sample)
        size = np.sqrt((total * total).sum(axis=1, keepdims=True))
        centre = np.where(size > 0, total / np.where(size > 0, size, 1), centre)
    return centre


def shards(nodes: DataFrame, centre: np.ndarray, overlap: int = OVERLAP) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                near = np.argsort(-(matrix(part.column("vector")) @ centre.T), axis=1, kind="stable")[:, :overlap]
                for j in range(near.shape[1]):
                    yield pa.RecordBatch.from_arrays([pa.array(near[:, j], pa.int32()), pa.array(np.full(len(near), j == 0)), part.column("node").cast(pa.int64()), part.column("vector").cast(pa.binary()), part.column("copies").cast(pa.int64())], schema=_MEMBER)

    return nodes.select("node", "vector", "copies").mapInArrow(run, MEMBER)


def dealt(members: DataFrame) -> DataFrame:
    """Members with ``own`` block and the pairs of blocks ``low, high`` they take part in."""
    big = members.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    big = big.select("shard", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    rows = members.join(big, "shard", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("shard", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "home", "node", "vector", "copies")


def pruned_graph(x: np.ndarray) -> np.ndarray:
    """Neighbours (-1: none) of every vector.  Of its POOL nearest the nearest
    is taken, then the nearest of those that no taken one is ALPHA times
    nearer to, and so on."""
    return graph_and_links(x, np.inf)[0]


def graph_and_links(x: np.ndarray, threshold: float) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """The pruned graph; of every vector those of its POOL nearest with a cosine
    of at least ``threshold``, and whether there may be more of them."""
    n = len(x)
    pool = min(POOL, n - 1)
    linked, crowded = [np.zeros(0, np.int64)] * (n if pool <= 0 else 0), np.zeros(n, dtype=bool)
    out = np.full((n, DEGREE), -1, dtype=np.int64)
    for a in range(0, n if pool > 0 else 0, 512):
        rows = np.arange(a, min(a + 512, n))
        sim = x[rows] @ x.T
        sim[np.arange(len(rows)), rows] = -np.inf
        near = np.argpartition(-sim, pool - 1, axis=1)[:, :pool]
        near = np.take_along_axis(near, np.argsort(-np.take_along_axis(sim, near, axis=1), axis=1, kind="stable"), axis=1)
        cosine = np.take_along_axis(sim, near, axis=1)
        fits = cosine >= threshold
        linked += [a[b] for a, b in zip(near, fits)]
        crowded[rows] = fits.all(axis=1) & (n - 1 > pool)
        own = np.sqrt(np.maximum(2 - 2 * cosine, 0))
        among = np.sqrt(np.maximum(2 - 2 * np.einsum("ikd,ild->ikl", x[near], x[near], optimize=True), 0))
        alive = near != rows[:, None]
        at = np.arange(len(rows))
        for j in range(DEGREE):
            pick = alive.argmax(axis=1)
            some = alive[at, pick]
            if not some.any():
                break
            out[rows[some], j] = near[at, pick][some]
            keep = alive & (ALPHA * among[at, pick] > own)
            alive = np.where(some[:, None], keep & (near != near[at, pick][:, None]), alive)
    return out, linked, crowded


def build(members: DataFrame, least: float, threshold: float) -> DataFrame:
    """United adjacency lists (see LIST) of the graphs of all shards;
    ``close`` are the neighbours with a cosine of at least ``least``,
    ``linked`` all nodes of the shards with one of at least ``threshold``,
    unless the node is ``crowded``."""

    def run(table: pa.Table) -> pa.Table:
        node, x = table["node"].to_numpy(), matrix(table["vector"])
        graph, linked, crowded = graph_and_links(x, threshold)
        cosine = np.concatenate([np.einsum("ikd,id->ik", x[graph[a: a + 512]], x[a: a + 512]) for a in range(0, len(x), 512)])
        near = [node[row[row >= 0]].tolist() for row in graph]
        close = [node[row[(row >= 0) & (c >= least)]].tolist() for row, c in zip(graph, cosine)]
        lists = [pa.array(c, pa.list_(pa.int64())) for c in (near, close, [node[i].tolist() for i in linked])]
        return pa.Table.from_arrays([pa.array(node, pa.int64()), *lists, pa.array(crowded)], schema=_LIST)

    lists = members.groupBy("shard", "low", "high").applyInArrow(run, LIST)
    return lists.groupBy("node").agg(*[F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("near", "close", "linked")], F.max("crowded").alias("crowded"))


def crowd(lists: DataFrame) -> DataFrame | None:
    """``(node)``: crowded nodes and all that links of the lists reach from them; None if there are none."""
    hot = written(lists.where("crowded").select("node"), "vector-crowd")
    if not hot.count():
        return None
    pairs = lists.select(F.col("node").alias("a"), F.explode("linked").alias("b"))
    reached = components(pairs, "vector-reach")
    whole = reached.join(hot, F.col("id") == F.col("node"), "left_semi").select("component").distinct()
    near = reached.join(whole, "component", "left_semi").select(F.col("id").alias("node"))
    return written(hot.unionByName(near).distinct(), "vector-crowd")


def leaves(centre: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
    """The leaf of every centroid: centroids halved along the direction they
    differ most in until a leaf has at most ``most`` nodes or is one centroid."""
    leaf, todo, n = np.zeros(len(centre), dtype=np.int64), [np.arange(len(centre))], 0
    while todo:
        some = todo.pop()
        if len(some) == 1 or size[some].sum() <= most:
            leaf[some], n = n, n + 1
            continue
        c = centre[some] - centre[some].mean(axis=0)
        some = some[np.argsort(c @ np.linalg.eigh(c.T @ c)[1][:, -1], kind="stable")]
        cut = np.searchsorted(np.cumsum(size[some]), size[some].sum() / 2) + 1
        cut = min(max(cut, 1), len(some) - 1)
        todo += [some[:cut], some[cut:]]
    return leaf


def crowd_links(nodes: DataFrame, threshold: float) -> DataFrame:
    """All links (see FOUND) between ``nodes``.  A node is sent to every block
    that can hold a neighbour: with |u - v| <= d and j the centroid nearest to v,
    u is at most d * |ci - cj| nearer to its own centroid i than to j."""
    centre = centroids(nodes, nodes.count(), CROWD)
    square, reach = (centre * centre).sum(axis=1), np.sqrt(max(2 - 2 * threshold, 0))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vector"))
            at = np.concatenate([np.zeros(0, np.int64), *((x[a: a + 1024] @ centre.T).argmax(axis=1) for a in range(0, len(x), 1024))])
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32())], names=["c"])

    size = np.zeros(len(centre), dtype=np.int64)
    for c, n in nodes.select("vector").mapInArrow(nearest, "c int").groupBy("c").count().collect():
        size[c] = n
    leaf = leaves(centre, size, CROWD_BLOCK)
    order = np.argsort(leaf, kind="stable")
    edge = np.flatnonzero(np.diff(leaf[order], prepend=-1))
    blocks = np.maximum(-(-np.bincount(leaf, weights=size).astype(np.int64) // CROWD_BLOCK), 1)
    first = np.cumsum(blocks) - blocks

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                dot = matrix(part.column("vector")) @ centre.T
                home = dot.argmax(axis=1)
                apart = np.sqrt(np.maximum(square[home][:, None] + square - 2 * centre[home] @ centre.T, 0))
                near = dot[np.arange(len(home)), home][:, None] - dot <= reach * apart + 1e-7
                near = np.logical_or.reduceat(near[:, order], edge, axis=1)
                own = first[leaf[home]] + part.column("node").to_numpy() % blocks[leaf[home]]
                for b in range(len(blocks)):
                    some = np.flatnonzero(near[:, b])
                    if not len(some):
                        continue
                    rows = part.take(pa.array(some))
                    for k in range(first[b], first[b] + blocks[b]):
                        ends = [pa.array(f(own[some], k), pa.int32()) for f in (np.minimum, np.maximum)]
                        yield pa.RecordBatch.from_arrays([*ends, pa.array(own[some], pa.int32()), rows.column("node").cast(pa.int64()), rows.column("vector").cast(pa.binary()), rows.column("copies").cast(pa.int64())], schema=_UNIT)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, own, copies = (table[c].to_numpy() for c in ("node", "own", "copies"))
        x = matrix(table["vector"])
        one = table["low"][0].as_py() == table["high"][0].as_py()
        left = np.flatnonzero(own == table["low"][0].as_py())
        right = left if one else np.flatnonzero(own == table["high"][0].as_py())
        links, root, edges = np.zeros(len(node), dtype=np.int64), np.arange(len(node)), []
        weight = copies.astype(np.float64)
        for a in range(0, len(left) if len(right) else 0, 512):
            rows = left[a: a + 512]
            fits = x[rows] @ x[right].T >= threshold
            if one:
                fits[np.arange(len(rows)), np.arange(a, a + len(rows))] = False
            count = fits.astype(np.float64)
            links[rows] += (count @ weight[right]).astype(np.int64)
            if not one:
                links[right] += (weight[rows] @ count).astype(np.int64)
            for i, row in zip(rows.tolist(), fits):
                other = right[row & (root[right] != root[i])]
                if len(other):
                    joined, at = np.unique(root[other], return_index=True)
                    edges += [(i, j) for j in other[at].tolist()]
                    root[np.isin(root, joined)] = root[i]
        some = np.flatnonzero(links)
        out = [(int(node[i]), int(links[i]), None) for i in some] + [(int(node[i]), 0, int(node[j])) for i, j in edges]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [(), (), ()], _FOUND.types)], schema=_FOUND)

    return nodes.select("node", "vector", "copies").mapInArrow(deal, UNIT).groupBy("low", "high").applyInArrow(run, FOUND)


def medoids(x: np.ndarray) -> np.ndarray:
    """Of MEDOIDS slices of the shard's nodes the ones nearest to the mean of their slice."""
    parts = np.array_split(np.arange(len(x)), min(MEDOIDS, len(x)))
    return np.unique([p[(x[p] @ x[p].mean(axis=0)).argmax()] for p in parts])


def greedy(x: np.ndarray, graph: np.ndarray, query: np.ndarray, seen: np.ndarray, start: np.ndarray, least: float, width: int = BEAM) -> list[tuple[np.ndarray, ...]]:
    """Beam search for the nodes ``query`` at once, from the medoids ``start``:
    all (place in ``query``, node, cosine) met with a cosine of at least
    ``least``; marks ``seen[query, node]``."""
    q = len(query)
    beam = np.full((q, width), -1, dtype=np.int64)
    score = np.full((q, width), -np.inf)
    open_ = np.zeros((q, width), dtype=bool)
    m = len(start)
    beam[:, :m], score[:, :m], open_[:, :m] = start, x[query] @ x[start].T, True
    seen[:, start] = True
    rows = np.arange(q)
    r, c = np.nonzero(score[:, :m] >= least)
    met = [(r, beam[r, c], score[r, c])]
    while True:
        best = np.where(open_, score, -np.inf).argmax(axis=1)
        live = rows[open_[rows, best]]
        if not len(live):
            return met
        open_[live, best[live]] = False
        near = graph[beam[live, best[live]]]
        new = (near >= 0) & ~seen[live[:, None], near]
        r, c = np.nonzero(new)
        who, what = live[r], near[r, c]
        seen[who, what] = True
        value = np.full(near.shape, -np.inf)
        cosine = np.einsum("id,id->i", x[query[who]], x[what])
        value[r, c] = cosine
        met.append((who[cosine >= least], what[cosine >= least], cosine[cosine >= least]))
        ids = np.concatenate([beam[live], np.where(new, near, -1)], axis=1)
        vals = np.concatenate([score[live], value], axis=1)
        opens = np.concatenate([open_[live], new], axis=1)
        top = np.argsort(-vals, axis=1, kind="stable")[:, :width]
        beam[live], score[live] = np.take_along_axis(ids, top, axis=1), np.take_along_axis(vals, top, axis=1)
        open_[live] = np.take_along_axis(opens, top, axis=1)


def in_range(x: np.ndarray, graph: np.ndarray, query: np.ndarray, start: np.ndarray, threshold: float, width: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place in ``query``, node) with a cosine of at least ``threshold``:
    a greedy search, then expansion over all nodes nearly in range."""
    seen = np.zeros((len(query), len(x)), dtype=bool)
    who, what, value = (np.concatenate(c) for c in zip(*greedy(x, graph, query, seen, start, threshold - SLACK, width)))
    found = [(who[value >= threshold], what[value >= threshold])]
    step = max(1, EXPANDED // graph.shape[1])
    while len(who):
        front = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for a in range(0, len(who), step):
            near = graph[what[a: a + step]]
            r, c = np.nonzero(near >= 0)
            key = np.unique(who[a: a + step][r] * len(x) + near[r, c])
            i, j = key // len(x), key % len(x)
            fresh = ~seen[i, j]
            i, j = i[fresh], j[fresh]
            seen[i, j] = True
            value = np.einsum("id,id->i", x[query[i]], x[j])
            found.append((i[value >= threshold], j[value >= threshold]))
            close = value >= threshold - SLACK
            front.append((i[close], j[close]))
        who, what = (np.concatenate(c) for c in zip(*front))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def forest(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    parent = list(range(n))
    out = []
    for i, j in zip(a.tolist(), b.tolist()):
        x, y = i, j
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if x != y:
            parent[x] = y
            out.append((i, j))
    return out


def search(rows: DataFrame, threshold: float, width: int = BEAM) -> DataFrame:
    """Of every home node that is not ``hot`` ``links``, summed over its rows, and
    edges to ``other`` nodes; a hot node that is found gets its link from there."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        home, hot = (table[c].to_numpy(zero_copy_only=False) for c in ("home", "hot"))
        query = np.flatnonzero(home & ~hot)
        if not len(query):
            return _FOUND.empty_table()
        node, x = table["node"].to_numpy(), matrix(table["vector"])
        own, low, high = (table[c].to_numpy() for c in ("own", "low", "high"))
        copies = table["copies"].to_numpy()
        place = {v: i for i, v in enumerate(node.tolist())}
        lists = [[place[v] for v in near or [] if v in place] for near in table["near"].to_pylist()]
        for i, near in enumerate([list(x) for x in lists]):  # and backwards
            for j in near:
                lists[j].append(i)
        far = np.random.default_rng(len(node)).integers(0, len(node), (len(node), FAR)).tolist()
        lists = [list(dict.fromkeys(x + y)) for x, y in zip(lists, far)]
        graph = np.full((len(node), max(1, max(map(len, lists), default=1))), -1, dtype=np.int64)
        for i, near in enumerate(lists):
            graph[i, : len(near)] = near
        start = medoids(x)
        links, edges = np.zeros(len(node), dtype=np.int64), []
        for a in range(0, len(query), 128):
            some = query[a: a + 128]
            q, v = in_range(x, graph, some, start, threshold, width)
            q = some[q]
            # in a pair of two blocks only links between them count, the others are the blocks' own
            fits = (q != v) & ((low[0] == high[0]) | (own[q] != own[v]))
            q, v = q[fits], v[fits]
            np.add.at(links, q, copies[v])
            np.add.at(links, v[hot[v]], copies[q[hot[v]]])
            edges += forest(q, v, len(node))
        out = [(int(node[i]), int(links[i]), None) for i in np.flatnonzero(links)] + [(int(node[i]), 0, int(node[j])) for i, j in edges]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [(), (), ()], _FOUND.types)], schema=_FOUND)

    return rows.groupBy("shard", "low", "high").applyInArrow(run, FOUND)


def find_links(nodes: DataFrame, n: int, threshold: float, wide: int = 1) -> DataFrame:
    """Links (see FOUND) of all nodes, with ``wide`` times the overlap and beam."""
    members = written(dealt(shards(nodes, centroids(nodes, n), OVERLAP * wide)), "vector-members")
    lists = written(build(members, threshold - 2 * SLACK, threshold), "vector-lists")
    hot = crowd(lists)
    lists = lists.withColumn("hot", F.lit(False)) if hot is None else lists.join(hot.withColumn("hot", F.lit(True)), "node", "left").fillna(False, ["hot"])
    # close neighbours outside the shard join the block whose node names them
    mine = members.where("home AND low = high").join(lists.where("NOT hot AND size(close) > 0"), "node")
    outside = mine.select("shard", F.col("own"), F.explode(F.array_union("close", "linked")).alias("node")).distinct()
    outside = outside.join(members.select("shard", "node").distinct(), ["shard", "node"], "left_anti")
    outside = outside.join(nodes, "node").select("shard", F.col("own").alias("low"), F.col("own").alias("high"), "own", F.lit(False).alias("home"), "node", "vector", "copies")
    rows = members.unionByName(outside).join(lists.select("node", "near", "hot"), "node", "left")
    found = search(rows, threshold, BEAM * wide)
    if hot is not None:
        found = found.unionByName(crowd_links(written(nodes.join(hot, "node", "left_semi"), "vector-crowded"), threshold))
    return written(found, "vector-links")


def audit_recall(nodes: DataFrame, found: DataFrame, threshold: float, audited: int = AUDITED) -> float:
    """Links found over true links, of ``audited`` nodes of all and as many of
    those with links (the smallest hashes of their vectors), each compared with
    every node, in blocks."""
    linked = nodes.join(found.select("node").distinct(), "node", "left_semi")
    some = [rows.select("node", "vector", "copies").orderBy(F.xxhash64("vector"), "vector").limit(audited) for rows in (nodes, linked)]
    query = some[0].union(some[1]).distinct().toArrow()
    ids, q, copies = query["node"].to_numpy(), matrix(query["vector"]), query["copies"].to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ids), dtype=np.int64)
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                total += ((q @ matrix(part.column("vector")).T) >= threshold) @ part.column("copies").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], names=["node", "n"])

    near = nodes.select("vector", "copies").mapInArrow(run, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    own = found.groupBy("node").agg(F.sum("links").alias("links"))
    rows = {r.node: (r.n, r.links or 0) for r in near.join(own, "node", "left").collect()}  # one per audited node
    true = sum(rows[i][0] - c for i, c in zip(ids.tolist(), copies.tolist()))
    return sum(min(rows[i][0] - c, rows[i][1]) for i, c in zip(ids.tolist(), copies.tolist())) / true if true else 1.0


def near_vectors(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, n_links, component_id, kept)`` per row: the number of other
    vectors found with a cosine of at least ``threshold``, the smallest id that
    links reach, and whether that is the row's own.

    A vector that is null, zero, or holds null or non-finite components links
    with nothing.  Equal vectors link with each other; rows that repeat an id
    are vectors of their own.  A row with a null id links with nothing and has
    a null component.  Vectors of different lengths raise, and so does a search
    that finds too few of the audited links.
    """
    bound_batches(vectors.sparkSession)
    nodes = written(unit_nodes(vectors, id_col, vector_col), "vector-nodes")
    n = nodes.count()
    if not n:
        empty = vectors.select(F.col(id_col).cast("long").alias(id_col))
        return empty.select(id_col, F.lit(0).cast("long").alias("n_links"), F.col(id_col).alias("component_id"), F.col(id_col).isNotNull().alias("kept"))
    for wide in WIDER:
        found = find_links(nodes, n, threshold, wide)
        recall = audit_recall(nodes, found, threshold)
        if recall >= RECALL:
            break
    else:
        raise RuntimeError(f"only {recall:.3f} of the audited links are found")
    counts = found.where("other IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
    linked = components(found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")), "vector").withColumnRenamed("id", "node")
    smallest = linked.join(nodes.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("component_id"))
    linked = linked.join(smallest, "component").drop("component")
    named = nodes.drop("vector").join(counts, "node", "left").join(linked, "node", "left")
    named = named.select("v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
    # from a row to its node: by the vector itself
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.when(F.col(id_col).isNotNull(), _values(F.col(vector_col))).alias("v"))
    placed = rows.join(named, "v", "left")
    return placed.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                         F.coalesce("component_id", "id").alias("component_id"), F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"))
