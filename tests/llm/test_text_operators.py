"""Operators on texts against brute force and the tokenizers' own libraries,
with nulls, empty and long texts, repeats, clashing columns and empty tables."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanmart.llm import line_dedup as lines_module
from loanmart.llm import simhash as sim
from loanmart.llm.exact_dedup import exact_dedup, tree_merge, digests
from loanmart.llm.line_dedup import PerfectHash, drop_common_lines, line_dedup
from loanmart.llm.packing import Bins, pack
from loanmart.llm.pieces import MODEL, decode, encode, encode_round_trip
from loanmart.llm.token_counts import TOKENIZER, token_counts

SF = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor " * 20_000 + "x" * 5_000
ODD = [
    (1, "The quick brown fox\njumps over it, it's fine.\n\n"), (2, None), (3, ""), (4, "The quick brown fox\njumps over it, it's fine.\n\n"),
    (5, " \t\n \r\n"), (6, "Straße ÉTÉ Σας 日本語  x <|endoftext|> y ▁z \U0001F600"), (7, LONG), (8, LONG), (None, "a null id"),
    (9, "one two"), (9, "one two"), (10, "ONE two"), (11, "a  b   c　d"), (None, None),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, body string, row string, version long, block long, stay long, word string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", "s", len(t or ""), 99, "b", "r", 7, 8, 9, "w") for i, t in ODD]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


# ------------------------------------------------------------- token counts
def test_token_counts_equal_the_library(spark, odd, docs):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENIZER)
    for df in (odd, docs):
        got = Counter(tuple(r) for r in token_counts(df, limit=50).collect())
        want = Counter()
        for i, x in texts(df):
            n = len(t.encode(x, add_special_tokens=False).ids)
            want[i, len(x.encode()), n, n > 50] += 1
        assert got == want
    assert token_counts(empty(spark)).count() == 0


# ------------------------------------------------------------------ packing
def packed(lengths, capacity=1024):
    """Rows of one worker's bins for documents of these lengths."""
    bins, rows = Bins(3, capacity), []
    for i, n in enumerate(lengths):
        bins.add(i, np.arange(n, dtype="<u4"))
        rows += bins.take().to_pylist()
    bins.finish()
    return rows + bins.take().to_pylist()


@pytest.mark.parametrize("lengths", [
    [1], [1024], [1023, 2], [5000], [700] * 9, [300] * 100, list(range(1, 1500, 7)), [1024, 2048, 4096],
    np.random.default_rng(2).integers(1, 1025, 3000).tolist(), np.random.default_rng(3).integers(1, 60, 3000).tolist()])
def test_bins_hold_every_id_once_without_padding(lengths):
    rows = packed(lengths)
    seen, fill = {i: [] for i in range(len(lengths))}, Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert fill[r["sequence_id"]] == r["offset"] and r["length"] > 0
        fill[r["sequence_id"]] += r["length"]
        seen[r["doc_id"]].append((r["start"], r["length"]))
        assert r["ids_crc32"] == zlib.crc32(np.arange(r["start"], r["start"] + r["length"], dtype="<u4").tobytes())
    for i, n in enumerate(lengths):
        at = 0
        for start, length in sorted(seen[i]):
            assert start == at
            at += length
        assert at == n
    short = sorted(n for n in fill.values() if n != 1024)
    assert max(fill.values()) <= 1024 and all(n & (n - 1) == 0 for n in short) and sum(short) < 1024


def test_most_documents_stay_whole():
    """Of documents that fit a sequence; a bin of class k holds k of them and a filler's cut."""
    lengths = np.random.default_rng(5).integers(1, 1025, 5000).tolist()
    rows = packed(lengths)
    whole = sum(r["length"] == r["doc_tokens"] for r in rows)
    assert whole > 0.65 * len(lengths)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for held in by_sequence.values():
        classes = {1024 // r["length"] for r in held if r["length"] == r["doc_tokens"]}
        if len(classes) == 1:
            k = classes.pop()
            assert sum(r["length"] == r["doc_tokens"] for r in held) <= k


def test_packing_round_trip(spark, odd, docs):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for df in (odd, docs.repartition(4)):
        got = pack(df).toPandas()
        pieces, tokens = Counter(), {}
        for r in got.itertuples():
            pieces[None if np.isnan(r.doc_id) else int(r.doc_id), r.doc_tokens] += r.length
            tokens.setdefault((None if np.isnan(r.doc_id) else int(r.doc_id), r.start, r.length), []).append(r.ids_crc32)
        want = Counter()
        crcs = {}
        for i, x in texts(df):
            ids = np.array([*t.encode(x, add_special_tokens=False).ids, 0], dtype="<u4")
            want[i, len(ids)] += len(ids)
            crcs.setdefault(i, []).append(ids)
        assert pieces == want
        for (i, start, length), found in tokens.items():
            may = [zlib.crc32(ids[start: start + length].tobytes()) for ids in crcs[i] if len(ids) >= start + length]
            assert set(found) <= set(may)
        for i, all_ids in crcs.items():
            if len(all_ids) == 1:  # the id names one document: its pieces tile it
                mine = sorted(k[1:] for k in tokens if k[0] == i)
                assert all(len(tokens[(i, *k)]) == 1 for k in mine)
                assert [a for a, _ in mine] == [0, *np.cumsum([n for _, n in mine])[:-1]]
        size = got.groupby("sequence_id").length.sum()
        assert size.max() <= 1024 and all(n == 1024 or n & (n - 1) == 0 for n in size)
        for _, rows in got.sort_values("offset").groupby("sequence_id"):
            assert (rows.offset == rows.length.cumsum() - rows.length).all()
    assert pack(empty(spark)).count() == 0


# -------------------------------------------------------------- exact dedup
@pytest.mark.parametrize("largest", [True, False])
def test_exact_dedup_equals_brute_force(spark, odd, largest):
    groups = defaultdict(list)
    for i, x in texts(odd):
        groups[x].append(i)
    want = Counter()
    for x, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = (max(known) if largest else min(known)) if known else None
        for i in ids:
            want[i, keep, len(ids), i == keep, hashlib.sha256(x.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in exact_dedup(odd, largest=largest).collect()) == want
    assert exact_dedup(empty(spark)).count() == 0


def test_digest_collisions_are_verified(spark, odd):
    same = digests(odd).withColumn("digest", F.lit(5).cast("long"))
    assert tree_merge(same).count() == len({x for _, x in texts(odd)})


# --------------------------------------------------------------- line dedup
def brute_lines(rows, min_docs, min_points):
    ascii_white = " \t\n\x0b\x0c\r"
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(ascii_white))
    have = defaultdict(list)
    for i, x in rows:
        for k in {key(s) for s in x.split("\n")}:
            if len(k) >= min_points:
                have[k].append(-1 if i is None else i)
    last = {k: max(v) for k, v in have.items() if len(v) >= min_docs}
    out = Counter()
    for i, x in rows:
        split = x.split("\n")
        kept = [s for s in split if last.get(key(s), -1 if i is None else i) == (-1 if i is None else i)]
        out[i, len(split), len(split) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()] += 1
    return out


def test_line_dedup_equals_brute_force(spark, odd, docs, monkeypatch):
    made = [(i, "\n".join(["  Shared Line number %d of many\t" % (i % 5), "own line %d, long enough to count" % i, "SHARED line Number %d of many" % (i % 5), "é" * 12 + str(i % 2), "short"]), *[None] * 10)
            for i in range(60)]
    made += [(None, made[0][1], *[None] * 10), made[3], made[59]]
    frame = spark.createDataFrame(made, SCHEMA).repartition(5)
    monkeypatch.setattr(lines_module, "SHARD_LINES", 16)
    for df, points in ((frame, 10), (odd, 2), (docs, 20)):
        got = line_dedup(df, 3, points).select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256)).collect()
        assert Counter(tuple(r) for r in got) == brute_lines(texts(df), 3, points)
    assert line_dedup(empty(spark)).count() == 0
    assert drop_common_lines(odd, 3, 2).columns == odd.columns


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(1).integers(0, 2**63, (5000, 2), dtype=np.uint64)
    mph = PerfectHash.build(keys[:, 0], keys[:, 1])
    assert sorted(mph.lookup(keys[:, 0], keys[:, 1])) == list(range(5000))


# ------------------------------------------------------------------ simhash
def clusters(n, near):
    parent = list(range(n))
    def find(a):
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        return a
    for a, b in near:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]


def brute_groups(values, most=3):
    near = np.argwhere(np.bitwise_count(values[:, None] ^ values[None, :]) <= most)
    return clusters(len(values), near.tolist())


def same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def test_fingerprint_by_the_letter():
    import xxhash
    def plain(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
        grams = [" ".join(words[i: i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0
    for t in ["", " \n", "One", "one TWO", "a b c", "É b c d é f g", "x " * 70 + "  y\x1cz", "A b\tc\x0bd " * 40]:
        assert sim.fingerprint(t.encode()) == plain(t)


@pytest.mark.parametrize("block", [4096, 8])
def test_simhash_links_lose_nothing(spark, monkeypatch, block):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    values = [base]
    for _ in range(12):  # chains of small steps, and dense groups
        flip = np.zeros(len(base), dtype=np.uint64)
        for _ in range(3):
            flip |= np.uint64(1) << rng.integers(0, 64, len(base), dtype=np.uint64)
        base = base ^ flip
        values += [base, values[0] ^ flip]
    values = np.unique(np.concatenate(values))
    monkeypatch.setattr(sim, "KEY_BLOCK", block)
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    place = {int(v): i for i, v in enumerate(values.view(np.int64))}
    edges = [(place[r.a], place[r.b]) for r in sim.links(df).collect()]
    assert all(bin(int(values[a] ^ values[b])).count("1") <= 3 for a, b in edges)
    assert same_partition(clusters(len(values), edges), brute_groups(values))


@pytest.mark.parametrize("m", [1, 2, 3, 4])
def test_every_allocation_is_a_pigeonhole(m):
    parts = sim.group_bits(np.zeros((64, 64)), m)
    assert sorted(b for p in parts for b in p) == list(range(64))
    cost, chosen = sim.allocate([[0.0, *np.random.default_rng(m).random(4)] for _ in parts], 4)
    assert sum(t + 1 for t in chosen) == 4 and min(chosen) >= -1


def test_simhash_groups(spark, odd, docs):
    for df in (odd, docs):
        rows = texts(df)
        fps = np.array([sim.fingerprint(x.encode()) for _, x in rows], dtype=np.uint64)
        group = brute_groups(fps)
        least = defaultdict(lambda: None)
        for (i, _), g in zip(rows, group):
            if i is not None:
                least[g] = i if least[g] is None else min(least[g], i)
        want = Counter((i, f"{int(f):016x}", least[g]) for (i, _), f, g in zip(rows, fps, group))
        assert Counter(tuple(r) for r in sim.simhash_groups(df).collect()) == want
    assert sim.simhash_groups(empty(spark)).count() == 0
    kept = sim.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and kept.count() > 0


# ------------------------------------------------------------ sentencepiece
def test_pieces_equal_the_library(spark, odd, docs):
    import sentencepiece
    s = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    more = spark.createDataFrame([(i, t) for i, t in enumerate(["ab" * 1500, " " * 300, "the" * 400, "\n\n  x", "<s>a</s><0x41>", "▁▁ ▁a", "in" * 129])], "doc_id long, text string")
    for df in (odd, docs, more):
        got = sorted((str(r.doc_id), list(r.ids)) for r in encode(df).collect())
        assert got == sorted((str(i), s.encode(x)) for i, x in texts(df))
        back = sorted((str(r.doc_id), r.text) for r in decode(encode(df)).collect())
        assert back == sorted((str(i), s.decode(s.encode(x))) for i, x in texts(df))
    rows = encode_round_trip(docs).collect()
    assert all(r.round_trip for r in rows) and len(rows) == docs.count()
    assert encode_round_trip(empty(spark)).count() == 0


# ------------------------------------------------------------- long words
@pytest.mark.parametrize("long,around", [(24, 6), (40, 3), (64, 16)])
def test_cuts_of_long_words_change_no_id(monkeypatch, long, around):
    import pyarrow as pa
    import sentencepiece
    from loanmart.llm import pieces
    monkeypatch.setattr(pieces, "LONG_WORD", long)
    monkeypatch.setattr(pieces, "AROUND", around)
    monkeypatch.setattr(pieces, "INDEXED", 5_000)
    model, rng = sentencepiece.SentencePieceProcessor(model_file=MODEL), np.random.default_rng(long)
    alphabets = ["ab", "abc", "etaoinshr", "the", "xX1", "0123456789", "aé日\U0001F600", "lorem ipsumdolor", "-=_", "ing", "x"]
    texts = ["".join(rng.choice(list(alphabets[i % len(alphabets)]), rng.integers(1, 600))) for i in range(220)]
    ids, counts = pieces.encode_block(pa.array(texts), MODEL)
    for text, own in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert own.tolist() == model.encode(text)


@pytest.mark.parametrize("size,made", [(2_000_000, "''.join(chr(97 + i) for i in rng.integers(0, 26, n))"), (10_000_000, "''.join(rng.choice(['the', 'lorem', 'tion', 'Data', 'x'], n // 3))")])
def test_a_text_without_blanks_needs_bounded_memory(size, made):
    """Up to 10 MB in one word: at most 700 MB above the start."""
    import subprocess
    import sys
    script = f"""
import resource
import numpy as np, pyarrow as pa
from loanmart.llm.pieces import MODEL, decode_block, encode_block, pieces
rng, n = np.random.default_rng(1), {size}
text = {made}
pieces(MODEL)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
ids, counts = encode_block(pa.array([text]), MODEL)
grown = (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024
assert decode_block(ids, counts, MODEL)[0].decode() == text
assert grown < 700, grown
"""
    subprocess.run([sys.executable, "-c", script], check=True, timeout=600)
