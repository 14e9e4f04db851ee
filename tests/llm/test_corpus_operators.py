"""LM scoring, importance resampling and the filter audit against brute force,
with nulls, empty and long texts, ties, repeats, clashing columns and empty tables."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loanmart.llm import filter_audit as audit
from loanmart.llm import importance as imp
from loanmart.llm import lm_scoring as lm
from loanmart.llm.segments import text_block

SF = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor " * 20_000 + "x" * 5_000
ODD = [
    (1, "The quick brown fox\njumps over it, it's fine.\n\n", "en"), (2, None, "en"), (3, "", None), (4, "The quick brown fox\njumps over it, it's fine.\n\n", "en"),
    (5, " \t\n \r\n", ""), (6, "Straße ÉTÉ Σας 日本語  x <|endoftext|> y ▁z \U0001F600 $", "de"), (7, LONG, "de"), (8, LONG, "fr"), (None, "a null id", "en"),
    (9, "one two", "en"), (9, "one two", "en"), (10, "ONE two", None), (11, "a  b   c　d", "en"), (None, None, "en"), (12, "A" * 200 + " b" * 99, "en"),
    (13, " ".join(f"w{i}" for i in range(150)), "en"), (14, " ".join(f"w{i}" for i in range(150)), "fr"),
]
SCHEMA = "doc_id long, text string, lang string, n_chars long, id long, part string, digest string, held string, block long, shard int, weight long, rank long"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, x, len(t or ""), 99, "p", "d", "h", 1, 2, 3, 4) for i, t, x in ODD]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def low(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


# ------------------------------------------------------------------ LM scoring
def held_out(doc):
    return zlib.crc32(str("" if doc is None else doc).encode()) % 10 == 0


def base_scores(pairs):
    """Counter of (doc_id, held, tokens, known, N, rounded base score), by definition."""
    tokens = [re.findall("[^\x20\x09-\x0D]+", low(t)) + [None] for _, t in pairs]
    seen = Counter(x for (i, _), ts in zip(pairs, tokens) if not held_out(i) for x in ts)
    n, v = sum(seen.values()), len(seen)
    score = lambda ts: sum(math.log10((seen[x] + 0.1) / (n + 0.1 * (v + 1))) for x in ts)
    return Counter((i, held_out(i), len(ts), sum(seen[x] > 0 for x in ts), n, round(score(ts), 4)) for (i, _), ts in zip(pairs, tokens))


def test_lm_counts_and_base_score(spark, odd, docs):
    for df in (odd, docs, docs.select(F.lit(None).cast("long").alias("doc_id"), "text")):
        got = lm.lm_scores(df).collect()
        assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == base_scores(rows_of(df, "doc_id", "text"))
        assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert lm.lm_scores(empty(spark)).count() == 0
    alone = lm.lm_scores(spark.createDataFrame([(None, "Ab c")], "doc_id long, text string")).collect()[0]
    # nothing is learned: the tokens "ab ", "c " and the end cost one bit each
    assert (alone.n_tokens, alone.n_known, alone.train_tokens, alone.base_score, alone.n_bytes) == (3, 0, 0, 0.0, 6)
    assert alone.score == pytest.approx(-48 * math.log10(2)) and alone.bits_per_byte == pytest.approx(8)


def test_lm_learns_from_all_shards_alike(spark, docs, monkeypatch):
    """Counts come from the whole corpus whatever its blocks and shards; only
    the averaged weights may differ a little."""
    one = {r.doc_id: r for r in lm.lm_scores(docs).collect()}
    monkeypatch.setattr(lm, "SHARD_BYTES", 60_000)
    monkeypatch.setattr(lm, "BLOCK_BYTES", 50_000)
    many = {r.doc_id: r for r in lm.lm_scores(docs.repartition(5)).collect()}
    for i, r in one.items():
        assert (r.n_known, r.train_tokens) == (many[i].n_known, many[i].train_tokens)
        assert r.score == pytest.approx(many[i].score, rel=0.05, abs=1)
    total = lambda rows, held, c: sum(r[c] for r in rows.values() if r.held_out == held)
    for rows in (one, many):
        assert total(rows, True, "score") > total(rows, True, "base_score")
        assert 0.5 < total(rows, True, "score") / total(rows, False, "score") * total(rows, False, "n_bytes") / total(rows, True, "n_bytes") < 2


def one_shard(units, texts_counts):
    """A shard's stream and its node totals over units ``(word, kind, count)``."""
    words = sorted({w for w, _, _ in units})
    row = {"words": lm._packed(b"\n".join(words)), "word_of": lm._packed(np.array([words.index(w) for w, _, _ in units]), "<u4"),
           "kinds": lm._packed(np.array([k for _, k, _ in units]), "u1"), "train": lm._planes(np.array([2 * c + 1 for _, _, c in units]), "<u8")}
    s = lm.stream_of(row)
    which, edges = lm.shard_edges(s)
    seen = lm.edge_counts(s, which, len(edges))
    answers = {}
    for p, part in lm.dealt(edges, texts_counts):
        sent = pa.table({"place": [p], "shard": [0], "edges": [lm._packed_keys(edges[part])], "n": [lm._planes(seen[part], "<u8")]})
        answers[p] = answered(sent)
    return s, which, edges, lm.node_totals(edges, texts_counts, answers)


def answered(sent):
    """What ``answer_edges`` does in its tasks, without Spark."""
    class Frame:
        def groupBy(self, *_):
            return self

        def applyInArrow(self, f, _):
            return f(sent)

    return lm.answer_edges(Frame()).to_pylist()[0]


def test_lm_node_totals_equal_counting(docs):
    counts = Counter(w for _, t in rows_of(docs.limit(20), "doc_id", "text") for w in low(t).encode().split())
    units = [(w, k, n + k) for w, n in sorted(counts.items())[:400] for k in (0, 2)] + [(b"", 0, 7), (b"unseen", 1, 0)]
    s, which, edges, totals = one_shard(units, 3)
    streams = [(w + b" " if w else b"\n", k, n) for w, k, n in units]

    def context(stream, kind, at, order):
        """What a predictor looks at: the last bytes, the kind before them; or the word so far."""
        return stream[:at] if order is None else ((kind,) + tuple(stream[:at]))[-order:] if at < order else tuple(stream[at - order: at])

    for k, order in enumerate(lm.ORDERS):
        followed = defaultdict(Counter)
        for stream, kind, n in streams:
            for at, byte in enumerate(stream):
                followed[context(stream, kind, at, order)][byte] += n
        at = 0
        for stream, kind, _ in streams:
            for place, byte in enumerate(stream):
                after = followed[context(stream, kind, place, order)]
                want = [sum(n for b, n in after.items() if b >> (8 - d) == byte >> (8 - d)) for d in range(9)]
                assert totals[which[k][at]].tolist() == want
                at += 1


def test_lm_probabilities_add_up_to_one():
    """Over all bytes that may follow, the model's probabilities sum to one,
    whatever its weights and maps are."""
    rng = np.random.default_rng(3)
    seen = [(b"ab", 0, 9), (b"abc", 0, 4), (b"abd", 2, 1), (b"b", 1, 3)]
    every = [(b"ab" + bytes([b]), 0, 0) for b in range(256) if b not in b"\n cd"]
    units = seen + every
    s, which, _, totals = one_shard(units, 2)
    model = lm.Model(rng.normal(0.3, 0.2, (lm.GATES, len(lm.ORDERS))), rng.integers(0, 50, (lm.MAP, 2)).astype(float))
    third = np.flatnonzero(s.place == 2)  # the byte after "ab": of every unit that has one
    cost = np.zeros(len(s.data))
    for i in third:  # the cost of that byte alone
        alone = lm.Stream(s.data[i: i + 1], np.zeros(1, np.int32), np.zeros(1, np.int64), s.kind[:1], s.train[:1], s.held[:1], s.word_of[:1])
        cost[i] = lm.unit_bits(alone, [w[i: i + 1] for w in which], totals, model, 0, np.ones(1, dtype=bool))[0]
    p = {}
    for i in third:
        if s.kind[s.unit[i]] == 0:
            p[int(s.data[i])] = 2.0 ** -cost[i]
    missing = 1 - sum(p.values())  # line feed and "d" (seen after another kind) have no unit here
    assert 0 <= missing < 0.2 and len(p) == 254


def test_lm_expected_token_without_itself():
    rng = np.random.default_rng(5)
    context, own = rng.integers(0, 40, 600), rng.integers(0, 6, 600)
    keys, n = np.unique((context.astype(np.uint64) << np.uint64(24)) | own.astype(np.uint64), return_counts=True)
    n = n * rng.integers(0, 2, len(n))
    codes, without, went = lm.expected(keys, n)

    def code(key, counts):
        same = {k: c for k, c in counts.items() if k >> 24 == key >> 24}
        total, top = sum(same.values()), max(same.values())
        if not total:
            return 0
        best = min(k for k, c in same.items() if c == top)
        return 1 + min(int(math.log2(total)), lm.OFTEN - 1) * lm.SHARE + 10 * top // total + (lm.HIT if best == key else 0)

    counts = dict(zip(keys.tolist(), n.tolist()))
    want = np.zeros((lm.EXPECTED, 2))
    for key, got, less in zip(keys.tolist(), codes.tolist(), without.tolist()):
        assert got == code(key, counts)
        if counts[key]:
            mine = code(key, counts | {key: counts[key] - 1})
            assert less == mine
            want[mine % lm.HIT, 0 if mine >= lm.HIT else 1] += counts[key]
    assert (went == want).all()


# ------------------------------------------------------- importance resampling
def test_prefix_crc_of_any_run():
    rng = np.random.default_rng(1)
    for n in (1, 5, imp.LANE - 1, imp.LANE, imp.LANE + 1, 5 * imp.LANE + 17):
        stream = rng.integers(0, 256, n, dtype=np.uint8)
        prefix = imp.prefixes(stream)
        start = rng.integers(0, n + 1, 200)
        end = np.maximum(start, rng.integers(0, n + 1, 200))
        assert imp.crc_of(prefix, start, end).tolist() == [zlib.crc32(stream[a:b].tobytes()) for a, b in zip(start, end)]
    assert len(imp.prefixes(np.zeros(0, np.uint8))) == 1
    block = text_block(pa.array(["Ab1 b\tc!é", None, "", "A", "-"]))
    stream, start, end, words = imp.word_stream(block)
    assert [stream[a:b].tobytes().decode() for a, b in zip(start, end)] == ["ab1", "b", "c", "é", "a"] and words.tolist() == [4, 0, 0, 1, 0]


def by_definition(pairs, target, buckets, longest, percent, least, seed):
    def grams(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))
        return len(words), [" ".join(words[i: i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]

    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    found = [(i, *grams(t)) for i, t in pairs]
    s, t = Counter(bucket(g) for _, _, gs in found for g in gs), Counter(bucket(g) for x in target for g in grams(x)[1])
    n, m = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n + buckets) / ((s[b] + 1) * (m + buckets))))
    out = []
    for i, words, gs in found:
        weight = sum(gain(bucket(g)) for g in gs)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(gs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, words])
    chosen = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for place, r in enumerate(chosen[: percent * len(chosen) // 100], 1):
        r[4] = place
    return Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("longest,buckets,percent,least", [(1, 10_000, 10, 20), (3, 100_000, 50, 1), (2, 7, 100, 0)])
def test_importance_equals_definition(spark, odd, docs, longest, buckets, percent, least):
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    wanted = [r.text for r in target.collect()]
    for df in (odd, docs):
        got = Counter(rows_of(imp.importance_resample(df, target, buckets, longest, percent, least), "doc_id", "n_features", "weight", "score", "rank"))
        assert got == by_definition(rows_of(df, "doc_id", "text"), wanted, buckets, longest, percent, least, 2024)


def test_importance_empty_and_drawn(spark, odd, docs):
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert imp.importance_resample(empty(spark), target).count() == 0
    got = Counter(rows_of(imp.importance_resample(docs, target.limit(0)), "doc_id", "n_features", "weight", "score", "rank"))
    assert got == by_definition(rows_of(docs, "doc_id", "text"), [], 10_000, 1, 10, 20, 2024)
    drawn = {r.doc_id for r in imp.importance_resample(docs, target, percent=30).where("rank IS NOT NULL").collect()}
    kept = imp.resampled(docs, target, percent=30)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == drawn and len(drawn) > 10


# --------------------------------------------------------------- filter audit
def audited(rows, labels):
    """Counter of the audit's rows, by applying each order's filters one after the other."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    parts = defaultdict(list)
    for i, t, part in rows:
        t = t or ""
        words = re.findall("[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 "D": re.search(r"[#$%&*|]", t) is not None, "E": i is not None and first[t] < i}
        rated = [x for x in labels if x[0] == i and i is not None]
        parts[part or ""].append((fails, any(q == 1 for _, q, _ in rated), any(x == 1 for _, _, x in rated)))
    out = []
    for part, docs in parts.items():
        mine = []
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if d[0][letter]]
                redundant = sum(d[0][letter] for d in docs) - len(gone)
                left = [d for d in left if not d[0][letter]]
                alone = sum(d[0][letter] and sum(d[0].values()) == 1 for d in docs)
                mine.append((part, "".join(order), step, len(left), len(gone), redundant, alone, sum(g for _, g, _ in gone), sum(x for _, _, x in gone)))
        shapley = Counter()
        for r in mine:
            shapley[r[1][r[2] - 1]] += r[4]
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in mine]
    return Counter(out)


def test_audit_equals_applying_the_filters(spark, odd, docs):
    odd_labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (4, 1, None), (7, None, 1), (None, 1, 1), (99, 1, 1), (12, 1, 1), (14, 1, 1)], "doc_id long, quality int, toxic int")
    for df, labels in ((odd, odd_labels), (docs, spark.read.parquet(f"{SF}/labels.parquet"))):
        got = Counter(tuple(r) for r in audit.filter_audit(df, labels).collect())
        assert got == audited(rows_of(df, "doc_id", "text", "lang"), rows_of(labels, "doc_id", "quality", "toxic"))
    assert audit.filter_audit(empty(spark), odd_labels).count() == 0
    assert audit.filter_audit(odd, odd_labels.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def test_audit_counters_never_overflow():
    """All documents alike fill a counter to its brim; sums pass through many
    parts and small holds unchanged."""
    n, width = 255, 8
    total = sum(audit.pack_outcomes(0b00001, True, True, width) for _ in range(n))
    rows = audit.unpack(total, width)
    assert len(rows) == 600 and all(r[3] == n - r[4] for r in rows if r[0][0] == "A" and r[1] == 1)
    assert {r[3:] for r in rows if r[0] == "ABCDE" and r[1] == 1} == {(n, 0, n, n, n, 120 * n)}
    pieces = [(f"p{i % 7}", i % 3, 1 << i) for i in range(300)]
    for hold in (1, 2, 100):
        got = Counter()
        for batch in audit._summed(iter(pieces), hold):
            for r in batch.to_pylist():
                got[r["part"], r["salt"]] += int.from_bytes(r["total"], "little")
        want = Counter()
        for part, salt, v in pieces:
            want[part, salt] += v
        assert got == want
