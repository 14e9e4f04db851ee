"""Substring and embedding near-dedup, the classifier, archives and the pipeline."""

import gzip
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loanmart.llm import embedding_dedup as emb
from loanmart.llm import substring_dedup as sub
from loanmart.llm.common import components, scratch, written
from loanmart.llm.quality import classify, corpus_ratings, features, fit_ordinal, select_good
from loanmart.llm.simhash import drop_near_duplicates, fingerprint
from loanmart.llm.warc import coalesced, decode_record, page_records, pages_round_trip, read_records, write_archives

SF = "/root/testdata/sf0.001"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(n))


# --------------------------------------------------------------- components
def test_components_of_any_shape(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(300, 301), (301, 300), (302, 302)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, **{200 + i: 100 for i in range(50)}, 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


# --------------------------------------------------------------- near-dedup
def test_one_row_of_each_group_stays(spark):
    a, b = (words(random.Random(s), 80) for s in (1, 2))
    rows = [(1, a, "x"), (1, a, "x"), (1, b, "y"), (2, b, "z"), (None, a, "n")]
    got = drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, more string").repartition(3))
    assert got.columns == ["doc_id", "text", "more"]
    assert Counter(tuple(r) for r in got.collect()) == Counter([(1, a, "x"), (1, b, "y")])


# ---------------------------------------------------------- substring dedup
def test_repeated_passages_are_found_and_clean_texts_stay(spark):
    rng = random.Random(5)
    docs = [words(rng, rng.randint(40, 200)) for _ in range(150)]
    where = {}
    for k in range(15):
        passage, hit = words(rng, 56), rng.sample(range(10 * k, 10 * k + 10), 3)
        for i in hit:
            w = docs[i].split(" ")
            j = rng.randint(0, len(w))
            docs[i] = " ".join([*w[:j], passage, *w[j:]])
        where[passage] = sorted(hit)
    rows = [(i, t, "x") for i, t in enumerate(docs)] + [(900, None, "x"), (901, "", "x"), (902, "too short", "x"), (903, "too short", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, cuts string").repartition(4)
    got = sub.repeated_spans(df).collect()
    planted = {i for hit in where.values() for i in hit}
    assert {r.id for r in got} == planted
    assert {r.id for r in got if r.removed} == {i for hit in where.values() for i in hit[1:]}
    left = {r.doc_id: r.text for r in sub.remove_repeats(df).collect()}
    assert set(left) == {r[0] for r in rows}
    for passage, hit in where.items():
        assert [i for i in hit if passage in left[i]] == hit[:1]
    assert all(left[i] == docs[i] for i in range(150) if i not in planted) and left[900] is None
    assert sub.remove_repeats(df).columns == df.columns
    assert sub.repeated_spans(df.limit(0)).count() == 0


@pytest.mark.parametrize("context", [512, 16])
def test_copies_are_covered_to_all_their_words(spark, monkeypatch, context):
    monkeypatch.setattr(sub, "CONTEXT", context)
    rng = random.Random(15)
    docs, copies = [], []
    for n in (60, 60, 120, 300, 300):
        passage = words(rng, n)
        for k in range(3):
            before, after = words(rng, rng.randint(20, 60)) + " ", " " + words(rng, 40)
            if k:
                copies.append((len(docs), len(before), len(before) + len(passage)))
            docs.append(before + (passage.upper() if k == 2 else passage) + after)
    spans = sub.repeated_spans(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).where("removed").collect()
    for i, start, stop in copies:
        gone = {b for r in spans if r.id == i for b in range(r.start, r.stop)}
        assert not [b for b in range(start, stop) if b not in gone and docs[i][b] != " "]
        assert gone <= set(range(start, stop))


@pytest.mark.parametrize("context,ends", [(512, 1024), (48, 1)])
def test_near_equal_passages_inside_lines_go_whole(spark, monkeypatch, context, ends):
    """Copies of one passage, each with some words changed, added or left out."""
    monkeypatch.setattr(sub, "CONTEXT", context)
    monkeypatch.setattr(sub, "END_BLOCK", ends)
    rng = random.Random(25)
    docs, copies = [], []
    for n in (70, 70, 120, 300):
        passage = words(rng, n).split(" ")
        for k in range(4):
            mine = list(passage)
            for at in range(24, n - 12, 24) if k else []:
                mine[at: at + 1] = [["changed"], ["two", "words"], []][k - 1]
            before, after = words(rng, rng.randint(20, 60)) + " ", " " + words(rng, 40)
            if k:
                copies.append((len(docs), len(before), len(before) + len(" ".join(mine))))
            docs.append(before + " ".join(mine) + after)
    spans = sub.repeated_spans(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).where("removed").collect()
    for i, start, stop in copies:
        gone = {b for r in spans if r.id == i for b in range(r.start, r.stop)}
        assert not [b for b in range(start, stop) if b not in gone and docs[i][b] != " "]
        assert gone <= set(range(start, stop))


def test_equal_words_and_edits():
    w = lambda a, b: " ".join(f"w{i}" for i in range(a, b))
    for mine, his, want in (
            (w(0, 10) + " X " + w(11, 20) + " end", w(0, 20) + " tail", w(0, 10) + " X " + w(11, 20)),
            (w(0, 10) + " " + w(12, 22), w(0, 22), w(0, 10) + " " + w(12, 22)),
            (w(0, 10) + " a b " + w(10, 19), w(0, 19), w(0, 10) + " a b " + w(10, 19)),
            (w(0, 10) + " a b c " + w(10, 19), w(0, 19), w(0, 10)),
            (w(0, 10) + " X " + w(11, 18), w(0, 18), w(0, 10)), ("a", "b", ""), ("", "b", "")):
        n, far = sub.equal_words(mine.encode(), his.encode(), False, False, False)
        assert mine[:n] == want and not far
        back = [" ".join(t.split(" ")[::-1]) for t in (mine, his)]
        n, far = sub.equal_words(back[0].encode(), back[1].encode(), True, False, False)
        assert n == len(want) and not far
    # what is seen ends where equal words may go on
    assert sub.equal_words(w(0, 5).encode(), w(0, 9).encode(), False, True, False)[1]
    assert sub.equal_words((w(0, 5) + " X " + w(6, 9)).encode(), w(0, 30).encode(), False, True, False)[1]


def test_lines_cluster_as_all_pairs_do(spark):
    """Exact Jaccard of all pairs of a few hundred lines against the banded join."""
    rng = random.Random(31)
    lines = []
    for _ in range(40):
        line = words(rng, rng.randint(5, 60)).split(" ")
        for _ in range(rng.randint(1, 8)):
            copy = list(line)
            for at in rng.sample(range(len(copy)), rng.randint(0, max(1, len(copy) // 25))):
                copy[at] = words(rng, 1)
            lines.append(" ".join(copy))
    rng.shuffle(lines)
    sets = [sub.shingles(t) for t in lines]
    least = list(range(len(lines)))
    pairs = [(i, j) for i in range(len(lines)) for j in range(i) if sub.jaccard(sets[i], sets[j]) >= 0.8]
    for _ in range(20):
        for i, j in pairs:
            least[i] = least[j] = min(least[i], least[j])
    want = {i: least[i] for i in range(len(lines)) if least.count(least[i]) > 1}
    got = sub.repeated_spans(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()
    whole = {r.id: r.keep_id for r in got if r.start == 0 and r.stop == len(lines[r.id])}
    assert len(pairs) > 100 and sum(whole.get(i) == k for i, k in want.items()) >= 0.97 * len(want)
    assert set(whole) <= set(want)


def test_repeats_in_odd_rows(spark):
    """Very long texts, repeated ids, null ids and columns with the operator's own names."""
    rng = random.Random(41)
    passage, long = words(rng, 60), words(rng, 60_000)
    rows = [(1, words(rng, 30) + " " + passage), (1, words(rng, 30)), (2, long + " " + passage + " " + words(rng, 50)), (None, words(rng, 20) + " " + passage), (3, "x" * 300_000), (4, None)]
    schema = "doc_id long, text string, id long, version long, row string, start long, stop long, label long, low long, hash string, body string"
    df = spark.createDataFrame([(*r, 1, 2, "r", 3, 4, 5, 6, "h", "b") for r in rows], schema).repartition(3)
    left = sub.remove_repeats(df)
    assert left.columns == df.columns
    got = Counter((r.doc_id, r.text) for r in left.collect())
    assert sum(got.values()) == 6 and got[1, rows[1][1]] == got[3, rows[4][1]] == got[4, None] == 1
    texts = {k for k in got}
    assert sum(passage in (t or "") for _, t in texts) == 1 and [i for i, t in texts if passage in (t or "")] == [None]
    assert next(t for i, t in texts if i == 2).startswith(long[:300_000])


@pytest.mark.parametrize("block", [1024, 4])
def test_near_equal_lines_are_one_cluster(spark, monkeypatch, block):
    monkeypatch.setattr(sub, "BUCKET_BLOCK", block)
    rng = random.Random(6)
    line = words(rng, 60).split(" ")
    edited = []
    for i in range(12):
        copy = list(line)
        copy[30 + i % 3] = f"new{i}"
        edited.append(words(rng, 30) + "\n" + " ".join(copy) + "\n" + words(rng, 30))
    got = sub.repeated_spans(spark.createDataFrame(list(enumerate(edited)), "doc_id long, text string")).toPandas()
    whole = got[got.stop - got.start > 300]  # the lines, not the passages in them
    assert sorted(whole.id) == list(range(12)) and whole.cluster.nunique() == 1 and set(whole.keep_id) == {0}


def test_short_lines_are_paragraphs(spark):
    rng = random.Random(16)
    equal, near = words(rng, 5), words(rng, 15).split(" ")
    texts = [equal, words(rng, 30) + "\n" + equal + "\n" + words(rng, 30), " ".join(near), words(rng, 30) + "\n" + " ".join([*near[:14], "other"]), words(rng, 9)]
    got = sub.repeated_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted((r.id, r.keep_id, r.removed, texts[r.id].encode()[r.start: r.stop].decode()) for r in got) == [
        (0, 0, False, equal), (1, 0, True, equal), (2, 2, False, " ".join(near)), (3, 2, True, " ".join([*near[:14], "other"]))]


def test_whole_copies_leave_one(spark):
    rng = random.Random(7)
    text = "\n".join(words(rng, 40) for _ in range(3))
    left = sub.remove_repeats(spark.createDataFrame([(5, text), (3, text), (None, text), (4, text)], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.text) for r in left] == [(None, text)]


def test_bands_reach_the_recall():
    bands, rows = sub.tune_bands(0.8, 0.98)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.98
    assert sub.jaccard(sub.shingles("a b c d e f"), sub.shingles("A b c d e g")) == pytest.approx(1 / 3)
    sets = [frozenset({1, 2, 3, 4}), frozenset({1, 2, 3, 4, 5}), frozenset({9}), frozenset({1, 2, 3, 4, 5, 6})]
    assert sorted(sub.similar_forest(sets, 0.8)) == [(0, 1), (1, 3)]


# ---------------------------------------------------- embedding near-dedup
@pytest.mark.parametrize("block", [4096, 64])
def test_near_vectors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(emb, "BLOCK", block)
    monkeypatch.setattr(emb, "SHARD", 128)
    rng = np.random.default_rng(8)
    base = rng.normal(size=(300, 16))
    near = np.repeat(base[:20], 12, axis=0) + rng.normal(size=(240, 16)) * 0.08
    x = np.concatenate([base, near, base[:30]]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(9000, None), (9001, [0.0] * 16), (9002, [float("nan")] * 16), (9003, [float("inf")] + [1.0] * 15), (9004, [None] + [1.0] * 15), (None, rows[0][1]), (7, rows[7][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").repartition(3)
    got = emb.near_vectors(df).collect()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    unit = np.concatenate([unit, unit[7:8]])
    ids = [*range(len(x)), 7]
    link = unit @ unit.T >= 0.95
    np.fill_diagonal(link, False)
    least = np.arange(len(unit))
    for _ in range(50):
        least = np.minimum(least, np.where(link, least[None, :], 1 << 40).min(axis=1))
    want = Counter((ids[i], int(link[i].sum()), ids[int(least[i])], ids[i] == ids[int(least[i])]) for i in range(len(unit)))
    want += Counter([(k, 0, k, True) for k in (9000, 9001, 9002, 9003, 9004)] + [(None, 0, None, False)])
    assert Counter(tuple(r) for r in got) == want
    assert emb.near_vectors(df.limit(0)).count() == 0


def test_near_vectors_with_repeated_ids_and_clashing_columns(spark):
    """Rows that share an id are vectors of their own: one row out for each."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 12))
    x = np.concatenate([base, base[:20] + rng.normal(size=(20, 12)) * 0.05, base[:10]])
    ids = [int(i) for i in rng.integers(0, 25, len(x))]
    schema = "vec_id long, embedding array<double>, node long, least long, v string, copies long, component string, n_links int"
    df = spark.createDataFrame([(i, v.tolist(), 1, 2, "v", 3, "c", 4) for i, v in zip(ids, x)], schema).repartition(3)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    link = unit @ unit.T >= 0.95
    np.fill_diagonal(link, False)
    least = np.array(ids)
    for _ in range(50):
        least = np.minimum(least, np.where(link, least[None, :], 1 << 40).min(axis=1))
    want = Counter((i, int(n), int(c), i == int(c)) for i, n, c in zip(ids, link.sum(axis=1), least))
    assert Counter(tuple(r) for r in emb.near_vectors(df).collect()) == want


def test_audit_sends_the_search_again_or_raises(spark, monkeypatch):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(60, 12))
    x = np.concatenate([base, base + rng.normal(size=(60, 12)) * 0.02])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    full, tried = emb.find_links, []

    def lossy(upto):
        def find(nodes, n, threshold, wide=1):
            tried.append(wide)
            found = full(nodes, n, threshold, wide)
            return found.where("node % 2 = 0") if wide <= upto else found
        return find

    monkeypatch.setattr(emb, "find_links", lossy(1))
    got = {r.vec_id: r for r in emb.near_vectors(df).collect()}
    assert tried == [1, 2] and all(got[i].n_links >= 1 for i in range(120))
    monkeypatch.setattr(emb, "find_links", lossy(99))
    with pytest.raises(RuntimeError, match="audited"):
        emb.near_vectors(df)


def test_crowd_reaches_along_a_chain_in_few_rounds(spark, monkeypatch):
    from loanmart.llm import common
    names, write = [], common.written
    for module in (common, emb):
        monkeypatch.setattr(module, "written", lambda df, name: (names.append(name), write(df, name))[1])
    rows = [(i, [i + 1] if i % 1000 != 999 else [], i == 500) for i in range(2000)]
    hot = emb.crowd(spark.createDataFrame(rows, "node long, linked array<long>, crowded boolean"))
    assert sorted(r.node for r in hot.collect()) == list(range(1000))
    assert len(names) < 40


@pytest.mark.parametrize("crowd_block", [8192, 100])
def test_a_group_over_many_shards_keeps_all_its_links(spark, monkeypatch, crowd_block):
    # one group of near-equal vectors over many centroids, blocks that lists cannot cover
    monkeypatch.setattr(emb, "SHARD", 64)
    monkeypatch.setattr(emb, "CROWD_BLOCK", crowd_block)
    rng = np.random.default_rng(12)
    centre = rng.normal(size=32)
    x = np.concatenate([centre / np.linalg.norm(centre) + rng.normal(size=(900, 32)) * 0.03, rng.normal(size=(900, 32))])
    x = np.concatenate([x, x[:3]])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    want = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    got = {r.vec_id: r for r in emb.near_vectors(df).collect()}
    assert want[:900].min() > 600
    assert [got[i].n_links for i in range(len(x))] == want.tolist()
    assert {got[i].component_id for i in range(900)} == {0}


def test_pruned_graph_has_no_loops():
    x = np.random.default_rng(1).normal(size=(200, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    g = emb.pruned_graph(x)
    assert g.shape == (200, emb.DEGREE) and not (g == np.arange(200)[:, None]).any()
    assert emb.pruned_graph(x[:1]).max() == -1


# --------------------------------------------------------------- classifier
def test_classifier_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF[:-3]}01/documents.parquet"), spark.read.parquet(f"{SF[:-3]}01/labels.parquet")
    train = labels.where("doc_id % 4 <> 0")
    got = classify(docs, train).join(labels.where("doc_id % 4 = 0"), "doc_id").toPandas()
    good = (got.quality == 1) & (got.toxic == 0)
    assert got[good].kept.mean() > 0.9 and got[~good].kept.mean() < 0.4
    assert got.expected_grade.between(0, 2).all() and got.tail_probability.between(0, 1).all()


def test_sample_is_of_documents_that_are_there(spark):
    docs = spark.createDataFrame([(i, ["bad awful bad", "fine good text"][i % 2]) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(4000)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in classify(docs, labels, sample_rows=40).collect()}
    assert not any(got[i] for i in range(0, 40, 2)) and all(r is not None for r in got.values())
    assert classify(docs, labels, sample_rows=40).where("expected_grade IS NULL").count() == 0


def test_classifier_edges(spark):
    schema = "doc_id long, text string, row string, expected_grade double"
    docs = spark.createDataFrame([(1, None, "r", 5.0), (2, "", "r", 5.0), (None, "x y", "r", 5.0), (3, "x y", "r", 5.0), (3, "x z", "r", 5.0), (4, "w " * 50_000, "r", 5.0)], schema)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.kept for r in classify(docs, none).collect()] == [True] * 6
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (4, 1, None), (77, 1, 1), (None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    assert {(r.id, r.grade) for r in corpus_ratings(labels).collect()} == {(3, 2), (3, 1), (4, 2), (77, 0), (None, 0), (1, None)}
    assert classify(docs, labels).count() == 6
    assert select_good(docs, labels).columns == docs.columns
    assert classify(docs.limit(0), labels).count() == 0


def test_fit_reaches_the_likelihood_of_a_reference_fit():
    """Against Newton steps with numerical derivatives on the same likelihood."""
    rng = np.random.default_rng(9)
    n, dim = 900, 4
    x = rng.random((n, dim))
    z = x @ np.array([3.0, -2.0, 1.0, 0.0]) + rng.logistic(size=n)
    grade = (z > 0.5).astype(int) + (z > 2.0)

    def likelihood(theta):
        t = np.array([theta[dim], theta[dim] + np.exp(theta[dim + 1])])
        below = np.concatenate([np.zeros((n, 1)), 1 / (1 + np.exp(x @ theta[:dim][:, None] - t[None, :])), np.ones((n, 1))], axis=1)
        return np.log(below[np.arange(n), grade + 1] - below[np.arange(n), grade]).mean()

    theta, step, eye = np.zeros(dim + 2), 1e-3, np.eye(dim + 2)
    for _ in range(30):
        slope = np.array([(likelihood(theta + step * e) - likelihood(theta - step * e)) / (2 * step) for e in eye])
        bend = np.array([[(likelihood(theta + step * (a + b)) - likelihood(theta + step * (a - b)) - likelihood(theta - step * (a - b)) + likelihood(theta - step * (a + b))) / (4 * step**2)
                          for a in eye] for b in eye])
        theta = theta - np.linalg.solve(bend - 1e-6 * np.eye(dim + 2), slope)
    model = fit_ordinal(np.full(n, dim), np.tile(np.arange(dim), n), x.ravel(), grade, 3)
    own = np.concatenate([model.weights[:dim], model.thresholds[:1], np.log(np.diff(model.thresholds))])
    assert likelihood(own) == pytest.approx(likelihood(theta), abs=2e-3)
    reference = 1 / (1 + np.exp(-(x @ theta[:dim])[:, None] + np.array([theta[dim], theta[dim] + np.exp(theta[dim + 1])])))
    assert np.abs(model.tails(model.score(np.full(n, dim), np.tile(np.arange(dim), n), x.ravel())) - reference).mean() < 0.03


def test_thresholds_are_ordered():
    import pyarrow as pa
    texts = ["bad awful bad", "so so text", "fine good text"] * 30
    grade = np.array([0, 1, 2] * 30)
    model = fit_ordinal(*features(pa.array(texts)), grade, 3)
    assert (np.diff(model.thresholds) > 0).all()
    tails = model.tails(model.score(*features(pa.array(texts[:3]))))
    assert (tails[:, 0] >= tails[:, 1]).all() and tails[2, 1] > 0.7 > tails[1, 1] and tails[0, 0] < 0.3


# ------------------------------------------------------------------ archives
def test_archives_round_trip(spark):
    big, same = "<p>é</p>" * 300, "<i>" + "y" * 1200
    rows = [(1, "u1", big), (2, "u2\r\nX: y", big), (3, None, None), (4, "u4", "small"), (5, "u5", "small"), (6, "", ""), (7, "u7", same), (None, "u8", same), (9, "u9", big + "!"), (7, "u7", same)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    want = Counter()
    for i, _, h in rows:
        raw = (h or "").encode()
        same_ids = [k for k, _, g in rows if g == h and k is not None]
        first = max(same_ids) if len(raw) >= 1000 and same_ids else i
        revisit = len(raw) >= 1000 and i != first
        want[i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None] += 1
    assert Counter(tuple(r) for r in pages_round_trip(pages).collect()) == want
    assert pages_round_trip(pages.limit(0)).count() == 0


def test_index_reads_only_what_is_selected(spark, tmpdir_path):
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>{i}</p>" * 50) for i in range(40)], "page_id long, url string, html string").coalesce(2)
    index = write_archives(page_records(pages), f"file:{tmpdir_path}/warc")
    some = index.where(F.col("url").isin("u3", "u4", "u30"))
    assert sorted((r.url, r.payload.decode()) for r in read_records(some).collect()) == [(f"u{i}", f"<p>{i}</p>" * 50) for i in (3, 30, 4)]
    entry = index.where("url = 'u5'").first()
    with open(entry.file.removeprefix("file:"), "rb") as f:
        f.seek(entry.offset)
        member = f.read(entry.length)
    assert gzip.decompress(member).startswith(b"WARC/1.1\r\n")
    head, payload = decode_record(member)
    assert head["WARC-Target-URI"] == "u5" and payload == b"<p>5</p>" * 50
    ranges = list(coalesced([("a", 0, 10), ("a", 10, 5), ("a", 10_000_000, 5), ("b", 0, 1)]))
    assert [(f, s, e) for f, s, e, _ in ranges] == [("a", 0, 15), ("a", 10_000_000, 10_000_005), ("b", 0, 1)]


def test_archives_with_repeated_ids_long_pages_and_clashing_columns(spark):
    a, b, long = "<p>a</p>" * 200, "<p>b</p>" * 200, "<i>é</i>" * 200_000
    rows = [(9, "u", a), (9, "u", b), (3, "u", a), (4, "u", b), (None, "u", a), (None, "u", "x" * 1200), (None, "u", "y" * 1200), (5, "u\r\nv", long),
            (6, None, long), (6, "u", long), (9, "u", a), (7, "u", "short"), (7, "u", "other")]
    pages = spark.createDataFrame([(*r, "r", "s", "d", 1) for r in rows], "page_id long, url string, html string, record_id string, sha string, first string, size int")
    got = Counter(tuple(r) for r in pages_round_trip(pages).collect())
    first = {}
    for i, _, html in rows:
        first[html] = max(first.get(html, -1), -1 if i is None else i)
    want = Counter()
    for i, _, html in rows:
        raw = html.encode()
        to = None if len(raw) < 1000 or first[html] in (-1, i) else first[html]
        want[i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if to is None else "revisit", to] += 1
    assert got == want
    index = write_archives(page_records(pages), scratch(spark, "test-warc"))
    assert {r.url for r in read_records(index).collect()} == {r.url or "" for r in index.collect()} == {"u", "uv", ""}


# ------------------------------------------------------------------ pipeline
def test_pipeline_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "simhash_near_dedup", "substring_dedup", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(written(stage(spark, seen[-1], SF), f"test-{name}"))
        if name != "packing":
            assert seen[-1].columns == columns
    good, lines, near, cut, packed = ({r.doc_id: r for r in df.collect()} for df in seen[1:])
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(labels[i].quality == 1 and labels[i].toxic == 0 for i in good if i in labels)
    assert set(lines) == set(good) and all(len(r.text or "") == r.n_chars for r in lines.values() if r.text != good[r.doc_id].text)
    fps = {i: fingerprint((r.text or "").encode()) for i, r in lines.items()}
    assert set(near) <= set(lines) and 0 < len(near)
    least = {i: i for i in lines}
    links = [(a, b) for a in lines for b in lines if a < b and bin(fps[a] ^ fps[b]).count("1") <= 3]
    for _ in range(len(lines)):
        before = dict(least)
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
        if least == before:
            break
    assert links and set(near) == {i for i in lines if least[i] == i}
    assert set(cut) <= set(near) and set(packed) == set(cut)
    total = seen[5].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    assert all(r.n == r.t for r in total)


def test_pipeline_over_odd_and_empty_tables(spark, tmpdir_path):
    rng = random.Random(51)
    texts = [None, "", "short", words(rng, 300), words(rng, 300), words(rng, 3000), "x" * 50_000, "a\n\n\nb " + words(rng, 50)]
    rows = [(i, t, "en", "s", len(t or ""), "row", "body", 7) for i, t in enumerate(texts)] + [(3, texts[3], None, None, None, None, None, None), (None, texts[4], "en", "s", 1, "r", "b", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, body string, version long"
    docs, labels = spark.createDataFrame(rows, schema), spark.createDataFrame([(3, 1, 0), (None, 0, 1), (99, 0, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    for n, kept in ((0, 0), (1, None)):
        docs.limit(n * 100).write.parquet(f"{tmpdir_path}/{n}/documents.parquet")
        labels.limit(n * 100).write.parquet(f"{tmpdir_path}/{n}/labels.parquet")
        out = corpus_pipeline.run(spark, f"{tmpdir_path}/{n}").collect()
        assert kept is None or len(out) == kept
        pieces = Counter()
        for r in out:
            pieces[r.doc_id, r.doc_tokens] += r.length
        assert all(v % k[1] == 0 for k, v in pieces.items())
    assert out


def test_registered_queries_match_their_table(spark):
    import __spark_entry__ as entry
    assert all(sum(q.startswith(f"op{n}_") for q in entry.queries()) == 1 for n in range(1, 14))
    assert "pipeline" in entry.queries()
