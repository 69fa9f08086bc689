import functools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from twinsift.llm import decontaminate as D
from twinsift.llm import queries

DOC = "doc_id long, text string"


@given(st.lists(st.sampled_from("abcde"), max_size=25), st.lists(st.sampled_from("abcde"), max_size=25))
@settings(max_examples=200, deadline=None)
def test_lcs(a, b):
    @functools.cache
    def f(i, j):
        return 0 if i == len(a) or j == len(b) else f(i + 1, j + 1) + 1 if a[i] == b[j] else max(f(i + 1, j), f(i, j + 1))

    assert D.lcs_length(a, b) == f(0, 0)


def vocabulary(rnd, n=3000):
    return ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(3, 9))) for _ in range(n)]


def prose(rnd, words, n):
    return [words[int(len(words) * rnd.random() ** 3)] for _ in range(n)]


def test_subspace_iteration_finds_the_singular_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [rng.integers(0, 40, 30).tolist() + [100 + i % 3] * 8 for i in range(60)]
    idf = np.ones(D.BUCKETS)
    a = np.zeros((60, 200))
    for i, r in enumerate(rows):
        np.add.at(a[i], r, 1)
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    a[:10] *= 2
    want = np.linalg.svd(a)[1]
    df = spark.createDataFrame([(r, 2.0 if i < 10 else 1.0) for i, r in enumerate(rows)], "places array<int>, weight double")
    basis, values = D.latent_basis(df.repartition(3), idf, rank=8)
    np.testing.assert_allclose(np.linalg.norm(a @ basis[:200], axis=0)[:3], want[:3], rtol=1e-3)
    np.testing.assert_allclose(values[:3], want[:3], rtol=1e-3)


def test_planted_items_and_paraphrases(spark, frame):
    rnd = random.Random(3)
    words = vocabulary(rnd)
    items = [(i, " ".join(prose(rnd, words, rnd.randint(16, 60)))) for i in range(40)] + [(100, None), (101, ""), (102, "tiny item")]
    docs, truth = [], set()
    for d in range(300):
        text = prose(rnd, words, rnd.choice([5, 60, 400, 1500]))
        if d % 3 == 0:
            item = items[d % 40][1].split()
            if d % 2:  # a paraphrase: some words changed, some put in
                item = [w if rnd.random() > 0.12 else rnd.choice(words) for w in item]
                for _ in range(3):
                    item.insert(rnd.randrange(len(item)), rnd.choice(words))
            at = rnd.randrange(len(text))
            text[at:at] = item
            truth.add((d, d % 40))
        docs.append((d, " ".join(text).title()))
    docs += [(1000, None), (1001, ""), (3, docs[3][1]), (None, items[0][1])]
    truth.add((None, 0))
    rows = D.contaminated(frame(docs, DOC).repartition(3), frame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]) for r in rows}
    assert len(truth - got) <= 0.02 * len(truth) and not got - truth
    assert sum(r["doc_id"] == 3 for r in rows) == 2  # repeated rows each


def test_recall_of_candidates_against_exact_cosine():
    """Passages whose exact TF-IDF cosine with an item is high are candidates."""
    rnd = random.Random(9)
    words = vocabulary(rnd)
    docs = [prose(rnd, words, 300) for _ in range(24)]
    items = [prose(rnd, words, 40) for _ in range(6)]
    for d, doc in enumerate(docs):
        doc[100:100] = items[d % 6]
    df = np.zeros(D.BUCKETS)
    for doc in docs:
        df[np.unique(D.buckets_of(doc))] += 1
    idf = np.log((1 + len(docs)) / (1 + df)).clip(0)
    a = np.zeros((len(docs) + len(items), D.BUCKETS), np.float32)
    for r, t in zip(a, [d[60:124] for d in docs] + items, strict=True):
        np.add.at(r, D.buckets_of(t), 1)
    a *= idf
    a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-9)
    a[len(docs):] *= D.ITEM_WEIGHT
    _, values, rows = np.linalg.svd(a, full_matrices=False)
    s = D.Searcher(D.item_passages([(i, " ".join(t)) for i, t in enumerate(items)], idf), idf, rows.T.astype(np.float32), values)
    found = {(d, j) for d, j, *_ in s.candidates([D.buckets_of(d) for d in docs])}
    exact = set()
    targets = [np.bincount(D.buckets_of(t), minlength=D.BUCKETS) * idf for t in items]
    for d, doc in enumerate(docs):
        for at in range(0, len(doc) - 63, D.STEP):
            w = np.bincount(D.buckets_of(doc[at:at + 64]), minlength=D.BUCKETS) * idf
            for j, t in enumerate(items):
                q = targets[j]
                if w @ q >= 0.6 * np.linalg.norm(w) * np.linalg.norm(q):
                    exact.add((d, j))
    assert len(exact) >= 15 and len(exact & found) >= 0.95 * len(exact)


def test_short_paraphrase_among_as_telling_words():
    """16 words, four of them changed: near enough in a window of two blocks
    only (in the full space; all words weigh the same)."""
    words = [f"{a}{b}" for a in "abcdefghijkl" for b in "abcdefghijkl"]
    item = words[:16]
    doc = words[40:72] + item[:12] + words[72:140]
    places = D.buckets_of(words)
    assert len(set(places.tolist())) == len(words)
    basis = np.zeros((D.BUCKETS, len(words)), np.float32)
    basis[places, np.arange(len(words))] = 1
    s = D.Searcher(D.item_passages([(7, " ".join(item))], np.ones(D.BUCKETS)), np.ones(D.BUCKETS), basis, np.ones(len(words), np.float32))
    assert [h[:2] for h in s.hits([" ".join(doc)])] == [(0, 0)]


@pytest.mark.parametrize("n", [200, 1200])
def test_recall_at_the_production_rank(n):
    """Benchmarks of more passages than RANK and than MAX_RANK: items of 16 to
    59 words at any place, a quarter of their words changed and some put in,
    are candidates where the exact cosine of a window is 0.45 or the word
    checks hold."""
    rnd = random.Random(n)
    tongues = [vocabulary(rnd, 4000) for _ in range(4)]
    items = [prose(rnd, tongues[i % 4], rnd.randint(16, 59)) for i in range(n)]
    docs, exact = [prose(rnd, tongues[d * n // 300 % 4], 300) for d in range(300)], set()
    sample = [prose(rnd, tongues[i % 4], D.PASSAGE) for i in range(2400)]
    for d, doc in enumerate(docs):
        words = tongues[d * n // 300 % 4]
        at = rnd.randrange(60, 240)
        item = [w if rnd.random() > 0.25 else rnd.choice(words) for w in items[d * n // 300]]
        for _ in range(len(item) // 6):
            item.insert(rnd.randrange(len(item)), rnd.choice(words))
        doc[at:at] = item
    df = np.zeros(D.BUCKETS)
    for doc in docs + sample:
        df[np.unique(D.buckets_of(doc))] += 1
    idf = np.log((1 + len(docs + sample)) / (1 + df)).clip(0)

    def unit(tokens):
        v = np.bincount(D.buckets_of(tokens), minlength=D.BUCKETS) * idf
        return (v / max(float(np.linalg.norm(v)), 1e-9)).astype(np.float32)

    q = np.stack([unit(t) for t in items])
    a = np.concatenate([np.stack([unit(t) for t in sample]), q * D.ITEM_WEIGHT])
    square, left = np.linalg.eigh(a @ a.T)
    best = np.argsort(-square)[:D.rank_of(n)]
    values = np.sqrt(np.maximum(square[best], 1e-9)).astype(np.float32)
    basis = (a.T @ left[:, best] / values).astype(np.float32)
    parts = D.item_passages([(i, " ".join(t)) for i, t in enumerate(items)], idf)
    s = D.Searcher(parts, idf, basis, values)
    found = {(d, j) for d, j, *_ in s.candidates([D.buckets_of(d) for d in docs])}
    for d, doc in enumerate(docs):
        if D.verify(*parts[d * n // 300][1:], doc):
            exact.add((d, d * n // 300))
        w = np.stack([unit(doc[at:at + D.STEP * k]) for k in (2, 3, 4) for at in range(0, len(doc), D.STEP)])
        exact |= {(d, int(j)) for j in np.flatnonzero((w @ q.T).max(axis=0) >= 0.45)}
    assert len(exact) >= 200
    assert len(exact & found) >= 0.97 * len(exact), (len(exact & found), len(exact))


def test_empty(spark, frame):
    none = frame([], DOC)
    item = frame([(1, "a b c")], "item_id long, text string")
    assert D.contaminated(none, item).count() == 0
    assert D.contaminated(frame([(1, "x y z")], DOC), frame([], "item_id long, text string")).count() == 0


def test_query_finds_all_whole_items(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    truth = {(d["doc_id"], i["item_id"]) for d in docs for i in items if i["text"] in d["text"]}
    got = {(r["doc_id"], r["item_id"]) for r in queries.op6_decontaminate(spark, sf).collect()}
    assert truth and truth <= got and len(got - truth) <= 1


def test_orthonormal_spans_the_columns():
    rng = np.random.default_rng(1)
    a = (rng.normal(size=(900, 20)) * np.logspace(0, -4, 20)).astype(np.float32)
    q = D.orthonormal(a.copy(), step=128)
    np.testing.assert_allclose(q.T @ q, np.eye(20), atol=1e-5)
    np.testing.assert_allclose(q @ (q.T @ a), a, atol=1e-5)
    same = np.repeat(a[:, :1], 3, axis=1)  # dependent columns
    assert np.isfinite(D.orthonormal(same.copy())).all()


def test_passages_left_out_hold_no_hit(monkeypatch):
    """The answer words around a passage bound the check from above: the hits
    are those of a search of all passages, also with given answers of one word
    and items shorter than a block."""
    rnd = random.Random(21)
    words = vocabulary(rnd, 600)
    items = [prose(rnd, words, n) for n in (3, 7, 12, 20, 40, 64, 90)]
    docs = [prose(rnd, words, rnd.choice([0, 5, 16, 33, 200, 700])) for _ in range(60)]
    for d, doc in enumerate(docs[:40]):
        at = rnd.randint(0, len(doc))
        doc[at:at] = [w if rnd.random() > 0.15 else rnd.choice(words) for w in items[d % 7]]
    idf = np.ones(D.BUCKETS)
    basis = np.linalg.qr(np.random.default_rng(3).standard_normal((D.BUCKETS, 80)))[0].astype(np.float32)
    texts = [" ".join(d) for d in docs]
    for answers in ({}, {1: items[1][0], 3: " ".join(items[3][:2])}):
        s = D.Searcher(D.item_passages([(i, " ".join(t)) for i, t in enumerate(items)], idf, answers), idf, basis, np.ones(80, np.float32))
        some = s.hits(texts)
        with monkeypatch.context() as m:
            m.setattr(s, "windows", lambda w: [(n, np.arange(max(1, -(-len(w) // D.STEP) - n + 1))) for n in D.WINDOWS if w])
            every = s.hits(texts)
        assert [(d, j, round(c, 4), share, at) for d, j, c, share, at in some] == [(d, j, round(c, 4), share, at) for d, j, c, share, at in every]
        assert len(some) >= 20


def test_frequencies_and_windows_by_their_definition(spark):
    rnd = random.Random(3)
    words = vocabulary(rnd, 300)
    texts = [" ".join(prose(rnd, words, rnd.randint(0, 200))) for _ in range(40)] + [None, "", "one one one"]
    rows = [(i, t, i * 7919) for i, t in enumerate(texts)]
    df, _ = D._statistics(spark.createDataFrame(rows, "doc_id long, text string, key long").repartition(3), len(rows))
    want = np.zeros(D.BUCKETS + 1)
    for t in texts:
        want[np.unique(D.buckets_of(set(D.words_of(t))))] += 1
    want[-1] = len(texts)
    assert (df == want).all()
    idf = 1 / (1 + df[:-1])
    searcher = D.Searcher(D.item_passages([(1, " ".join(words[:40])), (2, " ".join(words[200:230]))], idf), idf, np.ones((D.BUCKETS, 2), np.float32), np.ones(2, np.float32))
    for t in texts:
        w = D.words_of(t)
        at = [i for i, x in enumerate(w) if x in searcher.answers]
        got = dict(searcher.windows(w))
        for n in D.WINDOWS:
            blocks = -(-len(w) // D.STEP)
            many = [b for b in range(max(1, blocks - n + 1) if blocks else 0)
                    if sum(b * D.STEP - searcher.reach <= i < (b + n) * D.STEP + searcher.reach for i in at) >= searcher.least]
            assert got.get(n, np.zeros(0)).tolist() == many


def test_every_passage_of_every_text_is_in_the_fit(spark, monkeypatch):
    """The products are those of all passages of all texts and all benchmark
    passages, and the basis keeps what a whole SVD of them keeps."""
    rnd = random.Random(12)
    words = vocabulary(rnd, 400)
    texts = [" ".join(prose(rnd, words, rnd.choice([0, 3, 64, 65, 200, 700]))) for _ in range(50)]
    items = [D.buckets_of(prose(rnd, words, 40)) for _ in range(12)]
    monkeypatch.setattr(D, "TEXTS_WEIGHT", 10)
    monkeypatch.setattr(D, "CHUNK", 32)
    df, table = D._statistics(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3), len(texts))
    idf = np.log((1 + len(texts)) / (1 + df[:-1])).clip(0)
    rows = []
    for t in texts:
        places = D.buckets_of(t)
        parts = [places[at:at + D.PASSAGE] for at in range(0, len(places), D.PASSAGE)]
        rows += [(p, (10 / 50 / len(parts)) ** 0.5) for p in parts]
    rows += [(p, D.ITEM_WEIGHT) for p in items]
    a = np.zeros((len(rows), D.BUCKETS))
    for r, (p, weight) in zip(a, rows, strict=True):
        np.add.at(r, p, 1)
        r *= idf
        r *= weight / max(np.linalg.norm(r), 1e-9)
    asked = spark.createDataFrame([(bytearray(D._packed(p)), D.ITEM_WEIGHT) for p in items], "places binary, weight double")
    q = np.random.default_rng(2).normal(size=(D.BUCKETS, 24)).astype(np.float32)
    every = table.drop("key").unionByName(asked)
    np.testing.assert_allclose(D._times(every, idf, q), a.T @ (a @ q), atol=2e-4)
    basis, values = D.latent_basis(every, idf, 24, D.start_of(asked.unionByName(every.limit(20)), idf, 24))
    want = np.linalg.svd(a, full_matrices=False)[1][:24]
    np.testing.assert_allclose(basis.T @ basis, np.eye(24), atol=1e-4)
    assert np.linalg.norm(a @ basis) ** 2 >= 0.95 * np.sum(want ** 2)
    np.testing.assert_allclose(values[:8], want[:8], rtol=0.05)


def test_start_takes_a_passage_of_each_text(spark):
    texts = [list(range(n)) for n in (1, 63, 64, 65, 300)]
    table = spark.createDataFrame([(bytearray(D._packed(np.array(t))), 1.0, 7919 ** 4 * (i + 1)) for i, t in enumerate(texts)], "places binary, weight double, key long")
    got = sorted(np.frombuffer(r["places"], "<u2").tolist() for r in D.sampled(table, len(texts)).collect())
    assert sorted(map(len, got)) == [1, 63, 64, 64, 64] and all(p == list(range(p[0], p[0] + len(p))) for p in got)


def test_fit_without_texts_or_items(spark):
    none = spark.createDataFrame([], "places array<int>, weight double")
    basis, values = D.latent_basis(none, np.ones(D.BUCKETS), 4, D.start_of(none, np.ones(D.BUCKETS), 4))
    assert basis.shape == (D.BUCKETS, 4) and np.isfinite(basis).all() and not values.any()
