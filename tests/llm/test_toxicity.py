import pickle
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from twinsift.llm import queries
from twinsift.llm import toxicity as T

DOC, LAB = "doc_id long, text string", "doc_id long, toxic int"


@given(st.integers(0, 10_000), st.integers(1, 20))
@settings(max_examples=60, deadline=None)
def test_index_is_exact(seed, k):
    rng = np.random.default_rng(seed)
    terms = 30
    vectors = []
    for _ in range(int(rng.integers(0, 150))):
        p = np.sort(rng.choice(terms, int(rng.integers(1, 6)), replace=False))
        w = rng.integers(1, 4, len(p)).astype(float)
        vectors.append((p, w / np.linalg.norm(w)))
    index = T.BlockMaxIndex(vectors, terms, block=8)
    p = np.sort(rng.choice(terms, 4, replace=False))
    w = rng.random(4) + 0.1
    w /= np.linalg.norm(w)
    dense = np.zeros((len(vectors), terms))
    for r, (a, b) in zip(dense, vectors, strict=True):
        r[a] = b
    cos = dense[:, p] @ w
    want = np.sort(cos[cos > 0])[::-1][:k]
    ids, got = index.nearest(p, w, k)
    np.testing.assert_allclose(got, np.minimum(want, 1), atol=1e-9)
    np.testing.assert_allclose(cos[ids], got, atol=1e-9)


def test_blocks_are_skipped():
    vectors = [(np.array([0]), np.array([1.0]))] * 8 + [(np.array([0, 1]), np.array([0.6, 0.8]))] * 80
    index = T.BlockMaxIndex(vectors, 2, block=8)
    index.nearest(np.array([0]), np.array([1.0]), 4)
    assert index.visited == 1


def test_isotonic_is_monotone_and_keeps_the_mean():
    x, y = np.array([1.0, 2, 3, 4, 5]), np.array([0.0, 1, 0, 1, 1])
    a, b = T.isotonic(x, y, np.ones(5))
    assert (np.diff(a) > 0).all() and (np.diff(b) >= 0).all() and b.tolist() == [0, 0.5, 1]


def corpus(n=400):
    rng = np.random.default_rng(2)
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        w = [f"w{x}" for x in (rng.random(60) ** 2 * 500).astype(int)]
        if toxic:
            w[10], w[20] = rng.choice(["vilewort", "vileworts", "grotfug"], 2)
        docs.append((i, " ".join(["alpha beta"] + ["q" + x.translate(str.maketrans("0123456789", "abcdefghij")) for x in w if x[0] == "w"]
                                 + [x for x in w if x[0] != "w"])))
        if i % 2 == 0 or toxic:
            labels.append((i, int(toxic)))
    return docs, labels


def test_scores(spark, frame):
    docs, labels = corpus()
    docs += [(9000, None), (9001, ""), (9002, "VILEWORTH! grotfug"), (9003, "clean words only"), (0, docs[0][1]), (None, "grotfug vileworts")]
    labels += [(0, 1), (2, None), (None, 1), (5555, 1), (4, 0)]
    df = frame(docs, DOC)
    model = T.fit(df, frame(labels, LAB))
    out = T.scored(df, model).collect()
    assert len(out) == len(docs)
    by = {r["doc_id"]: r for r in out}
    for i in range(400):
        assert (by[i]["toxicity"] >= 0.5) == (i % 5 == 0), i
    assert by[9002]["toxicity"] >= 0.5 and by[9002]["toxicity_example_ids"] and by[None]["toxicity"] >= 0.5
    assert max(by[i]["toxicity"] for i in (9000, 9001, 9003)) < 0.5
    assert all(0 <= r["toxicity"] <= 1 and set(r["toxicity_example_ids"]) <= {l[0] for l in labels} for r in out)


def test_nothing_to_learn_and_empty(spark, frame):
    docs = frame([(1, "a b"), (2, None)], DOC)
    assert [r["toxicity"] for r in T.scored(docs, T.fit(docs, frame([], LAB))).collect()] == [0, 0]
    assert [r["toxicity"] for r in T.scored(docs, T.fit(docs, frame([(1, 1)], LAB))).collect()] == [1, 1]
    none = frame([], DOC)
    assert T.scored(none, T.fit(none, frame([(1, 1)], LAB))).count() == 0


def test_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op8_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    r = got.where("held_out").groupBy("toxic").agg(F.avg("predicted"), F.count("*")).collect()
    rate = {x[0]: x[1] for x in r}
    assert rate[0] <= 0.02 and rate[1] >= 0.6  # 45 toxic rows to learn from


def test_every_word_of_an_example_is_searched(spark, frame):
    """No term is cut: a copy of a labelled text is found by its ordinary
    words, and one rare word in common is enough."""
    docs, labels = corpus(200)
    docs += [(700, "quiet pond under grey willows"), (701, "quiet pond under grey willows"), (702, "unseen zzz willows yyy")]
    model = T.fit(frame(docs, DOC), frame([*labels, (700, 1)], LAB))
    out = {r["doc_id"]: r for r in T.scored(frame(docs, DOC), model).collect()}
    assert {"quiet", "pond", "willows", "willo*"} <= set(model.space)
    assert out[701]["toxicity_example_ids"][0] == 700 and out[701]["toxicity_example_cosines"][0] == 1
    assert out[702]["toxicity_example_ids"] == [700] and out[702]["toxicity_example_cosines"][0] > 0


@pytest.mark.parametrize("dense", [0, 20, 400])
def test_whole_scans_are_exact(monkeypatch, dense):
    monkeypatch.setattr(T, "DENSE", dense)
    rng = np.random.default_rng(dense)
    vectors = []
    for _ in range(200):
        p = np.sort(rng.choice(300, 40, replace=False, p=np.arange(300, 0, -1) / 45150))
        w = rng.integers(1, 4, len(p)).astype(float)
        vectors.append((p, w / np.linalg.norm(w)))
    dense = np.zeros((200, 300))
    for r, (p, w) in zip(dense, vectors, strict=True):
        r[p] = w
    index = T.BlockMaxIndex(vectors, 300)
    cut = [(p[:n], w[:n]) for (p, w), n in zip(vectors, [0, 1, 5, 9, *[40] * 196], strict=True)]
    for i, (ids, cos) in enumerate(index.nearest_many(cut, 15, list(range(200)))):
        want = dense[:, cut[i][0]] @ cut[i][1]
        want[i] = 0
        best = [j for j in np.lexsort((np.arange(200), -np.round(want, 12)))[:15] if want[j] > 0]
        assert ids.tolist() == best
        np.testing.assert_allclose(cos, want[best], atol=1e-12)


def test_model_ships_small_counts():
    """The driver holds and broadcasts places and counts; the weights are made
    where the index is built, the same as of the vectors one by one."""
    rng = np.random.default_rng(5)
    rows = [(i, i % 2, np.sort(rng.choice(3000, 400, replace=False)), rng.integers(1, 5, 400)) for i in range(100)]
    rows += [(200, 1, *rows[0][2:]), (201, 0, [], []), (202, 1, [1, 7], [70_000, 1])]
    model = T.Model(rows, {f"t{i}": i for i in range(3000)}, rng.random(3000) + 1, (1.0, 1.0))
    shipped = pickle.dumps(model)
    assert len(shipped) < 8 * model.places.nbytes // 4 + 20 * 3000
    assert model.vectors == 101 and model.rows[0].tolist() == [1, 1] and model.none == 0.0
    back = pickle.loads(shipped).index
    each = T.BlockMaxIndex([T.vector(p, c, model.weight) for _, _, p, c in [*rows[:100], rows[-1]]], 3000)
    assert (back.own_weight == each.own_weight).all() and (back.own_term == each.own_term).all() and (back.own_first == each.own_first).all()


def test_terms_of_many_texts_are_those_of_each():
    """Distinct runs are looked up for all texts at once; the terms are the
    whole texts' words and stems."""
    odd = ["Straße İstanbul ΟΔΟΣ", "a_b 12c3d x\x1cy z\x00w", "naïve café long-word's", "Ⅷ² ①words égalités", "wordwords 😀wordy",
           "\u0085next line", "don't WORDSMITH wordsmith, (wordsmith)"]
    rng = np.random.default_rng(3)
    texts = [None, "", " \n", *odd, *(" ".join(rng.choice(odd, 3)) for _ in range(2 * T.TEXTS)), None]
    words = [T._WORD.findall((t or "").lower()) for t in texts]
    names = sorted({t for ws in words for w in ws for t in T.word_terms(w)} - {"wordy"})
    parts = list(T.term_counts(texts, pa.array(names, pa.string())))
    assert [len(p) for p in parts] == [T.TEXTS, T.TEXTS, len(texts) - 2 * T.TEXTS]
    for ws, (places, counts) in zip(words, [v for p in parts for v in p], strict=True):
        want = Counter(t for w in ws for t in T.word_terms(w) if t != "wordy")
        assert {names[p]: n for p, n in zip(places, counts, strict=True)} == want and (np.diff(places) > 0).all()
    assert list(T.term_counts([], pa.array(names))) == [] and not len(next(T.term_counts(["word"], pa.array([], pa.string())))[0][0])


def test_index_of_counts_is_small_and_exact(monkeypatch):
    """An executor holds an index in each of its Python workers: beside the
    vectors' terms, it takes less than 12 bytes a posting (it took over 30)."""
    monkeypatch.setattr(T, "DENSE", 8)
    monkeypatch.setattr(T, "PART", 20_000)
    rng = np.random.default_rng(7)
    n, terms = 1500, 600
    rows = [(i, i % 2, np.sort(rng.choice(terms, 100, replace=False)), np.maximum(rng.geometric(0.8, 100), 1)) for i in range(n)]
    rows[5][3][:3] = 300, 70_000, 2
    model = T.Model(rows, {f"t{i}": i for i in range(terms)}, rng.random(terms) + 1, (1.0, 1.0))
    index = pickle.loads(pickle.dumps(model)).index
    vectors = [T.vector(p, c, model.weight) for _, _, p, c in rows]
    queries = [*vectors[:40], *((p[:6], w[:6]) for p, w in vectors[40:60])]
    got = list(index.nearest_many(queries, 15))
    held = {id(v): v.nbytes for k, v in vars(index).items() if isinstance(v, np.ndarray) and k not in ("own_term", "own_value", "dense")}
    assert sum(held.values()) < 12 * n * 100
    full = np.zeros((n, terms))
    for r, (p, w) in zip(full, vectors, strict=True):
        r[p] = w
    for (p, w), (ids, cos) in zip(queries, got, strict=True):
        want = full[:, p] @ w
        assert ids.tolist() == np.lexsort((np.arange(n), -np.round(want, 12)))[:15].tolist()
        np.testing.assert_allclose(cos, np.minimum(want[ids], 1), atol=1e-12)


def test_model_is_broadcast_once(spark, frame, monkeypatch):
    """Calibration and scoring use one broadcast: a worker never holds two
    models with their indexes."""
    sent, broadcast = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda sc, v: sent.append(type(v)) or broadcast(sc, v))
    docs, labels = corpus(100)
    df = frame(docs, DOC)
    model = T.fit(df, frame(labels, LAB))
    out = {r["doc_id"]: r["toxicity"] for r in T.scored(df, model).collect()}
    assert sent.count(T.Model) == 1
    assert len(model.steps[0]) and all((out[i] >= 0.5) == (i % 5 == 0) for i in range(100))
