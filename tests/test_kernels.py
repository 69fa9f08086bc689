import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from twinsift.functions import kernels


def _brute(left, right):
    return np.array([[len(set(a) & set(b)) for b in right] for a in left], dtype=float)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=12, unique=True), min_size=1, max_size=12),
       st.lists(st.lists(st.integers(0, 30), max_size=12, unique=True), min_size=1, max_size=12))
def test_sparse_dot_counts_equal_brute_force(left, right):
    lr, lf, lw, _ = kernels.flatten([np.array(x, dtype=np.int64) for x in left])
    rr, rf, rw, _ = kernels.flatten([np.array(x, dtype=np.int64) for x in right])
    got = kernels.sparse_dot(lr, lf, lw, len(left), rr, rf, rw, len(right))
    assert np.array_equal(got, _brute(left, right))


def test_sparse_dot_chunked_expansion(monkeypatch):
    monkeypatch.setattr(kernels, "EXPAND_CHUNK", 3)
    left = [[1, 2, 3], [2, 3], [9]]
    right = [[2, 3, 4], [1], [3, 9]]
    lr, lf, lw, _ = kernels.flatten([np.array(x) for x in left])
    rr, rf, rw, _ = kernels.flatten([np.array(x) for x in right])
    assert np.array_equal(kernels.sparse_dot(lr, lf, lw, 3, rr, rf, rw, 3), _brute(left, right))


def test_topk_ties_break_by_partner_rank():
    s = np.array([[0.5, 0.9, 0.9, 0.9]])
    valid = np.array([[True, True, True, False]])
    r, c = kernels.topk_per_row(s, valid, np.array([40, 30, 20, 10]), 2)
    assert list(c) == [2, 1]  # ids 20 then 30; id 10 is masked


def test_dense_cosine_zero_vector():
    m = kernels.dense_cosine(np.array([[1.0, 0.0], [0.0, 0.0]]), np.array([[1.0, 0.0]]))
    assert m[0, 0] == 1.0 and m[1, 0] == 0.0


def test_pair_dot_equals_matrix():
    from twinsift.functions import kernels

    rng = np.random.default_rng(7)
    side = lambda n: [np.unique(rng.integers(0, 40, rng.integers(0, 12))) for _ in range(n)]
    left, right = side(9), side(11)
    weights = lambda rows: [rng.random(len(x)) for x in rows]
    l_rows, l_f, l_w, l_len = kernels.flatten(left, weights(left))
    r_rows, r_f, r_w, _ = kernels.flatten(right, weights(right))
    full = kernels.sparse_dot(l_rows, l_f, l_w, 9, r_rows, r_f, r_w, 11)
    i, j = rng.integers(0, 9, 60), rng.integers(0, 11, 60)
    kernels_chunk, kernels.EXPAND_CHUNK = kernels.EXPAND_CHUNK, 17
    try:
        np.testing.assert_allclose(kernels.pair_dot(l_rows, l_f, l_w, l_len, r_rows, r_f, r_w, i, j), full[i, j], atol=1e-12)
    finally:
        kernels.EXPAND_CHUNK = kernels_chunk
