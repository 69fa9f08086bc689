"""Numpy kernels run inside one tile task (bounded input: two row blocks).

A tile holds at most ``2 * block_rows`` rows, so every array here is bounded
by the block size, never by the table size.
"""

from __future__ import annotations

import numpy as np

EXPAND_CHUNK = 4_000_000  # partial products materialised at once (light features)
DENSE_COL_CHUNK = 512     # heavy features turned into dense columns at once
DENSE_RATIO = 64          # a feature goes dense when df_l * df_r > n_left * n_right / DENSE_RATIO


def flatten(lists, with_weights=None):
    """Arrays-of-arrays (pandas object column) -> (row index, values[, weights])."""
    n = len(lists)
    lens = np.fromiter((0 if a is None else len(a) for a in lists), dtype=np.int64, count=n)
    rows = np.repeat(np.arange(n, dtype=np.int64), lens)
    if lens.sum() == 0:
        vals = np.zeros(0, dtype=np.int64)
    else:
        vals = np.concatenate([np.asarray(a, dtype=np.int64) for a in lists if a is not None and len(a)])
    if with_weights is None:
        return rows, vals, np.ones(len(vals), dtype=np.float64), lens
    if lens.sum() == 0:
        w = np.zeros(0, dtype=np.float64)
    else:
        w = np.concatenate([np.asarray(a, dtype=np.float64) for a in with_weights if a is not None and len(a)])
    return rows, vals, w, lens


def sparse_dot(l_rows, l_feat, l_w, n_left, r_rows, r_feat, r_w, n_right):
    """Dense ``n_left x n_right`` matrix of sparse dot products.

    Features shared by many rows of both sides go through a dense matrix
    product (BLAS); the rest through a sort-merge expansion done in chunks, so
    memory stays bounded whatever the feature frequencies are.
    """
    out = np.zeros(n_left * n_right, dtype=np.float64)
    if n_left == 0 or n_right == 0 or len(l_feat) == 0 or len(r_feat) == 0:
        return out.reshape(n_left, n_right)
    uniq, inv = np.unique(np.concatenate([l_feat, r_feat]), return_inverse=True)
    li, ri = inv[: len(l_feat)], inv[len(l_feat):]
    v = len(uniq)
    df_l = np.bincount(li, minlength=v)
    df_r = np.bincount(ri, minlength=v)
    work = df_l * df_r
    heavy = work * DENSE_RATIO > n_left * n_right
    # heavy features: dense columns, matrix product
    hv = np.flatnonzero(heavy & (work > 0))
    if hv.size:
        hid = np.full(v, -1, dtype=np.int64)
        hid[hv] = np.arange(hv.size)
        lh, rh = hid[li], hid[ri]
        # entries sorted by dense column, so each chunk is a slice
        lo, ro = np.argsort(lh, kind="stable"), np.argsort(rh, kind="stable")
        lh_s, rh_s = lh[lo], rh[ro]
        acc = out.reshape(n_left, n_right)
        for c0 in range(0, hv.size, DENSE_COL_CHUNK):
            c1 = min(c0 + DENSE_COL_CHUNK, hv.size)
            la, lb = np.searchsorted(lh_s, [c0, c1])
            ra, rb = np.searchsorted(rh_s, [c0, c1])
            a = np.zeros((n_left, c1 - c0))
            b = np.zeros((n_right, c1 - c0))
            # features are distinct within a row: plain assignment, no scatter-add
            a[l_rows[lo[la:lb]], lh_s[la:lb] - c0] = l_w[lo[la:lb]]
            b[r_rows[ro[ra:rb]], rh_s[ra:rb] - c0] = r_w[ro[ra:rb]]
            acc += a @ b.T
    # light features: expansion of matching entries
    order = np.argsort(ri, kind="stable")
    ri_s, r_rows_s, r_w_s = ri[order], r_rows[order], r_w[order]
    start = np.searchsorted(ri_s, np.arange(v))
    sel = (~heavy[li]) & (df_r[li] > 0)
    e_feat, e_row, e_w = li[sel], l_rows[sel], l_w[sel]
    cnt = df_r[e_feat]
    csum = np.cumsum(cnt)
    a = 0
    while a < cnt.size:
        done = int(csum[a - 1]) if a else 0
        b = max(int(np.searchsorted(csum, done + EXPAND_CHUNK, side="right")), a + 1)
        c = cnt[a:b]
        tot = int(c.sum())
        if tot:
            pos = np.repeat(start[e_feat[a:b]] - (np.cumsum(c) - c), c) + np.arange(tot)
            idx = np.repeat(e_row[a:b], c) * n_right + r_rows_s[pos]
            out += np.bincount(idx, weights=np.repeat(e_w[a:b], c) * r_w_s[pos], minlength=n_left * n_right)
        a = b
    return out.reshape(n_left, n_right)


def pair_dot(l_rows, l_feat, l_w, l_len, r_rows, r_feat, r_w, i, j):
    """Sparse dot products of the pairs (i, j) only: each feature of the left
    row is looked up among those of the right row, in chunks."""
    out = np.zeros(len(i))
    if not len(i) or not len(l_feat) or not len(r_feat):
        return out
    uniq, inv = np.unique(np.concatenate([l_feat, r_feat]), return_inverse=True)
    l_code, r_key = inv[: len(l_feat)].astype(np.int64), r_rows.astype(np.int64) * len(uniq) + inv[len(l_feat):]
    order = np.argsort(r_key, kind="stable")
    r_key, r_w = r_key[order], r_w[order]
    start, size = np.cumsum(l_len) - l_len, l_len[i]
    ends = np.cumsum(size)
    a = 0
    while a < len(i):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + EXPAND_CHUNK, side="right")))
        n = size[a:b]
        pair = np.repeat(np.arange(a, b), n)
        at = np.arange(n.sum()) + np.repeat(start[i[a:b]] - (np.cumsum(n) - n), n)
        key = j[pair] * np.int64(len(uniq)) + l_code[at]
        found = np.minimum(np.searchsorted(r_key, key), len(r_key) - 1)
        hit = r_key[found] == key
        out += np.bincount(pair[hit], weights=l_w[at[hit]] * r_w[found[hit]], minlength=len(i))
        a = b
    return out


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows of length one in float64; zero rows stay zero."""
    m = np.asarray(m, dtype=np.float64)
    n = np.linalg.norm(m, axis=1, keepdims=True)
    n[n == 0] = 1.0
    return m / n


def spherical_centres(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Unit centres of a spherical k-means of unit rows, from evenly spaced
    first centres; one axis where there is no row."""
    if not len(x):
        return np.eye(1, max(1, x.shape[1]))
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        sums = np.zeros_like(centres)
        np.add.at(sums, np.argmax(x @ centres.T, axis=1), x)
        length = np.linalg.norm(sums, axis=1)
        centres[length > 1e-9] = sums[length > 1e-9] / length[length > 1e-9, None]
    return centres


def dense_cosine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cosine matrix in float64; zero vectors score 0."""
    if len(left) == 0 or len(right) == 0:
        return np.zeros((len(left), len(right)))
    return unit_rows(left) @ unit_rows(right).T


def stack_vectors(vecs) -> np.ndarray:
    if len(vecs) == 0:
        return np.zeros((0, 0))
    return np.vstack([np.asarray(v, dtype=np.float64) for v in vecs])


def round6(x: np.ndarray) -> np.ndarray:
    """Half-up rounding to 6 decimals (the SQL ``round(x, 6)`` rule) for
    ranking. The product may fall a little below an exact half (41/640), which
    the SQL rule, working on decimals, rounds up."""
    return np.floor(np.asarray(x) * 1e6 + (0.5 + 1e-7)) / 1e6


def topk_per_row(score: np.ndarray, valid: np.ndarray, partner_rank: np.ndarray, k: int):
    """Top-k columns per row by (rounded score desc, partner rank asc).

    Returns (row index, column index). ``valid`` masks pairs that are no
    candidate (self pairs, zero overlap). Ties at the k-th value are resolved
    exactly by partner rank, never arbitrarily.
    """
    n_rows, n_cols = score.shape
    if n_rows == 0 or n_cols == 0:
        e = np.zeros(0, dtype=np.int64)
        return e, e
    key = np.where(valid, round6(score), -np.inf)
    if n_cols > k:
        kth = -np.partition(-key, k - 1, axis=1)[:, k - 1]
        cand = valid & (key >= kth[:, None])
    else:
        cand = valid
    r, c = np.nonzero(cand)
    if r.size == 0:
        return r, c
    order = np.lexsort((partner_rank[c], -key[r, c], r))
    r, c = r[order], c[order]
    first = np.r_[True, r[1:] != r[:-1]]
    grp_start = np.maximum.accumulate(np.where(first, np.arange(r.size), 0))
    keep = (np.arange(r.size) - grp_start) < k
    return r[keep], c[keep]
