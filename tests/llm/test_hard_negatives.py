import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinsift.llm import hard_negatives as H
from test_exact_topk import dot, ints

ROW = "vec_id long, embedding array<double>, label int"


def brute(rows, positives=5, negatives=3, low=50, high=95, every=5):
    at = {}
    for i, v, label in rows:
        v = ints(v)
        if i is not None and v is not None and label is not None and (i not in at or (v, str(label)) < at[i]):
            at[i] = (v, str(label))
    out = set()
    for a, (v, label) in at.items():
        if a % every:
            continue
        order = sorted((-dot(v, w), i, x) for i, (w, x) in at.items() if i != a)
        for s, p, _ in [o for o in order if o[2] == label][:positives]:
            fit = [o for o in order if o[2] != label and low * -s <= 100 * -o[0] <= high * -s][:negatives]
            out |= {(a, p, r, i, -s, -t) for r, (t, i, _) in enumerate(fit, 1)}
    return out


def got(df, **more):
    out = H.mine(df, "vec_id", "embedding", "label", F.col("id") % 5 == 0, **more)
    return {tuple(r) for r in out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()}


def fixture(seed, n=150, dim=5):
    rnd = random.Random(seed)
    centres = [[rnd.uniform(-1, 1) for _ in range(dim)] for _ in range(4)]
    near = lambda c, d: [x + rnd.uniform(-d, d) for x in c]
    rows = [(i, centres[0] if i % 3 == 0 else near(centres[i % 4], 0.4), (i // 2) % 3) for i in range(n)]
    rows += [(n + 1, [0.0] * dim, 0), (n + 2, [0.0] * dim, 1), (n + 5, [0.0] * dim, 1), (900, None, 1), (905, [None] * dim, 1), (910, [float("nan")] * dim, 1),
             (915, centres[1], None), (None, centres[1], 1), (0, centres[2], 2), (0, centres[2], 1), (920, [], 1), (925, [30.0] * dim, 2), (930, centres[1][:2], 0)]
    return rows


@pytest.mark.parametrize("references", [1, 7])
def test_against_brute_force(spark, frame, references):
    rows = fixture(references)
    assert got(frame(rows, ROW), references=references, rows_per_block=32, anchors_per_block=8, window=4) == brute(rows)


def test_other_numbers_and_small_tables(spark, frame):
    rows = fixture(5, n=40)
    assert got(frame(rows, ROW), positives=2, negatives=1, low=0, high=100) == brute(rows, 2, 1, 0, 100)
    assert got(frame([], ROW)) == set()
    assert got(frame([(0, [1.0], 1), (1, [1.0], 1)], ROW)) == set()  # no other label
    assert got(frame([(0, [1.0], 1), (1, [1.0], 2)], ROW)) == set()  # no positive


def test_bounds_hold_and_skip_windows():
    """Every score lies in its window's interval; on clustered vectors most
    windows are ruled out for a narrow range of scores."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 16))
    x = np.floor(256 * (centres[rng.integers(0, 8, 1024)] + 0.05 * rng.normal(size=(1024, 16)))).astype(np.int64)
    u, norm = H.unit(x)
    refs, _ = H.unit(centres)
    angle = H.angles(u, refs)
    order = np.lexsort((angle.min(axis=1), angle.argmin(axis=1)))
    x, angle, norm = x[order], angle[order], norm[order]
    cuts = np.arange(0, 1024, 32)
    least, greatest = H.score_bounds(angle[::50], norm[::50], np.minimum.reduceat(angle, cuts), np.maximum.reduceat(angle, cuts),
                                     np.minimum.reduceat(norm, cuts), np.maximum.reduceat(norm, cuts))
    s = x[::50] @ x.T
    assert (np.minimum.reduceat(s, cuts, axis=1) >= least).all() and (np.maximum.reduceat(s, cuts, axis=1) <= greatest).all()
    best = np.sort(s, axis=1)[:, -5]
    assert (greatest >= best[:, None]).mean() < 0.4
