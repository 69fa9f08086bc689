import math
import random

import pytest
from pyspark.sql import functions as F

from twinsift.llm import exact_topk as T
from twinsift.llm import vectors

VEC = "vec_id long, embedding array<double>"


def ints(v):
    if v is None or any(x is None or math.isnan(x) or math.isinf(x) for x in v):
        return None
    return [math.floor(256 * x) for x in v]


def one_a_row(rows):
    out = {}
    for i, v in rows:
        v = ints(v)
        if i is not None and v is not None and (i not in out or v < out[i]):
            out[i] = v
    return out


def dot(a, b):
    return sum(x * y for x, y in zip(a, b, strict=False))


def brute(rows, k, every):
    at = one_a_row(rows)
    out = set()
    for q in at:
        if q % every == 0:
            order = sorted((-dot(at[q], at[i]), i) for i in at if i != q)[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(order, 1)}
    return out


def got(df, **more):
    return {tuple(r) for r in T.top_k(df, "vec_id", "embedding", F.col("id") % 5 == 0, **more).select("query_id", "rank", "id", "score").collect()}


def fixture(seed, n=90, dim=6):
    rnd = random.Random(seed)
    point = lambda: [rnd.uniform(-1, 1) for _ in range(dim)]
    same = point()
    rows = [(i, same if i % 3 == 0 else [0.0] * dim if i % 17 == 0 else point()) for i in range(n)]
    rows += [(n + i, [x + rnd.uniform(0, 0.01) for x in same]) for i in range(10)]
    rows += [(500, None), (505, [None] + same[1:]), (510, [math.nan] + same[1:]), (515, [math.inf] + same[1:]), (None, point()),
             (5, point()), (5, rows[5][1]), (520, []), (525, same[:2]), (-10, point()), (530, [2000.5] * dim)]
    return rows


@pytest.mark.parametrize("nodes", [1, 2, 4])
def test_against_brute_force(spark, frame, nodes):
    rows = fixture(nodes)
    assert got(frame(rows, VEC), k=5, nodes=nodes, rows_per_block=16, queries_per_block=8) == brute(rows, 5, 5)


def test_few_rows_ties_and_empty(spark, frame):
    rows = [(i, [0.5, 0.5]) for i in range(4)]
    assert got(frame(rows, VEC), k=5) == brute(rows, 5, 5)
    assert got(frame([], VEC), k=5) == set()
    assert got(frame([(0, [1.0])], VEC), k=5) == set()
    negative = [(0, [1.0, 1.0]), (1, [-1.0, 0.0]), (2, [-0.5, -0.5]), (3, [-0.25, 0.0]), (4, [-1.0, -1.0]), (6, [0.0, -0.5]), (7, [-0.1, 0.0])]
    assert got(frame(negative, VEC), k=3, nodes=2) == brute(negative, 3, 5)


def test_large_components(spark, frame):
    rows = [(i, [float(i * 1000), -7.0, 4_000_000.0 - i]) for i in range(20)]
    assert got(frame(rows, VEC), k=4, nodes=2) == brute(rows, 4, 5)
    with pytest.raises(Exception, match="too large"):
        got(frame([(0, [1e9])], VEC), k=1)


def test_lists_do_not_hold_all_pairs(spark):
    """On random vectors few entries reach the cutoffs."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    seen = []
    keep = T.common.stored
    try:
        T.common.stored = lambda d, name: (lambda out: (seen.append(out.count()) if name == "entries" else None, out)[1])(keep(d, name))
        T.top_k(df, "vec_id", "embedding", F.col("id") % 50 == 0).count()
    finally:
        T.common.stored = keep
    assert seen and seen[0] < 0.1 * 40 * 2000


def test_string_ids(spark):
    df = spark.createDataFrame([(f"v{i:02d}", [math.sin(i), math.cos(i)]) for i in range(40)], "vec_id string, embedding array<float>")
    out = T.top_k(df, "vec_id", "embedding", F.col("id") == "v07", k=3).orderBy("rank").collect()
    at = {r.vec_id: ints(r.embedding) for r in df.collect()}
    want = sorted((-dot(at["v07"], v), i) for i, v in at.items() if i != "v07")[:3]
    assert [(-r.score, r.id) for r in out] == want


def test_products_are_exact():
    import numpy as np
    rng = np.random.default_rng(1)
    for most in (200, 10**5, 2**30):
        a, b = rng.integers(-most, most, (5, 7)), rng.integers(-most, most, (6, 7))
        assert (vectors.products(a, b) == a.astype(object) @ b.astype(object).T).all()
    with pytest.raises(OverflowError):
        vectors.products(np.full((1, 4), 2**31), np.full((1, 4), 2**31))
