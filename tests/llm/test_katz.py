import collections
import math
import zlib

import pytest
from pyspark.sql import functions as F

from twinsift.llm import katz, queries

DOC = "doc_id long, text string, h boolean"


def brute(rows, order):
    """rows: (id, text, held). Plain dictionaries; also checks that the
    distribution after every history sums to 1."""
    toks = [((t or "").encode().lower().split() + [katz.END]) for _, t, _ in rows]
    grams = {m: collections.Counter() for m in range(1, order + 1)}
    pad = [katz.START] * (order - 1)
    for (_, _, held), t in zip(rows, toks):
        if not held:
            s = pad + t
            for i in range(len(pad), len(s)):
                for m in grams:
                    grams[m][tuple(s[i - m + 1:i + 1])] += 1

    def discount(c):
        n = collections.Counter(c.values())
        d = katz.discounts([n[r] for r in range(1, katz.CUTOFF + 2)])
        return lambda r: d[r] if r <= katz.CUTOFF else 1.0

    d = {m: discount(c) for m, c in grams.items()}
    total = sum(grams[1].values())
    lost = sum((1 - d[1](c)) * c for c in grams[1].values())
    bottom = total + (1 if total and lost < 1e-9 else 0)
    unknown = (lost if lost >= 1e-9 else 1) / bottom if total else 1.0
    after = {m: collections.defaultdict(dict) for m in grams}
    for m, c in grams.items():
        for g, n in c.items():
            after[m][g[:-1]][g[-1]] = n
    state = {}

    def p(h, w):
        m = len(h) + 1
        if m == 1:
            c = grams[1][(w,)]
            return d[1](c) * c / bottom if c else unknown
        seen = after[m].get(h)
        if not seen:
            return p(h[1:], w)
        if h not in state:
            n = sum(seen.values())
            mass = sum(d[m](c) * c for c in seen.values())
            b = n + (1 if n - mass < 1e-9 * n else 0)
            state[h] = b, (1 - mass / b) / (1 - sum(p(h[1:], x) for x in seen))
        b, alpha = state[h]
        return d[m](seen[w]) * seen[w] / b if w in seen else alpha * p(h[1:], w)

    for m in range(2, order + 1):
        for h in list(after[m])[:40]:
            s = sum(p(h, w) for (w,) in grams[1]) + p(h, b"\0unknown")
            assert s == pytest.approx(1, abs=1e-9)
    out = []
    v = len(grams[1])
    for (i, _, held), t in zip(rows, toks):
        s = pad + t
        out.append((i, held, len(t), sum((w,) in grams[1] for w in t), total,
                    sum(math.log10((grams[1][(w,)] + .1) / (total + .1 * (v + 1))) for w in t),
                    sum(math.log10(p(tuple(s[k - order + 1:k]), s[k])) for k in range(len(pad), len(s)))))
    return out


def same(got, want, near=1e-9):
    key = lambda r: (str(r[0]), r[2], round(r[6], 4))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=near, abs=near)


ROWS = [(i, t, i % 5 == 0) for i, t in enumerate(
    ["the cat sat on the mat", "The cat ate", "a dog sat on a mat", "", None, "the the the the the the the", "unknown words here",
     "the cat sat", "the cat sat", "a b c d e f g", "new", "on the mat", "on a mat the cat sat on the mat"])] + [(3, "a dog", False), (None, "cat", True)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_brute_force(spark, frame, order):
    docs = frame(ROWS, DOC).repartition(3)
    same(katz.score(docs, F.col("h"), order=order, block_tokens=12).collect(), brute(ROWS, order))


def test_nothing_to_learn_and_empty(spark, frame):
    rows = [(1, "a b", True)]
    same(katz.score(frame(rows, DOC), F.col("h")).collect(), brute(rows, 2))
    assert katz.score(frame([], DOC), F.col("h")).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"], zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0)
            for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    same(queries.op4_katz(spark, sf).collect(), brute(rows, 2), 1e-6)  # rounded
