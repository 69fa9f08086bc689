import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from twinsift.llm import max_sketch as M

DOC, ITEM = "doc_id long, text string", "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t)) if t else []


def brute(docs, items, k):
    own = [(i, Counter(terms(t))) for i, t in docs]
    own = [(i, c) for i, c in own if c]
    n_docs, total = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    least = {}
    for i, t in items:
        least[i] = t if i not in least or least[i] is None else least[i] if t is None else min(least[i], t)
    out = set()
    for item, text in least.items():
        found = []
        for i, c in own:
            m = 50 + 50 * sum(c.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if s > 0:
                found.append((-s, i is None, i))
        out |= {(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)}
    return out


def got(d, i, **more):
    return {tuple(r) for r in M.search(d, i, **more).select("item_id", "rank", "doc_id", "score").collect()}


def fixture(seed, n=150):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["ÄRA", "naïve", "Straße", "中文", "x_y", "a-b"]
    text = lambda m: " ".join(rnd.choice(vocabulary[: 5 + rnd.randrange(61)]) + rnd.choice(["", ".", ",\n", "--", "\x7f", "\x00"]) for _ in range(m))
    docs = [(i, text(rnd.randint(1, 40))) for i in range(n)]
    docs += [(n + i, docs[0][1]) for i in range(60)] + [(n + 70, None), (n + 71, ""), (n + 72, " .;- "), (n + 73, text(5000)), (3, docs[3][1]), (3, text(9)), (None, text(12))]
    items = [(i, text(rnd.randint(1, 12))) for i in range(12)] + [(20, None), (21, "--"), (22, "nowhere to be found"), (23, "W1 w1 W2"), (23, "a w3"), (None, "w5 w6"), (24, text(900))]
    return docs, items


@pytest.mark.parametrize("batch_items", [1000, 4])
def test_against_brute_force(spark, frame, batch_items):
    docs, items = fixture(batch_items)
    assert got(frame(docs, DOC).repartition(5), frame(items, ITEM), k=10, batch_items=batch_items) == brute(docs, items, 10)


def test_empty_tables_and_few_documents(spark, frame):
    docs, items = [(1, "a b"), (2, "b c"), (3, "a b")], [(1, "a"), (2, "z")]
    assert got(frame(docs, DOC), frame(items, ITEM)) == brute(docs, items, 50)
    assert got(frame([], DOC), frame(items, ITEM)) == set() == got(frame(docs, DOC), frame([], ITEM))
    assert got(frame([(1, None), (2, "")], DOC), frame(items, ITEM)) == set()


def test_terms():
    for t in ("Ab-c_d", "x\x00y\x7fz", "ÄÖ straße", "a1B2 中文,字", "\ud800 a", None, "", "  "):
        assert [x.decode("utf-8", "surrogatepass") for x in M.terms(t)] == terms(t)


def test_look_ups_are_never_below_the_impacts():
    import xxhash
    rnd = random.Random(2)
    for n in (1, 3, 40, 700):
        counts = {f"t{i}".encode(): rnd.randint(1, 50) for i in range(n)}
        m = rnd.randint(50, 5000)
        s = np.frombuffer(M.sketch(counts, m), np.uint8)
        assert len(s) >= M.PLACES_PER_TERM * n and len(s) & (len(s) - 1) == 0
        impact = M.impacts(np.array(list(counts.values())), m)
        code = s[[xxhash.xxh64_intdigest(t) & (len(s) - 1) for t in counts]]
        assert (M.LEVELS[code] >= impact).all()
        assert (M.LEVELS[code] <= max(impact) * 1.06 + 1).all()
    assert M.LEVELS[-1] == 10**6 and len(M.LEVELS) <= 256


def test_most_documents_are_not_scored(spark):
    """A document whose bound stays below the threshold is never read."""
    docs = spark.createDataFrame([(i, f"rare{i} common words of no use") for i in range(2000)] + [(9000 + i, "the wanted phrase " * (i + 1)) for i in range(20)], DOC)
    items = spark.createDataFrame([(1, "the wanted phrase")], ITEM)
    b = M.Batch([(1, "the wanted phrase")])
    n_docs, n_terms, df = M.counted(docs, b)
    b.weight = M.weights(n_docs, df)
    index = M.written_index(docs, n_docs, n_terms).toArrow()
    bound = b.bounds(index.column("sketch").combine_chunks() if index.column("sketch").num_chunks != 1 else index.column("sketch").chunk(0))[:, 0]
    tenth = sorted((s for _, _, _, s in got(docs, items, k=10)), reverse=True)[-1]
    assert (bound >= tenth).sum() < 200
