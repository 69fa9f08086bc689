import random
import re

import pytest
import xxhash

from twinsift.llm import queries
from twinsift.llm import simhash as S

DOC = "doc_id long, text string"


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    fps = sorted(set(fps))
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


@pytest.mark.parametrize("text", [None, "", " \n", "one", "One two", "A b C d e", "É x É x É x É", "w " * 500])
def test_fingerprint(text):
    assert S.fingerprint(text) == brute_fingerprint(text)


def test_chunks_of_a_long_text(monkeypatch):
    text = " ".join(str(i % 97) for i in range(400))
    monkeypatch.setattr(S, "_CHUNK", 7)
    assert S.fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("hot", [1, 4, 48])
def test_links_and_components_of_planted_fingerprints(spark, hot):
    """Random ones, pairs at 1, 2 and 3 bits, chains, and a group within two
    bits of a centre that is larger than a hot variant."""
    rnd = random.Random(5)
    fps = [rnd.getrandbits(64) for _ in range(60)] + [0, 1, 2**63, 2**64 - 1, 2**64 - 1 - 2**31]
    for n in (1, 2, 3):
        for f in list(fps[:8]):
            for b in rnd.sample(range(64), n):
                f ^= 1 << b
            fps.append(f)
    centre = rnd.getrandbits(64)
    for _ in range(80):
        i, j = rnd.sample(range(64), 2)
        fps.append(centre ^ (1 << i) ^ (1 << j))
    f = rnd.getrandbits(64)
    for _ in range(12):
        i, j = rnd.sample(range(64), 2)
        f ^= (1 << i) ^ (1 << j)
        fps.append(f)
    fps = sorted(set(fps))
    signed = lambda x: x - 2**64 if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    edges = [(r["src"], r["dst"]) for r in S.links(df, hot=hot).collect()]
    want = brute_components(fps)
    roots = {signed(f): f for f in fps} | {}
    got = {r["node"]: r["root"] for r in S.components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    classes = lambda m: {frozenset(k for k in m if m[k] == v) for v in set(m.values())}
    assert classes({x: got.get(x, x) for x in roots}) == classes({signed(k): signed(v) for k, v in want.items()})


def test_documents(spark, frame):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(5, base), (3, base), (3, base), (9, base.upper()), (7, None), (8, ""), (1, "quite another text"), (None, base), (None, "alone here")]
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in S.near_duplicates(frame(rows, DOC)).collect()}
    want = set()
    for i, t in rows:
        f = brute_fingerprint(t)
        near = [k for k, x in rows if k is not None and (brute_fingerprint(x) ^ f).bit_count() <= 2]
        want.add((i, f"{f:016x}", min(near) if near else None))
    assert got == want
    assert S.near_duplicates(frame(rows, DOC)).count() == len(rows)
    assert S.near_duplicates(frame([], DOC)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    fp = {i: brute_fingerprint(t) for i, t in rows}
    root = brute_components(fp.values())
    least = {}
    for i, f in fp.items():
        least[root[f]] = min(i, least.get(root[f], i))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op9_simhash(spark, sf).collect()}
    assert got == {i: (f"{f:016x}", least[root[f]]) for i, f in fp.items()}


def test_variants_against_bits(spark):
    """Each of the 64 bits out once, within its segment; each two out once."""
    fps = [0, 1, 2**63, 2**64 - 1, 0x0123456789ABCDEF, 0xFEDCBA9876543210, 1 << 31, 1 << 32]
    signed = lambda x: x - 2**64 if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    want = set()
    for f in fps:
        for i in range(64):
            half, b = f >> (i & 32) & 0xFFFFFFFF, i & 31
            want.add((signed(f), i << 32 | half >> b + 1 << b | half & (1 << b) - 1))
    got = [tuple(r) for r in S.variants(df).collect()]
    assert len(got) == 64 * len(fps) and set(got) == want
    want = {(signed(f), i * 64 + j, signed(f & ~(1 << i | 1 << j))) for f in fps for i in range(64) for j in range(i + 1, 64)}
    got = [tuple(r) for r in S.without_two(df).collect()]
    assert len(got) == 2016 * len(fps) and set(got) == want


def test_plans_stay_small(spark, monkeypatch):
    """What the driver plans at once does not grow with the bits of a
    fingerprint, and a step of the components reads its edges twice only."""
    sizes, stored = [], S.common.stored

    def watched(df, name):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        sizes.append((name, len(plan), plan.count("Relation [") + plan.count("LogicalRDD [")))
        return stored(df, name)

    monkeypatch.setattr(S.common, "stored", watched)
    rows = [(i, " ".join(f"w{(i // 2) * 50 + j}" for j in range(40 + i % 2))) for i in range(20)]
    S.near_duplicates(spark.createDataFrame(rows, DOC)).collect()
    steps = [s for s in sizes if s[0] in ("cc", "cc-large")]
    assert len(steps) >= 3
    assert max(n for _, _, n in steps[1:]) <= 2
    assert max(n for _, n, _ in sizes) < 12000, sizes


def test_keys_are_dealt_to_tasks(spark, monkeypatch):
    """However few files the fingerprints lie in, a task makes the keys of
    about TASK of them."""
    dealt, variants = [], S.variants
    monkeypatch.setattr(S, "variants", lambda fps: dealt.append(fps.rdd.getNumPartitions()) or variants(fps))
    monkeypatch.setattr(S, "TASK", 10)
    df = spark.range(0, 95, 1, 1).selectExpr("xxhash64(id) as fp")
    assert S.links(df).count() == 0
    assert dealt == [10]
