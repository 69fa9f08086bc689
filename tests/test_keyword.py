import math
import re

from pyspark.sql import functions as F

from twinsift.operators.hybrid import hybrid_topk
from twinsift.operators.candidates import similarity_pairs
from twinsift.operators.keyword import bm25_self_topk, bm25_topk
from twinsift.operators.tiles import skew_join

WORD = re.compile(r"[^\w]+", re.UNICODE)


def _toks(t):
    return [x for x in WORD.split(t.lower()) if x]


def test_bm25_matches_brute_force(spark):
    docs = [(1, "the cat sat on the mat"), (2, "the dog sat"), (3, "cats and dogs"), (4, "the the the")]
    queries = [(10, "cat on mat"), (11, "the dog"), (12, "zebra")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(queries, "item_id long, text string")
    got = {(r.original_id, r.potential_duplicate_id): r.bm25_score
           for r in bm25_topk(q, "item_id", "text", d, "doc_id", "text", 4).collect()}
    n = len(docs)
    toks = {i: _toks(t) for i, t in docs}
    avgdl = sum(len(v) for v in toks.values()) / n
    df = {}
    for v in toks.values():
        for w in set(v):
            df[w] = df.get(w, 0) + 1
    expect = {}
    for qid, qt in queries:
        for did, dt in toks.items():
            s = 0.0
            for w in set(_toks(qt)):
                tf = dt.count(w)
                if tf:
                    idf = math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
                    s += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(dt) / avgdl))
            if s > 0:
                expect[(qid, did)] = round(s, 6)
    assert got.keys() == expect.keys()
    assert all(abs(got[k] - expect[k]) < 1e-6 for k in got)


def _short_queries(spark, seed=3, n=300):
    import random
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(80)]
    text = lambda m: " ".join(["stop"] * (rnd.random() < 0.9) + [words[min(79, int(rnd.expovariate(0.08)))] for _ in range(m)])
    docs = [(i, text(rnd.randint(1, 30))) for i in range(n)] + [(n, None), (n + 1, ""), (n + 2, "w79 w79 w78")]
    queries = [(i, text(rnd.randint(1, 6))) for i in range(25)] + [(25, "stop"), (26, "zebra"), (27, None), (28, "w78 w79 stop"), (3, "w79 more")]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(queries, "item_id long, text string")


def test_max_score_equals_tiles(spark):
    d, q = _short_queries(spark)
    q = q.groupBy("item_id").agg(F.concat_ws(" ", F.collect_list("text")).alias("text"))
    key = lambda df: sorted(map(tuple, df.collect()))
    for k in (1, 4, 400):
        a = bm25_topk(q, "item_id", "text", d, "doc_id", "text", k, plan="max_score")
        assert key(a) == key(bm25_topk(q, "item_id", "text", d, "doc_id", "text", k))
    both = bm25_topk(q.withColumnRenamed("item_id", "doc_id"), "doc_id", "text", d, "doc_id", "text", 3, exclude_same_id=True, plan="max_score")
    assert both.where("original_id = potential_duplicate_id").count() == 0
    assert bm25_topk(q.limit(0), "item_id", "text", d, "doc_id", "text", 3, plan="max_score").count() == 0


def test_common_words_are_not_expanded(spark):
    """Queries of one rare and three stop words: postings of the stop words,
    nine tenths of all, stay unexpanded."""
    from twinsift.operators import keyword

    docs = [(i, "the of and " + (f"rare{i // 6}" if i % 3 == 0 else f"other{i}")) for i in range(1200)]
    queries = [(i, f"the of and rare{i}") for i in range(40)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(queries, "item_id long, text string")
    postings, terms = keyword._postings(q, "item_id", "text", d, "doc_id", "text")
    essential, rest = keyword._essential(postings, terms, 1)
    every, expanded = (t.agg(F.sum("df")).first()[0] for t in (terms, essential))
    assert expanded < 0.01 * every and rest.select("h").distinct().count() == 3


def test_hybrid_reports_cosine_and_fuses_ranks(spark):
    rows = [(1, "alpha beta gamma delta epsilon"), (2, "alpha beta gamma delta epsilon"),
            (3, "alpha beta gamma zeta eta"), (4, "omega psi chi phi upsilon")]
    df = spark.createDataFrame(rows, "id long, text string")
    got = hybrid_topk(df, "id", "text", 2).collect()
    top = {(r.original_id, r.potential_duplicate_id): r for r in got}
    assert top[(1, 2)].search_score == 1.0
    assert all(0.0 <= r.search_score <= 1.0 for r in got)
    assert top[(1, 2)].rrf_score == round(2 / 61, 9)


def test_hybrid_fuses_complete_ranks(spark):
    """All partners ranked in both legs by brute force; a short list depth
    would lose partners that rank well in neither list but in both legs."""
    import random
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rnd.choice(words[: 8 + i % 32]) for _ in range(rnd.randint(2, 14)))) for i in range(160)]
    df = spark.createDataFrame(rows, "id long, text string")
    got = {}
    for r in hybrid_topk(df, "id", "text", 3, text_mode="words").collect():
        got.setdefault(r.original_id, []).append((r.potential_duplicate_id, r.rrf_score, r.search_score))
    full = lambda rows, s: {o: sorted(v, key=lambda x: (-x[1], x[0])) for o, v in _group(rows, s).items()}
    n = len(rows)
    vec = full(similarity_pairs(df, n, "exact", "words").collect(), "search_score")
    kw = full(bm25_self_topk(df, "id", "text", n).collect(), "bm25_score")
    for o, _ in rows:
        total = {}
        for leg in (vec, kw):
            for rank, (p, _) in enumerate(leg.get(o, []), 1):
                total[p] = total.get(p, 0) + 1 / (60 + rank)
        want = sorted(((p, round(t, 9), dict(vec.get(o, [])).get(p, 0.0)) for p, t in total.items()), key=lambda x: (-x[1], x[0]))[:3]
        assert sorted(got.get(o, []), key=lambda x: (-x[1], x[0])) == want


def _group(rows, score):
    out = {}
    for r in rows:
        out.setdefault(r.original_id, []).append((r.potential_duplicate_id, r[score]))
    return out


def test_skew_join_spreads_hot_key_and_keeps_rows(spark):
    big = spark.createDataFrame([(i, 7 if i % 3 == 0 else i) for i in range(3000)], "id long, k long")
    small = spark.createDataFrame([(7, "hot")] + [(i, f"v{i}") for i in range(3000) if i != 7], "k long, v string")
    out = skew_join(big, small, "k", 3000, salts=8)
    assert out.count() == 3000
    assert out.where(F.col("v") == "hot").count() == 1000 + (1 if 7 % 3 else 0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan


def test_index_bounds_its_batches(spark):
    """Batches of 10,000 long texts filled an executor's Python."""
    from twinsift.functions.vectorize import WEIGHT_ROWS, bm25_index

    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    was = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], "10000")
        spark.conf.set(keys[1], str(256 << 20))
        rows = [(i, f"common w{i % 7} " * (1 + i % 3)) for i in range(2 * WEIGHT_ROWS + 9)] + [(9999, None), (9998, "")]
        vectors, _, n, _ = bm25_index(spark.createDataFrame(rows, "id long, text string").coalesce(1), "id", "text")
        got = {r["id"]: (r["f"], r["w"]) for r in vectors.collect()}
        assert int(spark.conf.get(keys[0])) <= 4096 and int(spark.conf.get(keys[1])) <= 8 << 20
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert n == len(rows) == len(got) and got[9998] == ([], [])
    assert all(len(got[i][0]) == 2 for i in range(2 * WEIGHT_ROWS + 9)) and got[0] == got[21]
