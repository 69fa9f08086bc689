import hashlib

import pytest
from pyspark.sql import functions as F

from twinsift.llm import mixing as M
from twinsift.llm import queries

DOC = "doc_id long, text string, source string"


def brute_targets(sizes, share=1.0, cap=3.0):
    """Reshare the excess by weight until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), share * sum(sizes.values())
    while free:
        w = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / w > cap * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / w for s in free}
        for s in over:
            target[s] = cap * sizes[s]
            free.remove(s)
        left = share * sum(sizes.values()) - sum(target.values())
    return target


def brute(rows, seed=7):
    out, size = [], lambda t: len((t or "").encode().split())
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    targets = brute_targets(sizes)
    for s, total in sizes.items():
        own = {}
        for i, t, x in rows:
            if x == s:
                name = i if i is not None else ("" if t is None else hashlib.md5(t.encode()).hexdigest())
                own.setdefault(int(hashlib.md5(f"{seed}:{name}".encode()).hexdigest()[:15], 16), []).append((i, size(t)))
        epochs = int(targets[s] / total + 1e-9) if total else 0
        rest, before = targets[s] - epochs * total, 0
        for key in sorted(own):
            k = sum(n for _, n in own[key])
            more = rest > 0 and before + k / 2 <= rest
            out += [(i, n, total, pytest.approx(targets[s]), (epochs + more) * n) for i, n in own[key]]
            before += k
    return out


ROWS = [(i, "w " * (i * 7 % 23), ["a", "b", "c", "d", "é", "Z", None][i % 7] if i % 3 else "hot") for i in range(300)]
ROWS += [(7, None, "a"), (8, "", "tiny"), (9, "one", "tiny2"), (9, "one", "tiny2"), (None, "x y", "a"), (None, None, None), (10, " \t\x0b\x0c\r\nq\x1cz  r ", "b")]


@pytest.mark.parametrize("slice_rows", [3, 2000])
def test_brute_force(spark, frame, slice_rows):
    got = M.mix(frame(ROWS, DOC), slice_rows=slice_rows).select("doc_id", "size", "source_size", "target", "taken").collect()
    key = lambda r: (str(r[0]), r[1], r[2])
    assert [tuple(r) for r in sorted(map(tuple, got), key=key)] == sorted(brute(ROWS), key=key)


def test_rows_of_the_mix(spark, frame):
    docs = frame(ROWS, DOC)
    copies = {}
    for r in M.mix(docs).collect():
        copies[r["doc_id"], r["source"], r["size"]] = copies.get((r["doc_id"], r["source"], r["size"]), 0) + r["copies"]
    got = {}
    for r in M.mixed(docs).withColumn("z", M.word_count(F.col("text"))).collect():
        k = (r["doc_id"], r["source"], r["z"])
        got[k] = got.get(k, 0) + 1
    assert got == {k: v for k, v in copies.items() if v}


def test_empty(spark, frame):
    assert M.mix(frame([], DOC)).count() == 0 and M.mixed(frame([], DOC)).count() == 0
    assert [r["taken"] for r in M.mix(frame([(1, "", "a")], DOC)).collect()] == [0]


def test_query_sql(spark):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = sorted(con.sql(queries.ORACLE_SQL["op7_mixing"]).fetchall())
    got = sorted(tuple(r) for r in queries.op7_mixing(spark, sf).select("doc_id", "size", "source_size", "target", "taken").collect())
    assert [w[:3] + w[4:] for w in want] == [g[:3] + g[4:] for g in got]
    assert [w[3] for w in want] == pytest.approx([g[3] for g in got])
