import re

import pytest

from twinsift.llm import quality_rules as Q
from twinsift.llm import queries

DOC = "doc_id long, text string, source string"


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    again = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(8)}
    lines, dup = set(), 0
    for x in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in lines
            lines.add(x)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again)


TEXTS = [None, "", " \n\t", "a b c d e f g h " * 3, "x " * 9, "a b c\x1cd", "l1\nl2\nl1\n\n\n l1", "#*$ %&|<>", "one two\x0bthree\x0cfour\r\nfive",
         "w " * 7 + "q", " ".join(map(str, range(40))), " ".join(map(str, range(30))) + " 1 2 3 4 5 6 7 8"]


@pytest.mark.parametrize("text", TEXTS)
def test_counts(text):
    assert Q.rule_counts(text) == brute(text)


def test_host_verdicts(spark, frame):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, good, "good") for i in range(200)] + [(1000 + i, "short", "bad") for i in range(200)]
    rows += [(2000, good, "bad"), (2001, good, None), (2002, None, None), (2003, "short", "tiny"), (0, good, "good")]
    out = Q.host_level_rules(frame(rows, DOC)).collect()
    assert len(out) == len(rows)
    by = {(r["doc_id"], r["host"]): r for r in out}
    assert by[0, "good"]["kept"] and not by[1000, "bad"]["kept"]
    assert by[2000, "bad"]["host_ok"] is False and not by[2000, "bad"]["base_failed"] and not by[2000, "bad"]["kept"]
    # One failure of one document is shrunk towards the mean of all hosts.
    assert by[2003, "tiny"]["host_rate"] < 1 and by[2002, None]["base_failed"]
    assert by[2001, None]["host_rate"] == by[2002, None]["host_rate"]


def test_clean_corpus_is_kept_and_empty(spark, frame):
    good = " ".join(f"w{i}" for i in range(30))
    out = Q.host_level_rules(frame([(i, good, f"s{i % 7}") for i in range(50)], DOC)).collect()
    assert all(r["kept"] and r["host_rate"] == 0 for r in out)
    assert Q.host_level_rules(frame([], DOC)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = queries.op5_host_rules(spark, sf).collect()
    assert len(out) == len(texts)
    for r in out:
        n = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        if n[0] < 1500:
            assert n == brute(texts[r["doc_id"]])
        assert r["base_failed"] == (n[0] < 20 or 100 * n[4] > 30 * n[0]) and not (r["base_failed"] and r["kept"])


def test_hosts_rejected_by_symbols_and_lines_equal_sql(spark, frame, scratch):
    """Hosts whose documents pass one by one are rejected by the rate of a
    rule; the query equals its SQL where verdicts differ by host."""
    import duckdb

    from twinsift.llm import oracle

    good = " ".join(f"w{i}" for i in range(30))
    signs = " ".join(f"#{i}$" for i in range(30))
    lines = good + "\nagain\nagain\nagain"
    rows = [(i, good, "good") for i in range(150)] + [(200 + i, lines if i % 2 else signs, "mixed") for i in range(30)]
    rows += [(300 + i, signs if i % 5 else good, "signs") for i in range(100)]
    rows += [(500 + i, lines if i % 5 else good, "lines") for i in range(100)]
    rows += [(700, signs, None), (701, None, "good"), (702, "short", "signs")]
    folder = f"{scratch}/op5-hosts"
    frame(rows, DOC).coalesce(1).write.parquet(f"{folder}/documents.parquet")
    out = queries.op5_host_rules(spark, folder)
    got = {tuple(r) for r in out.collect()}
    kept = {r[0]: r[out.columns.index("kept")] for r in got}
    assert kept[0] and not kept[300] and not kept[301] and not kept[500] and not kept[501] and not kept[702]
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    want = db.execute(f"SELECT {', '.join(out.columns)} FROM ({oracle.OP5})").fetchall()
    assert got == set(want) and len(want) == len(rows)
