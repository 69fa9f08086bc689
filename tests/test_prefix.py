"""The prefix-filtered join against all pairs in tiles."""

import random

import numpy as np
import pytest

from twinsift.operators import prefix
from twinsift.operators.candidates import best_k
from twinsift.operators.knn import sparse_cosine_topk
from twinsift.operators.tiles import tiled_topk


def _rows(seed: int, n: int = 160):
    """Random texts, near copies, boilerplate in a third of the rows, rows of
    boilerplate alone, one-feature rows and rows that share nothing."""
    rnd = random.Random(seed)
    hot = list(range(1, 13))
    rows = []
    for i in range(n):
        own = rnd.sample(range(100, 100 + 4 * n), rnd.randint(1, 12))
        kind = i % 6
        if kind == 1 and rows:
            own = [x for x in rnd.choice(rows)[1] if rnd.random() < 0.8] or [99]
        elif kind in (2, 3):
            own += rnd.sample(hot, rnd.randint(3, 12))
        elif kind == 4:
            own = rnd.sample(hot, rnd.randint(1, 12))
        elif i % 12 == 5:
            own = [10_000 + i]
        rows.append((i, sorted(set(own))))
    return rows


def _key(df):
    return sorted((r.original_id, r.potential_duplicate_id, r.search_score) for r in df.collect())


@pytest.mark.parametrize(("pairs_per_feature", "k"), [(0, 3), (1, 1), (1, 3), (3, 3), (1000, 1)])
def test_equals_all_pairs(spark, pairs_per_feature, k):
    df = spark.createDataFrame(_rows(pairs_per_feature + k), "id long, f array<long>").checkpoint()
    want = _key(best_k(tiled_topk(df, "binary_cosine", k), k))
    assert _key(prefix.prefix_topk(df, k, pairs_per_feature=pairs_per_feature)) == want


def test_hot_feature_in_every_row_and_string_ids(spark):
    rows = [(f"r{i:03d}", [1, 2] + [100 + i // 2] * (i % 5 > 0)) for i in range(120)]
    df = spark.createDataFrame(rows, "id string, f array<long>").checkpoint()
    want = _key(best_k(tiled_topk(df, "binary_cosine", 3), 3))
    assert _key(prefix.prefix_topk(df, 3, pairs_per_feature=1)) == want


def test_nothing_shared_and_empty(spark):
    df = spark.createDataFrame([(1, [5]), (2, [6]), (3, [])], "id long, f array<long>").checkpoint()
    assert prefix.prefix_topk(df, 3).count() == 0
    assert prefix.prefix_topk(df.limit(0).checkpoint(), 3).count() == 0


def test_lists_stay_within_the_features(spark):
    """The limit keeps the partners in all lists below a multiple of the
    table's features, whatever the frequencies."""
    df = spark.createDataFrame([(2, 50), (8, 4), (100, 2), (1000, 1)], "df long, times int").selectExpr(
        "df", "explode(sequence(1, times)) as i")
    for most in (0, 100, 400, 30_000, 10**7):
        d, pairs = prefix.rare_limit(df, most)
        assert pairs <= most and pairs == sum(t * f * (f - 1) for f, t in ((2, 50), (8, 4), (100, 2), (1000, 1)) if f <= d)


def test_plans_agree_on_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id as id", "text")
    assert _key(sparse_cosine_topk(docs, "id", "text", 3)) == _key(sparse_cosine_topk(docs, "id", "text", 3, plan="tiles"))


def _records(n: int):
    """Records of a few words, all of them in many rows; some with more words
    than ``FEW_HOT``, one alone."""
    rnd = random.Random(5)
    rows = [(i, sorted({rnd.randint(0, 3), 10 + rnd.randint(0, 4), 20 + rnd.randint(0, 5), 30 + rnd.randint(0, 2)})) for i in range(n)]
    return rows, [*rows, *((n + i, sorted(rnd.sample(range(35), 10 + i))) for i in range(12)), (n + 12, [99])]


@pytest.mark.parametrize("k", [1, 3])
def test_short_records_meet_by_subsets(spark, monkeypatch, k):
    monkeypatch.setattr(prefix, "FEW_PAIRS", 0)
    rows, mixed = _records(150)
    for some in (mixed, rows):
        df = spark.createDataFrame(some, "id long, f array<long>").checkpoint()
        want = _key(best_k(tiled_topk(df, "binary_cosine", k), k))
        if some is rows:  # no pair of all rows is made where all are short
            monkeypatch.setattr(prefix, "tiled_topk", None)
        assert _key(prefix.prefix_topk(df, k, pairs_per_feature=0)) == want


def test_slices_and_rounds_change_no_row_and_leave_nothing(spark, monkeypatch):
    """Features, lists and representatives stored and shuffled some at a time:
    the rows of one go, and only what the result reads is left on disk."""
    from pathlib import Path

    from twinsift.operators import copies
    from twinsift.session import ensure_checkpoint_dir

    texts = [(i, f"the same record {i // 3} of some {i % 7} words and {i * 5 % 11} more") for i in range(90)]
    df = spark.createDataFrame(texts, "id long, text string").checkpoint()
    want = _key(sparse_cosine_topk(df, "id", "text", 3, plan="tiles"))
    for module, name in ((copies, "PIECE_ROWS"), (prefix, "PLACES_PER_SLICE"), (prefix, "PAIRS_PER_ROUND")):
        monkeypatch.setattr(module, name, 40)
        monkeypatch.setattr(module, "release_shuffles", lambda spark: None)
    for module, name in ((copies, "MOST_PIECES"), (prefix, "MOST_SLICES")):
        monkeypatch.setattr(module, name, 2)
    monkeypatch.setattr(prefix, "PAIRS_PER_FEATURE", 8)
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = {p.name for p in folder.iterdir()}
    assert _key(sparse_cosine_topk(df, "id", "text", 3)) == want
    new = {p.name for p in folder.iterdir()} - before
    assert not [n for n in new if n.startswith(("features", "representatives", "shared", "lists-"))]
    assert [n for n in new if n.startswith("list-pairs")]


def _by_tiles(spark, rows, k):
    df = spark.createDataFrame(rows, "id long, f array<long>").checkpoint()
    return df, _key(best_k(tiled_topk(df, "binary_cosine", k), k))


def test_lists_and_hot_features_are_sent_a_bounded_part_at_a_time(spark, monkeypatch):
    """More rounds where more entries are sent, however many; the features of
    both rows travel with some of the pairs at a time."""
    df, want = _by_tiles(spark, [(i, [i // 4, 100 + i // 9, 200 + i // 40, 300 + i % 3]) for i in range(60)], 3)
    monkeypatch.setattr(prefix, "PAIRS_PER_ROUND", 20)
    monkeypatch.setattr(prefix, "HOT_BYTES", 3000)
    seen = []
    store = prefix.store
    monkeypatch.setattr(prefix, "store", lambda df, path, *a: seen.append(path.split("/")[-1].rsplit("-", 1)[0]) or store(df, path, *a))
    monkeypatch.setattr(prefix, "PART_OF_FEATURES", 10 ** 9)
    assert _key(prefix.prefix_topk(df, 3)) == want
    assert seen.count("block-pairs") > 4 and seen.count("known") > 2


def test_open_rows_meet_in_rounds_of_tiles(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, sorted(rng.choice(60, 20, replace=False).tolist())) for i in range(150)]
    df, want = _by_tiles(spark, rows, 3)
    asked = []
    best = prefix.best_in_rounds
    monkeypatch.setattr(prefix, "tile_rounds", lambda *a: 3)
    monkeypatch.setattr(prefix, "best_in_rounds", lambda rounds, *a, **b: asked.append(rounds) or best(rounds, *a, **b))
    assert _key(prefix.prefix_topk(df, 3, pairs_per_feature=0, block_rows=20)) == want
    assert asked and set(asked) == {3}


def test_stored_steps_leave_no_shuffle(spark, scratch):
    import time
    from pathlib import Path

    from twinsift.sources.tables import materialize, store

    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()

    def files():
        return {f for d in dirs for f in Path(d.getPath()).rglob("shuffle_*.data") if f.stat().st_size > 50_000}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = files(), spark.conf.get(key)
    frames = [spark.range(400_000).repartition(4, "id") for _ in range(2)]  # kept: no garbage
    assert store(frames[0], f"{scratch}/x").count() == 400_000 and materialize(frames[1]).count() == 400_000
    end = time.time() + 10
    while files() - before and time.time() < end:
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(key) == setting
