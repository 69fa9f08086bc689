"""Tiles dealt to rounds: the same rows, fewer copies of each row on disk at once."""

import numpy as np
import pytest

from twinsift.operators import hybrid, tiles
from twinsift.operators.candidates import best_k


@pytest.fixture()
def quick(monkeypatch):
    for module in (tiles, hybrid):
        monkeypatch.setattr(module, "release_shuffles", lambda spark: None)


def _texts(spark, n):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.random(12) ** 3 * 60)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, text string")


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_number_of_rounds():
    many = (50_000, 500.0)
    assert tiles.tile_rounds("dot", 66, many, many, None, 12) >= 10
    assert tiles.tile_rounds("subset_cosine", 66, many, None, None, 12) >= 8
    assert tiles.tile_rounds("dot", 66, (2000, 500.0), None, None, 12) == 1
    assert tiles.tile_rounds("dot", 3, (10 ** 6, 500.0), None, None, 12) <= 10 ** 6 / 2048 + 1


@pytest.mark.parametrize("rounds", [2, 3, 9])
def test_every_pair_of_blocks_meets_once(spark, quick, rounds):
    rng = np.random.default_rng(rounds)
    rows = [(i, sorted(rng.choice(40, 8, replace=False).tolist())) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, f array<long>").repartition(3).checkpoint()
    want = _rows(best_k(tiles.tiled_topk(df, "binary_cosine", 4, block_rows=20), 4, keep_rank=True))
    assert _rows(tiles.best_in_rounds(rounds, 4, lambda part: tiles.tiled_topk(df, "binary_cosine", 4, block_rows=20, part=part), keep_rank=True)) == want
    parts = [tiles.tiled_topk(df, "binary_cosine", 4, right=df.where("id < 60"), block_rows=20, part=(r, rounds)) for r in range(rounds)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    assert _rows(every) == _rows(tiles.tiled_topk(df, "binary_cosine", 4, right=df.where("id < 60"), block_rows=20))


def test_hybrid_in_rounds(spark, quick, monkeypatch):
    texts = _texts(spark, 200)
    want = _rows(hybrid.hybrid_topk(texts, "id", "text", 2))
    monkeypatch.setattr(tiles, "ROUND_BYTES", 0)
    monkeypatch.setattr(tiles, "ROUND_COPIES", 1)
    seen = []
    rounds = tiles.tile_rounds
    monkeypatch.setattr(hybrid, "tile_rounds", lambda *a: seen.append(rounds(*a)) or seen[-1])
    assert _rows(hybrid.hybrid_topk(texts, "id", "text", 2)) == want
    assert len(seen) >= 2 and max(seen) > 1
