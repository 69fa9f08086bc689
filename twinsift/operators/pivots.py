"""Exact dense top-k over pivot partitions (J2).

Rows are dealt to partitions by their nearest pivot (centres of a spherical
k-means over a sample; they change the speed only) and cut into blocks. A block
keeps the least and greatest angle of its rows to every pivot. Two rows are at
least as far apart as their angles to a pivot differ (triangle inequality on the
sphere), so the pivots bound the best score between two blocks from above.

1. Each block is scored against itself, which gives its rows a k-th best score;
   the lowest of them is the block's bar.
2. A pair of blocks is scored only if its bound reaches the lower of both bars.
   Bounds and bars are compared block by block, one thin row a pair of blocks.
3. Blocks that follow each other are a group; a task scores the pairs that remain
   between two groups, so a block is sent once a group and not once a pair.
   Scores below a row's k-th best so far are not ranked. The groups meet in
   rounds, a few copies of the blocks on disk at once (``COPIES``).
4. The best of the tasks are merged.

On clustered vectors most pairs of blocks fall out; on vectors without any
structure none does, and the work is that of all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsift.functions import kernels
from twinsift.operators.candidates import best_k
from twinsift.operators.tiles import _rank, choose_block_rows
from twinsift.session import release_shuffles, ship_package
from twinsift.sources.tables import drop_table, materialize, scratch_path, store

PIVOTS = 16
SAMPLE = 4096
GROUPS = 16  # at least, where there are so many blocks
GROUP_BLOCKS = 24  # at most
COPIES = 4  # of each block that are shuffled at once
ROUND_BLOCKS = 128  # so few copies of blocks are one round
ANGLE_SLACK = 1e-6  # far above the rounding of an angle
SCORE_SLACK = 2e-6  # scores are compared after rounding to 6 decimals


def pivot_directions(vecs: DataFrame, pivots: int = PIVOTS) -> np.ndarray:
    """Unit centres fitted on the ``SAMPLE`` rows with the smallest id hashes."""
    some = vecs.orderBy(F.xxhash64("id")).limit(SAMPLE).select("vec").toPandas()["vec"]
    x = kernels.unit_rows(kernels.stack_vectors(list(some)))
    return kernels.spherical_centres(x[np.linalg.norm(x, axis=1) > 0.5], pivots)


class _Blocks:
    """Packed blocks: (block, ids, data, lo, hi)."""

    def __init__(self, vecs: DataFrame, n: int, block_rows: int, pivots: np.ndarray):
        self.kind = vecs.schema["id"].dataType.simpleString()

        def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                x = kernels.unit_rows(kernels.stack_vectors(list(pdf["vec"])))
                yield pdf.assign(pivot=np.argmax(x @ pivots.T, axis=1).astype(np.int32) if len(x) else np.zeros(0, np.int32))

        vec_kind = vecs.schema["vec"].dataType.simpleString()
        dealt = materialize(vecs.select("id", "vec").mapInPandas(nearest, f"id {self.kind}, vec {vec_kind}, pivot int"))
        counts = {r["pivot"]: r["n"] for r in dealt.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")).collect()}
        number, first = F.lit(0), 0
        for p in sorted(counts):  # at most PIVOTS
            some = math.ceil(counts[p] / block_rows)
            number = F.when(F.col("pivot") == p, F.lit(first) + F.pmod(F.xxhash64("id"), F.lit(some))).otherwise(number)
            first += some
        self.count = max(1, first)

        def pack(table: pa.Table) -> pa.Table:
            x = kernels.unit_rows(kernels.stack_vectors(table.column("vec").to_pandas().tolist()))
            angle = np.arccos(np.clip(x @ pivots.T, -1.0, 1.0))
            return pa.table({"block": table.column("block")[:1], "ids": pa.array([table.column("id").to_pylist()], pa.list_(table.schema.field("id").type)),
                             "data": pa.array([x.tobytes()], pa.binary()), "lo": pa.array([angle.min(axis=0)], pa.list_(pa.float64())),
                             "hi": pa.array([angle.max(axis=0)], pa.list_(pa.float64()))})

        dealt = dealt.withColumn("block", number.cast("int")).repartition(max(1, min(4096, self.count)), "block")
        self.rows = materialize(dealt.groupBy("block").applyInArrow(pack, f"block int, ids array<{self.kind}>, data binary, lo array<double>, hi array<double>"))


def _unpacked(ids, data) -> tuple[np.ndarray, np.ndarray]:
    names = ids.values.to_numpy(zero_copy_only=False)
    return names, np.frombuffer(data.as_buffer(), "<f8").reshape(len(names), -1)


class _Lists:
    """The best ``k`` so far of each row of a block, from its k-th score on."""

    def __init__(self, ids: np.ndarray, kth: np.ndarray, k: int):
        self.ids, self.kth, self.k = ids, kth.copy(), k
        self.row, self.other, self.score = np.zeros(0, np.int64), ids[:0], np.zeros(0)

    def limits(self) -> np.ndarray:
        """Least raw scores that can matter; scores below 0 count as 0."""
        return np.where(self.kth <= SCORE_SLACK, -np.inf, self.kth - SCORE_SLACK)

    def add(self, row: np.ndarray, other: np.ndarray, score: np.ndarray) -> None:
        apart = self.ids[row] != other
        if not apart.any():
            return
        row, score = np.r_[self.row, row[apart]], np.r_[self.score, np.clip(score[apart], 0.0, 1.0)]
        other = np.concatenate([self.other, other[apart]])
        value = kernels.round6(score)
        order = np.lexsort((_rank(other), -value, row))
        sorted_row = row[order]
        first = np.flatnonzero(np.r_[True, sorted_row[1:] != sorted_row[:-1]])
        place = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
        full = order[place == self.k - 1]
        self.kth[row[full]] = np.maximum(self.kth[row[full]], value[full])
        keep = order[place < self.k]
        self.row, self.other, self.score = row[keep], other[keep], score[keep]


def _meet(left: _Lists, right: _Lists, s: np.ndarray) -> None:
    """Add the scores of two blocks (rows of ``left`` x rows of ``right``) to
    the lists of both; of a block with itself once."""
    for own, other, part in ((left, right, s), (right, left, s.T)) if left is not right else ((left, right, s),):
        limit = own.limits()
        open_ = np.isinf(limit)
        if open_.any():  # rows without a bound: their best by rank, not all of them
            some = np.flatnonzero(open_)
            r, c = kernels.topk_per_row(np.clip(part[some], 0.0, 1.0), own.ids[some][:, None] != other.ids[None, :], _rank(other.ids), own.k)
            own.add(some[r], other.ids[c], part[some[r], c])
            limit = np.where(open_, np.inf, limit)
        r, c = np.nonzero(part >= limit[:, None])
        if len(r):
            own.add(r, other.ids[c], part[r, c])


def kept_pairs(blocks: DataFrame, bars: DataFrame, n_blocks: int) -> DataFrame:
    """(i, j), i < j: pairs of blocks whose bound reaches a bar."""
    stats = materialize(blocks.select("block", "lo", "hi").join(bars, "block"))
    a = stats.select(F.col("block").alias("i"), F.col("lo").alias("a_lo"), F.col("hi").alias("a_hi"), F.col("bar").alias("a_bar"))
    a = a.withColumn("j", F.explode(F.sequence(F.col("i") + 1, F.greatest(F.lit(n_blocks), F.col("i") + 1)))).where(F.col("j") < n_blocks)
    b = stats.select(F.col("block").alias("j"), F.col("lo").alias("b_lo"), F.col("hi").alias("b_hi"), F.col("bar").alias("b_bar"))
    gap = F.expr("array_max(transform(arrays_zip(a_lo, a_hi, b_lo, b_hi), x -> greatest(x.b_lo - x.a_hi, x.a_lo - x.b_hi, 0D)))")
    top = F.greatest(F.cos(F.greatest(gap - F.lit(ANGLE_SLACK), F.lit(0.0))), F.lit(0.0)) + F.lit(SCORE_SLACK)
    # written so that a bound that is no number keeps its pair
    return a.join(b, "j").where(~F.coalesce(top < F.least("a_bar", "b_bar"), F.lit(False))).select("i", "j")


def pivot_topk(vecs: DataFrame, k: int, n: int, block_rows: int | None = None, pivots: int = PIVOTS) -> DataFrame:
    """Best ``k`` other rows of each row of ``vecs`` (id, vec) by cosine,
    clamped to [0, 1]; the same as all pairs in tiles."""
    spark = vecs.sparkSession
    ship_package(spark)
    vecs = materialize(vecs)
    br = choose_block_rows(1.0, block_rows, n, spark.sparkContext.defaultParallelism)
    blocks = _Blocks(vecs, n, br, pivot_directions(vecs, pivots))
    out = f"original_id {blocks.kind}, potential_duplicate_id {blocks.kind}, score double"

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, ids, data in zip(*batch.columns, strict=True):
                names, x = _unpacked(ids, data)
                # A row with fewer than k partners in its block has no bar: that
                # of a block of up to k rows is below every bound.
                lists = _Lists(names, np.full(len(names), -1.0), k)
                _meet(lists, lists, x @ x.T)
                yield pa.RecordBatch.from_arrays([pa.array([b.as_py()], pa.int32()), pa.array([lists.kth.tobytes()], pa.binary()),
                                                  pa.array([lists.kth.min(initial=1.0)])], names=["block", "kth", "bar"])

    bars = materialize(blocks.rows.select("block", "ids", "data").mapInArrow(own, "block int, kth binary, bar double"))
    width = max(1, min(GROUP_BLOCKS, blocks.count // GROUPS))
    groups = math.ceil(blocks.count / width)
    rounds = math.ceil(groups / COPIES) if blocks.count * groups > ROUND_BLOCKS else 1
    group = lambda c: F.floor(F.col(c) / F.lit(width)).cast("int")
    itself = blocks.rows.select(F.col("block").alias("i"), F.col("block").alias("j"))
    pairs = materialize(kept_pairs(blocks.rows, bars.select("block", "bar"), blocks.count).unionByName(itself)
                        .select("i", "j", group("i").alias("g"), group("j").alias("h")))
    # Which meetings of groups a block takes part in, and the blocks it is scored with there (as the first of a pair).
    meet = F.struct("g", "h", "js")
    needs = (pairs.groupBy("g", "h", F.col("i").alias("block")).agg(F.collect_list("j").alias("js"))
             .unionByName(pairs.select("g", "h", F.col("j").alias("block"), F.array().cast("array<int>").alias("js")).distinct())
             .groupBy("g", "h", "block").agg(F.flatten(F.collect_list("js")).alias("js"))
             .groupBy("block").agg(F.collect_list(meet).alias("needs")))
    rows = materialize(blocks.rows.select("block", "ids", "data").join(bars.select("block", "kth"), "block").join(needs, "block"))

    def tile(table: pa.Table) -> pa.Table:
        held, lists, wanted = {}, {}, []
        columns = (table.column(c).combine_chunks() for c in ("block", "ids", "data", "kth", "js"))
        for b, ids, data, kth, js in zip(*columns, strict=True):
            names, held[b.as_py()] = _unpacked(ids, data)
            lists[b.as_py()] = _Lists(names, np.frombuffer(kth.as_buffer(), "<f8"), k)
            wanted += [(b.as_py(), j) for j in js.as_py()]
        for i, j in sorted(wanted):
            _meet(lists[i], lists[j], held[i] @ held[j].T)
        kind = table.schema.field("ids").type.value_type
        return pa.table({"original_id": pa.array(np.concatenate([x.ids[x.row] for x in lists.values()]), kind),
                         "potential_duplicate_id": pa.array(np.concatenate([x.other for x in lists.values()]), kind),
                         "score": pa.array(np.concatenate([x.score for x in lists.values()]))})

    def met(r: int) -> DataFrame:
        sent = rows.select("block", "ids", "data", "kth", F.explode(F.filter("needs", lambda n: F.pmod(n["g"] + n["h"], F.lit(rounds)) == r)).alias("n"))
        sent = sent.select("n.g", "n.h", "n.js", "block", "ids", "data", "kth")
        tasks = max(1, min(4096, math.ceil(groups * (groups + 1) / rounds)))
        return sent.repartition(tasks, "g", "h").groupBy("g", "h").applyInArrow(tile, out)

    if rounds == 1:
        return best_k(met(0), k)
    found_at = scratch_path(spark, "dense-pairs")
    for r in range(rounds):
        found = store(met(r), found_at)
        release_shuffles(spark)
    best = materialize(best_k(found, k))
    drop_table(spark, found_at)
    return best
