"""Exact top-k search by inner product: a three-phase uniform threshold.

A vector is cut into ``nodes`` slices of components. A node's local score of a
query and a vector is the inner product of their slices; the score is the sum
of the local scores. Each node's list is spread over blocks of rows.

1. Each node gives its ``depth`` best entries a query, merged over the blocks.
   The exact scores of these vectors give t, the k-th best known so far.
2. The cutoff t / nodes goes to all nodes, and each returns every entry that
   reaches it. It is safe: local scores that add up to t or more cannot all
   lie below t / nodes. A vector that all nodes returned is known; for another
   the missing local scores lie below the cutoff, which bounds its score. It
   is dropped if the bound is below t or the k-th best of the known scores.
3. The missing scores of the others are resolved exactly.

Equal vectors are searched once, as one vector with its smallest ids, so a
group of copies that holds a third of the rows costs as much as one row.

Data on the move: vectors once, query blocks once a block of rows, entries
that reach the cutoffs as (query, vector, node, score) rows. The driver gets
counts only, and nothing is broadcast.

Defined cases: see ``vectors`` for null vectors, components and repeated ids.
Scores tie to the smaller id. The query itself is no candidate (by id). A query
of an empty table has no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinsift.llm import common, vectors

NODES = 2
# Entries of a node's list, times k, in the first phase: a longer head finds a
# cutoff nearer to the final one.
HEADS = 4
ROWS_PER_BLOCK = 4096
QUERIES_PER_BLOCK = 512

_ENTRY = pa.schema([("q", pa.int64()), ("r", pa.int64()), ("node", pa.int32()), ("s", pa.int64())])
_ENTRY_DDL = "q long, r long, node int, s long"


def top_k(df: DataFrame, id_col: str, vec_col: str, is_query: Column, k: int = 5, nodes: int = NODES, depth: int | None = None,
          rows_per_block: int = ROWS_PER_BLOCK, queries_per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` best other rows of each row for
    which ``is_query`` holds (a condition on ``id``)."""
    rows = vectors.integer_rows(df, id_col, vec_col)
    # k + 1: one of the best groups may be led by the query itself.
    groups, members = _distinct(rows, k + 1)
    asked = common.stored(members.where(is_query), "query-rows")
    n, dim, most = vectors.shape(groups)
    wanted = common.stored(groups.join(asked.select("key").distinct(), "key", "left_semi").select("key", "v"), "query-vectors")
    n_wanted = wanted.count()
    nodes = max(1, min(nodes, dim))
    table = _Slices(groups, n, dim, most, nodes, rows_per_block)
    queries = _Slices(wanted, n_wanted, dim, most, nodes, queries_per_block)
    best = _search(table, queries, k + 1, depth or HEADS * (k + 1))
    return _expanded(best, table, queries, groups, asked, k)


def _distinct(rows: DataFrame, m: int) -> tuple[DataFrame, DataFrame]:
    """(key, v, ids: its ``m`` smallest ids) of each different vector, and
    (id, key) of all rows."""
    keyed = rows.withColumn("key", F.sha2(F.to_json("v"), 256))
    w = Window.partitionBy("key").orderBy("id")
    least = keyed.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= m)
    groups = least.groupBy("key").agg(F.min(F.when(F.col("_r") == 1, F.col("v"))).alias("v"), F.array_sort(F.collect_list("id")).alias("ids"))
    return common.stored(groups, "vector-groups"), keyed.select("id", "key")


class _Slices:
    """Blocks of rows, one stored row for each block and node, and the keys of
    the places."""

    def __init__(self, rows: DataFrame, n: int, dim: int, most: int, nodes: int, per_block: int):
        self.blocks, self.nodes = max(1, -(-n // per_block)), nodes
        kind, cuts = vectors.kind_of(most), np.linspace(0, dim, nodes + 1).astype(int)

        def pack(t: pa.Table) -> pa.Table:
            m = vectors.matrix(vectors.one_array(t.column("v")), dim).astype(kind)
            keys = t.column("key").to_pylist()
            return pa.table({"block": pa.array([t.column("block")[0].as_py()] * nodes, pa.int32()), "node": pa.array(range(nodes), pa.int32()),
                             "n": pa.array([len(keys)] * nodes, pa.int32()),
                             "keys": pa.array([keys] + [[]] * (nodes - 1), pa.list_(pa.string())),
                             "data": pa.array([m[:, a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())})

        self.kind = kind
        self.stored = vectors.packed(rows.select("key", "v", vectors.hash_block("key", self.blocks).alias("block")), self.blocks, pack,
                                     "block int, node int, n int, keys array<string>, data binary")
        self.data = self.stored.select("block", "node", "n", "data")

    def places(self, name: str) -> DataFrame:
        """(place, key)"""
        at = self.stored.where("node = 0").select("block", F.posexplode("keys").alias("i", "key"))
        return at.select((F.shiftleft(F.col("block").cast("long"), vectors.PLACE_BITS) + F.col("i")).alias(name), "key")

    def as_queries(self) -> DataFrame:
        return self.data.select(F.col("block").alias("q_block"), "node", F.col("n").alias("q_n"), F.col("data").alias("q_data"))


def _local(row: dict, kind: str) -> tuple[np.ndarray, np.ndarray]:
    part = lambda data, n: np.frombuffer(row[data].as_buffer(), kind).reshape(row[n].as_py(), -1)
    return part("q_data", "q_n"), part("data", "n")


def _entries(row: dict, i: np.ndarray, j: np.ndarray, s: np.ndarray) -> dict:
    return {"q": vectors.places(row["q_block"].as_py(), i), "r": vectors.places(row["block"].as_py(), j),
            "node": np.full(len(i), row["node"].as_py(), np.int32), "s": s}


def _search(table: _Slices, queries: _Slices, k: int, depth: int) -> DataFrame:
    """(q, r, s): at least the ``k`` best places of each query place, and all
    that tie with the last of them."""
    kind, nodes = table.kind, table.nodes
    asked = queries.as_queries()

    # Phase 1: the head of each node's list.
    def head(row: dict) -> Iterator[dict]:
        s = vectors.products(*_local(row, kind))
        d = min(depth, s.shape[1])
        j = np.argpartition(-s, d - 1, axis=1)[:, :d]
        i = np.repeat(np.arange(len(s)), d)
        yield _entries(row, i, j.ravel(), s[i, j.ravel()])

    heads = vectors.map_rows(vectors.tiles(table.data, asked, table.blocks, ["node"]), head, _ENTRY, _ENTRY_DDL)
    w = Window.partitionBy("q", "node").orderBy(F.desc("s"), "r")
    heads = heads.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= depth)
    first = common.stored(heads.select("q", "r").distinct(), "list-heads")
    known = _resolved(first, table, queries)
    t = known.groupBy("q").agg(F.slice(F.sort_array(F.collect_list("s"), False), k, 1).alias("t"))
    t = common.stored(t.select("q", F.get("t", F.lit(0)).alias("t")), "cutoffs")

    # Phase 2: the cutoff goes out, all entries that reach it come back.
    cuts = (t.select(vectors.block_of("q").alias("q_block"), F.struct("q", "t").alias("c"))
            .groupBy("q_block").agg(F.collect_list("c").alias("c")).select("q_block", F.col("c.q").alias("cq"), F.col("c.t").alias("ct")))

    def reach(row: dict) -> Iterator[dict]:
        s = vectors.products(*_local(row, kind))
        cut, none, at = np.zeros(len(s), np.int64), np.ones(len(s), bool), row["cq"].values.to_numpy() & (1 << vectors.PLACE_BITS) - 1
        cut[at] = row["ct"].values.fill_null(0).to_numpy(zero_copy_only=False)
        none[at] = row["ct"].values.is_null().to_numpy(zero_copy_only=False)  # fewer than k known: all
        i, j = np.nonzero((s >= -(-cut // nodes)[:, None]) | none[:, None])  # s * nodes >= t
        yield _entries(row, i, j, s[i, j])

    entries = vectors.map_rows(vectors.tiles(table.data, asked.join(cuts, "q_block"), table.blocks, ["node"]), reach, _ENTRY, _ENTRY_DDL)
    sums = entries.groupBy("q", "r").agg(F.sum("s").alias("s"), F.count(F.lit(1)).alias("c")).join(t, "q")
    below = F.expr(f"(CASE WHEN t > 0 THEN (t + {nodes - 1}) div {nodes} ELSE t div {nodes} END) - 1")  # a missing score is no larger
    bound = F.col("s") + (F.lit(nodes) - F.col("c")) * F.coalesce(below, F.lit(0))
    sums = sums.where(F.col("t").isNull() | (bound >= F.col("t"))).withColumn("bound", bound)
    sums = common.stored(sums.select("q", "r", "s", "c", "bound", "t"), "entries")
    complete = sums.where(F.col("c") == nodes)
    w = Window.partitionBy("q").orderBy(F.desc("s"), "r")
    kth = (complete.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == k).select("q", F.col("s").alias("t2")))
    left = sums.join(kth, "q", "left").withColumn("t", F.greatest("t", "t2"))

    # Phase 3: what the lists left open.
    open_ = left.where((F.col("c") < nodes) & (F.col("t").isNull() | (F.col("bound") >= F.col("t"))))
    rest = _resolved(common.stored(open_.select("q", "r"), "open-pairs"), table, queries).join(t, "q")
    both = left.where(F.col("c") == nodes).select("q", "r", "s", "t").unionByName(rest.select("q", "r", "s", "t"))
    return both.where(F.col("t").isNull() | (F.col("s") >= F.col("t"))).select("q", "r", "s")


def _resolved(pairs: DataFrame, table: _Slices, queries: _Slices) -> DataFrame:
    """(q, r, s): exact scores of pairs of places, looked up block by block in
    every node."""
    by_tile = pairs.groupBy(vectors.block_of("q").alias("q_block"), vectors.block_of("r").alias("block")).agg(F.collect_list(F.struct("q", "r")).alias("p"))
    by_tile = by_tile.select("q_block", "block", F.col("p.q").alias("pq"), F.col("p.r").alias("pr"))
    mask, kind = (1 << vectors.PLACE_BITS) - 1, table.kind

    def look_up(row: dict) -> Iterator[dict]:
        q, r = _local(row, kind)
        pq, pr = row["pq"].values.to_numpy(), row["pr"].values.to_numpy()
        s = np.concatenate([np.einsum("ij,ij->i", q[pq[a:a + 65536] & mask].astype(np.int64), r[pr[a:a + 65536] & mask].astype(np.int64))
                            for a in range(0, max(1, len(pq)), 65536)])
        yield {"q": pq, "r": pr, "node": np.full(len(pq), row["node"].as_py(), np.int32), "s": s}

    tasks = max(1, min(4096, 2 * table.blocks))
    need = queries.as_queries().join(by_tile, "q_block")
    tiles = table.data.repartition(tasks, "block", "node").join(need.repartition(tasks, "block", "node"), ["block", "node"])
    return vectors.map_rows(tiles, look_up, _ENTRY, _ENTRY_DDL).groupBy("q", "r").agg(F.sum("s").alias("s"))


def _expanded(best: DataFrame, table: _Slices, queries: _Slices, groups: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Results of places -> rows: each query row's best ``k`` ids."""
    at = table.places("r").join(groups.select("key", "ids"), "key").select("r", "ids", F.get("ids", F.lit(0)).alias("least"))
    named = best.join(at, "r")
    w = Window.partitionBy("q").orderBy(F.desc("s"), "least")
    named = named.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k + 1)
    per_key = (named.groupBy("q").agg(F.collect_list(F.struct("s", "ids")).alias("found")).join(queries.places("q"), "q").select("key", "found"))
    counts = common.stored(asked.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "query-counts")
    per_row = common.salted_join(asked, per_key, "key", common.heavy_keys(counts, "key", "n"), F.col("id"), "inner")
    one = per_row.select(F.col("id").alias("query_id"), F.explode("found").alias("f")).select("query_id", "f.s", F.explode("f.ids").alias("id"))
    w = Window.partitionBy("query_id").orderBy(F.desc("s"), "id")
    ranked = one.where("id != query_id").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", F.col("s").alias("score"))
