"""Integer vectors in blocks, shared by the vector searches.

A component x becomes floor(256 * x) as an exact integer. Vectors that are null
or hold a null or non-finite component take no part, neither do rows without
an id; shorter vectors count as filled up with zeros. A component of 2**31 or
more after scaling is an error. Of rows that repeat an id the one with the
smallest vector counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinsift.llm import common

SCALE = 256
MOST = 2**31
PLACE_BITS = 24  # a place is block << PLACE_BITS | row of the block


def scaled(vec: Column) -> Column:
    """array<long> of floor(256 x); NULL where the vector takes no part."""
    fit = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    out = F.transform(vec, lambda x: F.floor(x.cast("double") * SCALE))
    small = F.forall(vec, lambda x: F.abs(x.cast("double")) * SCALE < F.lit(float(MOST)))
    return F.when(fit & ~small, F.raise_error(F.lit("a vector component is too large for exact scores"))).when(fit, out)


def integer_rows(df: DataFrame, id_col: str, vec_col: str, **more: Column) -> DataFrame:
    """(id, v, ...): one row an id, stored."""
    rows = df.select(F.col(id_col).alias("id"), scaled(F.col(vec_col)).alias("v"), *[c.alias(n) for n, c in more.items()])
    rows = common.stored(rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()), "vectors")
    again = common.stored(rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"), "repeated-ids")
    if again.isEmpty():
        return rows
    names = ["v", *more]
    one = rows.join(again, "id", "left_semi").groupBy("id").agg(F.min(F.struct(*names)).alias("r")).select("id", *[f"r.{n}" for n in names])
    return common.stored(rows.join(again, "id", "left_anti").select("id", *names).unionByName(one), "vectors")


def shape(rows: DataFrame) -> tuple[int, int, int]:
    """(rows, components, greatest magnitude)."""
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d"),
                 F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("m")).first()
    return int(r["n"]), int(r["d"] or 0), int(r["m"] or 0)


def kind_of(most: int) -> str:
    """The smallest integer type for components up to ``most``."""
    return "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"


def matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as int64, filled up with zeros to ``dim``."""
    lens = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lens), dim), np.int64)
    row = np.repeat(np.arange(len(lens)), lens)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(lens) - lens, lens)] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def one_array(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def products(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; floats where they hold every
    partial sum exactly, int64 otherwise."""
    bound = q.shape[1] * int(np.abs(q).max(initial=0)) * int(np.abs(r).max(initial=0))
    if bound < 2**24:
        return (q.astype(np.float32) @ r.astype(np.float32).T).astype(np.int64)
    if bound < 2**53:
        return (q.astype(np.float64) @ r.astype(np.float64).T).astype(np.int64)
    if bound >= 2**63:
        raise OverflowError("inner products beyond 64 bits")
    return q.astype(np.int64) @ r.astype(np.int64).T


def places(block: int, at: np.ndarray) -> np.ndarray:
    return (np.int64(block) << np.int64(PLACE_BITS)) + at.astype(np.int64)


def block_of(place: str) -> Column:
    return F.shiftright(F.col(place), PLACE_BITS).cast("int")


def packed(rows: DataFrame, blocks: int, function: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """What ``function`` makes of each ``block`` of rows; stored."""
    common.prepare(rows.sparkSession)
    dealt = rows.repartition(max(1, min(blocks, 4096)), "block")
    return common.stored(dealt.groupBy("block").applyInArrow(function, schema), "blocks")


def hash_block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def tiles(rows: DataFrame, queries: DataFrame, blocks: int, on: list[str] | None = None) -> DataFrame:
    """Each block of rows with each block of queries, a row a pair of blocks:
    the queries, the smaller side, go to every one of the ``blocks``."""
    keys = ["block", *(on or [])]
    tasks = max(1, min(4096, 2 * blocks))
    dealt = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return rows.repartition(tasks, *keys).join(dealt.repartition(tasks, *keys), keys)


def map_rows(df: DataFrame, function: Callable[[dict], Iterator[dict]], schema: pa.Schema, ddl: str) -> DataFrame:
    """``mapInArrow`` a row (a tile) at a time; what it yields goes out in
    slices, so that a tile with many results stays small in memory."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(batch.num_rows):
            row = {name: batch.column(j)[i] for j, name in enumerate(batch.schema.names)}
            for out in function(row):
                whole = pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)
                for at in range(0, whole.num_rows, 1 << 17):
                    yield whole.slice(at, 1 << 17)

    return common.map_batches(df, run, ddl)
