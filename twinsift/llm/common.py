"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinsift.session import bound_batches, ensure_checkpoint_dir, release_shuffles, ship_package  # noqa: F401 - used by the operators

# Characters between words: space and \t \n \v \f \r (the ASCII white space
# that bytes.split() splits on, too).
SPACES = " \t\n\x0b\x0c\r"
# The same for Spark's trim and split.
SPACE_CLASS = "[ \\t-\\r]+"


def words(text: str | None) -> list[bytes]:
    """Maximal runs of ``[^\\x20\\x09-\\x0D]`` of a text, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: the
    lineage ends there and a lost executor costs a re-read."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Give memory of finished steps back to the system: Python's garbage,
    what Arrow keeps for its next table and, where the C library is glibc, the
    pages that it holds free."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def prepare(spark: SparkSession) -> None:
    """Make the package importable in the Python workers and bound the Arrow
    batches by bytes as well as rows, so that long texts cannot fill a
    worker. Smaller values set by the user stay."""
    ship_package(spark)
    bound_batches(spark)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch] | pa.RecordBatch],
                schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()  # what the worker's earlier tasks left
        for batch in batches:
            out = function(batch)
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                yield from out

    return df.mapInArrow(run, schema)


def heavy_keys(counts: DataFrame, key: str, n: str, share: int = 256) -> list:
    """Values of ``key`` with more than 1/``share`` of all rows, from a table
    of counts: fewer than ``share`` of them whatever the size of the data, so
    they can be held on the driver."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    return [r[0] for r in counts.where(F.col(n) * share > F.lit(int(total))).select(key).collect()]


def salted_join(big: DataFrame, small: DataFrame, key: str, hot: list, salt_by, how: str = "left",
                salts: int = 64) -> DataFrame:
    """Join ``big`` with ``small`` (one row a key) so that the rows of a hot
    key spread over ``salts`` tasks: they get a salt from ``salt_by``, and the
    (fewer than 256) hot rows of ``small`` are repeated once a salt. NULL keys
    match each other."""
    if not hot:
        return _null_safe(big, small, key, how)
    values = [h for h in hot if h is not None]
    is_hot = F.col(key).isin(values) if values else F.lit(False)
    is_hot = F.coalesce(is_hot, F.lit(None in hot))
    b = big.withColumn("__salt", F.when(is_hot, F.pmod(F.xxhash64(salt_by), F.lit(salts))).otherwise(F.lit(0)).cast("int"))
    s = small.withColumn("__salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1)))
                                             .otherwise(F.array(F.lit(0)))))
    return _null_safe(b, s, key, how, "__salt").drop("__salt")


def _null_safe(big: DataFrame, small: DataFrame, key: str, how: str, salt: str | None = None) -> DataFrame:
    s = small.withColumnRenamed(key, "__key")
    on = F.col(key).eqNullSafe(F.col("__key"))
    if salt:
        s = s.withColumnRenamed(salt, "__salt2")
        on = on & (F.col(salt) == F.col("__salt2"))
    return big.join(s, on, how).drop("__key", "__salt2")


def splitmix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function (splitmix64 finaliser) over uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
