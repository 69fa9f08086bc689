"""Table edge: scans, existence checks, overwrite sinks, comments, drops."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def is_path(name: str) -> bool:
    return "/" in name or name.endswith(".parquet")


def table_exists(spark: SparkSession, name: str) -> bool:
    """S2: checked before a plan is built. Only a missing (or empty) path
    counts as missing; any other error is raised."""
    if is_path(name):
        try:
            spark.read.parquet(name).schema  # noqa: B018 - footer read only
            return True
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise
    return spark.catalog.tableExists(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """S1: a catalog table or a parquet path."""
    return spark.read.parquet(name) if is_path(name) else spark.table(name)


def ensure_parallel(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a small input (one file, one row group) over the cores before
    CPU-heavy per-row work. Decided from the optimizer's size estimate, so
    nothing runs: an input that the scan's own split size already cuts into a
    part for each core is left as it is (no shuffle)."""
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")))
    return df.repartition(want) if size < want * split else df


def materialize(df: DataFrame) -> DataFrame:
    """Compute a costly intermediate once for several consumers: a reliable
    ``checkpoint`` into the shared folder named by ``spark.checkpoint.dir``
    (a lost executor then costs a re-read, not a recomputation chain). The
    shuffles that made it are deleted."""
    from twinsift.session import ensure_checkpoint_dir, shuffles_removed

    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_removed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a plan made under the setting


def scratch_path(spark: SparkSession, name: str = "stored") -> str:
    """A new folder under the shared checkpoint folder."""
    import uuid

    from twinsift.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """``materialize`` for a large intermediate: added to the Parquet folder
    ``path`` and read from there. Its caller deletes the folder
    (``drop_table``) after the last read, so that the next steps do not find
    the disk taken."""
    from twinsift.session import shuffles_removed

    writer = df.write.mode("append")
    with shuffles_removed(df.sparkSession):
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_overwrite(df: DataFrame, name: str, comments: dict[str, str] | None = None) -> None:
    """S8 (+S10): overwrite a parquet table or path; column comments are set
    as field metadata so they travel with the schema."""
    if comments:
        from pyspark.sql import functions as F
        df = df.select(*[F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c)
                         for c in df.columns])
    if is_path(name):
        df.write.mode("overwrite").parquet(name)
    else:
        df.write.mode("overwrite").format("parquet").saveAsTable(name)


def set_column_comments(spark: SparkSession, name: str, comments: dict[str, str]) -> None:
    """S10 on an existing catalog table."""
    for col, text in comments.items():
        escaped = text.replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{col}` COMMENT '{escaped}'")


def column_comments(spark: SparkSession, name: str) -> DataFrame:
    """S10 read back: (column_name, data_type, comment) of a written table or
    path; the comment is NULL where none was set."""
    rows = [(f.name, f.dataType.simpleString(), f.metadata.get("comment")) for f in read_table(spark, name).schema.fields]
    return spark.createDataFrame(rows, "column_name string, data_type string, comment string")


def drop_table(spark: SparkSession, name: str) -> None:
    """S11 (opt-in in the jobs layer): a table, or the folder of a path."""
    if not is_path(name):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
