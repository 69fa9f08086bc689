"""E1: a stored table of embeddings keyed by the text's hash.

A text is embedded once, however many rows hold it and however often the job
runs: a run embeds only the texts whose SHA-256 the table does not have yet for
the model, and appends them (one committed write, so a run that fails leaves
the table as it was).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from twinsift.operators.tiles import skew_join
from twinsift.sources.tables import ensure_parallel, table_exists


class VectorTable:
    """(model, text_key, vec) under a path or a catalog name."""

    SCHEMA = "model string, text_key string, vec array<float>"

    def __init__(self, spark: SparkSession, path: str, model: str):
        self.spark, self.path, self.model = spark, path, model

    def _known(self) -> DataFrame:
        if not table_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(self.path).where(F.col("model") == self.model)

    def sync(self, texts: DataFrame, embed_fn) -> int:
        """Embed the texts of (id, text) that are new; how many they were."""
        keyed = texts.select(_key().alias("text_key"), F.coalesce("text", F.lit("")).alias("text"))
        new = keyed.join(self._known().select("text_key"), "text_key", "left_anti")
        new = ensure_parallel(new.groupBy("text_key").agg(F.min("text").alias("text")))
        seen = Observation()
        out = new.select(F.lit(self.model).alias("model"), "text_key", embed_fn(F.col("text")).alias("vec"))
        out.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(self.path)
        return int(seen.get["n"])

    def vectors(self, texts: DataFrame) -> DataFrame:
        """(id, vec) of texts that are in the table; a text that a third of the
        rows hold is spread over tasks."""
        keyed = texts.select("id", _key().alias("text_key"))
        counts = keyed.groupBy("text_key").agg(F.count(F.lit(1)).alias("_n"))
        return skew_join(keyed, self._known().select("text_key", "vec"), "text_key", texts.count(), counts=counts).select("id", "vec")


def _key():
    return F.sha2(F.coalesce("text", F.lit("")), 256)
