"""Mixing sources to target weights, with DataFrame functions only.

Sources by code point (null last) get the weights 5, 2, 1 in turn; the
targets share ``share`` of all sizes by weight, each capped at
``max_epochs`` times its source's size, the excess going to the others by
weight until none is above its cap. Documents of a source are put in the
order of a hash of (seed, id); the source is taken whole as often as
its target allows, and the last epoch is cut where the running size is
nearest to what is left. So a document is taken ``floor`` or ``ceil`` times.

Running sums are distributed: a source's key range is cut into equal slices
(about ``slice_rows`` rows each, hash keys being uniform), the slices' totals
give each slice's offset, and a window sums inside a slice. A source that
holds a third of the rows is spread over as many slices as it needs.

Defined cases: a null text has size 0; a null source is a source of its own;
rows that share an id share a key and are decided as one, with the sum of
their sizes (a null id takes its text's hash instead); an empty table gives
no rows; sizes all 0 give targets 0; extra columns are kept out of the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinsift.llm import common

WEIGHTS = (5.0, 2.0, 1.0)


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs; 0 for null."""
    core = F.trim(F.coalesce(text, F.lit("")), F.lit(common.SPACES))
    return F.when(core == "", F.lit(0)).otherwise(F.size(F.split(core, common.SPACE_CLASS))).cast("long")


def random_key(seed: int, name: Column) -> Column:
    """A uniform 60-bit key from MD5 (so that SQL can make the same key)."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(name, F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def source_targets(sources: DataFrame, share: float = 1.0, max_epochs: float = 3.0,
                   weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """(source, rows, source_size) -> the same with ``target``.

    A capped source has target ``max_epochs * size``, any other ``level *
    weight`` with one common level, so the sources are capped in the order of
    cap / weight: with the running sums over that order, the level follows
    from the first source that is not capped. The two windows here run over
    the sources (one row each), never over documents.
    """
    ws = F.array(*[F.lit(float(w)) for w in weights])
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    s = sources.withColumn("weight", F.element_at(ws, (rank % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    s = s.withColumn("ratio", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy()
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
    s = s.withColumn("w_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    s = s.withColumn("left", F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    # Level if this source and all after it are not capped; the first source
    # whose own ratio is above it fixes the level.
    s = s.withColumn("at", F.col("left") / F.col("w_left"))
    s = s.withColumn("place", F.row_number().over(Window.orderBy("ratio", F.col("source").asc_nulls_last())))
    s = s.withColumn("level", F.min(F.when(F.col("ratio") >= F.col("at"), F.struct("place", "at"))).over(everything)["at"])
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight")))
    return s.select("source", "rows", "source_size", target.alias("target"))


def document_key(id_col: str, text_col: str, seed: int) -> Column:
    return random_key(seed, F.coalesce(F.col(id_col).cast("string"), F.md5(F.col(text_col))))


def _decisions(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, share: float, max_epochs: float,
               slice_rows: int) -> tuple[DataFrame, DataFrame]:
    """The documents' thin rows, and (source, slice, key) -> copies."""
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       word_count(F.col(text_col)).alias("size"), document_key(id_col, text_col, seed).alias("key"))
    thin = common.stored(thin, "mix-rows")
    sources = thin.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size"))
    sources = common.stored(source_targets(sources, share, max_epochs), "mix-sources")
    hot = common.heavy_keys(sources, "source", "rows")
    d = common.salted_join(thin, sources, "source", hot, "key", "inner")
    # The slice of a key: its place in the 64-bit range times the slices.
    slices = F.ceil(F.col("rows") / F.lit(slice_rows)).cast("long")
    d = d.withColumn("slice", F.least(F.floor(F.col("key") / F.lit(2.0**60) * slices), slices - 1).cast("long"))
    # Rows of one key are decided as one: weight by their number.
    keyed = d.groupBy("source", "slice", "key").agg(F.sum("size").alias("key_size"), F.first("target").alias("target"),
                                                   F.first("source_size").alias("source_size"))
    keyed = common.stored(keyed, "mix-keys")
    totals = keyed.groupBy("source", "slice").agg(F.sum("key_size").alias("slice_size"))
    offset = F.sum("slice_size").over(Window.partitionBy("source").orderBy("slice")) - F.col("slice_size")
    totals = totals.select("source", "slice", offset.alias("offset"))
    j = keyed.alias("k").join(totals.alias("t"), F.col("k.source").eqNullSafe(F.col("t.source"))
                              & (F.col("k.slice") == F.col("t.slice"))).select("k.*", "t.offset")
    inside = Window.partitionBy("source", "slice").orderBy("key")
    j = j.withColumn("before", F.col("offset") + F.sum("key_size").over(inside) - F.col("key_size"))
    size = F.col("source_size")
    epochs = F.when(size > 0, F.floor(F.col("target") / size + F.lit(1e-9))).otherwise(F.lit(0)).cast("long")
    rest = F.col("target") - epochs * size
    more = F.col("before") + F.col("key_size") / 2.0 <= rest
    j = j.select("source", "slice", "key", (epochs + F.when(more & (rest > 0), 1).otherwise(0)).cast("long").alias("copies"))
    return d, common.stored(j, "mix-copies")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7,
        share: float = 1.0, max_epochs: float = 3.0, slice_rows: int = 2_000) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, copies, taken."""
    d, j = _decisions(docs, id_col, text_col, source_col, seed, share, max_epochs, slice_rows)
    out = d.alias("d").join(j.alias("j"), F.col("d.source").eqNullSafe(F.col("j.source"))
                            & (F.col("d.slice") == F.col("j.slice")) & (F.col("d.key") == F.col("j.key")))
    return out.select("d.doc_id", "d.source", "d.key", "d.size", "d.source_size", "d.target", "j.copies",
                      (F.col("j.copies") * F.col("d.size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7,
          share: float = 1.0, max_epochs: float = 3.0, slice_rows: int = 2_000) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    _, j = _decisions(docs, id_col, text_col, source_col, seed, share, max_epochs, slice_rows)
    taken = j.where("copies > 0").select(F.col("source").alias("__source"), F.col("key").alias("__key"), F.col("copies").alias("__copies"))
    d = docs.withColumn("__mix_key", document_key(id_col, text_col, seed))
    out = d.join(taken, (F.col("__mix_key") == F.col("__key")) & F.col(source_col).cast("string").eqNullSafe(F.col("__source")))
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))).select(*docs.columns)
