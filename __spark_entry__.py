"""
DuckDB ``oracle_sql``.

Every query reads the given parquet tables in full. Scores are rounded to 6
decimals and ties are broken by the smaller partner id on both sides, so the
Spark result and the SQL result are the same set of rows.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinsift.config import DEFAULT_THRESHOLDS, EntitySpec
from twinsift.functions.text import with_combined_text
from twinsift.operators import analyze, candidates, dedupe, quality

K = 3
DOCS = EntitySpec("documents", "doc_id", ("doc_id", "source", "n_chars"), 0.8, text_mode="shingles")
PARTS = EntitySpec("part", "p_partkey", ("p_partkey", "p_retailprice"), 0.85, text_mode="tokens")


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cands(spark, sf_dir, spec: EntitySpec, method: str = "exact") -> DataFrame:
    return candidates.detect_candidates(_t(spark, sf_dir, spec.entity_name), spec, K, method)


def _pairs(spark, sf_dir, spec: EntitySpec) -> DataFrame:
    """Candidates without the texts (what analysis and dedupe read)."""
    silver = with_combined_text(_t(spark, sf_dir, spec.entity_name), spec.exclude)
    texts = silver.select(F.col(spec.primary_key).alias("id"), F.col("combined_data").alias("text"))
    return candidates.similarity_pairs(texts, K, "exact", spec.text_mode)


# ---------------------------------------------------------------- entry
def entry(spark: SparkSession) -> DataFrame:
    """Flagship: documents -> combined text -> exact shingle cosine top-3 ->
    rows kept at threshold 0.8 (sf0.001)."""
    return _q_dedupe_by_threshold(spark, "/root/testdata/sf0.001")


# ---------------------------------------------------------------- queries
def _q_combined_text(spark, sf):
    part = _t(spark, sf, "part")
    return with_combined_text(part, PARTS.exclude)


def _q_combined_text_nulls(spark, sf):
    part = _t(spark, sf, "part").select(
        "p_partkey", F.expr("nullif(p_name, 'small ring')").alias("p_name"),
        F.expr("nullif(p_brand, 'Brand#2')").alias("p_brand"), F.expr("nullif(p_type, 'SMALL')").alias("p_type"),
        "p_size", "p_retailprice")
    return with_combined_text(part, PARTS.exclude).select("p_partkey", "combined_data")


def _q_sparse_cosine_topk(spark, sf):
    return _pairs(spark, sf, DOCS)


def _q_sparse_cosine_ties(spark, sf):
    return _pairs(spark, sf, PARTS)


def _q_dense_knn_topk(spark, sf):
    from twinsift.operators.knn import dense_knn_topk
    return dense_knn_topk(_t(spark, sf, "embeddings"), "vec_id", "embedding", K)


def _q_detect_candidates(spark, sf):
    return _cands(spark, sf, DOCS)


def _q_score_stats(spark, sf):
    return analyze.score_stats(_pairs(spark, sf, DOCS)).select(
        F.round("avg_search_score", 6).alias("avg_search_score"), "median_search_score", "top_quartile_score",
        "potential_duplicate_pairs_above_99", "pair_count")


def _q_best_score_per_record(spark, sf):
    return analyze.best_score_per_record(_pairs(spark, sf, DOCS))


def _q_perfect_score_records(spark, sf):
    return analyze.perfect_score_records(_pairs(spark, sf, DOCS))


def _q_threshold_sweep(spark, sf):
    return analyze.threshold_sweep(_pairs(spark, sf, DOCS), _t(spark, sf, "documents"))


def _q_analyze_entities(spark, sf):
    out = None
    for spec in (DOCS, PARTS):
        a = analyze.analyze_candidates(_pairs(spark, sf, spec), _t(spark, sf, spec.entity_name), spec.entity_name)
        a = a.withColumn("avg_search_score", F.round("avg_search_score", 6))
        out = a if out is None else out.unionByName(a)
    return out


def _q_removable_ids(spark, sf):
    return dedupe.removable_ids(_pairs(spark, sf, DOCS), DOCS.threshold)


def _q_dedupe_by_threshold(spark, sf):
    return dedupe.dedupe_by_threshold(_t(spark, sf, "documents"), _pairs(spark, sf, DOCS), "doc_id", DOCS.threshold)


def _q_distinct_rows(spark, sf):
    part = _t(spark, sf, "part")
    doubled = part.unionByName(part)
    return dedupe.dedupe_by_threshold(doubled, _pairs(spark, sf, PARTS), "p_partkey", PARTS.threshold)


def _q_dedupe_report(spark, sf):
    out = None
    for spec in (DOCS, PARTS):
        base = _t(spark, sf, spec.entity_name)
        kept = dedupe.dedupe_by_threshold(base, _pairs(spark, sf, spec), spec.primary_key, spec.threshold)
        r = dedupe.dedupe_report(base, kept, spec.entity_name, spec.threshold)
        out = r if out is None else out.unionByName(r)
    return out


def _orders_with_nulls(spark, sf):
    return _t(spark, sf, "orders").select(
        "o_orderkey", F.expr("nullif(o_custkey, 1)").alias("o_custkey"),
        F.expr("nullif(o_orderstatus, 'F')").alias("o_orderstatus"), "o_totalprice", "o_orderdate",
        F.expr("nullif(o_orderpriority, '1-URGENT')").alias("o_orderpriority"))


def _q_not_null_check(spark, sf):
    return quality.not_null_check(_orders_with_nulls(spark, sf),
                                  ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])


def _q_unique_key_check(spark, sf):
    return quality.unique_key_check(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def _q_foreign_key_check(spark, sf):
    return quality.foreign_key_check(_t(spark, sf, "orders"), "o_custkey", _t(spark, sf, "customer"), "c_custkey")


def _q_foreign_key_orphans(spark, sf):
    parent = _t(spark, sf, "customer").where(F.col("c_mktsegment") != F.lit("BUILDING"))
    return quality.foreign_key_check(_orders_with_nulls(spark, sf), "o_custkey", parent, "c_custkey")


def _doc_texts(spark, sf):
    silver = with_combined_text(_t(spark, sf, "documents"), DOCS.exclude)
    return silver.select(F.col("doc_id").alias("id"), F.col("combined_data").alias("text"))


def _q_bm25_topk(spark, sf):
    from twinsift.operators.keyword import bm25_topk
    return bm25_topk(_t(spark, sf, "benchmark"), "item_id", "text", _t(spark, sf, "documents"), "doc_id", "text", K)


def _q_bm25_max_score(spark, sf):
    from twinsift.operators.keyword import bm25_topk
    return bm25_topk(_t(spark, sf, "benchmark"), "item_id", "text", _t(spark, sf, "documents"), "doc_id", "text", K, plan="max_score")


def _q_hybrid_rrf_topk(spark, sf):
    from twinsift.operators.hybrid import hybrid_topk
    return hybrid_topk(_doc_texts(spark, sf), "id", "text", K)


def _q_minhash_candidates(spark, sf):
    from twinsift.operators.lsh import minhash_topk
    return minhash_topk(_doc_texts(spark, sf), "id", "text", K)


def _q_lsh_candidates(spark, sf):
    from twinsift.operators.lsh import hyperplane_topk
    return hyperplane_topk(_t(spark, sf, "embeddings"), "vec_id", "embedding", K)


def _q_hash_embed(spark, sf):
    from twinsift.functions.vectorize import embed
    out = embed(_t(spark, sf, "documents").select("doc_id", "text"), "text")
    return out.select("doc_id", F.transform("embedding", lambda x: F.round(x.cast("double"), 6)).alias("embedding"))


def _q_dense_detect(spark, sf):
    return _cands(spark, sf, DOCS, method="dense")


def _q_incremental_candidates(spark, sf):
    """The documents table streamed in three file batches through the
    incremental handler; the final lists must equal the batch exact result
    (same oracle as sparse_cosine_topk)."""
    import uuid

    from twinsift.session import ensure_checkpoint_dir
    from twinsift.streaming.incremental import run_incremental

    run = f"{ensure_checkpoint_dir(spark).rstrip('/')}/incremental-{uuid.uuid4().hex}"
    docs = _doc_texts(spark, sf)
    docs.repartition(3).write.parquet(f"{run}/source")
    handler = run_incremental(spark, f"{run}/source", docs.schema, f"{run}/state", f"{run}/checkpoint",
                              "id", "text", K, DOCS.text_mode)
    return handler.latest()


def _q_repeated_keys_topk(spark, sf):
    """``part`` twice: a repeated key is one record, so the lists are those of
    ``part`` once."""
    silver = with_combined_text(_t(spark, sf, "part"), PARTS.exclude)
    texts = silver.select(F.col("p_partkey").alias("id"), F.col("combined_data").alias("text"))
    return candidates.similarity_pairs(texts.unionByName(texts), K, "exact", PARTS.text_mode)


def _run_folder(spark, name: str) -> str:
    import uuid

    from twinsift.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _q_written_table(spark, sf):
    """Overwrite sink twice, with column comments, and the scan of it."""
    from twinsift.sources.tables import read_table, write_overwrite

    path = _run_folder(spark, "written") + "/part"
    part = _t(spark, sf, "part")
    for _ in range(2):
        write_overwrite(part, path, comments={"p_name": "the part's name"})
    return read_table(spark, path)


def _job(spark, sf):
    from twinsift.config import JobParams
    from twinsift.plans import jobs

    spec = EntitySpec(f"{sf.rstrip('/')}/part.parquet", PARTS.primary_key, PARTS.exclude, PARTS.threshold, PARTS.text_mode)
    params = JobParams(catalog=_run_folder(spark, "lake"), num_results=K, method="exact", entities=(spec,))
    return jobs, params, spec, jobs.run_pipeline(spark, params, setup=True)


def _q_job_gold(spark, sf):
    """The job layer over ``part``: setup, checks, detect, analyze, dedupe,
    each step reading the tables the one before wrote; its gold table."""
    jobs, params, spec, _ = _job(spark, sf)
    return _read(spark, jobs.layout_of(params).gold(spec))


def _q_job_analysis(spark, sf):
    jobs, params, _, _ = _job(spark, sf)
    out = _read(spark, jobs.layout_of(params).analysis())
    return out.withColumn("avg_search_score", F.round("avg_search_score", 6))


def _read(spark, name: str) -> DataFrame:
    return spark.read.parquet(name)


def _q_dense_knn_pivots(spark, sf):
    from twinsift.operators.knn import dense_knn_topk
    return dense_knn_topk(_t(spark, sf, "embeddings"), "vec_id", "embedding", K, plan="pivots")


def _q_embedding_table(spark, sf):
    """The documents embedded into a vector table twice; the second run finds
    every text there."""
    from twinsift.functions.vectorize import embedder
    from twinsift.sources.vector_table import VectorTable

    table = VectorTable(spark, _run_folder(spark, "vectors"), "hashed-char-ngrams")
    texts = _t(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    new = [table.sync(texts, embedder(table.model)) for _ in range(2)]
    out = table.vectors(texts).select(F.col("id").alias("doc_id"), F.transform("vec", lambda x: F.round(x.cast("double"), 6)).alias("embedding"))
    return out.withColumn("embedded_again", F.lit(new[1]).cast("long"))


def _q_merged_analysis(spark, sf):
    """The analysis of ``part`` from the histograms of three parts of its
    candidates (by original), added up."""
    pairs = _pairs(spark, sf, PARTS).checkpoint()
    base = _t(spark, sf, "part")
    in_part = lambda df, key, i: df.where(F.pmod(F.xxhash64(key), F.lit(3)) == i)
    parts = [analyze.score_histogram(in_part(pairs, "original_id", i), in_part(base, "p_partkey", i), "part") for i in range(3)]
    out = analyze.analysis_of_histogram(analyze.merged_histograms(*parts))
    return out.withColumn("avg_search_score", F.round("avg_search_score", 6))


def _q_declared_rules(spark, sf):
    parent = _t(spark, sf, "customer").where(F.col("c_mktsegment") != F.lit("BUILDING"))
    orders = _orders_with_nulls(spark, sf)
    return quality.table_rules(orders.unionByName(orders.where("o_orderstatus IS NULL")),
                               ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"], "o_orderkey", [("o_custkey", parent, "c_custkey")])


def _q_job_status(spark, sf):
    """Detection over a present, an absent and a failing entity."""
    from twinsift.config import JobParams
    from twinsift.plans import jobs

    at = lambda t: f"{sf.rstrip('/')}/{t}.parquet"
    entities = (EntitySpec(at("part"), PARTS.primary_key, PARTS.exclude, text_mode=PARTS.text_mode), EntitySpec(at("no_such_table"), "id"),
                EntitySpec(at("supplier"), "s_suppkey", ("no_such_column",)))
    params = JobParams(catalog=_run_folder(spark, "lake"), num_results=K, method="exact", entities=entities)
    status = jobs.detect_entities(spark, params)
    found = jobs.layout_of(params)
    rows = [(s.entity_name, status[s.entity_name].split(": ")[0], _read(spark, found.candidates(s)).count() if status[s.entity_name] == "ok" else 0) for s in entities]
    return spark.createDataFrame(rows, "entity_name string, status string, candidates long")


def _q_column_comments(spark, sf):
    """Comments written with a table and read back from it."""
    from twinsift.sources.tables import column_comments, write_overwrite

    path = _run_folder(spark, "commented") + "/orders"
    orders = _t(spark, sf, "orders")
    write_overwrite(orders, path, comments={c: f"{c} of an order" for c in orders.columns if c != "o_orderkey"})
    return column_comments(spark, path).select("column_name", "comment").withColumn("rows", F.lit(_read(spark, path).count()))


def _loose_orders(spark, sf):
    bad = F.when(F.col("o_orderkey") % 10 == 0, F.lit("31/12/1995")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return _t(spark, sf, "orders").select("o_orderkey", "o_custkey", bad.alias("o_orderdate"))


def _typed_load(spark, sf):
    from pyspark.sql import types as T
    from twinsift.sources.schemas import load_table

    path = _run_folder(spark, "typed") + "/orders"
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()), T.StructField("o_orderdate", T.DateType())])
    bad = [load_table(spark, path, _loose_orders(spark, sf), schema) for _ in range(2)][-1]
    return path, bad


def _q_typed_load(spark, sf):
    """``orders`` with its dates as text, loaded twice into a typed table."""
    out = _read(spark, _typed_load(spark, sf)[0])
    return out.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


def _q_typed_load_bad_cells(spark, sf):
    return _typed_load(spark, sf)[1]


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "combined_text": _q_combined_text,
    "combined_text_nulls": _q_combined_text_nulls,
    "dense_knn_topk": _q_dense_knn_topk,
    "sparse_cosine_topk": _q_sparse_cosine_topk,
    "sparse_cosine_ties": _q_sparse_cosine_ties,
    "detect_candidates": _q_detect_candidates,
    "score_stats": _q_score_stats,
    "best_score_per_record": _q_best_score_per_record,
    "perfect_score_records": _q_perfect_score_records,
    "threshold_sweep": _q_threshold_sweep,
    "analyze_entities": _q_analyze_entities,
    "removable_ids": _q_removable_ids,
    "dedupe_by_threshold": _q_dedupe_by_threshold,
    "distinct_rows": _q_distinct_rows,
    "dedupe_report": _q_dedupe_report,
    "not_null_check": _q_not_null_check,
    "unique_key_check": _q_unique_key_check,
    "foreign_key_check": _q_foreign_key_check,
    "foreign_key_orphans": _q_foreign_key_orphans,
    "bm25_topk": _q_bm25_topk,
    "hybrid_rrf_topk": _q_hybrid_rrf_topk,
    "minhash_candidates": _q_minhash_candidates,
    "lsh_candidates": _q_lsh_candidates,
    "hash_embed": _q_hash_embed,
    "dense_detect": _q_dense_detect,
    "incremental_candidates": _q_incremental_candidates,
    "repeated_keys_topk": _q_repeated_keys_topk,
    "written_table": _q_written_table,
    "job_gold": _q_job_gold,
    "job_analysis": _q_job_analysis,
    "dense_knn_pivots": _q_dense_knn_pivots,
    "bm25_max_score": _q_bm25_max_score,
    "embedding_table": _q_embedding_table,
    "merged_analysis": _q_merged_analysis,
    "declared_rules": _q_declared_rules,
    "job_status": _q_job_status,
    "column_comments": _q_column_comments,
    "typed_load": _q_typed_load,
    "typed_load_bad_cells": _q_typed_load_bad_cells,
}


def _llm_part(module: str):
    """``module`` of the optional subpackage, or None where its folders have
    been removed; any other import error is raised."""
    try:
        return importlib.import_module(module)
    except ModuleNotFoundError as e:
        if e.name in ("twinsift.llm", "twinsift.llm.queries", "corpus_pipeline"):
            return None
        raise


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = dict(_QUERIES)
    if (llm := _llm_part("twinsift.llm.queries")) is not None:
        out |= llm.QUERIES
    if (pipeline := _llm_part("corpus_pipeline")) is not None:
        out["pipeline"] = pipeline.run
    return out


# ---------------------------------------------------------------- oracle SQL
WORD = r"[^\p{L}\p{N}]+"
CODE = r"[^a-z0-9#]+"


def _sql_topk(src: str, mode: str, k: int = K) -> str:
    """CTEs ``texts(id, text)``, ``feat(id, s)``, ``cands(original_id,
    potential_duplicate_id, search_score)`` by brute force over ``src``
    (a SELECT of id and text)."""
    if mode == "shingles":
        feat = f"""
  tok AS (SELECT id, list_filter(regexp_split_to_array(lower(text), '{WORD}'), lambda x: x <> '') AS t FROM texts),
  feat AS (SELECT DISTINCT id, t[i] || ' ' || t[i + 1] || ' ' || t[i + 2] AS s
           FROM (SELECT id, t, unnest(range(1, len(t) - 1)) AS i FROM tok WHERE len(t) >= 3)
           UNION ALL SELECT id, array_to_string(t, ' ') FROM tok WHERE len(t) BETWEEN 1 AND 2)"""
    else:
        pat = CODE if mode == "tokens" else WORD
        feat = f"""
  tok AS (SELECT id, list_filter(regexp_split_to_array(lower(text), '{pat}'), lambda x: x <> '') AS t FROM texts),
  feat AS (SELECT DISTINCT id, unnest(t) AS s FROM tok)"""
    return f"""WITH texts AS ({src}),{feat},
  nf AS (SELECT id, count(*) AS n FROM feat GROUP BY id),
  pc AS (SELECT a.id AS original_id, b.id AS potential_duplicate_id, count(*) AS c
         FROM feat a JOIN feat b ON a.s = b.s AND a.id <> b.id GROUP BY 1, 2),
  scored AS MATERIALIZED (SELECT original_id, potential_duplicate_id, round(c / sqrt(na.n * nb.n), 6) AS search_score
             FROM pc JOIN nf na ON na.id = pc.original_id JOIN nf nb ON nb.id = pc.potential_duplicate_id),
  cands AS (SELECT * FROM scored QUALIFY row_number() OVER (
             PARTITION BY original_id ORDER BY search_score DESC, potential_duplicate_id) <= {k})"""


DOCS_SRC = "SELECT doc_id AS id, concat_ws(',', text, lang) AS text FROM documents WHERE doc_id IS NOT NULL"
PARTS_SRC = ("SELECT p_partkey AS id, concat_ws(',', p_name, p_brand, p_type, p_size) AS text "
             "FROM part WHERE p_partkey IS NOT NULL")
DOCS_TOPK = _sql_topk(DOCS_SRC, "shingles")
PARTS_TOPK = _sql_topk(PARTS_SRC, "tokens")


def _sql_bm25(src: str) -> str:
    """CTEs ``bd(id, t)`` (word lists) and ``wt(id, w, wt)`` (BM25 weights)."""
    return f"""
  bd AS (SELECT id, list_filter(regexp_split_to_array(lower(text), '{WORD}'), lambda x: x <> '') AS t FROM ({src})),
  bst AS (SELECT count(*) AS n, avg(len(t)) AS avgdl FROM bd),
  btf AS (SELECT id, dl, w, count(*) AS tf FROM (SELECT id, len(t) AS dl, unnest(t) AS w FROM bd) GROUP BY ALL),
  bdf AS (SELECT w, count(*) AS df FROM btf GROUP BY w),
  wt AS (SELECT btf.id, btf.w,
           ln(1.0::DOUBLE + (CAST(bst.n - bdf.df AS DOUBLE) + 0.5::DOUBLE) / (CAST(bdf.df AS DOUBLE) + 0.5::DOUBLE))
           * btf.tf * 2.2::DOUBLE / (btf.tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * btf.dl / bst.avgdl)) AS wt
         FROM btf JOIN bdf USING (w) CROSS JOIN bst)"""


def _sql_analysis(topk: str, base: str, name: str) -> str:
    sweep = " UNION ALL ".join(
        f"SELECT {t}::DOUBLE AS threshold, (SELECT count(*) FROM best WHERE max_score >= {t}::DOUBLE) AS c"
        for t in DEFAULT_THRESHOLDS)
    return f"""{topk},
  best AS (SELECT original_id, max(search_score) AS max_score FROM cands WHERE original_id IS NOT NULL GROUP BY 1),
  st AS (SELECT (SELECT count(*) FROM {base}) AS total,
                avg(search_score) AS av, quantile_disc(search_score, 0.5) AS med,
                quantile_disc(search_score, 0.75) AS q3,
                CAST(sum(CASE WHEN search_score > 0.99 THEN 1 ELSE 0 END) AS BIGINT) AS p99,
                (SELECT count(*) FROM best WHERE max_score = 1.0) AS mx FROM cands),
  sw AS ({sweep})
SELECT '{name}' AS entity_name, sw.threshold, CAST(sw.c AS BIGINT) AS duplicate_count,
       sw.c / st.total * 100.0 AS percent_duplicates, CAST(st.total AS BIGINT) AS total_record_count,
       round(st.av, 6) AS avg_search_score, st.med AS median_search_score,
       st.p99 AS potential_duplicate_pairs_above_99, st.q3 AS top_quartile_score,
       CAST(st.mx AS BIGINT) AS records_with_max_score
FROM sw, st"""


ORDERS_NULLS = """(SELECT o_orderkey, nullif(o_custkey, 1) AS o_custkey, nullif(o_orderstatus, 'F') AS o_orderstatus,
  o_totalprice, o_orderdate, nullif(o_orderpriority, '1-URGENT') AS o_orderpriority FROM orders)"""

_SQL: dict[str, str] = {
    "combined_text": """SELECT *, concat_ws(',', p_name, p_brand, p_type, p_size) AS combined_data FROM part""",
    "combined_text_nulls": """SELECT p_partkey, concat_ws(',', nullif(p_name, 'small ring'), nullif(p_brand, 'Brand#2'),
  nullif(p_type, 'SMALL'), p_size) AS combined_data FROM part""",
    "dense_knn_topk": """WITH e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
                 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
  p AS (SELECT a.id AS original_id, b.id AS potential_duplicate_id,
               list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) AS cs
        FROM e a JOIN e b ON a.id <> b.id),
  s AS (SELECT original_id, potential_duplicate_id, round(greatest(least(cs, 1.0), 0.0), 6) AS search_score FROM p)
SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY original_id ORDER BY search_score DESC, potential_duplicate_id) <= 3""",
    "sparse_cosine_topk": DOCS_TOPK + "\nSELECT * FROM cands",
    "sparse_cosine_ties": PARTS_TOPK + "\nSELECT * FROM cands",
    "detect_candidates": DOCS_TOPK + """
SELECT c.original_id, o.text AS original_combined_data, c.potential_duplicate_id,
       p.text AS potential_duplicate_combined_data, c.search_score
FROM cands c JOIN texts o ON o.id = c.original_id JOIN texts p ON p.id = c.potential_duplicate_id""",
    "score_stats": DOCS_TOPK + """
SELECT round(avg(search_score), 6) AS avg_search_score, quantile_disc(search_score, 0.5) AS median_search_score,
       quantile_disc(search_score, 0.75) AS top_quartile_score,
       CAST(sum(CASE WHEN search_score > 0.99 THEN 1 ELSE 0 END) AS BIGINT) AS potential_duplicate_pairs_above_99,
       count(*) AS pair_count FROM cands""",
    "best_score_per_record": DOCS_TOPK + """
SELECT original_id, max(search_score) AS max_score FROM cands WHERE original_id IS NOT NULL GROUP BY 1""",
    "perfect_score_records": DOCS_TOPK + """
SELECT original_id, max(search_score) AS max_score FROM cands WHERE original_id IS NOT NULL GROUP BY 1
HAVING max(search_score) = 1.0""",
    "threshold_sweep": "SELECT threshold, duplicate_count, percent_duplicates FROM (\n"
                       + _sql_analysis(DOCS_TOPK, "documents", "") + ")",
    "analyze_entities": "SELECT * FROM (" + _sql_analysis(DOCS_TOPK, "documents", "documents")
                        + ") UNION ALL SELECT * FROM (" + _sql_analysis(PARTS_TOPK, "part", "part") + ")",
    "removable_ids": DOCS_TOPK + """
SELECT DISTINCT greatest(original_id, potential_duplicate_id) AS duplicate_id FROM cands
WHERE search_score >= 0.8::DOUBLE AND original_id IS NOT NULL AND potential_duplicate_id IS NOT NULL""",
    "dedupe_by_threshold": DOCS_TOPK + """
SELECT DISTINCT d.* FROM documents d WHERE d.doc_id NOT IN (
  SELECT greatest(original_id, potential_duplicate_id) FROM cands
  WHERE search_score >= 0.8::DOUBLE AND original_id IS NOT NULL AND potential_duplicate_id IS NOT NULL)
  OR d.doc_id IS NULL""",
    "distinct_rows": PARTS_TOPK + """
SELECT DISTINCT p.* FROM (SELECT * FROM part UNION ALL SELECT * FROM part) p WHERE p.p_partkey NOT IN (
  SELECT greatest(original_id, potential_duplicate_id) FROM cands
  WHERE search_score >= 0.85::DOUBLE AND original_id IS NOT NULL AND potential_duplicate_id IS NOT NULL)""",
    "dedupe_report": "SELECT * FROM (" + DOCS_TOPK + """
SELECT 'documents' AS entity_name, 0.8::DOUBLE AS threshold, oc AS original_count, fc AS filtered_count,
  oc - fc AS removed_count FROM (SELECT (SELECT count(*) FROM documents) AS oc,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM documents WHERE doc_id NOT IN (
     SELECT greatest(original_id, potential_duplicate_id) FROM cands WHERE search_score >= 0.8::DOUBLE))) AS fc))
UNION ALL SELECT * FROM (""" + PARTS_TOPK + """
SELECT 'part' AS entity_name, 0.85::DOUBLE AS threshold, oc AS original_count, fc AS filtered_count,
  oc - fc AS removed_count FROM (SELECT (SELECT count(*) FROM part) AS oc,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM part WHERE p_partkey NOT IN (
     SELECT greatest(original_id, potential_duplicate_id) FROM cands WHERE search_score >= 0.85::DOUBLE))) AS fc))""",
    "not_null_check": f"""SELECT column_name, null_count FROM (
  SELECT 'o_orderkey' AS column_name, count(*) FILTER (WHERE o_orderkey IS NULL) AS null_count FROM {ORDERS_NULLS}
  UNION ALL SELECT 'o_custkey', count(*) FILTER (WHERE o_custkey IS NULL) FROM {ORDERS_NULLS}
  UNION ALL SELECT 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus IS NULL) FROM {ORDERS_NULLS}
  UNION ALL SELECT 'o_orderdate', count(*) FILTER (WHERE o_orderdate IS NULL) FROM {ORDERS_NULLS}
  UNION ALL SELECT 'o_orderpriority', count(*) FILTER (WHERE o_orderpriority IS NULL) FROM {ORDERS_NULLS})""",
    "unique_key_check": """SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1""",
    "foreign_key_check": """SELECT o.* FROM orders o WHERE o.o_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)""",
    "foreign_key_orphans": f"""SELECT o.* FROM {ORDERS_NULLS} o WHERE o.o_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_mktsegment <> 'BUILDING')""",
}


_SQL["bm25_topk"] = "WITH " + _sql_bm25(
    "SELECT doc_id AS id, text FROM documents WHERE doc_id IS NOT NULL").lstrip() + f""",
  q AS (SELECT DISTINCT item_id AS qid,
          unnest(list_filter(regexp_split_to_array(lower(text), '{WORD}'), lambda x: x <> '')) AS w
        FROM benchmark WHERE item_id IS NOT NULL),
  sc AS (SELECT q.qid, wt.id, round(sum(wt.wt), 6) AS s FROM q JOIN wt ON q.w = wt.w GROUP BY 1, 2)
SELECT qid AS original_id, id AS potential_duplicate_id, s AS bm25_score FROM sc
QUALIFY row_number() OVER (PARTITION BY qid ORDER BY s DESC, id) <= {K}"""

_SQL["hybrid_rrf_topk"] = _sql_topk(DOCS_SRC, "shingles") + "," + _sql_bm25(DOCS_SRC) + f""",
  kw AS MATERIALIZED (SELECT q.id AS original_id, wt.id AS potential_duplicate_id, round(sum(wt.wt), 6) AS bm25_score
         FROM (SELECT id, w FROM btf) q JOIN wt ON q.w = wt.w AND q.id <> wt.id GROUP BY 1, 2),
  kwr AS (SELECT *, row_number() OVER (PARTITION BY original_id ORDER BY bm25_score DESC, potential_duplicate_id)
          AS r_kw FROM kw),
  vr AS (SELECT *, row_number() OVER (PARTITION BY original_id ORDER BY search_score DESC, potential_duplicate_id)
         AS r_vec FROM scored),
  fused AS (SELECT coalesce(v.original_id, k.original_id) AS original_id,
                   coalesce(v.potential_duplicate_id, k.potential_duplicate_id) AS potential_duplicate_id,
                   round(coalesce(1.0::DOUBLE / (60 + r_vec), 0.0::DOUBLE)
                         + coalesce(1.0::DOUBLE / (60 + r_kw), 0.0::DOUBLE), 9) AS rrf_score
            FROM vr v FULL OUTER JOIN kwr k
              ON v.original_id = k.original_id AND v.potential_duplicate_id = k.potential_duplicate_id),
  top AS (SELECT * FROM fused QUALIFY row_number() OVER (
            PARTITION BY original_id ORDER BY rrf_score DESC, potential_duplicate_id) <= {K})
SELECT top.original_id, top.potential_duplicate_id, coalesce(s.search_score, 0.0::DOUBLE) AS search_score,
       top.rrf_score
FROM top LEFT JOIN scored s USING (original_id, potential_duplicate_id)"""


_SQL["repeated_keys_topk"] = _SQL["sparse_cosine_ties"]
_SQL["written_table"] = "SELECT * FROM part"
_SQL["job_gold"] = _SQL["distinct_rows"]
_SQL["job_analysis"] = _sql_analysis(PARTS_TOPK, "part", "part")
_SQL["minhash_candidates"] = _sql_topk(DOCS_SRC, "shingles") + """,
  x AS (SELECT DISTINCT id, ('0x' || substr(md5(s), 1, 7))::BIGINT AS x FROM feat),
  co AS (SELECT i, ('0x' || substr(md5('a' || i), 1, 7))::BIGINT + 1 AS a, ('0x' || substr(md5('b' || i), 1, 7))::BIGINT AS b
         FROM range(0, 64) t(i)),
  sig AS (SELECT id, i, min((a * x + b) % 2147483647) AS m FROM x, co GROUP BY id, i),
  band AS (SELECT id, i // 4 AS band, list(m ORDER BY i) AS key FROM sig GROUP BY id, i // 4),
  near AS (SELECT DISTINCT a.id AS original_id, b.id AS potential_duplicate_id
           FROM band a JOIN band b ON a.band = b.band AND a.key = b.key AND a.id <> b.id)
SELECT * FROM scored JOIN near USING (original_id, potential_duplicate_id)
QUALIFY row_number() OVER (PARTITION BY original_id ORDER BY search_score DESC, potential_duplicate_id) <= 3"""

_SQL["lsh_candidates"] = """WITH e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
  n AS (SELECT greatest(6, ceil(log2(count(*) / 8.0)))::BIGINT AS bits, max(len(v)) AS dim FROM e),
  pl AS (SELECT j, list(1.0 - 2.0 * (('0x' || substr(md5(i || ':' || j), 1, 1))::BIGINT & 1) ORDER BY i)::DOUBLE[] AS p
         FROM n, range(0, 64) a(i), range(0, 48 * 24) b(j) WHERE i < dim AND j < 48 * bits GROUP BY j),
  bt AS (SELECT id, j // bits AS band, list(CASE WHEN list_dot_product(v, p) >= 0 THEN 1 ELSE 0 END ORDER BY j) AS key
         FROM e, pl, n GROUP BY id, j // bits),
  near AS (SELECT DISTINCT a.id AS original_id, b.id AS potential_duplicate_id
           FROM bt a JOIN bt b ON a.band = b.band AND a.key = b.key AND a.id <> b.id),
  s AS (SELECT original_id, potential_duplicate_id, round(greatest(least(list_dot_product(a.v, b.v)
          / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)), 1.0), 0.0), 6) AS search_score
        FROM near JOIN e a ON a.id = original_id JOIN e b ON b.id = potential_duplicate_id)
SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY original_id ORDER BY search_score DESC, potential_duplicate_id) <= 3"""

EMBEDDED = """
  gr AS (SELECT id, substr(md5(substr(t, i::INT, 3)), 1, 10) AS h FROM (
           SELECT id, t, unnest(range(1, length(t) - 1)) AS i FROM (SELECT id, lower(text) AS t FROM texts))),
  gc AS (SELECT id, ('0x' || substr(h, 1, 8))::BIGINT % 64 AS p, sum(1 - 2 * (('0x' || substr(h, 9, 2))::BIGINT % 2))::DOUBLE AS c
         FROM gr GROUP BY 1, 2),
  gn AS (SELECT id, sqrt(sum(c * c)) AS n FROM gc GROUP BY id),
  em AS (SELECT id, list((coalesce(c / nullif(n, 0), 0))::FLOAT ORDER BY p) AS v
         FROM (SELECT id, p FROM texts, range(0, 64) r(p)) LEFT JOIN gc USING (id, p) LEFT JOIN gn USING (id) GROUP BY id)"""

_SQL["hash_embed"] = "WITH texts AS (SELECT doc_id AS id, text FROM documents)," + EMBEDDED + """
SELECT id AS doc_id, list_transform(v, lambda x: round(x::DOUBLE, 6)) AS embedding FROM em"""

_SQL["dense_detect"] = f"WITH texts AS ({DOCS_SRC})," + EMBEDDED + f""",
  d AS MATERIALIZED (SELECT id, v::DOUBLE[] AS v, sqrt(list_dot_product(v::DOUBLE[], v::DOUBLE[])) AS n FROM em),
  s AS (SELECT a.id AS original_id, b.id AS potential_duplicate_id,
          round(greatest(least(coalesce(list_dot_product(a.v, b.v) / nullif(a.n * b.n, 0), 0), 1.0), 0.0), 6) AS search_score
        FROM d a JOIN d b ON a.id <> b.id),
  c AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY original_id ORDER BY search_score DESC, potential_duplicate_id) <= {K})
SELECT original_id, o.text AS original_combined_data, potential_duplicate_id, p.text AS potential_duplicate_combined_data, search_score
FROM c JOIN texts o ON o.id = original_id JOIN texts p ON p.id = potential_duplicate_id"""

_SQL["bm25_max_score"] = _SQL["bm25_topk"]
_SQL["dense_knn_pivots"] = _SQL["dense_knn_topk"]
_SQL["embedding_table"] = "SELECT *, 0::BIGINT AS embedded_again FROM (" + _SQL["hash_embed"] + ")"
_SQL["merged_analysis"] = _SQL["job_analysis"]
_RULES_TABLE = f"(SELECT * FROM {ORDERS_NULLS} UNION ALL SELECT * FROM {ORDERS_NULLS} WHERE o_orderstatus IS NULL)"
_SQL["declared_rules"] = "WITH t AS (SELECT * FROM " + _RULES_TABLE + """)
SELECT 'not_null' AS rule, 'o_orderkey' AS columns, count(*) FILTER (o_orderkey IS NULL) AS violations FROM t
UNION ALL SELECT 'not_null', 'o_custkey', count(*) FILTER (o_custkey IS NULL) FROM t
UNION ALL SELECT 'not_null', 'o_orderstatus', count(*) FILTER (o_orderstatus IS NULL) FROM t
UNION ALL SELECT 'not_null', 'o_orderpriority', count(*) FILTER (o_orderpriority IS NULL) FROM t
UNION ALL SELECT 'primary_key', 'o_orderkey', count(*) FROM (SELECT o_orderkey FROM t GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'foreign_key', 'o_custkey', count(*) FROM t WHERE o_custkey IS NOT NULL
  AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')"""
_SQL["job_status"] = PARTS_TOPK + """
SELECT 'part' AS entity_name, 'ok' AS status, count(*) AS candidates FROM cands
UNION ALL SELECT 'no_such_table', 'skipped', 0 UNION ALL SELECT 'supplier', 'failed', 0"""
_SQL["column_comments"] = """SELECT column_name, CASE WHEN column_name <> 'o_orderkey' THEN column_name || ' of an order' END AS comment,
  (SELECT count(*) FROM orders) AS rows FROM (DESCRIBE SELECT * FROM orders)"""
_SQL["typed_load"] = "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate::DATE::VARCHAR END AS o_orderdate FROM orders"
_SQL["typed_load_bad_cells"] = """SELECT 'o_orderdate' AS column_name, '31/12/1995' AS value, count(*) AS n FROM orders
WHERE o_orderkey % 10 = 0 HAVING count(*) > 0"""
_SQL["incremental_candidates"] = _SQL["sparse_cosine_topk"]


def oracle_sql() -> dict[str, str]:
    out = {k: v for k, v in _SQL.items() if k in _QUERIES}
    if (llm := _llm_part("twinsift.llm.queries")) is not None:
        out |= llm.ORACLE_SQL
    if (pipeline := _llm_part("corpus_pipeline")) is not None and pipeline.ORACLE_SQL:
        out["pipeline"] = pipeline.ORACLE_SQL
    return out
