import datetime

import pytest
from pyspark.sql import functions as F

from twinsift.config import EntitySpec, JobParams
from twinsift.plans.jobs import Layout, analyze_entities, dedupe_entities, detect_entities, run_pipeline
from twinsift.sources import schemas
from twinsift.sources.tables import read_table


def _people(spark, root):
    rows = [(1, "Acme Health Corp", "Active"), (2, "Acme Health Corp", "Active"), (3, "Beta Care LLC", "Pending"),
            (4, "Gamma Mutual Inc", "Active"), (5, "Gamma Mutual Incc", "Active")]
    df = spark.createDataFrame(rows, "pid long, name string, status string")
    df.write.mode("overwrite").parquet(f"{root}/bronze/people")


def test_job_params_validation():
    with pytest.raises(ValueError):
        JobParams(catalog="")
    with pytest.raises(ValueError):
        JobParams(catalog="c", num_results=0)
    p = JobParams(catalog="c", num_results="3")
    assert p.num_results == 3 and len(p.thresholds) == 13


def test_pipeline_on_paths(spark, scratch):
    _people(spark, scratch)
    specs = (EntitySpec("people", "pid", ("pid",), 0.7, text_mode="tokens"),
             EntitySpec("missing", "id", ("id",), 0.9),
             EntitySpec("people_nothreshold", "pid", ("pid",), None))
    params = JobParams(catalog="local", num_results=2, entities=specs)
    layout = Layout(root=scratch)
    out = run_pipeline(spark, params, layout)
    assert out["detect"]["people"] == "ok" and out["detect"]["missing"].startswith("skipped")
    silver = read_table(spark, f"{scratch}/silver/people")
    assert "combined_data" in silver.columns
    gold = sorted(r.pid for r in read_table(spark, f"{scratch}/gold/people").collect())
    assert gold == [1, 3, 4]
    rep = out["report"].collect()
    assert [(r.entity_name, r.original_count, r.filtered_count, r.removed_count) for r in rep] == \
        [("people", 5, 3, 2)]
    analysis = read_table(spark, f"{scratch}/analysis/duplicate_analysis")
    assert analysis.count() == 13
    assert analysis.schema["threshold"].metadata.get("comment")


def test_source_names_count_drop_and_setup(spark, scratch):
    import os

    rows = [(1, "Acme Health Corp"), (2, "Acme Health Corp")]
    spark.createDataFrame(rows, "pid long, name string").write.parquet(f"{scratch}/elsewhere/people.parquet")
    specs = (EntitySpec(f"{scratch}/elsewhere/people.parquet", "pid", ("pid",), 0.7), EntitySpec("missing", "id", ("id",), 0.9))
    params = JobParams(catalog=f"{scratch}/lake", entities=specs, method="exact", drop_candidates_after_dedupe=True)
    from twinsift.plans.jobs import layout_of
    assert layout_of(params).bronze(specs[0]) == specs[0].table
    assert Layout(catalog="c").bronze(EntitySpec("a.b.t", "id")) == "a.b.t" and Layout(catalog="c").bronze(EntitySpec("b.t", "id")) == "c.b.t"
    out = run_pipeline(spark, params, setup=True)
    assert out["analyzed"] == 1 and out["detect"]["people"] == "ok"
    assert not os.path.exists(f"{scratch}/lake/bronze/people_duplicate_candidates")
    found = {(r.table_name, r.rule, r.columns): r.violations for r in out["violations"].collect()}
    assert found["payer_network", "foreign_key", "payer_id"] == 0 and found["payer", "primary_key", "payer_id"] == 0
    with pytest.raises(ValueError):
        EntitySpec("t", "id", text_mode="dense")
    with pytest.raises(ValueError):
        detect_entities(spark, JobParams(catalog=scratch, embedding_model="nope"))


def test_declared_rules_find_violations(spark, scratch):
    from twinsift.plans.jobs import declared_violations
    t = {x.name: x for x in schemas.SOURCE_TABLES}
    schemas.rows_frame(spark, [(1, 7, 5), (2, 8, 6), (2, 8, 6)], t["payer_network"].schema).write.parquet(f"{scratch}/bronze/payer_network")
    spark.createDataFrame([(7,)], "payer_id long").write.parquet(f"{scratch}/bronze/payer")
    one = Layout(root=scratch)
    import dataclasses
    tables = [dataclasses.replace(t["payer"], schema=spark.read.parquet(f"{scratch}/bronze/payer").schema), t["payer_network"]]
    found = {(r.table_name, r.rule): r.violations for r in declared_violations(spark, one, tables).collect()}
    assert found["payer_network", "primary_key"] == 1 and found["payer_network", "foreign_key"] == 2


def test_failing_entity_is_recorded(spark, scratch):
    _people(spark, scratch)
    specs = (EntitySpec("people", "pid", ("nope",)), EntitySpec("people", "pid", ("pid",)))
    st = detect_entities(spark, JobParams(catalog="c", entities=specs), Layout(root=scratch))
    assert st["people"] == "ok"  # the second run of the same entity still ran


def test_analysis_not_emptied_when_nothing_analysed(spark, scratch):
    _people(spark, scratch)
    layout = Layout(root=scratch)
    params = JobParams(catalog="c", entities=(EntitySpec("people", "pid", ("pid",), 0.9),))
    detect_entities(spark, params, layout)
    assert analyze_entities(spark, params, layout) == 1
    params2 = JobParams(catalog="c", entities=(EntitySpec("ghost", "id", ("id",), 0.9),))
    assert analyze_entities(spark, params2, layout) == 0
    assert read_table(spark, layout.analysis()).count() == 13
    assert dedupe_entities(spark, params2, layout).count() == 0


def test_setup_catalog_layers_and_overwrite_load(spark):
    made = schemas.create_layers(spark, tables=(schemas.PAYER_NETWORK, schemas.PAYER_ALT_NAME))
    assert made == ["bronze.payer_network", "bronze.payer_alt_name"]
    schemas.create_layers(spark, tables=(schemas.PAYER_ALT_NAME,))  # idempotent
    rows = [(1, 10, "Name One", "2024-01-02", None), (2, 10, "Name Two", "2023-05-06", "2024-01-01")]
    for _ in range(2):  # a rerun must not double the table
        schemas.load_rows(spark, "bronze.payer_alt_name", rows, schemas.PAYER_ALT_NAME.schema)
    t = spark.table("bronze.payer_alt_name")
    assert t.count() == 2
    assert t.where(F.col("alt_name_id") == 1).first().effective_date == datetime.date(2024, 1, 2)
    assert dict(t.dtypes)["effective_date"] == "date"
    assert "payer key" in [f.metadata.get("comment") for f in t.schema.fields]


def test_no_matches_writes_empty_typed_candidates(spark, scratch):
    df = spark.createDataFrame([(1, "alpha"), (2, "beta"), (3, "gamma")], "pid long, name string")
    df.write.mode("overwrite").parquet(f"{scratch}/bronze/lonely")
    layout = Layout(root=scratch)
    spec = EntitySpec("lonely", "pid", ("pid",), 0.9, text_mode="tokens")
    params = JobParams(catalog="c", entities=(spec,), method="exact")
    # a stale candidate table from an earlier run must be replaced
    spark.createDataFrame([(1, "x", 2, "y", 1.0)], "original_id long, original_combined_data string, "
                          "potential_duplicate_id long, potential_duplicate_combined_data string, "
                          "search_score double").write.mode("overwrite").parquet(layout.candidates(spec))
    assert detect_entities(spark, params, layout)["lonely"] == "ok"
    cands = read_table(spark, layout.candidates(spec))
    assert cands.count() == 0
    assert cands.columns == ["original_id", "original_combined_data", "potential_duplicate_id",
                             "potential_duplicate_combined_data", "search_score"]
    rep = dedupe_entities(spark, params, layout).first()
    assert (rep.original_count, rep.removed_count) == (3, 0)
    assert read_table(spark, layout.gold(spec)).count() == 3


def test_pipeline_on_catalog_tables_with_comments_and_drop(spark):
    from twinsift.sources.tables import set_column_comments
    schemas.create_layers(spark, tables=(schemas.PAYER_ALT_NAME,))
    rows = [(1, 10, "Acme Health", "2024-01-02", None), (2, 11, "Acme Health", "2024-01-02", None),
            (3, 12, "Beta Care", "2023-05-06", "2024-01-01")]
    schemas.load_rows(spark, "bronze.payer_alt_name", rows, schemas.PAYER_ALT_NAME.schema)
    spec = EntitySpec("payer_alt_name", "alt_name_id", ("alt_name_id", "payer_id"), 0.98, text_mode="tokens")
    params = JobParams(catalog="spark_catalog", entities=(spec,), drop_candidates_after_dedupe=True)
    layout = Layout(catalog="spark_catalog")
    out = run_pipeline(spark, params, layout)
    assert out["detect"]["payer_alt_name"] == "ok"
    assert sorted(r.alt_name_id for r in spark.table(layout.gold(spec)).collect()) == [1, 3]
    assert not spark.catalog.tableExists(layout.candidates(spec))  # dropped on request
    set_column_comments(spark, layout.analysis(), {"threshold": "cut-off it's for"})
    desc = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE TABLE {layout.analysis()}").collect()}
    assert desc["threshold"] == "cut-off it's for"
    assert desc["duplicate_count"]  # comment written with the table
