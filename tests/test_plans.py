"""Plan hygiene for every registered query: no cartesian products or
nested-loop joins anywhere, per-group limits planned as WindowGroupLimit."""

import pytest

import __spark_entry__ as E

from paths import SF0001

# top-k queries whose final plan holds the window (detect_candidates,
# dense_detect and hybrid_rrf_topk checkpoint their thin top-k before the
# joins that follow it)
TOPK = {"dense_knn_topk", "sparse_cosine_topk", "sparse_cosine_ties", "bm25_topk",
        "minhash_candidates", "lsh_candidates"}


@pytest.mark.parametrize("name", sorted(set(E._QUERIES) - {"incremental_candidates", "job_gold", "job_analysis"}))
def test_plan_has_no_cartesian_product(spark, name):
    df = E.queries()[name](spark, SF0001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    if name in TOPK:
        assert "WindowGroupLimit" in plan
