"""Plan checks on the registered jobs (built at sf0.001, not executed)."""
import pytest

import __spark_entry__ as E
from sparkwright.plans import registry
from tests.conftest import SF001

# jobs whose step needs Python inside tasks (see README "Python in tasks")
PANDAS_OK = {"doc_entropy", "interpolate_cubic", "replay_ledger_min", "bootstrap_ci", "combine_top3", "combine_product",
             # distinct values of a task's batches, by Arrow's hash tables
             "n_distinct_all", "type_profile", "optimize_types", "type_savings", "profile_table", "stored_sketches"}
# model jobs return small report frames built from fitted models: nothing to plan-check
SKIP = {"linear_sgd", "linear_elastic", "tree_regression", "gbt_regression", "logistic_accuracy",
        "linear_shap", "glm_binomial", "recommend_als", "linear_scored", "shap_ranking", "glm_summary", "glm_scored"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    queries = E.queries()
    for name in registry.jobs():
        if name not in SKIP:
            out[name] = _plan(queries[name](spark, SF001))
    return out


def test_no_cartesian_or_nested_loop_joins(plans):
    bad = [n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p]
    assert bad == []


def test_no_row_at_a_time_python_and_pandas_only_where_documented(plans):
    assert [n for n, p in plans.items() if "BatchEvalPython" in p] == []
    py = {n for n, p in plans.items()
          if any(k in p for k in ("ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow"))}
    assert py <= PANDAS_OK


def test_top_k_lookup_is_broadcast_and_pruned(plans):
    p = plans["top10_items"]
    assert "TakeOrderedAndProject" in p and "BroadcastHashJoin" in p
    assert "ReadSchema: struct<l_partkey:bigint>" in p


def test_range_filters_reach_the_scan(plans):
    p = plans["reconcile_stats"]
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p
    assert "GreaterThanOrEqual(l_shipdate" in p
    assert "PushedFilters: [IsNotNull(c_acctbal), GreaterThanOrEqual(c_acctbal,1000.0)" in plans["sql_range_view"]


def test_aggregates_are_partial_before_the_shuffle(plans):
    for n in ("popular_items", "word_count", "spend_by_customer", "most_connected"):
        assert "partial_count" in plans[n] or "partial_sum" in plans[n], n


def test_entry_module_imports_without_a_session():
    import subprocess
    import sys
    code = ("import sys; sys.path.insert(0, %r); import __spark_entry__ as E; "
            "q = E.queries(); o = E.oracle_sql(); assert set(o) <= set(q); print(len(q), len(o))") % E.__file__.rsplit("/", 1)[0]
    r = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert r.returncode == 0, r.stderr[-2000:]
