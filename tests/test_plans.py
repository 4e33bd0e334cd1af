"""Plan hygiene for every registered query: JVM-only, no cross joins, no stray single-task sorts."""

import pytest

from conftest import SF_SMALL

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas",
             "CartesianProduct", "BroadcastNestedLoopJoin")


def _queries():
    from peakflow.plans.registry import all_queries
    return all_queries()


# Forest-dependent and sink keys execute fits or writes while building; their plans are checked elsewhere.
SKIP_PREFIX = ("ml_", "sink_", "result_long_form")


@pytest.mark.parametrize("key", sorted(k for k in _queries() if not k.startswith(SKIP_PREFIX)))
def test_plan_is_jvm_only_without_cross_joins(spark, key):
    df = _queries()[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, (key, bad)


def test_preprocess_reads_each_table_once_per_branch(spark):
    """The labelled plan scans events in the row branch; window/threshold branches reuse its shuffle."""
    df = _queries()["preprocess"](spark, SF_SMALL)
    df.collect()
    final = _final_plan(df._jdf.queryExecution().executedPlan().toString())
    assert final.count("FileScan parquet") == 1, final
    assert "ReusedExchange" in final


def _final_plan(text: str) -> str:
    """Executed AQE plan without the (never run) 'Initial Plan' listings, nested ones included."""
    keep, skip_deeper_than = [], None
    for line in text.splitlines():
        indent = len(line) - len(line.lstrip(" :+-|"))
        if skip_deeper_than is not None and indent >= skip_deeper_than:
            continue
        skip_deeper_than = None
        if "== Initial Plan ==" in line:
            skip_deeper_than = indent
            continue
        keep.append(line)
    return "\n".join(keep)


def test_column_pruning_reaches_scan(spark):
    df = _queries()["top_routes"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    lineitem_scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "lineitem" in ln][0]
    assert "l_extendedprice" not in lineitem_scan and "l_suppkey" in lineitem_scan


def test_route_reports_count_before_the_supplier_join(spark):
    df = _queries()["top_routes"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    counts = next(i for i, ln in enumerate(plan) if "Aggregate [l_suppkey" in ln)
    assert counts > next(i for i, ln in enumerate(plan) if "Join" in ln)
    assert not any("rightHint" in ln or "leftHint" in ln for ln in plan)


@pytest.mark.parametrize("key", ["ml_string_index", "ml_one_hot", "ml_features", "flat_encoded", "ml_baseline", "ml_majority_class"])
def test_ml_keys_read_the_written_input(spark, key):
    df = _queries()[key](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "user_id" not in plan and "Expand" not in plan
    assert not any(bad in plan for bad in FORBIDDEN[:-1])
