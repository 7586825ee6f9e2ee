"""Plan checks: pruning reaches the scan, no Python UDFs, LeftSemi for the key
filter, no global single-partition window over customers."""

import pytest

import __spark_entry__ as se
from starling.plans.catalog import QUERIES

from conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf(spark, name):
    plan = _plan(se.queries()[name](spark, SF001))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in plan, name


def test_scan_is_pruned(spark):
    plan = _plan(se.queries()["category_sales"](spark, SF001))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "lineitem" in line]
    assert scans, plan
    for s in scans:
        assert "l_extendedprice" not in s and "l_shipdate" not in s, s


def test_referential_filter_is_semi_join(spark):
    assert "LeftSemi" in _plan(se.queries()["fact_sales"](spark, SF001))


def test_rfm_has_no_global_window(spark):
    plan = _plan(se.queries()["rfm_sql"](spark, SF001))
    assert "ntile" not in plan.lower()
    plan_p = _plan(se.queries()["rfm_scores_bins"](spark, SF001))
    assert "row_number" not in plan_p.lower()


def test_category_sales_aggregates_before_join(spark):
    plan = _plan(se.queries()["category_sales"](spark, SF001))
    # partial aggregation per product happens below the join with the dimension
    lines = plan.splitlines()
    join_at = min(i for i, line in enumerate(lines) if "Join" in line)
    assert any("HashAggregate" in line and "product_id" in line for line in lines[join_at:])
