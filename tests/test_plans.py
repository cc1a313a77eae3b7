"""Plan shape of every registered query: no cross joins, no row-at-a-time Python,
and the scan reads only what it needs."""

import pytest

from cupola.plans.catalog import QUERIES
from tests.conftest import SF001

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cross_join_or_row_udf(spark, key):
    plan = QUERIES[key](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    for node in FORBIDDEN:
        assert node not in plan, f"{key}: {node}"


def test_time_filters_reach_the_scan(spark):
    plan = QUERIES["entity_features"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(ts," in plan
    plan = QUERIES["merchant_features"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(l_shipdate," in plan


def test_normalise_reads_only_needed_columns(spark):
    plan = QUERIES["discount_bands"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "l_suppkey" not in plan


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_wide_table_scans_are_pruned(spark, key):
    """No query needs every column of lineitem or orders: each such scan reads fewer."""
    import re

    width = {t: len(spark.read.parquet(f"{SF001}/{t}.parquet").columns) for t in ("lineitem", "orders")}
    plan = QUERIES[key](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        scan = re.search(r"FileScan parquet \[([^\]]*)\].*/(\w+)\.parquet\]", line)
        if scan and scan.group(2) in width:
            assert len(scan.group(1).split(",")) < width[scan.group(2)], (key, scan.group(2))


def test_flagship_shapes(spark):
    """Parsing is one projection over the scan; the band report adds one aggregate shuffle."""
    plan = QUERIES["coupon_normalise"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    plan = QUERIES["discount_bands"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "HashAggregate" in plan
