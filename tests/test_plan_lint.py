"""Scale invariants of the physical plans (see tools/plan_lint.py)."""
import importlib.util
import os

import pytest

import __spark_entry__ as E

_spec = importlib.util.spec_from_file_location(
    "plan_lint", os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools", "plan_lint.py"))
lint = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(lint)


@pytest.mark.parametrize("name", ["customer_360", "product_performance", "fact_order_products", "rpt_departments",
                                  "rpt_kpi", "fact_orders_incremental", "dim_products_scd2"])
def test_no_unbounded_single_task_stage(spark, name):
    plan = E.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SortAggregate" not in plan
    feeders = set(lint.single_partition_feeders(plan))
    assert feeders <= set(lint.BOUNDED_FEEDERS), feeders
