"""Plan checks over every registered query."""

import re

import pytest

from tidemark.plans import catalog

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas")
PRODUCT_JOINS = ("CartesianProduct", "BroadcastNestedLoopJoin")


def _formatted(spark, df):
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def check_plan(spark, df, name):
    plan = _formatted(spark, df)
    assert not any(n in plan for n in PYTHON_NODES), name
    assert not any(n in plan for n in PRODUCT_JOINS), name
    # every single-partition exchange is fed by a global aggregate's partial rows
    # (one per task), by the per-partition counts of the dense index or by a top-k
    simple = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    lines = simple.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = lines[i + 1]
            assert re.search(r"HashAggregate\(keys=\[(\]|_idx_part)", child) or "TakeOrderedAndProject" in child, \
                (name, child)
    return simple


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side is small: sort-merge joins everywhere a size does not decide."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_plans_without_broadcast(no_broadcast, name):
    simple = check_plan(no_broadcast, catalog.QUERIES[name](no_broadcast, SF), name)
    # campaign ids or regions alone (a dozen values) never deal out the rows of a join
    if name in ("individual_email_response", "monthly_kpi", "monthly_kpi_deduped"):
        assert not re.search(r"hashpartitioning\((campaign_id|id|blast_region)#\d+L?, \d+\)", simple), name
    if name.startswith("monthly_kpi"):
        assert "Expand" not in simple
