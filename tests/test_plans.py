"""Plan guards for every registered query: no cartesian or nested-loop
joins, no Python UDF operators, and every single-partition exchange sits
above an aggregate, so base rows never flow into one task."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

# The optional training-data queries have plan tests of their own.
QUERIES = {n: q for n, q in E.queries().items() if n != "pipeline" and not n.startswith("op")}


def _depth(line: str) -> int:
    return len(line) - len(line.lstrip(" :+-"))


def _single_partition_children_are_aggregated(plan: str) -> list[str]:
    """For each single-partition exchange, the first aggregate-or-scan below
    it (pre-order) must be an aggregate."""
    lines = plan.splitlines()
    bad = []
    for i, ln in enumerate(lines):
        if "Exchange SinglePartition" not in ln or "Reused" in ln:
            continue
        d = _depth(ln)
        for sub in lines[i + 1:]:
            if _depth(sub) <= d:
                break
            if "HashAggregate" in sub or "ObjectHashAggregate" in sub or "SortAggregate" in sub:
                break
            if "Scan " in sub or "FileScan" in sub or "ExistingRDD" in sub:
                bad.append(ln.strip())
                break
    return bad


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_guards(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert op not in plan, f"{name}: {op}"
    assert _single_partition_children_are_aggregated(plan) == [], name


def test_guard_flags_a_window_over_base_rows(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(
        "l_orderkey", F.row_number().over(Window.orderBy("l_orderkey")).alias("rn"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert _single_partition_children_are_aggregated(plan) != []
