"""NTILE by selection equals the window function: ties, hot values, nulls,
few rows, wide numbers."""

from __future__ import annotations

import random
from decimal import Decimal as D

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from revmart.operators import selection
from revmart.operators.selection import select_ntiles


def reference(df, k):
    up = Window.orderBy(F.col("m").asc_nulls_last(), F.col("id").asc_nulls_last())
    down = Window.orderBy(F.col("m").desc_nulls_first(), F.col("id").asc_nulls_last())
    wide = Window.orderBy(F.col("d").asc_nulls_last(), F.col("id").asc_nulls_last())
    out = df.withColumn("t", F.ntile(k).over(up)).withColumn("u", F.ntile(k).over(down)).withColumn("w", F.ntile(k).over(wide))
    return sorted(map(repr, map(tuple, out.collect())))


def selected(df, k):
    out = select_ntiles(df, k, {"t": F.col("m"), "u": -F.col("m"), "w": F.col("d")}, "id", nulls_first=frozenset({"u"}))
    return sorted(map(repr, map(tuple, out.collect())))


@pytest.mark.parametrize("n,seed", [(1, 0), (3, 1), (5, 2), (47, 3), (1200, 4)])
def test_equals_the_window(spark, n, seed):
    r = random.Random(seed)
    rows = [(f"c{i}" if i else None, None if r.random() < .1 else r.choice([1, 1, 1, 2, 7, 7, r.randrange(50)]),
             None if r.random() < .3 else D(r.choice([10 ** 17, 10 ** 17 + 1, -5, r.randrange(10 ** 18)])).scaleb(-2)) for i in range(n)]
    df = spark.createDataFrame(rows, "id string, m int, d decimal(38,2)").checkpoint()
    assert selected(df, 5) == reference(df, 5)


def test_all_null_and_all_equal(spark):
    df = spark.createDataFrame([(f"{i:012d}", None, D(1)) for i in range(23)], "id string, m int, d decimal(38,2)").checkpoint()
    assert selected(df, 5) == reference(df, 5)


def test_a_sketch_that_misses_is_replaced(spark, monkeypatch):
    monkeypatch.setattr(selection.F, "percentile_approx", lambda v, at, acc: F.array(*[F.lit(10 ** 6)] * len(at)))
    df = spark.createDataFrame([(f"c{i}", i % 17, D(i)) for i in range(60)], "id string, m int, d decimal(38,2)").checkpoint()
    assert selected(df, 4) == reference(df, 4)


def test_no_rows(spark):
    df = spark.createDataFrame([], "id string, m int, d decimal(38,2)").checkpoint()
    assert selected(df, 5) == []


def test_only_counts_move(spark):
    """No range partitioning and no row-wise exchange: every shuffle lies above
    a partial aggregate or carries one row per cut."""
    from revmart.plans.warehouse import Warehouse
    from tests.conftest import SF_SMALL
    plans = []
    keep = selection._pick

    def spy(grouped, *a):
        plans.append(grouped._jdf.queryExecution().executedPlan().toString())
        return keep(grouped, *a)
    selection._pick = spy
    try:
        w = Warehouse.from_testdata(spark, SF_SMALL)
        assert w["vw_customer_rfm"].count() > 0
    finally:
        selection._pick = keep
    assert plans and not any("rangepartitioning" in p for p in plans)
    assert all("partial_count" in p for p in plans)
