"""Distributed exact NTILE equals the single-partition window function."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from revmart.operators.ntile import add_ntile


@pytest.mark.parametrize("n", [1, 3, 4, 5, 7, 23, 1001])
@pytest.mark.parametrize("k", [5, 3])
def test_ntile_equals_window(spark, n, k):
    rnd = random.Random(n * 31 + k)
    rows = [(f"c{i:05d}", rnd.randint(0, 6)) for i in range(n)]  # many ties
    df = spark.createDataFrame(rows, "id string, m int")
    order = [F.col("m").asc_nulls_last(), F.col("id").asc_nulls_last()]
    got = {r["id"]: r["t"] for r in add_ntile(df, k, order, "t", num_partitions=4).collect()}
    ref = {r["id"]: r["t"] for r in df.withColumn(
        "t", F.ntile(k).over(Window.orderBy(*order))).collect()}
    assert got == ref
    sizes = {}
    for t in got.values():
        sizes[t] = sizes.get(t, 0) + 1
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_ntile_with_adaptive_range_partitions(spark):
    """No explicit partition count: AQE may coalesce neighbouring ranges."""
    rows = [(f"c{i:05d}", i % 13) for i in range(2503)]
    df = spark.createDataFrame(rows, "id string, m int").repartition(7)
    order = [F.col("m").desc_nulls_first(), F.col("id").asc_nulls_last()]
    got = {r["id"]: r["t"] for r in add_ntile(df, 5, order, "t").collect()}
    ref = {r["id"]: r["t"] for r in df.withColumn("t", F.ntile(5).over(Window.orderBy(*order))).collect()}
    assert got == ref


def test_ntile_nulls_last_and_null_ids(spark):
    rows = [("a", 3), ("b", None), (None, 1), ("c", 1), ("d", 2), ("e", 2)]
    df = spark.createDataFrame(rows, "id string, m int")
    order = [F.col("m").asc_nulls_last(), F.col("id").asc_nulls_last()]
    got = sorted((r["id"] or "", r["t"]) for r in add_ntile(df, 5, order, "t", 3).collect())
    ref = sorted((r["id"] or "", r["t"]) for r in df.withColumn(
        "t", F.ntile(5).over(Window.orderBy(*order))).collect())
    assert got == ref


def test_only_partition_counts_reach_a_single_partition(spark):
    """Data rows are never gathered: the one single-partition exchange is
    over the per-partition count frame (one row per range partition)."""
    df = spark.range(0, 200).select(F.col("id").cast("string").alias("id"), (F.col("id") % 7).alias("m"))
    out = add_ntile(df, 5, [F.col("m"), F.col("id")], "t", 4)
    lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    singles = [i for i, ln in enumerate(lines) if "Exchange SinglePartition" in ln]
    assert singles
    for i in singles:
        assert "HashAggregate(keys=[__nt_pid" in lines[i + 1], lines[i:i + 2]
