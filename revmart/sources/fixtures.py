"""Adapters that derive the five raw sources from the driver's tables.

The reference's sources are workbooks that are not published; the test
tables (TPC-H-like parquet) stand in for them with the derivations below.
Money is cast to decimal before any arithmetic; ids become strings.
Every adapter is a lazy DataFrame over the parquet scans, so Catalyst prunes
columns and pushes filters into the scans.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.functions import MONEY_TOTAL
from revmart.sources.raw import Sources

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _d(s: str) -> F.Column:
    return F.lit(Decimal(s))


def src_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(p, li.l_partkey == p.p_partkey))
    gross = F.col("l_extendedprice").cast(T.DecimalType(15, 2))
    retail = F.col("p_retailprice").cast(T.DecimalType(12, 2))
    units = F.col("l_quantity").cast(T.IntegerType())
    mfg = (retail * _d("0.60")).cast(T.DecimalType(12, 2))
    disc = (-gross * F.col("l_discount").cast(T.DecimalType(5, 4))).cast(T.DecimalType(15, 2))
    base = j.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("o_orderdate").cast(T.DateType()).alias("order_date"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("p_brand").alias("product_id"),
        units.alias("units_sold"),
        mfg.alias("manufacturing_price"),
        retail.alias("target_sale_price"),
        gross.alias("gross_sales"),
        disc.alias("discount_premium"),
    )
    with_rev = base.withColumn(
        "revenue", (F.col("gross_sales") + F.col("discount_premium")).cast(T.DecimalType(15, 2))
    ).withColumn(
        "cogs", (F.col("units_sold") * F.col("manufacturing_price")).cast(T.DecimalType(15, 2))
    )
    return with_rev.withColumn(
        "profit", (F.col("revenue") - F.col("cogs")).cast(T.DecimalType(15, 2)))


def src_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    band = (F.col("c_acctbal").cast(T.DecimalType(15, 2)) * _d("0.00001")).cast(T.DecimalType(10, 4))
    return j.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("country"),
        band.alias("discount_premium_band"),
    )


def src_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    yr = F.year("o_orderdate").cast(T.IntegerType())
    g = (o.groupBy(yr.alias("y"))
          .agg(F.sum(F.col("o_totalprice").cast(T.DecimalType(15, 2))).alias("s")))
    return g.select(
        (F.col("s") * _d("0.80")).cast(MONEY_TOTAL).alias("revenue_target"),
        F.make_date(F.col("y"), F.lit(1), F.lit(1)).alias("target_date"),
    )


def src_cash_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", "l_extendedprice")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = li.join(p, li.l_partkey == p.p_partkey)
    g = (j.groupBy(F.year("l_shipdate").cast(T.IntegerType()).alias("y"), F.col("p_brand"))
          .agg(F.sum(F.col("l_extendedprice").cast(T.DecimalType(15, 2))).alias("s")))
    brand_no = F.expr("CAST(substring(p_brand, 7) AS INT)")
    rate = (_d("0.05") + _d("0.01") * (brand_no % 5)).cast(T.DecimalType(5, 4))
    sign = F.when(F.col("y") == 1995, -(F.lit(2) + brand_no % 7)).otherwise(F.lit(1))
    return g.select(
        F.make_date(F.col("y"), F.lit(1), F.lit(1)).alias("date"),
        F.col("p_brand").alias("product"),
        rate.alias("discount_rate"),
        (sign * F.col("s")).cast(MONEY_TOTAL).alias("cashflow"),
    )


def src_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (s.join(n, s.s_nationkey == n.n_nationkey)
          .join(r, F.col("n_regionkey") == r.r_regionkey))
    start = F.date_add(F.lit("2015-01-01").cast(T.DateType()),
                       ((F.col("s_suppkey") * 53) % 2500).cast(T.IntegerType()))
    tenure = ((F.col("s_suppkey") * 37 % 1000) * _d("0.01")).cast(T.DecimalType(5, 2))
    return j.select(
        F.col("s_suppkey").cast("string").alias("employee_id"),
        F.col("s_name").alias("name"),
        start.alias("start_date"),
        tenure.alias("tenure_(years)"),
        F.col("r_name").alias("department"),
    )


def testdata_sources(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(
        sales=lambda: src_sales(spark, sf_dir),
        customers=lambda: src_customers(spark, sf_dir),
        targets=lambda: src_targets(spark, sf_dir),
        cash_flow=lambda: src_cash_flow(spark, sf_dir),
        employees=lambda: src_employees(spark, sf_dir),
    )
