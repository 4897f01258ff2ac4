"""Page 3 - product analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.functions import (
    MONEY_TOTAL, UNIT_PRICE, UNIT_PRICE4, mean_ratio_pct, pct, ratio,
)
from revmart.plans.marts import customer_multiplicity

LONG = T.LongType()
INT = T.IntegerType()

def vw_product_performance(mart_product: DataFrame) -> DataFrame:
    """Product mart projection, by revenue."""
    return mart_product.select(
        "product_id", "total_units_sold", "total_revenue", "total_cogs",
        "total_profit", "gross_margin_pct", "avg_unit_mfg_cost",
        "avg_unit_revenue", "avg_unit_profit", "total_orders",
        "customer_reach", "first_sale_date", "last_sale_date",
    ).orderBy(F.col("total_revenue").desc_nulls_first())


def vw_product_monthly_trend(product_sales: DataFrame) -> DataFrame:
    """Product x month units, revenue, profit, margin.

    Grouped by (product, year, month); month start and quarter are
    functions of (year, month) and are derived after aggregation.
    """
    g = product_sales.groupBy("product_id", "order_year", "order_month").agg(
        F.sum("units_sold").alias("_units"),
        F.sum("revenue").alias("_rev"),
        F.sum("calculated_profit").alias("_profit"),
    )
    ms = F.make_date(F.col("order_year"), F.col("order_month"), F.lit(1))
    return g.select(
        "product_id",
        ms.alias("month_start"),
        "order_year", "order_month",
        F.quarter(ms).cast(INT).alias("order_quarter"),
        F.col("_units").cast(LONG).alias("units_sold"),
        F.col("_rev").cast(MONEY_TOTAL).alias("revenue"),
        F.col("_profit").cast(MONEY_TOTAL).alias("profit"),
        pct(F.col("_profit"), F.col("_rev")).alias("margin_pct"),
    ).orderBy(F.col("product_id").asc_nulls_last(), F.col("month_start").asc_nulls_last())


def vw_product_segment_matrix(stg_sales: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """P10: product x segment x year (long form), customers, avg unit price."""
    per_cust = stg_sales.where(F.col("customer_id").isNotNull()).groupBy(
        "product_id", "customer_id", "order_year").agg(
        F.sum("units_sold").alias("_units"),
        F.sum("revenue").alias("_rev"),
        F.sum("calculated_profit").alias("_profit"),
    )
    cust = customer_multiplicity(stg_customers, ["customer_segment"])
    j = per_cust.join(cust, "customer_id")
    k = F.col("_k")
    g = j.groupBy("product_id", F.col("customer_segment").alias("segment"),
                  F.col("order_year").alias("year")).agg(
        F.sum(F.col("_units") * k).alias("_units"),
        F.sum(F.col("_rev") * k).alias("_rev"),
        F.sum(F.col("_profit") * k).alias("_profit"),
        F.countDistinct("customer_id").alias("customers"),
    )
    return g.select(
        "product_id", "segment", "year",
        F.col("_units").cast(LONG).alias("units_sold"),
        F.col("_rev").cast(MONEY_TOTAL).alias("revenue"),
        F.col("_profit").cast(MONEY_TOTAL).alias("profit"),
        pct(F.col("_profit"), F.col("_rev")).alias("margin_pct"),
        F.col("customers").cast(LONG).alias("customers"),
        ratio(F.col("_rev"), F.col("_units"), 2, UNIT_PRICE).alias("avg_unit_price"),
    ).orderBy(F.col("product_id").asc_nulls_last(), F.col("revenue").desc_nulls_first())


def vw_product_pricing(product_sales: DataFrame) -> DataFrame:
    """Product x year average prices, realised unit price and the
    unweighted mean of per-row discount/premium ratios."""
    g = product_sales.groupBy("product_id", F.col("order_year").alias("year")).agg(
        F.sum("mfg_sum").alias("_mfg_sum"),
        F.sum("mfg_n").alias("_mfg_n"),
        F.sum("target_sum").alias("_tgt_sum"),
        F.sum("target_n").alias("_tgt_n"),
        F.sum("revenue").alias("_rev"),
        F.sum("units_sold").alias("_units"),
        F.sum("off_units").alias("_disc_units"),
        F.sum("off_n").alias("_disc_n"),
        F.sum("discount_premium").alias("_disc"),
        F.sum("gross_sales").alias("_gross"),
    )
    return g.select(
        "product_id", "year",
        ratio(F.col("_mfg_sum"), F.col("_mfg_n"), 4, UNIT_PRICE4).alias("avg_mfg_price"),
        ratio(F.col("_tgt_sum"), F.col("_tgt_n"), 4, UNIT_PRICE4).alias("avg_target_price"),
        ratio(F.col("_rev"), F.col("_units"), 4, UNIT_PRICE4).alias("avg_actual_unit_price"),
        mean_ratio_pct(F.col("_disc_units"), F.col("_disc_n")).alias("avg_discount_premium_pct"),
        F.col("_disc").cast(MONEY_TOTAL).alias("total_discount_premium"),
        F.col("_gross").cast(MONEY_TOTAL).alias("total_gross_sales"),
        F.col("_rev").cast(MONEY_TOTAL).alias("total_net_revenue"),
    ).orderBy(F.col("product_id").asc_nulls_last(), F.col("year").asc_nulls_last())
