"""Page 1 - executive overview."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.functions import MONEY_TOTAL, growth_pct, pct
from revmart.plans.marts import customer_multiplicity

LONG = T.LongType()


def vw_exec_kpi_scorecard(mart_annual: DataFrame) -> DataFrame:
    """Annual KPIs with prior-year revenue, YoY growth and target status.

    LAG runs over the yearly mart (one row per year), so the unpartitioned
    window sees only a handful of rows. LAG is positional: a missing year
    compares with the last year present, as in the reference.
    """
    w = Window.orderBy(F.col("performance_year").asc_nulls_last())
    prior = F.lag("actual_revenue").over(w)
    status = (F.when(F.col("targeted_revenue") == 0, "No Target")
               .when(F.col("actual_revenue") >= F.col("targeted_revenue"), "On Target")
               .otherwise("Below Target"))
    return mart_annual.select(
        "performance_year", "actual_revenue", "actual_cogs", "actual_profit",
        "gross_margin_pct", "units_sold", "total_orders", "unique_customers",
        "targeted_revenue", "target_variance", "target_achievement_pct",
        prior.alias("prior_year_revenue"),
        growth_pct(F.col("actual_revenue"), prior).alias("yoy_revenue_growth_pct"),
        status.alias("target_status"),
    ).orderBy(F.col("performance_year").asc_nulls_last())


def vw_exec_monthly_trend(mart_monthly: DataFrame) -> DataFrame:
    """Monthly trend with the same month of the prior year."""
    w = Window.partitionBy("order_month").orderBy(F.col("order_year").asc_nulls_last())
    prior = F.lag("monthly_revenue").over(w)
    return mart_monthly.select(
        "month_start", "order_year", "order_month", "order_quarter", "month_abbr",
        "monthly_revenue", "monthly_profit", "monthly_cogs", "monthly_units",
        "order_count", "margin_pct", "ytd_revenue",
        prior.alias("prior_year_same_month_revenue"),
        growth_pct(F.col("monthly_revenue"), prior).alias("mom_yoy_growth_pct"),
    ).orderBy(F.col("month_start").asc_nulls_last())


def sales_by_customer_year(stg_sales: DataFrame) -> DataFrame:
    """Fact rolled up to (customer, year) before it meets the customer table."""
    return stg_sales.where(F.col("customer_id").isNotNull()).groupBy("customer_id", "order_year").agg(
        F.sum("revenue").alias("_rev"),
        F.sum("calculated_profit").alias("_profit"),
        F.sum("units_sold").alias("_units"),
        F.countDistinct("order_id").alias("_orders"),
    )


def vw_exec_segment_summary(stg_sales: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """Year x segment customers, revenue, profit, margin and share of
    the year's revenue (share via a window over the grouped rows)."""
    cust = customer_multiplicity(stg_customers, ["customer_segment"])
    j = sales_by_customer_year(stg_sales).join(cust, "customer_id")
    g = j.groupBy(F.col("order_year").alias("year"), F.col("customer_segment").alias("segment")).agg(
        F.countDistinct("customer_id").alias("customer_count"),
        F.sum(F.col("_rev") * F.col("_k")).alias("_rev"),
        F.sum(F.col("_profit") * F.col("_k")).alias("_profit"),
    )
    year_total = F.sum("_rev").over(Window.partitionBy("year"))
    return g.select(
        "year", "segment",
        F.col("customer_count").cast(LONG).alias("customer_count"),
        F.col("_rev").cast(MONEY_TOTAL).alias("total_revenue"),
        F.col("_profit").cast(MONEY_TOTAL).alias("total_profit"),
        pct(F.col("_profit"), F.col("_rev")).alias("margin_pct"),
        pct(F.col("_rev"), year_total).alias("revenue_share_pct"),
    ).orderBy(F.col("year").asc_nulls_last(), F.col("total_revenue").desc_nulls_first())
