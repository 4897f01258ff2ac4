"""Marts (M1-M5): the aggregations the presentation layer reads.

Scale notes
-----------
* The sales fact is aggregated *before* it meets targets or customers. Each
  aggregate runs as partial (map-side) + final hash aggregation, so a hot
  year, customer or product is combined inside every map task before the
  shuffle and never lands whole in one task.
* The reference joins first and aggregates after, so a repeated customer id
  or a second target row for a year multiplies that group's sums. That
  fan-out is kept exactly: the pre-aggregated sums are multiplied by the
  number of matching rows (distinct counts, minima and maxima are unchanged
  by duplication).
* COUNT(DISTINCT ...) is exact (Catalyst's Expand + two-level aggregation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.functions import (
    MONEY, MONEY_TOTAL, RATE, UNIT_PRICE4, month_abbr, pct, pv_round, pv_units, ratio, ratio_units, uuid5,
    year_month_label,
)

INT = T.IntegerType()
LONG = T.LongType()


def order_sales(stg_sales: DataFrame) -> DataFrame:
    """The fact rolled up to customer x year x month x order: all that the
    annual, monthly and customer relations read. Sums keep their names, so a
    relation computes the same from it as from the fact."""
    return stg_sales.groupBy("customer_id", "order_year", "order_month", "order_id").agg(
        *[F.sum(c).alias(c) for c in ("revenue", "calculated_profit", "cogs", "units_sold", "discount_premium")],
        F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date"))


def first_date(sales: DataFrame) -> str:
    return "first_date" if "first_date" in sales.columns else "order_date"


def last_date(sales: DataFrame) -> str:
    return "last_date" if "last_date" in sales.columns else "order_date"


PRODUCT_MONTH = ("product_id", "order_year", "order_month")


def product_sales(stg_sales: DataFrame, keys: tuple[str, ...] = PRODUCT_MONTH) -> DataFrame:
    """The fact rolled up to product x year x month (or fewer ``keys``): sums, and the sums and
    counts behind average prices and mean discount ratios."""
    off = ratio_units(F.col("revenue") - F.col("gross_sales"), F.col("gross_sales"))
    return stg_sales.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("revenue", "calculated_profit", "units_sold", "discount_premium", "gross_sales")],
        F.sum("manufacturing_price").alias("mfg_sum"), F.count("manufacturing_price").alias("mfg_n"),
        F.sum("target_sale_price").alias("target_sum"), F.count("target_sale_price").alias("target_n"),
        F.max("target_sale_price").alias("target_max"), F.sum(off).alias("off_units"), F.count(off).alias("off_n"))


def mart_annual_performance(stg_sales: DataFrame, stg_targets: DataFrame) -> DataFrame:
    """M1: yearly revenue, profit, cost, units, distinct orders/customers,
    target, variance, attainment % and gross margin %."""
    sales = stg_sales.groupBy(F.col("order_year").alias("performance_year")).agg(
        F.sum("revenue").alias("_rev"),
        F.sum("calculated_profit").alias("_profit"),
        F.sum("cogs").alias("_cogs"),
        F.sum("units_sold").alias("_units"),
        F.countDistinct("order_id").alias("total_orders"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )
    targets = stg_targets.groupBy(F.col("target_year").alias("performance_year")).agg(
        F.max("targeted_revenue").alias("_target"),
        F.count(F.lit(1)).alias("_n_targets"),
    )
    j = sales.join(targets, "performance_year", "left")
    k = F.greatest(F.coalesce(F.col("_n_targets"), F.lit(0)), F.lit(1))
    rev = F.col("_rev") * k
    profit = F.col("_profit") * k
    target0 = F.coalesce(F.col("_target"), F.lit(0))
    return j.select(
        uuid5(F.col("performance_year").cast("string")).alias("annual_performance_key"),
        "performance_year",
        rev.cast(MONEY_TOTAL).alias("actual_revenue"),
        profit.cast(MONEY_TOTAL).alias("actual_profit"),
        (F.col("_cogs") * k).cast(MONEY_TOTAL).alias("actual_cogs"),
        (F.col("_units") * k).cast(LONG).alias("units_sold"),
        F.col("total_orders").cast(LONG).alias("total_orders"),
        F.col("unique_customers").cast(LONG).alias("unique_customers"),
        target0.cast(MONEY_TOTAL).alias("targeted_revenue"),
        (rev - target0).cast(MONEY_TOTAL).alias("target_variance"),
        pct(rev, F.col("_target")).alias("target_achievement_pct"),
        pct(profit, rev).alias("gross_margin_pct"),
    )


def mart_monthly_sales(stg_sales: DataFrame) -> DataFrame:
    """M2: monthly sums, distinct orders, margin % and year-to-date revenue.

    Grouped by (year, month); month start, quarter and abbreviation are
    functions of that pair and are derived after the aggregation. The
    year-to-date window runs over the monthly rows only (12 per year).
    """
    g = stg_sales.groupBy("order_year", "order_month").agg(
        F.sum("revenue").alias("_rev"),
        F.sum("calculated_profit").alias("_profit"),
        F.sum("cogs").alias("_cogs"),
        F.sum("units_sold").alias("monthly_units"),
        F.countDistinct("order_id").alias("order_count"),
    )
    ms = F.make_date(F.col("order_year"), F.col("order_month"), F.lit(1))
    ytd_w = (Window.partitionBy("order_year").orderBy(F.col("month_start").asc_nulls_last())
             .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return (g.withColumn("month_start", ms)
            .select(
                uuid5(year_month_label(F.col("order_year"), F.col("order_month"))).alias("monthly_sales_key"),
                "month_start",
                "order_year",
                "order_month",
                F.quarter("month_start").cast(INT).alias("order_quarter"),
                month_abbr(F.col("month_start")).alias("month_abbr"),
                F.col("_rev").cast(MONEY_TOTAL).alias("monthly_revenue"),
                F.col("_profit").cast(MONEY_TOTAL).alias("monthly_profit"),
                F.col("_cogs").cast(MONEY_TOTAL).alias("monthly_cogs"),
                F.col("monthly_units").cast(LONG).alias("monthly_units"),
                F.col("order_count").cast(LONG).alias("order_count"),
                pct(F.col("_profit"), F.col("_rev")).alias("margin_pct"),
                F.sum("_rev").over(ytd_w).cast(MONEY_TOTAL).alias("ytd_revenue"),
            ))


def _customer_rollup(stg_sales: DataFrame) -> DataFrame:
    """Per-customer aggregates of the fact, before any join."""
    return stg_sales.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.sum("units_sold").alias("_units"),
        F.sum("revenue").alias("_rev"),
        F.sum("calculated_profit").alias("_profit"),
        F.min(first_date(stg_sales)).alias("first_order_date"),
        F.max(last_date(stg_sales)).alias("last_order_date"),
        F.countDistinct("order_year").alias("active_years"),
        F.sum("discount_premium").alias("_disc"),
    )


def customer_multiplicity(stg_customers: DataFrame, attrs: list[str]) -> DataFrame:
    """Distinct (customer_id, attrs) rows with their number of copies ``_k``.

    The reference joins the fact to the raw customer rows, so k identical
    copies of a customer multiply its sums by k. Counting the copies with a
    partial + final aggregation collapses them on the map side, so even an
    id copied across a third of the table never lands whole in one task,
    and each join output row is exactly one output group.
    """
    return (stg_customers.where(F.col("customer_id").isNotNull())
            .groupBy("customer_id", *attrs).agg(F.count(F.lit(1)).alias("_k")))


def mart_customer_sales(stg_sales: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """M3: per-customer value, inner-joined to the customer attributes."""
    per_cust = _customer_rollup(stg_sales)
    cust = customer_multiplicity(stg_customers, ["customer_segment", "country", "discount_premium_band"])
    j = per_cust.join(cust, "customer_id")
    k = F.col("_k")
    rev = F.col("_rev") * k
    return j.select(
        uuid5(F.col("customer_id")).alias("customer_sales_key"),
        "customer_id", "customer_segment", "country", "discount_premium_band",
        F.col("total_orders").cast(LONG).alias("total_orders"),
        (F.col("_units") * k).cast(LONG).alias("total_units"),
        rev.cast(MONEY_TOTAL).alias("total_revenue"),
        (F.col("_profit") * k).cast(MONEY_TOTAL).alias("total_profit"),
        pct(F.col("_profit") * k, rev).alias("profit_margin_pct"),
        "first_order_date", "last_order_date",
        F.col("active_years").cast(LONG).alias("active_years"),
        ratio(rev, F.col("total_orders"), 2, MONEY).alias("avg_order_value"),
        (F.col("_disc") * k).cast(MONEY_TOTAL).alias("total_discount_premium"),
    )


def product_reach(stg_sales: DataFrame) -> DataFrame:
    """Distinct orders and customers per product. Each id is a row of three
    columns, (product, kind, id), so what is shuffled to count them carries no sums."""
    ids = F.explode(F.array(*[F.struct(F.lit(i).alias("_kind"), F.col(c).alias("_id")) for i, c in enumerate(("order_id", "customer_id"))]))
    pairs = stg_sales.select("product_id", ids.alias("_e")).select("product_id", "_e.*").where(F.col("_id").isNotNull()).distinct()
    kind = F.col("_kind")
    return pairs.groupBy("product_id").agg(F.count(F.when(kind == 0, 1)).alias("total_orders"), F.count(F.when(kind == 1, 1)).alias("customer_reach"))


def mart_product_sales(stg_sales: DataFrame) -> DataFrame:
    """M4: per-product totals, margin, unit economics and reach.

    The sums are combined inside every map task and the distinct counts are
    taken apart from them: one aggregate for both would spread every row three
    times, with the buffers of all sums.
    """
    sums = stg_sales.groupBy("product_id").agg(
        F.sum("units_sold").alias("_units"),
        F.sum("revenue").alias("_rev"),
        F.sum("cogs").alias("_cogs"),
        F.sum("calculated_profit").alias("_profit"),
        F.min("order_date").alias("first_sale_date"),
        F.max("order_date").alias("last_sale_date"),
    )
    # One row per product from either side; a null product is a group like any other.
    both = sums.unionByName(product_reach(stg_sales), allowMissingColumns=True)
    g = both.groupBy("product_id").agg(*[F.max(c).alias(c) for c in sums.columns[1:]],
                                       *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("total_orders", "customer_reach")])
    u = F.col("_units")
    return g.select(
        uuid5(F.col("product_id")).alias("product_sales_key"),
        "product_id",
        u.cast(LONG).alias("total_units_sold"),
        F.col("_rev").cast(MONEY_TOTAL).alias("total_revenue"),
        F.col("_cogs").cast(MONEY_TOTAL).alias("total_cogs"),
        F.col("_profit").cast(MONEY_TOTAL).alias("total_profit"),
        pct(F.col("_profit"), F.col("_rev")).alias("gross_margin_pct"),
        ratio(F.col("_cogs"), u, 4, UNIT_PRICE4).alias("avg_unit_mfg_cost"),
        ratio(F.col("_rev"), u, 4, UNIT_PRICE4).alias("avg_unit_revenue"),
        ratio(F.col("_profit"), u, 4, UNIT_PRICE4).alias("avg_unit_profit"),
        F.col("total_orders").cast(LONG).alias("total_orders"),
        F.col("customer_reach").cast(LONG).alias("customer_reach"),
        "first_sale_date", "last_sale_date",
    )


def mart_product_cashflow(stg_cash_flow: DataFrame) -> DataFrame:
    """M5: per project and date: period number, flow type, discounted flow
    (exact decimals, rounded to cents once) and running undiscounted total.

    Duplicate (date, product) rows are summed first, so the windows run over
    one row per project period.
    """
    sched = stg_cash_flow.groupBy("cashflow_date", "cashflow_year", "product_id").agg(
        F.max("assigned_discount_rate").alias("assigned_discount_rate"),
        F.sum("operational_cashflow").alias("operational_cashflow"),
    )
    order = F.col("cashflow_date").asc_nulls_last()
    w = Window.partitionBy("product_id").orderBy(order)
    numbered = sched.withColumn("period_t", (F.row_number().over(w) - 1).cast(LONG))
    cf = F.col("operational_cashflow")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return numbered.select(
        uuid5(F.concat_ws("", F.col("product_id"), F.lit("_"),
                          F.col("cashflow_date").cast("string"))).alias("product_cashflow_key"),
        "cashflow_date", "cashflow_year", "product_id",
        F.col("assigned_discount_rate").cast(RATE).alias("assigned_discount_rate"),
        cf.cast(MONEY_TOTAL).alias("operational_cashflow"),
        "period_t",
        F.when(cf < 0, "Outflow").otherwise("Inflow").alias("flow_type"),
        pv_round(pv_units(cf, F.col("assigned_discount_rate"), F.col("period_t")), MONEY_TOTAL).alias("discounted_cashflow"),
        F.sum(cf).over(run).cast(MONEY_TOTAL).alias("cumulative_cashflow"),
    )
