"""Page 2 - customer analytics."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.functions import MONEY_TOTAL, pct
from revmart.operators.selection import select_ntiles
from revmart.plans.executive import sales_by_customer_year
from revmart.plans.marts import customer_multiplicity, last_date
from revmart.session import ensure_checkpoint_dir

LONG = T.LongType()
INT = T.IntegerType()


def vw_customer_performance(mart_customer: DataFrame) -> DataFrame:
    """Per-customer projection of the customer mart, by revenue."""
    return mart_customer.select(
        "customer_id", "customer_segment", "country", "discount_premium_band",
        "total_orders", "total_units", "total_revenue", "total_profit",
        "profit_margin_pct", "first_order_date", "last_order_date",
        "active_years", "avg_order_value", "total_discount_premium",
    ).orderBy(F.col("total_revenue").desc_nulls_first())


def vw_customer_yearly_revenue(stg_sales: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """P5: customer x year revenue, profit, units and orders. Both sides are
    unique on the join key's grain, so every join row is one output row."""
    cust = customer_multiplicity(stg_customers, ["customer_segment", "country"])
    j = sales_by_customer_year(stg_sales).join(cust, "customer_id")
    k = F.col("_k")
    return j.select(
        "customer_id", "customer_segment", "country", F.col("order_year").alias("year"),
        (F.col("_rev") * k).cast(MONEY_TOTAL).alias("revenue"),
        (F.col("_profit") * k).cast(MONEY_TOTAL).alias("profit"),
        (F.col("_units") * k).cast(LONG).alias("units_sold"),
        F.col("_orders").cast(LONG).alias("orders"),
    ).orderBy(F.col("customer_id").asc_nulls_last(), F.col("year").asc_nulls_last())


def vw_customer_country_summary(stg_sales: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """Country x segment x year customers, revenue, margin, units, orders.

    The fact is first rolled up to (customer, year, order) -- the finest
    grain the distinct counts need -- and only then joined to customers.
    """
    per_order = stg_sales.where(F.col("customer_id").isNotNull()).groupBy(
        "customer_id", "order_year", "order_id").agg(
        F.sum("revenue").alias("_rev"),
        F.sum("calculated_profit").alias("_profit"),
        F.sum("units_sold").alias("_units"),
    )
    cust = customer_multiplicity(stg_customers, ["country", "customer_segment"])
    j = per_order.join(cust, "customer_id")
    k = F.col("_k")
    g = j.groupBy("country", "customer_segment", F.col("order_year").alias("year")).agg(
        F.countDistinct("customer_id").alias("customer_count"),
        F.sum(F.col("_rev") * k).alias("_rev"),
        F.sum(F.col("_profit") * k).alias("_profit"),
        F.sum(F.col("_units") * k).alias("_units"),
        F.countDistinct("order_id").alias("total_orders"),
    )
    return g.select(
        "country", "customer_segment", "year",
        F.col("customer_count").cast(LONG).alias("customer_count"),
        F.col("_rev").cast(MONEY_TOTAL).alias("total_revenue"),
        F.col("_profit").cast(MONEY_TOTAL).alias("total_profit"),
        pct(F.col("_profit"), F.col("_rev")).alias("margin_pct"),
        F.col("_units").cast(LONG).alias("total_units"),
        F.col("total_orders").cast(LONG).alias("total_orders"),
    ).orderBy(F.col("total_revenue").desc_nulls_first())


RFM_DEFAULT_SEGMENT = "Need Attention"


def rfm_segment(r: F.Column, f: F.Column, m: F.Column) -> F.Column:
    """Named RFM segment; the rules are fixed values, first match wins."""
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
          .when((r >= 3) & (f >= 3), "Loyal Customers")
          .when(r >= 4, "Recent Customers")
          .when((f >= 4) & (m >= 4), "Potential Loyalists")
          .when((r <= 2) & (f >= 3), "At Risk")
          .when((r <= 2) & (f <= 2), "Lost")
          .otherwise(RFM_DEFAULT_SEGMENT))


def vw_customer_rfm(stg_sales: DataFrame, stg_customers: DataFrame,
                    as_of: _dt.date, recency_high_is_recent: bool = False) -> DataFrame:
    """Recency / frequency / monetary quintiles and a named segment.

    ``as_of`` replaces the reference's CURRENT_DATE (tiles do not depend on
    it). As in the reference, recency is tiled ascending, so the most recent
    customers get r_score 1; ``recency_high_is_recent=True`` flips that.
    Scores are computed over every customer id in the fact (NULL and
    unknown ids included) before the join to customers drops them.
    The NTILEs are exact and sort no customers (see ``operators.selection``);
    ties are broken by customer_id. Building the frame runs jobs: the customer
    roll-up is written once to the checkpoint folder, and the cut points of the
    three metrics are closed in on by counts over it.
    """
    raw = stg_sales.groupBy("customer_id").agg(
        F.max(last_date(stg_sales)).alias("last_order_date"),
        F.countDistinct("order_id").alias("frequency"),
        F.sum("revenue").alias("_monetary"),
    ).select(
        "customer_id", "last_order_date",
        F.col("frequency").cast(LONG).alias("frequency"),
        F.col("_monetary").cast(MONEY_TOTAL).alias("monetary"),
        F.datediff(F.lit(as_of), F.col("last_order_date")).cast(INT).alias("recency_days"),
    )
    ensure_checkpoint_dir(raw.sparkSession)
    raw = raw.checkpoint(eager=True)

    recency = -F.col("recency_days") if recency_high_is_recent else F.col("recency_days")
    scored = select_ntiles(raw, 5, {"r_score": recency, "f_score": F.col("frequency"), "m_score": F.col("monetary")}, "customer_id",
                           nulls_first=frozenset({"r_score"} if recency_high_is_recent else ()))
    # Copies of a customer row are counted before the join and spelled out after it.
    cust = customer_multiplicity(stg_customers, ["customer_segment", "country"])
    j = scored.join(cust, "customer_id").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast(LONG), F.col("_k"))))
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return j.select(
        "customer_id", "customer_segment", "country", "last_order_date",
        "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score",
        (r + f + m).cast(INT).alias("rfm_total"),
        rfm_segment(r, f, m).alias("rfm_segment"),
    ).orderBy(F.col("rfm_total").desc_nulls_first(), "customer_id")
