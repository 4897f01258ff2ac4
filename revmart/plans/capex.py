"""Page 5 - capital budgeting."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.functions import INDEX3, MONEY_TOTAL, RATE, pv_round, pv_units, ratio

LONG = T.LongType()

# Discount rates of the sensitivity table.
SENSITIVITY_RATES = ("0.03", "0.05", "0.07", "0.08", "0.10", "0.12", "0.15")
SENSITIVITY_RATE_TYPE = T.DecimalType(3, 2)


def vw_capex_cashflow_schedule(mart_cashflow: DataFrame) -> DataFrame:
    """The cash-flow mart as a schedule."""
    return mart_cashflow.select(
        "product_id", F.col("cashflow_year").alias("year"), "cashflow_date",
        "operational_cashflow", "assigned_discount_rate", "flow_type", "period_t",
        "discounted_cashflow", "cumulative_cashflow",
    ).orderBy(F.col("product_id").asc_nulls_last(), F.col("cashflow_date").asc_nulls_last())


def vw_capex_project_summary(mart_cashflow: DataFrame) -> DataFrame:
    """Per project NPV (sum of the rounded discounted flows), the
    minimum flow as initial investment, inflows/outflows, payback period
    (first period whose running total is >= 0, null if never) and the
    profitability index.

    Payback is a conditional MIN in the same aggregation, so the summary is
    a single grouped pass with no self-join.
    """
    cf = F.col("operational_cashflow")
    g = mart_cashflow.groupBy("product_id").agg(
        F.max("assigned_discount_rate").alias("discount_rate"),
        F.sum(cf).alias("_total"),
        F.sum("discounted_cashflow").alias("_npv"),
        F.min(cf).alias("_inv"),
        F.sum(F.when(cf > 0, cf).otherwise(F.lit(0))).alias("_in"),
        F.sum(F.when(cf < 0, cf).otherwise(F.lit(0))).alias("_out"),
        F.count(F.lit(1)).alias("num_periods"),
        F.min("cashflow_date").alias("project_start"),
        F.max("cashflow_date").alias("project_end"),
        F.min(F.when(F.col("cumulative_cashflow") >= 0, F.col("period_t"))).alias("_payback"),
    )
    npv = F.col("_npv").cast(MONEY_TOTAL)
    inv = F.col("_inv").cast(MONEY_TOTAL)
    # DISTINCT ON + LEFT JOIN USING never matches a NULL project id.
    payback = F.when(F.col("product_id").isNotNull(), F.col("_payback"))
    return g.select(
        "product_id", "project_start", "project_end",
        F.col("discount_rate").cast(RATE).alias("discount_rate"),
        inv.alias("initial_investment"),
        F.col("_in").cast(MONEY_TOTAL).alias("total_inflows"),
        F.col("_out").cast(MONEY_TOTAL).alias("total_outflows"),
        F.col("_total").cast(MONEY_TOTAL).alias("total_undiscounted_cf"),
        npv.alias("npv"),
        F.when(npv > 0, "Viable").otherwise("Not Viable").alias("viability"),
        payback.cast(LONG).alias("payback_period"),
        ratio(npv + F.abs(inv), F.abs(inv), 3, INDEX3).alias("profitability_index"),
        F.col("num_periods").cast(LONG).alias("num_periods"),
    ).orderBy(F.col("npv").desc_nulls_first())


def vw_capex_sensitivity(mart_cashflow: DataFrame) -> DataFrame:
    """NPV of every project at each of seven discount rates, rounded
    once (an exact sum of discounted terms in fixed point, so it does not
    depend on the order of the rows), with its sign.

    All seven NPVs are computed in one grouped pass (seven conditional
    sums), then unpivoted to seven rows per project -- no cross join.
    """
    cf, t = F.col("operational_cashflow"), F.col("period_t")
    aggs = [F.sum(pv_units(cf, F.lit(Decimal(r)), t)).alias(f"_npv{i}")
            for i, r in enumerate(SENSITIVITY_RATES)]
    g = mart_cashflow.groupBy("product_id").agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(Decimal(r)).cast(SENSITIVITY_RATE_TYPE).alias("discount_rate"),
                 F.col(f"_npv{i}").alias("npv_units"))
        for i, r in enumerate(SENSITIVITY_RATES)
    ])
    long = g.select("product_id", F.explode(rows).alias("_r")).select(
        "product_id", "_r.discount_rate", "_r.npv_units")
    return long.select(
        "product_id", "discount_rate",
        pv_round(F.col("npv_units"), MONEY_TOTAL).alias("npv"),
        F.when(F.col("npv_units") > 0, "Positive").otherwise("Negative").alias("npv_sign"),
    ).orderBy(F.col("product_id").asc_nulls_last(), F.col("discount_rate").asc_nulls_last())
