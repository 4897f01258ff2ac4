"""Staging layer (T1-T5): typed, trimmed, lazily evaluated projections.

Each function is a pure projection + cast + filter over one raw source, so
Catalyst folds it into whatever consumes it: columns the consumer does not
read are pruned from the scan and the NOT NULL filters are pushed down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.functions import (
    BAND, MONEY, MONEY_DIFF, MONEY_TOTAL, RATE, TENURE, UNIT_PRICE, month_name_padded,
    pg_int, varchar,
)

INT = T.IntegerType()


def _type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def stg_customers(raw: DataFrame) -> DataFrame:
    """Customer dimension source, ids as strings, segment upper-cased."""
    return raw.where(F.col("customer_id").isNotNull()).select(
        varchar(F.col("customer_id")).alias("customer_id"),
        F.upper(F.trim(F.col("segment"))).alias("customer_segment"),
        F.trim(F.col("country")).alias("country"),
        F.col("discount_premium_band").cast(BAND).alias("discount_premium_band"),
    )


def stg_sales(raw: DataFrame) -> DataFrame:
    """Typed sales fact with calendar parts and a recomputed profit."""
    d = F.col("order_date").cast(T.DateType())
    revenue = F.col("revenue").cast(MONEY)
    cogs = F.col("cogs").cast(MONEY)
    return raw.where(F.col("order_id").isNotNull()).select(
        varchar(F.col("order_id")).alias("order_id"),
        d.alias("order_date"),
        F.year(d).cast(INT).alias("order_year"),
        F.month(d).cast(INT).alias("order_month"),
        F.quarter(d).cast(INT).alias("order_quarter"),
        month_name_padded(d).alias("order_month_name"),
        varchar(F.col("customer_id")).alias("customer_id"),
        varchar(F.col("product_id")).alias("product_id"),
        pg_int(F.col("units_sold"), _type_of(raw, "units_sold")).alias("units_sold"),
        F.col("manufacturing_price").cast(UNIT_PRICE).alias("manufacturing_price"),
        F.col("target_sale_price").cast(UNIT_PRICE).alias("target_sale_price"),
        F.col("gross_sales").cast(MONEY).alias("gross_sales"),
        F.col("discount_premium").cast(MONEY).alias("discount_premium"),
        revenue.alias("revenue"),
        cogs.alias("cogs"),
        F.col("profit").cast(MONEY).alias("reported_profit"),
        (revenue - cogs).cast(MONEY_DIFF).alias("calculated_profit"),
    )


def stg_revenue_targets(raw: DataFrame) -> DataFrame:
    """Annual revenue targets keyed by year."""
    d = F.col("target_date").cast(T.DateType())
    return raw.select(
        F.col("revenue_target").cast(MONEY_TOTAL).alias("targeted_revenue"),
        d.alias("target_date"),
        F.year(d).cast(INT).alias("target_year"),
    )


def stg_cash_flow(raw: DataFrame) -> DataFrame:
    """T4: capital project cash flows."""
    d = F.col("date").cast(T.DateType())
    return raw.select(
        d.alias("cashflow_date"),
        F.year(d).cast(INT).alias("cashflow_year"),
        varchar(F.trim(F.col("product"))).alias("product_id"),
        F.col("discount_rate").cast(RATE).alias("assigned_discount_rate"),
        F.col("cashflow").cast(MONEY_TOTAL).alias("operational_cashflow"),
    )


def stg_employees(raw: DataFrame) -> DataFrame:
    """T5: employee roster; the raw tenure column keeps its parentheses."""
    return raw.where(F.col("employee_id").isNotNull()).select(
        varchar(F.col("employee_id")).alias("employee_id"),
        F.trim(F.col("name")).alias("employee_name"),
        F.col("start_date").cast(T.DateType()).alias("start_date"),
        F.col("`tenure_(years)`").cast(TENURE).alias("tenure_years"),
        F.trim(F.col("department")).alias("department"),
    )
