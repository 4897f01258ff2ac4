"""Dimensions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.functions import UNIT_PRICE, UNIT_PRICE4, month_abbr, month_name, month_start, ratio, uuid5

INT = T.IntegerType()

# The calendar span of the date dimension.
CALENDAR_START = _dt.date(2015, 1, 1)
CALENDAR_END = _dt.date(2035, 12, 31)


def dim_customers(stg_customers: DataFrame) -> DataFrame:
    """One row per customer_id with a uuid5 key.

    The reference keeps an arbitrary survivor per id; here the survivor is
    the first by (segment, country, band), ascending, nulls last. Catalyst
    plans ``row_number() ... = 1`` as a WindowGroupLimit that keeps only the
    top row per id on the map side, so a hot id is cut before the shuffle.
    """
    w = Window.partitionBy("customer_id").orderBy(
        F.col("customer_segment").asc_nulls_last(),
        F.col("country").asc_nulls_last(),
        F.col("discount_premium_band").asc_nulls_last(),
    )
    return (stg_customers
            .withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1)
            .select(
                uuid5(F.col("customer_id")).alias("customer_key"),
                "customer_id", "customer_segment", "country", "discount_premium_band"))


def dim_products(product_sales: DataFrame) -> DataFrame:
    """One row per product: mean manufacturing price (4 dp), max target price."""
    g = product_sales.groupBy("product_id").agg(
        F.sum("mfg_sum").alias("_mfg_sum"),
        F.sum("mfg_n").alias("_mfg_n"),
        F.max("target_max").alias("target_sale_price"),
    )
    return g.select(
        uuid5(F.col("product_id")).alias("product_key"),
        "product_id",
        ratio(F.col("_mfg_sum"), F.col("_mfg_n"), 4, UNIT_PRICE4).alias("avg_mfg_price"),
        F.col("target_sale_price").cast(UNIT_PRICE).alias("target_sale_price"),
    )


def dim_date(spark: SparkSession, start: _dt.date = CALENDAR_START,
             end: _dt.date = CALENDAR_END) -> DataFrame:
    """D3: daily calendar. Generated with ``spark.range`` so the rows are
    produced in parallel slices rather than exploded from one row."""
    days = (end - start).days + 1
    d = F.date_add(F.lit(start), F.col("id").cast(INT))
    base = spark.range(0, days).select(d.alias("d"))
    dd = F.col("d")
    return base.select(
        F.date_format(dd, "yyyyMMdd").cast(INT).alias("date_key"),
        dd.alias("calendar_date"),
        F.year(dd).cast(INT).alias("calendar_year"),
        F.quarter(dd).cast(INT).alias("calendar_quarter"),
        F.concat(F.lit("Q"), F.quarter(dd).cast("string")).alias("quarter_name"),
        F.month(dd).cast(INT).alias("month_number"),
        month_name(dd).alias("month_name"),
        month_abbr(dd).alias("month_abbr"),
        F.concat(month_name(dd), F.lit(" "), F.year(dd).cast("string")).alias("month_year_label"),
        F.date_format(dd, "E").alias("day_of_week_short"),
        (F.weekday(dd) + 1).cast(INT).alias("day_of_week_number"),
        F.trunc(dd, "week").alias("week_start_date"),
        month_start(dd).alias("month_start_date"),
        F.trunc(dd, "quarter").alias("quarter_start_date"),
        F.when(F.month(dd) >= 7, F.year(dd) + 1).otherwise(F.year(dd)).cast(INT).alias("fiscal_year"),
    )
