"""Page 4 - revenue forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.functions import MONEY_TOTAL, PCT, mean_ratio_pct, month_abbr, ratio, ratio_units

INT = T.IntegerType()

FORECAST_YEARS = 3  # fixed value: horizon of the linear projection


def vw_revenue_actual_vs_target(scorecard: DataFrame) -> DataFrame:
    """Actual vs target projection of the KPI scorecard."""
    return scorecard.select(
        "performance_year", "targeted_revenue", "actual_revenue", "actual_profit",
        "target_variance", "target_achievement_pct", "target_status",
    ).orderBy(F.col("performance_year").asc_nulls_last())


def vw_revenue_growth(scorecard: DataFrame) -> DataFrame:
    """YoY growth plus compound annual growth from the first year.

    CAGR = (exp(ln(revenue / base) / years) - 1) * 100, in double precision,
    rounded to cents of a percent; null in the base year and when the base
    revenue is null or zero. The window is over yearly rows only.
    """
    w = Window.orderBy(F.col("performance_year").asc_nulls_last())
    base = scorecard.select(
        F.col("performance_year").alias("year"),
        "actual_revenue", "actual_profit", "actual_cogs", "gross_margin_pct",
        "prior_year_revenue", "yoy_revenue_growth_pct",
        F.first("actual_revenue").over(w).alias("_base_rev"),
        F.first("performance_year").over(w).alias("_base_year"),
    )
    years = (F.col("year") - F.col("_base_year")).cast("double")
    growth = F.exp(F.ln(F.col("actual_revenue").cast("double") / F.col("_base_rev").cast("double"))
                   / F.nullif(years, F.lit(0.0)))
    cagr = F.when(
        (F.col("year") == F.col("_base_year")) | F.col("_base_rev").isNull() | (F.col("_base_rev") == 0),
        F.lit(None),
    ).otherwise(F.round((growth - 1) * 100, 2).cast(PCT))
    return base.select(
        "year", "actual_revenue", "actual_profit", "actual_cogs", "gross_margin_pct",
        "prior_year_revenue", "yoy_revenue_growth_pct",
        cagr.cast(PCT).alias("cagr_from_base_pct"),
    ).orderBy(F.col("year").asc_nulls_last())


def vw_revenue_forecast_linear(mart_annual: DataFrame) -> DataFrame:
    """Least-squares trend of yearly revenue, projected three years past
    the last actual year, stacked under the actual rows.

    The regression is one global aggregate over the yearly mart; the forecast
    years come from exploding a sequence on that single row (no cross join).
    """
    y = F.col("actual_revenue").cast("double")
    x = F.col("performance_year").cast("double")
    reg = mart_annual.agg(
        F.regr_slope(y, x).alias("_slope"),
        F.regr_intercept(y, x).alias("_intercept"),
        F.max("performance_year").alias("_last"),
    )
    fc = reg.select(
        "_slope", "_intercept",
        F.explode(F.sequence(F.col("_last") + 1, F.col("_last") + FORECAST_YEARS)).alias("year"),
    ).select(
        F.col("year").cast(INT).alias("year"),
        F.lit("Forecast").alias("record_type"),
        F.round(F.col("_slope") * F.col("year") + F.col("_intercept"), 0).cast(MONEY_TOTAL).alias("projected_revenue"),
        F.lit(None).cast(MONEY_TOTAL).alias("actual_revenue"),
    )
    act = mart_annual.select(
        F.col("performance_year").cast(INT).alias("year"),
        F.lit("Actual").alias("record_type"),
        F.lit(None).cast(MONEY_TOTAL).alias("projected_revenue"),
        F.col("actual_revenue").cast(MONEY_TOTAL).alias("actual_revenue"),
    )
    return fc.unionByName(act).orderBy(F.col("year").asc_nulls_last())


def vw_revenue_seasonality(mart_monthly: DataFrame) -> DataFrame:
    """Per calendar month, the mean share of annual revenue and the
    mean / max / min monthly revenue across years.

    Reads the monthly mart, whose revenue is the exact per-(year, month) sum
    of the fact, so a materialized warehouse serves this view from about a
    hundred rows instead of a fact scan. The annual total is a window over
    those rows, equivalent to the reference's join on year (rows without a
    year drop out in both).
    """
    monthly = (mart_monthly.where(F.col("order_year").isNotNull())
               .select(F.col("order_year").alias("year"), F.col("order_month").alias("month_num"),
                       F.col("monthly_revenue").alias("_m")))
    annual = F.sum("_m").over(Window.partitionBy("year"))
    share = monthly.withColumn("_share_units", ratio_units(F.col("_m"), annual))
    g = share.groupBy(
        "month_num",
        month_abbr(F.make_date(F.lit(2000), F.col("month_num"), F.lit(1))).alias("month_abbr"),
    ).agg(
        F.sum("_share_units").alias("_su"),
        F.count("_share_units").alias("_sn"),
        F.sum("_m").alias("_msum"),
        F.count("_m").alias("_mn"),
        F.max("_m").alias("_mmax"),
        F.min("_m").alias("_mmin"),
    )
    return g.select(
        "month_num", "month_abbr",
        mean_ratio_pct(F.col("_su"), F.col("_sn")).alias("avg_month_share_pct"),
        ratio(F.col("_msum"), F.col("_mn"), 0, MONEY_TOTAL).alias("avg_monthly_revenue"),
        F.col("_mmax").cast(MONEY_TOTAL).alias("max_monthly_revenue"),
        F.col("_mmin").cast(MONEY_TOTAL).alias("min_monthly_revenue"),
    ).orderBy(F.col("month_num").asc_nulls_last())
