"""Page 6 - employee analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.functions import PCT1, TENURE, ratio

LONG = T.LongType()
INT = T.IntegerType()

SENIOR_YEARS = 6      # fixed values: seniority thresholds in years
MID_LEVEL_YEARS = 4


def vw_employee_dept_summary(stg_employees: DataFrame) -> DataFrame:
    """Per department head count, tenure stats, senior/junior split and
    share of all staff. The share's total is a window over the per-department
    rows (one row per department), not over employees."""
    t = F.col("tenure_years")
    g = stg_employees.groupBy("department").agg(
        F.count("employee_id").alias("headcount"),
        F.sum(t).alias("_tsum"),
        F.count(t).alias("_tn"),
        F.min(t).alias("_tmin"),
        F.max(t).alias("_tmax"),
        F.count(F.when(t >= SENIOR_YEARS, 1)).alias("senior_count"),
        F.count(F.when(t < SENIOR_YEARS, 1)).alias("junior_count"),
    )
    total = F.sum("headcount").over(Window.partitionBy())
    return g.select(
        "department",
        F.col("headcount").cast(LONG).alias("headcount"),
        ratio(F.col("_tsum"), F.col("_tn"), 2, TENURE).alias("avg_tenure_years"),
        F.col("_tmin").cast(TENURE).alias("min_tenure_years"),
        F.col("_tmax").cast(TENURE).alias("max_tenure_years"),
        F.col("senior_count").cast(LONG).alias("senior_count"),
        F.col("junior_count").cast(LONG).alias("junior_count"),
        ratio(F.col("senior_count"), F.col("headcount"), 1, PCT1, mult=100).alias("senior_pct"),
        ratio(F.col("headcount"), total, 1, PCT1, mult=100).alias("dept_headcount_share_pct"),
    ).orderBy(F.col("headcount").desc_nulls_first())


def tenure_band(t: F.Column) -> F.Column:
    """Tenure band, upper bounds inclusive; NULL tenure falls to '5+ Years'."""
    return (F.when(t <= 1, "0-1 Year")
             .when(t <= 2, "1-2 Years")
             .when(t <= 3, "2-3 Years")
             .when(t <= 4, "3-4 Years")
             .when(t <= 5, "4-5 Years")
             .otherwise("5+ Years"))


def vw_employee_tenure_distribution(stg_employees: DataFrame) -> DataFrame:
    """P20: head count per department, tenure value and band (the band is
    a function of tenure, so it is derived after grouping)."""
    g = stg_employees.groupBy("department", "tenure_years").agg(
        F.count("employee_id").alias("headcount"))
    return g.select(
        "department", "tenure_years",
        tenure_band(F.col("tenure_years")).alias("tenure_band"),
        F.col("headcount").cast(LONG).alias("headcount"),
    ).orderBy(F.col("department").asc_nulls_last(), F.col("tenure_years").asc_nulls_last())


def vw_employee_hiring_cohort(stg_employees: DataFrame) -> DataFrame:
    """Hires and mean current tenure per hire year and department."""
    t = F.col("tenure_years")
    g = stg_employees.groupBy(F.year("start_date").cast(INT).alias("hire_year"), "department").agg(
        F.count("employee_id").alias("hires"),
        F.sum(t).alias("_tsum"),
        F.count(t).alias("_tn"),
    )
    return g.select(
        "hire_year", "department",
        F.col("hires").cast(LONG).alias("hires"),
        ratio(F.col("_tsum"), F.col("_tn"), 2, TENURE).alias("avg_current_tenure"),
    ).orderBy(F.col("hire_year").asc_nulls_last(), F.col("department").asc_nulls_last())


def seniority_level(t: F.Column) -> F.Column:
    return (F.when(t >= SENIOR_YEARS, "Senior")
             .when(t >= MID_LEVEL_YEARS, "Mid-Level")
             .otherwise("Junior"))


def vw_employee_roster(stg_employees: DataFrame) -> DataFrame:
    """Full roster with a seniority level."""
    return stg_employees.select(
        "employee_id", "employee_name", "department", "start_date", "tenure_years",
        seniority_level(F.col("tenure_years")).alias("seniority_level"),
    ).orderBy(F.col("department").asc_nulls_last(), F.col("employee_name").asc_nulls_last())
