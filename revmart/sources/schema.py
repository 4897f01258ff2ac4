"""Schemas of the five raw sources, as implied by the staging casts.

Landing infers types from each extract; these explicit schemas are used
when a source is read with a known layout (no inference pass) and by tests.
"""

from __future__ import annotations

from pyspark.sql import types as T

SALES = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("units_sold", T.IntegerType()),
    T.StructField("manufacturing_price", T.DecimalType(12, 2)),
    T.StructField("target_sale_price", T.DecimalType(12, 2)),
    T.StructField("gross_sales", T.DecimalType(15, 2)),
    T.StructField("discount_premium", T.DecimalType(15, 2)),
    T.StructField("revenue", T.DecimalType(15, 2)),
    T.StructField("cogs", T.DecimalType(15, 2)),
    T.StructField("profit", T.DecimalType(15, 2)),
])

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("discount_premium_band", T.DecimalType(10, 4)),
])

TARGETS = T.StructType([
    T.StructField("revenue_target", T.DecimalType(38, 2)),
    T.StructField("target_date", T.DateType()),
])

CASH_FLOW = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("product", T.StringType()),
    T.StructField("discount_rate", T.DecimalType(5, 4)),
    T.StructField("cashflow", T.DecimalType(38, 2)),
])

EMPLOYEES = T.StructType([
    T.StructField("employee_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("tenure_(years)", T.DecimalType(5, 2)),
    T.StructField("department", T.StringType()),
])

# Raw table names used when the five sources are landed under their
# logical names (landing otherwise derives names from file names).
RAW_TABLES = {
    "sales": "sales_fact",
    "customers": "customer_dim",
    "targets": "revenue_targets",
    "cash_flow": "cash_flow",
    "employees": "employees",
}

SCHEMAS = {
    "sales": SALES,
    "customers": CUSTOMERS,
    "targets": TARGETS,
    "cash_flow": CASH_FLOW,
    "employees": EMPLOYEES,
}
