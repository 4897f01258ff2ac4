"""The warehouse: every relation as a lazy DataFrame over the raw sources.

Each relation is a pure function of DataFrames; ``Warehouse`` wires them
together and memoises the frames so that, e.g., the KPI scorecard and the
growth view are built on the same annual-mart plan. Frames are lazy, but for
the RFM view, whose roll-up and cut points are computed while it is built.

Where two roll-ups of the fact (``ROLLUPS``) have been written, by
``materialize`` or ``share_rollups``, all relations that do not need the fact's
own grain read them; otherwise each aggregates the fact at its own grain.

``materialize`` is the reference's deploy step: dimensions and marts are
written as tables, and counted for the profile while they are written;
``publish_views`` defines staging and presentation as SQL views over the raw
tables and the *written* marts.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from revmart.plans import (
    capex, customer, dims, employee, executive, forecast, marts, product, staging, views,
)
from revmart.session import ensure_checkpoint_dir
from revmart.sources import publish
from revmart.sources.fixtures import testdata_sources
from revmart.sources.raw import Sources
from revmart.sources.schema import RAW_TABLES

# Page groups (fixed values): the layer or dashboard page of each relation.
STAGING = "staging"
DIMS_MARTS = "dims_marts"
EXECUTIVE = "executive"
CUSTOMER = "customer"
PRODUCT = "product"
FORECAST = "forecast"
CAPEX = "capex"
EMPLOYEE = "employee"

PROFILE_TABLE = "relation_profile"
PROFILE_SCHEMA = "relation string, page_group string, column_name string, data_type string, row_count long, null_count long"


@dataclass
class Warehouse:
    sources: Sources
    spark: SparkSession
    as_of: _dt.date | None = None
    raw: dict[str, str] | None = None          # full names of the raw tables, where there are any
    analytics: str | None = None               # database of the written marts
    counted: list = field(default_factory=list, repr=False)   # profile rows of what was written
    _cache: dict = field(default_factory=dict, repr=False)
    _overrides: dict = field(default_factory=dict, repr=False)

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str,
                      as_of: _dt.date | None = None) -> "Warehouse":
        return cls(testdata_sources(spark, sf_dir), spark, as_of)

    @classmethod
    def from_tables(cls, spark: SparkSession, database: str = "raw",
                    as_of: _dt.date | None = None, tables: dict[str, str] | None = None) -> "Warehouse":
        """Warehouse over landed raw tables (see ``revmart.sources.landing``).
        ``tables`` names the raw table of a source where it is not the usual
        one, e.g. ``{"sales": "book_sheet"}``."""
        names = {k: f"{database}.{t}" for k, t in dict(RAW_TABLES, **(tables or {})).items()}
        return cls(Sources.from_tables(spark, database, tables), spark, as_of, raw=names)

    def relation(self, name: str) -> DataFrame:
        if name in self._overrides:
            return self._overrides[name]
        if name not in self._cache:
            if name not in RELATIONS and name not in ROLLUPS:
                raise KeyError(f"unknown relation {name!r}")
            self._cache[name] = ROLLUPS[name](self) if name in ROLLUPS else RELATIONS[name][1](self)
        return self._cache[name]

    __getitem__ = relation

    def use_table(self, name: str, table: str) -> None:
        """Serve relation ``name`` from an existing table (e.g. one written by
        an earlier ``materialize``) instead of recomputing it."""
        self._overrides[name] = self.spark.table(table)
        self._forget()

    def _forget(self) -> None:
        """Drop the frames that must be rebuilt over newly written tables."""
        self._cache = {k: v for k, v in self._cache.items() if k in RELATIONS and RELATIONS[k][0] == STAGING}

    def rollup(self, name: str, *keys: str) -> DataFrame:
        """The written roll-up, or what takes its place at the grain ``keys``:
        the fact itself, or its product sums by ``keys``."""
        if name in self._overrides:
            return self._overrides[name]
        return marts.product_sales(self["stg_sales"], keys) if name == "product_sales" else self["stg_sales"]

    def share_rollups(self) -> "Warehouse":
        """Compute both roll-ups of the fact now, once for all relations."""
        ensure_checkpoint_dir(self.spark)
        for name in ROLLUPS:
            self._overrides[name] = self.relation(name).checkpoint(eager=True)
        self._forget()
        return self

    def _count(self, name: str, columns: list[tuple[str, str, int]], rows: int) -> None:
        if name in RELATIONS:
            self.counted += [(name, RELATIONS[name][0], c, t, rows, nulls) for c, t, nulls in columns]

    def write_once(self, names) -> "Warehouse":
        """Write the staging relations, the roll-ups and those dimensions and
        marts among ``names`` to the checkpoint folder, each worked out once
        from what is already written, and counted while it is written. So the
        sources are read, and the fact is put together, a single time."""
        from revmart.sources.publish import observed
        folder = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/relations-{uuid.uuid4().hex}"
        of_group = lambda group: [n for n, (g, _) in RELATIONS.items() if g == group and n in names]
        for name in [*of_group(STAGING), *ROLLUPS, *of_group(DIMS_MARTS)]:
            df = self.relation(name)
            counted, counts = observed(df)
            counted.write.parquet(f"{folder}/{name}")
            got = counts.get
            self._count(name, [(f.name, f.dataType.simpleString(), got["n"] - got[f"c{i}"]) for i, f in enumerate(df.schema)], got["n"])
            self._overrides[name] = self.spark.read.schema(df.schema).parquet(f"{folder}/{name}")
            self._forget()
        return self

    def _write(self, database: str, name: str, unique: list[str] = ()) -> str:
        """Write a relation as the next version of its table, check its keys
        there and move the name to it. A failed build or a duplicate key leaves
        the previous version in place."""
        from revmart.operators.quality import DuplicateKeyError, assert_unique
        version = publish.stage(self.spark, self.relation(name), database, name)
        try:
            for key in unique:
                assert_unique(self.spark.table(version.name), key, f"{database}.{name}")
        except DuplicateKeyError:
            publish.discard(self.spark, version)
            raise
        publish.publish(self.spark, version, database, name)
        self._count(name, version.null_counts(), version.row_count)
        return f"{database}.{name}"

    def materialize(self, database: str, names: list[str] | None = None,
                    presentation_database: str | None = None) -> list[str]:
        """Write dimensions and marts as tables in ``database`` (full refresh
        by versions, see ``sources.publish``), check their unique keys first (a
        duplicate raises and keeps the previous table, as a failed unique index
        stops the reference's run), and re-point later relations at the written
        tables. The roll-ups of the fact are written first, so the fact is read
        for them, its own staging aggregates and no more. With
        ``presentation_database``, the presentation relations are also written
        there as tables for BI import. What was counted while the tables were
        written becomes ``<database>.relation_profile``. Returns the tables
        written."""
        from revmart.operators.quality import UNIQUE_KEYS

        written = []
        self.counted, self.analytics = [], database
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        if names is None:
            for name in ROLLUPS:
                self._overrides[name] = self.spark.table(self._write(database, name))
            self._forget()
        for name, (group, _) in RELATIONS.items():
            if group == DIMS_MARTS and (names is None or name in names):
                written.append(self._write(database, name, [key for rel, key in UNIQUE_KEYS if rel == name]))
                self._overrides[name] = self.spark.table(written[-1])
        self._forget()
        if presentation_database:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {presentation_database}")
            written += [self._write(presentation_database, name) for name, (group, _) in RELATIONS.items() if group not in (STAGING, DIMS_MARTS)]
        profile = self.spark.createDataFrame(self.counted, PROFILE_SCHEMA).coalesce(1)
        publish.publish(self.spark, publish.stage(self.spark, profile, database, PROFILE_TABLE), database, PROFILE_TABLE)
        return written

    def publish_views(self, staging_database: str, presentation_database: str) -> list[str]:
        """Staging and presentation relations as SQL views, worked out whenever
        they are read: over the raw tables as they then are, and over the marts
        that ``materialize`` wrote last. Presentation views keep their order."""
        if self.raw is None or self.analytics is None:
            raise ValueError("views need landed raw tables and materialized marts")
        for database in (staging_database, presentation_database):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for statement in views.functions(presentation_database):
            self.spark.sql(statement)
        units = self.spark.table(self.raw["sales"]).schema["units_sold"].dataType
        return (views.define(self.spark, staging_database, views.staging_sql(self.raw, units))
                + views.define(self.spark, presentation_database,
                               views.presentation_sql(staging_database, self.analytics, presentation_database, self.as_of)))


def register_views(w: "Warehouse", names: list[str] | None = None, prefix: str = "") -> list[str]:
    """Expose relations to SQL as temporary views (``prefix + name``), so
    consumers can ``spark.sql("SELECT ... FROM vw_exec_kpi_scorecard")``."""
    out = []
    for n in names or list(RELATIONS):
        w.relation(n).createOrReplaceTempView(prefix + n)
        out.append(prefix + n)
    return out


def _rfm(w: Warehouse) -> DataFrame:
    as_of = w.as_of or _dt.date.today()
    return customer.vw_customer_rfm(w.rollup("order_sales"), w["stg_customers"], as_of)


# Internal roll-ups of the fact: not relations of the warehouse themselves.
ROLLUPS: dict[str, Callable] = {
    "order_sales": lambda w: marts.order_sales(w["stg_sales"]),
    "product_sales": lambda w: marts.product_sales(w["stg_sales"]),
}

Builder = Callable[[Warehouse], DataFrame]

# name -> (group, builder); order follows the reference's layer listing.
RELATIONS: dict[str, tuple[str, Builder]] = {
    "stg_customers": (STAGING, lambda w: staging.stg_customers(w.sources.customers)),
    "stg_sales": (STAGING, lambda w: staging.stg_sales(w.sources.sales)),
    "stg_revenue_targets": (STAGING, lambda w: staging.stg_revenue_targets(w.sources.targets)),
    "stg_cash_flow": (STAGING, lambda w: staging.stg_cash_flow(w.sources.cash_flow)),
    "stg_employees": (STAGING, lambda w: staging.stg_employees(w.sources.employees)),
    "dim_customers": (DIMS_MARTS, lambda w: dims.dim_customers(w["stg_customers"])),
    "dim_products": (DIMS_MARTS, lambda w: dims.dim_products(w.rollup("product_sales", "product_id"))),
    "dim_date": (DIMS_MARTS, lambda w: dims.dim_date(w.spark)),
    "mart_annual_performance": (DIMS_MARTS, lambda w: marts.mart_annual_performance(
        w.rollup("order_sales"), w["stg_revenue_targets"])),
    "mart_monthly_sales": (DIMS_MARTS, lambda w: marts.mart_monthly_sales(w.rollup("order_sales"))),
    "mart_customer_sales": (DIMS_MARTS, lambda w: marts.mart_customer_sales(
        w.rollup("order_sales"), w["stg_customers"])),
    "mart_product_sales": (DIMS_MARTS, lambda w: marts.mart_product_sales(w["stg_sales"])),
    "mart_product_cashflow": (DIMS_MARTS, lambda w: marts.mart_product_cashflow(w["stg_cash_flow"])),
    "vw_exec_kpi_scorecard": (EXECUTIVE, lambda w: executive.vw_exec_kpi_scorecard(
        w["mart_annual_performance"])),
    "vw_exec_monthly_trend": (EXECUTIVE, lambda w: executive.vw_exec_monthly_trend(
        w["mart_monthly_sales"])),
    "vw_exec_segment_summary": (EXECUTIVE, lambda w: executive.vw_exec_segment_summary(
        w.rollup("order_sales"), w["stg_customers"])),
    "vw_customer_performance": (CUSTOMER, lambda w: customer.vw_customer_performance(
        w["mart_customer_sales"])),
    "vw_customer_yearly_revenue": (CUSTOMER, lambda w: customer.vw_customer_yearly_revenue(
        w.rollup("order_sales"), w["stg_customers"])),
    "vw_customer_country_summary": (CUSTOMER, lambda w: customer.vw_customer_country_summary(
        w.rollup("order_sales"), w["stg_customers"])),
    "vw_customer_rfm": (CUSTOMER, _rfm),
    "vw_product_performance": (PRODUCT, lambda w: product.vw_product_performance(
        w["mart_product_sales"])),
    "vw_product_monthly_trend": (PRODUCT, lambda w: product.vw_product_monthly_trend(
        w.rollup("product_sales", "product_id", "order_year", "order_month"))),
    "vw_product_segment_matrix": (PRODUCT, lambda w: product.vw_product_segment_matrix(
        w["stg_sales"], w["stg_customers"])),
    "vw_product_pricing": (PRODUCT, lambda w: product.vw_product_pricing(
        w.rollup("product_sales", "product_id", "order_year"))),
    "vw_revenue_actual_vs_target": (FORECAST, lambda w: forecast.vw_revenue_actual_vs_target(
        w["vw_exec_kpi_scorecard"])),
    "vw_revenue_growth": (FORECAST, lambda w: forecast.vw_revenue_growth(w["vw_exec_kpi_scorecard"])),
    "vw_revenue_forecast_linear": (FORECAST, lambda w: forecast.vw_revenue_forecast_linear(
        w["mart_annual_performance"])),
    "vw_revenue_seasonality": (FORECAST, lambda w: forecast.vw_revenue_seasonality(
        w["mart_monthly_sales"])),
    "vw_capex_cashflow_schedule": (CAPEX, lambda w: capex.vw_capex_cashflow_schedule(
        w["mart_product_cashflow"])),
    "vw_capex_project_summary": (CAPEX, lambda w: capex.vw_capex_project_summary(
        w["mart_product_cashflow"])),
    "vw_capex_sensitivity": (CAPEX, lambda w: capex.vw_capex_sensitivity(w["mart_product_cashflow"])),
    "vw_employee_dept_summary": (EMPLOYEE, lambda w: employee.vw_employee_dept_summary(
        w["stg_employees"])),
    "vw_employee_tenure_distribution": (EMPLOYEE, lambda w: employee.vw_employee_tenure_distribution(
        w["stg_employees"])),
    "vw_employee_hiring_cohort": (EMPLOYEE, lambda w: employee.vw_employee_hiring_cohort(
        w["stg_employees"])),
    "vw_employee_roster": (EMPLOYEE, lambda w: employee.vw_employee_roster(w["stg_employees"])),
}


def group_of(name: str) -> str:
    return RELATIONS[name][0]

