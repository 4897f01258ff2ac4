"""Views are statements, not frozen rows: equal to the relations, in their
order, and current when read."""

from __future__ import annotations

import datetime as dt
import os
import tempfile
import uuid

import pytest

from revmart.plans.warehouse import DIMS_MARTS, RELATIONS, STAGING, Warehouse
from revmart.sources import landing
from revmart.sources.schema import RAW_TABLES
from tests.conftest import SF_SMALL

AS_OF = dt.date(2001, 12, 31)
VIEWS = [n for n, (g, _) in RELATIONS.items() if g != DIMS_MARTS]


@pytest.fixture(scope="module")
def built(spark):
    """Extracts landed, marts built and views published, with copies of a
    customer, a second target in a year and unknown ids among the rows."""
    src = Warehouse.from_testdata(spark, SF_SMALL).sources
    root, tag = tempfile.mkdtemp(prefix="views-", dir="/tmp"), uuid.uuid4().hex[:8]
    extra = {"customers": lambda d: d.unionByName(d.limit(3)).unionByName(d.limit(2)),
             "sales": lambda d: d.unionByName(d.limit(40).selectExpr(*[
                 "CAST(NULL AS STRING) AS customer_id" if c == "customer_id" else "'??' AS product_id" if c == "product_id" else c for c in d.columns]))}
    for logical, table in RAW_TABLES.items():
        extra.get(logical, lambda d: d)(getattr(src, logical)).write.parquet(os.path.join(root, table))
    raw, analytics, staging, pres = (f"{x}_{tag}" for x in "rasp")
    landing.land(spark, root, raw)
    w = Warehouse.from_tables(spark, raw, as_of=AS_OF)
    w.materialize(analytics)
    w.publish_views(staging, pres)
    return w, root, raw, analytics, staging, pres


def view_of(spark, built, name):
    *_, staging, pres = built
    return spark.table(f"{staging if RELATIONS[name][0] == STAGING else pres}.{name}")


@pytest.mark.parametrize("name", VIEWS)
def test_view_equals_relation(spark, built, name):
    want = Warehouse.from_tables(spark, built[2], as_of=AS_OF)[name]
    got = view_of(spark, built, name)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))


def test_views_come_in_their_order(spark, built):
    """The key of each ORDER BY, with its direction and where nulls stand."""
    orders = {
        "vw_exec_kpi_scorecard": [("performance_year", 1)], "vw_exec_monthly_trend": [("month_start", 1)],
        "vw_exec_segment_summary": [("year", 1), ("total_revenue", -1)], "vw_customer_performance": [("total_revenue", -1)],
        "vw_customer_yearly_revenue": [("customer_id", 1), ("year", 1)], "vw_customer_country_summary": [("total_revenue", -1)],
        "vw_customer_rfm": [("rfm_total", -1)], "vw_product_performance": [("total_revenue", -1)],
        "vw_product_monthly_trend": [("product_id", 1), ("month_start", 1)], "vw_product_segment_matrix": [("product_id", 1), ("revenue", -1)],
        "vw_product_pricing": [("product_id", 1), ("year", 1)], "vw_revenue_actual_vs_target": [("performance_year", 1)],
        "vw_revenue_growth": [("year", 1)], "vw_revenue_forecast_linear": [("year", 1)], "vw_revenue_seasonality": [("month_num", 1)],
        "vw_capex_cashflow_schedule": [("product_id", 1), ("cashflow_date", 1)], "vw_capex_project_summary": [("npv", -1)],
        "vw_capex_sensitivity": [("product_id", 1), ("discount_rate", 1)], "vw_employee_dept_summary": [("headcount", -1)],
        "vw_employee_tenure_distribution": [("department", 1), ("tenure_years", 1)], "vw_employee_hiring_cohort": [("hire_year", 1), ("department", 1)],
        "vw_employee_roster": [("department", 1), ("employee_name", 1)],
    }
    assert set(orders) == {n for n in VIEWS if not n.startswith("stg_")}
    for name, keys in orders.items():
        rows = [tuple(r[c] for c, _ in keys) for r in view_of(spark, built, name).collect()]
        want = list(rows)
        for i, (_, way) in reversed(list(enumerate(keys))):
            known = [r for r in want if r[i] is not None]
            unknown = [r for r in want if r[i] is None]
            known.sort(key=lambda r: r[i], reverse=way < 0)
            want = known + unknown if way > 0 else unknown + known
        assert rows == want, name


def test_a_new_load_shows_without_a_rebuild(spark, built):
    w, root, raw, *_ = built
    before = {n: view_of(spark, built, n).count() for n in ("stg_employees", "vw_employee_roster", "vw_customer_rfm")}
    new = spark.sql("SELECT '9999' AS employee_id, 'New One' AS name, DATE '2020-01-01' AS start_date, CAST(1.5 AS DECIMAL(5,2)) AS `tenure_(years)`, 'AFRICA' AS department")
    staff = spark.table(f"{raw}.{RAW_TABLES['employees']}").unionByName(new)
    landing.load_table(spark, staff, raw, RAW_TABLES["employees"])
    assert view_of(spark, built, "vw_employee_roster").where("employee_name = 'New One'").first()["seniority_level"] == "Junior"
    after = {n: view_of(spark, built, n).count() for n in before}
    assert after == {**before, "stg_employees": before["stg_employees"] + 1, "vw_employee_roster": before["vw_employee_roster"] + 1}
    w.publish_views(*built[-2:])                      # redefined in place
    assert view_of(spark, built, "vw_employee_roster").count() == after["vw_employee_roster"]


def test_profile_was_counted_by_the_writes(spark, built):
    from revmart.operators.quality import profile
    analytics = built[3]
    stored = spark.table(f"{analytics}.relation_profile")
    for name, (group, _) in RELATIONS.items():
        if group == DIMS_MARTS:
            want = profile(spark.table(f"{analytics}.{name}"), name, group)
            assert sorted(map(tuple, stored.where(f"relation = '{name}'").collect())) == sorted(map(tuple, want.collect())), name


def test_views_need_landed_tables(spark):
    with pytest.raises(ValueError, match="landed"):
        Warehouse.from_testdata(spark, SF_SMALL).publish_views("x_s", "x_p")
