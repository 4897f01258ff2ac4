"""Hand-made rows for behaviour the generated tables cannot reach: NULL and
unknown keys, duplicated customers and targets (join fan-out), zero/NULL
targets, positional LAG over a missing year, one-point regression, NTILE
with fewer rows than tiles, cash-flow edge cases and tenure boundaries."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest

from revmart.plans.warehouse import Warehouse
from revmart.sources import schema as S
from revmart.sources.raw import Sources


def sale(order_id, day, customer, product="P1", units=1, revenue="9.00", cogs="1.00", gross="10.00"):
    rev, cg, gr = D(revenue), D(cogs), D(gross)
    return (order_id, day, customer, product, units, D("1.00"), D("2.00"), gr, rev - gr, rev, cg, rev - cg)


def make(spark, sales=(), customers=(), targets=(), cash_flow=(), employees=(), as_of=dt.date(2022, 1, 1)):
    def frame(rows, schema):
        return spark.createDataFrame(list(rows), schema)
    return Warehouse(Sources(sales=frame(sales, S.SALES), customers=frame(customers, S.CUSTOMERS),
                             targets=frame(targets, S.TARGETS), cash_flow=frame(cash_flow, S.CASH_FLOW),
                             employees=frame(employees, S.EMPLOYEES)), spark, as_of)


def rows(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


CUST = [("A", " enterprise ", "Kenya ", D("0.0100")), ("B", "Government", "Chile", D("0.0200"))]


def test_null_unknown_and_duplicate_customers(spark):
    sales = [sale("o1", dt.date(2020, 1, 5), "A", revenue="100.00"),
             sale("o2", dt.date(2020, 2, 5), "A", revenue="50.00"),
             sale("o3", dt.date(2020, 3, 5), None, revenue="70.00"),
             sale("o4", dt.date(2020, 3, 6), "X", revenue="30.00"),
             sale("o5", dt.date(2020, 3, 7), "B", revenue="10.00")]
    customers = CUST + [("A", " enterprise ", "Kenya ", D("0.0100")), (None, "SMB", "Peru", None)]
    w = make(spark, sales, customers)
    mcs = rows(w["mart_customer_sales"], "customer_id")
    # NULL and unknown ids drop out of the inner join; the repeated 'A' row
    # (identical attributes) doubles A's sums, not its distinct counts
    assert set(mcs) == {"A", "B"}
    assert mcs["A"]["total_revenue"] == D("300.00") and mcs["A"]["total_orders"] == 2
    assert mcs["A"]["customer_segment"] == "ENTERPRISE" and mcs["A"]["country"] == "Kenya"
    assert mcs["A"]["avg_order_value"] == D("150.00")
    ann = rows(w["mart_annual_performance"], "performance_year")[2020]
    assert ann["unique_customers"] == 3          # NULL not counted, unknown 'X' counted
    assert ann["actual_revenue"] == D("260.00")  # every sale, no customer join
    seg = {(r["year"], r["segment"]): r for r in w["vw_exec_segment_summary"].collect()}
    assert seg[(2020, "ENTERPRISE")]["total_revenue"] == D("300.00")
    assert seg[(2020, "ENTERPRISE")]["revenue_share_pct"] == D("96.77")  # 300 / 310
    dq = {(r["relation"], r["key_column"]): r for r in
          __import__("revmart.operators.quality", fromlist=["x"]).unique_key_report(w).collect()}
    assert dq[("stg_customers", "customer_id")]["duplicate_keys"] == 1
    assert dq[("dim_customers", "customer_id")]["duplicate_keys"] == 0


def test_duplicate_customer_with_different_attributes_splits_groups(spark):
    sales = [sale("o1", dt.date(2020, 1, 5), "A", revenue="100.00")]
    customers = [("A", "ENTERPRISE", "Kenya", D("0.0100")), ("A", "SMB", "Kenya", D("0.0100"))]
    w = make(spark, sales, customers)
    got = sorted((r["customer_segment"], r["total_revenue"]) for r in w["mart_customer_sales"].collect())
    assert got == [("ENTERPRISE", D("100.00")), ("SMB", D("100.00"))]
    dim = w["dim_customers"].collect()
    assert len(dim) == 1 and dim[0]["customer_segment"] == "ENTERPRISE"


def test_targets_zero_null_missing_and_duplicated(spark):
    sales = [sale(f"o{y}", dt.date(y, 6, 1), "A", revenue="100.00") for y in (2017, 2018, 2019, 2020, 2021)]
    targets = [(D("0.00"), dt.date(2017, 1, 1)), (None, dt.date(2018, 1, 1)),
               (D("80.00"), dt.date(2020, 1, 1)), (D("120.00"), dt.date(2020, 1, 1)),
               (D("100.00"), dt.date(2021, 1, 1))]
    w = make(spark, sales, CUST, targets)
    k = rows(w["vw_exec_kpi_scorecard"], "performance_year")
    assert k[2017]["target_status"] == "No Target" and k[2017]["target_achievement_pct"] is None
    assert k[2018]["targeted_revenue"] == D("0.00") and k[2018]["target_status"] == "No Target"
    assert k[2019]["targeted_revenue"] == D("0.00") and k[2019]["target_status"] == "No Target"
    # two targets in 2020: the year's sums are doubled, the target is the max
    assert k[2020]["actual_revenue"] == D("200.00") and k[2020]["targeted_revenue"] == D("120.00")
    assert k[2020]["target_achievement_pct"] == D("166.67") and k[2020]["target_status"] == "On Target"
    assert k[2020]["units_sold"] == 2 and k[2020]["total_orders"] == 1
    assert k[2021]["target_status"] == "On Target" and k[2021]["target_variance"] == D("0.00")
    assert k[2021]["yoy_revenue_growth_pct"] == D("-50.00")


def test_lag_is_positional_and_growth(spark):
    sales = [sale("o1", dt.date(2018, 1, 1), "A", revenue="100.00"),
             sale("o2", dt.date(2020, 1, 1), "A", revenue="121.00")]
    w = make(spark, sales, CUST)
    k = rows(w["vw_exec_kpi_scorecard"], "performance_year")
    assert k[2020]["prior_year_revenue"] == D("100.00")  # 2019 missing: compares with 2018
    assert k[2020]["yoy_revenue_growth_pct"] == D("21.00")
    g = rows(w["vw_revenue_growth"], "year")
    assert g[2018]["cagr_from_base_pct"] is None
    assert g[2020]["cagr_from_base_pct"] == D("10.00")  # (121/100)^(1/2) - 1
    mt = rows(w["vw_exec_monthly_trend"], "order_year")
    assert mt[2020]["prior_year_same_month_revenue"] == D("100.00")


def test_one_year_regression_gives_null_projection(spark):
    w = make(spark, [sale("o1", dt.date(2020, 5, 1), "A", revenue="100.00")], CUST)
    f = w["vw_revenue_forecast_linear"].collect()
    fc = sorted((r["year"], r["projected_revenue"]) for r in f if r["record_type"] == "Forecast")
    assert fc == [(2021, None), (2022, None), (2023, None)]
    act = [r for r in f if r["record_type"] == "Actual"]
    assert len(act) == 1 and act[0]["actual_revenue"] == D("100.00") and act[0]["projected_revenue"] is None


def test_linear_forecast_exact_line(spark):
    sales = [sale(f"o{y}", dt.date(y, 5, 1), "A", revenue=f"{100 + 10 * (y - 2015)}.00") for y in range(2015, 2019)]
    w = make(spark, sales, CUST)
    fc = {r["year"]: r["projected_revenue"] for r in w["vw_revenue_forecast_linear"].collect()
          if r["record_type"] == "Forecast"}
    assert fc == {2019: D("140.00"), 2020: D("150.00"), 2021: D("160.00")}


def test_rfm_with_fewer_customers_than_tiles_and_ties(spark):
    sales = [sale("o1", dt.date(2021, 12, 1), "A", revenue="10.00"),
             sale("o2", dt.date(2021, 6, 1), "B", revenue="10.00"),
             sale("o3", dt.date(2021, 6, 1), "C", revenue="30.00"),
             sale("o4", dt.date(2021, 6, 2), "C", revenue="5.00")]
    customers = CUST + [("C", "SMB", "Peru", D("0.0300"))]
    w = make(spark, sales, customers, as_of=dt.date(2021, 12, 31))
    r = rows(w["vw_customer_rfm"], "customer_id")
    # recency is tiled ascending: A (30 days) gets r_score 1
    assert (r["A"]["recency_days"], r["C"]["recency_days"], r["B"]["recency_days"]) == (30, 212, 213)
    assert (r["A"]["r_score"], r["C"]["r_score"], r["B"]["r_score"]) == (1, 2, 3)
    # frequency ties (A, B = 1) broken by customer id
    assert (r["A"]["f_score"], r["B"]["f_score"], r["C"]["f_score"]) == (1, 2, 3)
    assert (r["A"]["m_score"], r["B"]["m_score"], r["C"]["m_score"]) == (1, 2, 3)
    assert r["C"]["rfm_total"] == 8 and r["C"]["rfm_segment"] == "At Risk"  # r <= 2, f >= 3
    assert r["A"]["rfm_segment"] == "Lost"


def test_cash_flow_edge_cases(spark):
    cf = [(dt.date(2015, 1, 1), " P1 ", D("0.1000"), D("-100.00")),
          (dt.date(2016, 1, 1), "P1", D("0.1000"), D("60.00")),
          (dt.date(2016, 1, 1), "P1", D("0.1000"), D("0.00")),     # same period: summed
          (dt.date(2017, 1, 1), "P1", D("0.1000"), D("60.50")),
          (dt.date(2015, 1, 1), "P2", D("0.0500"), D("-10.00")),
          (dt.date(2016, 1, 1), "P2", D("0.0500"), None),          # NULL flow -> Inflow
          (dt.date(2017, 1, 1), "P2", D("0.0500"), D("0.00"))]
    w = make(spark, cash_flow=cf)
    sched = {(r["product_id"], r["period_t"]): r for r in w["mart_product_cashflow"].collect()}
    assert len(sched) == 6
    assert sched[("P1", 1)]["operational_cashflow"] == D("60.00")
    assert sched[("P1", 1)]["discounted_cashflow"] == D("54.55")   # 60 / 1.1
    assert sched[("P1", 2)]["discounted_cashflow"] == D("50.00")   # 60.5 / 1.21
    assert sched[("P1", 2)]["cumulative_cashflow"] == D("20.50")
    assert sched[("P2", 1)]["flow_type"] == "Inflow" and sched[("P2", 2)]["flow_type"] == "Inflow"
    s = rows(w["vw_capex_project_summary"], "product_id")
    assert s["P1"]["npv"] == D("4.55") and s["P1"]["viability"] == "Viable"
    assert s["P1"]["payback_period"] == 2 and s["P1"]["initial_investment"] == D("-100.00")
    assert s["P1"]["profitability_index"] == D("1.046")
    assert s["P2"]["payback_period"] is None and s["P2"]["viability"] == "Not Viable"
    assert s["P2"]["num_periods"] == 3
    sens = {(r["product_id"], str(r["discount_rate"])): r for r in w["vw_capex_sensitivity"].collect()}
    assert len(sens) == 14
    assert sens[("P2", "0.03")]["npv_sign"] == "Negative"


def test_tenure_bands_and_seniority(spark):
    emp = [(str(i), f" E{i} ", dt.date(2016 + i % 3, 1, 1), D(str(t)) if t is not None else None, " Ops ")
           for i, t in enumerate([1, 2, 3, 4, 5, 6, "0.50", "5.01", None])]
    w = make(spark, employees=emp)
    td = {str(r["tenure_years"]): r["tenure_band"] for r in w["vw_employee_tenure_distribution"].collect()}
    assert td == {"1.00": "0-1 Year", "2.00": "1-2 Years", "3.00": "2-3 Years", "4.00": "3-4 Years",
                  "5.00": "4-5 Years", "6.00": "5+ Years", "0.50": "0-1 Year", "5.01": "5+ Years",
                  "None": "5+ Years"}
    ro = {r["employee_name"]: r["seniority_level"] for r in w["vw_employee_roster"].collect()}
    assert ro["E5"] == "Senior" and ro["E3"] == "Mid-Level" and ro["E2"] == "Junior" and ro["E8"] == "Junior"
    d = w["vw_employee_dept_summary"].collect()[0]
    assert d["department"] == "Ops" and d["headcount"] == 9
    assert (d["senior_count"], d["junior_count"]) == (1, 7)    # NULL tenure is neither
    assert d["senior_pct"] == D("11.1") and d["dept_headcount_share_pct"] == D("100.0")
    assert d["avg_tenure_years"] == D("3.31")                   # 26.51 / 8


def test_padded_month_name_in_staging(spark):
    w = make(spark, [sale("o1", dt.date(2020, 5, 1), "A")], CUST)
    r = w["stg_sales"].first()
    assert r["order_month_name"] == "May      " and r["calculated_profit"] == D("8.00")


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_properties_on_fixture(spark, sf):
    w = Warehouse.from_testdata(spark, sf, as_of=dt.date(2001, 12, 31))
    ann = {r["performance_year"]: r["actual_revenue"] for r in w["mart_annual_performance"].collect()}
    ms = w["mart_monthly_sales"].collect()
    for y, rev in ann.items():
        last = max((r for r in ms if r["order_year"] == y), key=lambda r: r["order_month"])
        assert last["ytd_revenue"] == rev
    shares = {}
    for r in w["vw_exec_segment_summary"].collect():
        shares[r["year"]] = shares.get(r["year"], 0) + r["revenue_share_pct"]
    assert all(abs(v - 100) <= D("0.05") for v in shares.values())
    sched = w["mart_product_cashflow"].collect()
    tot = {}
    for r in sched:
        tot[r["product_id"]] = tot.get(r["product_id"], 0) + r["operational_cashflow"]
    for p, t in tot.items():
        last = max((r for r in sched if r["product_id"] == p), key=lambda r: r["period_t"])
        assert last["cumulative_cashflow"] == t
    tiles = {}
    for r in w["vw_customer_rfm"].collect():
        tiles[r["r_score"]] = tiles.get(r["r_score"], 0) + 1
    assert max(tiles.values()) - min(tiles.values()) <= 1
