"""SQL text of the staging and presentation relations.

``publish_views`` stores these statements as views, so a view is worked out
when it is read: over the raw tables as they are then (staging and what reads
it) and over the marts as last built, and its rows come in its ORDER BY. The
exact rounding rules are SQL functions beside the views. The statements follow
the DataFrame relations: both sides of a join with customers are aggregated
before it (copies of a customer row are counted and multiplied in), and the
quintiles of the RFM view are found without a window over all customers.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from revmart.functions import MONEY, MONEY_TOTAL, PCT, PCT1, PV_DIGITS, RATIO_UNIT_DIGITS, TENURE, UNIT_PRICE, UNIT_PRICE4
from revmart.functions.numeric import BAND, INDEX3, MONEY_DIFF, RATE
from revmart.plans.capex import SENSITIVITY_RATES
from revmart.plans.customer import RFM_DEFAULT_SEGMENT
from revmart.plans.employee import MID_LEVEL_YEARS, SENIOR_YEARS
from revmart.plans.forecast import FORECAST_YEARS


def _t(dtype: T.DataType) -> str:
    return dtype.simpleString()


TOTAL = _t(MONEY_TOTAL)


def functions(db: str) -> list[str]:
    """Statements that create the views' functions in database ``db``."""
    wide = "num DECIMAL(38,4), den DECIMAL(38,4)"
    twice = "(abs(num) * (2 * factor) + abs(nullif(den, 0)))"
    half_up = f"CAST(({twice} - pmod({twice}, abs(nullif(den, 0)) * 2)) / (abs(nullif(den, 0)) * 2) AS DECIMAL(38,0))"
    step = "(2BD * 10000BD * v + m)"

    def ratio(name, factor, scale, dtype):
        scaled = f"CAST({db}.round_div(num, den, {factor}) AS DECIMAL(30,0))"
        value = f"CAST({scaled} * {10 ** -scale:.{scale}f}BD AS {_t(dtype)})" if scale else f"CAST({scaled} AS {_t(dtype)})"
        return f"CREATE OR REPLACE FUNCTION {db}.{name}({wide}) RETURNS {_t(dtype)} RETURN {value}"

    return [
        # num * factor / den as an integer, ties away from zero
        f"CREATE OR REPLACE FUNCTION {db}.round_div({wide}, factor DECIMAL(20,0)) RETURNS DECIMAL(38,0) "
        f"RETURN CASE WHEN (num < 0) <> (nullif(den, 0) < 0) THEN -{half_up} ELSE {half_up} END",
        ratio("pct", 10 ** 4, 2, PCT), ratio("pct1", 10 ** 3, 1, PCT1),
        ratio("mean2", 10 ** 2, 2, TENURE), ratio("price2", 10 ** 2, 2, UNIT_PRICE), ratio("price4", 10 ** 4, 4, UNIT_PRICE4),
        ratio("whole", 1, 0, MONEY_TOTAL), ratio("index3", 10 ** 3, 3, INDEX3),
        f"CREATE OR REPLACE FUNCTION {db}.growth_pct(cur {TOTAL}, prev {TOTAL}) RETURNS {_t(PCT)} RETURN {db}.pct(cur - prev, prev)",
        # mean of ratios held as integers of 10**-15, as a percentage
        f"CREATE OR REPLACE FUNCTION {db}.mean_pct(units DECIMAL(38,0), n BIGINT) RETURNS {_t(PCT)} "
        f"RETURN {db}.pct(units, n * {10 ** RATIO_UNIT_DIGITS}BD)",
        # cents * 10**PV_DIGITS discounted over t periods, rounded at every step
        f"CREATE OR REPLACE FUNCTION {db}.pv_units(cash {TOTAL}, rate {_t(RATE)}, t BIGINT) RETURNS DECIMAL(38,0) RETURN "
        f"CASE WHEN cash < 0 THEN -1 ELSE 1 END * aggregate(array_repeat(CAST((1 + rate) * 10000 AS DECIMAL(10,0)), CAST(t AS INT)), "
        f"CAST(abs(cash) * {10 ** (PV_DIGITS + 2)}BD AS DECIMAL(38,0)), (v, m) -> CAST(({step} - pmod({step}, 2BD * m)) / (2BD * m) AS DECIMAL(38,0)))",
    ]


def _units(dtype: T.DataType) -> str:
    """``::INT`` of the units, which rounds."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return "CAST(rint(units_sold) AS INT)"
    return "CAST(round(units_sold, 0) AS INT)" if isinstance(dtype, T.DecimalType) else "CAST(units_sold AS INT)"


def staging_sql(raw: dict[str, str], units_type: T.DataType) -> dict[str, str]:
    """Statements of T1-T5 over the raw tables."""
    money, price = _t(MONEY), _t(UNIT_PRICE)

    def key(c):
        return f"substring(CAST({c} AS STRING), 1, 50)"
    return {
        "stg_customers": f"""
            SELECT {key('customer_id')} AS customer_id, upper(trim(segment)) AS customer_segment, trim(country) AS country,
                   CAST(discount_premium_band AS {_t(BAND)}) AS discount_premium_band
            FROM {raw['customers']} WHERE customer_id IS NOT NULL""",
        "stg_sales": f"""
            SELECT {key('order_id')} AS order_id, d AS order_date, year(d) AS order_year, month(d) AS order_month, quarter(d) AS order_quarter,
                   rpad(date_format(d, 'MMMM'), 9, ' ') AS order_month_name,
                   {key('customer_id')} AS customer_id, {key('product_id')} AS product_id, {_units(units_type)} AS units_sold,
                   CAST(manufacturing_price AS {price}) AS manufacturing_price, CAST(target_sale_price AS {price}) AS target_sale_price,
                   CAST(gross_sales AS {money}) AS gross_sales, CAST(discount_premium AS {money}) AS discount_premium,
                   CAST(revenue AS {money}) AS revenue, CAST(cogs AS {money}) AS cogs, CAST(profit AS {money}) AS reported_profit,
                   CAST(CAST(revenue AS {money}) - CAST(cogs AS {money}) AS {_t(MONEY_DIFF)}) AS calculated_profit
            FROM (SELECT *, CAST(order_date AS DATE) AS d FROM {raw['sales']} WHERE order_id IS NOT NULL)""",
        "stg_revenue_targets": f"""
            SELECT CAST(revenue_target AS {TOTAL}) AS targeted_revenue, CAST(target_date AS DATE) AS target_date,
                   year(CAST(target_date AS DATE)) AS target_year
            FROM {raw['targets']}""",
        "stg_cash_flow": f"""
            SELECT CAST(date AS DATE) AS cashflow_date, year(CAST(date AS DATE)) AS cashflow_year, {key('trim(product)')} AS product_id,
                   CAST(discount_rate AS {_t(RATE)}) AS assigned_discount_rate, CAST(cashflow AS {TOTAL}) AS operational_cashflow
            FROM {raw['cash_flow']}""",
        "stg_employees": f"""
            SELECT {key('employee_id')} AS employee_id, trim(name) AS employee_name, CAST(start_date AS DATE) AS start_date,
                   CAST(`tenure_(years)` AS {_t(TENURE)}) AS tenure_years, trim(department) AS department
            FROM {raw['employees']} WHERE employee_id IS NOT NULL""",
    }


def _customers(s: str, *attrs: str) -> str:
    """Distinct customer rows and how many copies each has."""
    cols = ", ".join(("customer_id", *attrs))
    return f"SELECT {cols}, count(*) AS k FROM {s}.stg_customers WHERE customer_id IS NOT NULL GROUP BY {cols}"


def _tile(metric: str, out: str) -> str:
    """CTEs for where the rows of one metric value and id prefix start in the
    order of all rows. Counts are summed in two levels, over coarse classes of
    the metric (logarithmic, some thousands) and within each class, so no
    window holds more than a class; a value that very many customers share is
    spread by the first characters of their ids."""
    return f"""
        {out}_fine AS (
            SELECT {metric} AS m, part AS p, count(*) AS n, CAST(floor(sign({metric}) * ln(1 + abs(CAST({metric} AS DOUBLE))) * 64) AS INT) AS c
            FROM rfm_raw GROUP BY {metric}, part),
        {out}_coarse AS (
            SELECT c AS class, sum(n) OVER (ORDER BY c ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS before,
                   sum(n) OVER () AS total FROM (SELECT c, sum(n) AS n FROM {out}_fine GROUP BY c)),
        {out}_starts AS (
            SELECT m, p, before - n + sum(n) OVER (PARTITION BY c ORDER BY m ASC NULLS LAST, p ASC NULLS LAST
                                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ahead,
                   total DIV 5 AS q, total % 5 AS r
            FROM {out}_fine JOIN {out}_coarse ON c <=> class)"""


def _rfm(s: str, as_of: _dt.date | None) -> str:
    today = f"DATE '{as_of.isoformat()}'" if as_of else "current_date()"
    metrics = (("recency_days", "r"), ("frequency", "f"), ("monetary", "m"))
    places = ", ".join(f"row_number() OVER (PARTITION BY {m}, part ORDER BY customer_id ASC NULLS LAST) AS {x}_place" for m, x in metrics)
    joins = " ".join(f"JOIN {x}_starts AS {x}s ON {m} <=> {x}s.m AND part <=> {x}s.p" for m, x in metrics)

    def tile(x):
        rn, big = f"({x}s.ahead + {x}_place)", f"{x}s.r * ({x}s.q + 1)"
        return (f"CAST(CASE WHEN {rn} <= {big} THEN ({rn} - 1) DIV ({x}s.q + 1) + 1 "
                f"ELSE {x}s.r + ({rn} - {big} - 1) DIV greatest({x}s.q, 1) + 1 END AS INT) AS {x}_score")
    return f"""
        WITH rfm_raw AS (
            SELECT customer_id, max(order_date) AS last_order_date, count(DISTINCT order_id) AS frequency, CAST(sum(revenue) AS {TOTAL}) AS monetary,
                   CAST(datediff({today}, max(order_date)) AS INT) AS recency_days, substring(customer_id, 1, 3) AS part
            FROM {s}.stg_sales GROUP BY customer_id),
        {", ".join(_tile(m, x) for m, x in metrics)},
        numbered AS (SELECT *, {places} FROM rfm_raw),
        scored AS (SELECT customer_id, last_order_date, recency_days, frequency, monetary, {tile('r')}, {tile('f')}, {tile('m')} FROM numbered {joins}),
        cust AS ({_customers(s, 'customer_segment', 'country')}),
        copies AS (SELECT *, explode(sequence(1L, k)) AS copy FROM scored JOIN cust USING (customer_id))
        SELECT customer_id, customer_segment, country, last_order_date, recency_days, frequency, monetary, r_score, f_score, m_score,
               r_score + f_score + m_score AS rfm_total,
               CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
                    WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal Customers'
                    WHEN r_score >= 4 THEN 'Recent Customers'
                    WHEN f_score >= 4 AND m_score >= 4 THEN 'Potential Loyalists'
                    WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
                    WHEN r_score <= 2 AND f_score <= 2 THEN 'Lost'
                    ELSE '{RFM_DEFAULT_SEGMENT}' END AS rfm_segment
        FROM copies ORDER BY rfm_total DESC NULLS FIRST, customer_id"""


def presentation_sql(s: str, a: str, f: str, as_of: _dt.date | None = None) -> dict[str, str]:
    """Statements of P1-P22 over staging database ``s`` and mart database
    ``a``, with the functions of database ``f``."""
    year_sales = f"""
        SELECT customer_id, order_year, sum(revenue) AS rev, sum(calculated_profit) AS profit, sum(units_sold) AS units,
               count(DISTINCT order_id) AS orders
        FROM {s}.stg_sales WHERE customer_id IS NOT NULL GROUP BY customer_id, order_year"""
    out = {
        "vw_exec_kpi_scorecard": f"""
            SELECT performance_year, actual_revenue, actual_cogs, actual_profit, gross_margin_pct, units_sold, total_orders, unique_customers,
                   targeted_revenue, target_variance, target_achievement_pct, prior_year_revenue,
                   {f}.growth_pct(actual_revenue, prior_year_revenue) AS yoy_revenue_growth_pct,
                   CASE WHEN targeted_revenue = 0 THEN 'No Target' WHEN actual_revenue >= targeted_revenue THEN 'On Target'
                        ELSE 'Below Target' END AS target_status
            FROM (SELECT *, lag(actual_revenue) OVER (ORDER BY performance_year ASC NULLS LAST) AS prior_year_revenue
                  FROM {a}.mart_annual_performance)
            ORDER BY performance_year ASC NULLS LAST""",
        "vw_exec_monthly_trend": f"""
            SELECT month_start, order_year, order_month, order_quarter, month_abbr, monthly_revenue, monthly_profit, monthly_cogs, monthly_units,
                   order_count, margin_pct, ytd_revenue, prior_year_same_month_revenue,
                   {f}.growth_pct(monthly_revenue, prior_year_same_month_revenue) AS mom_yoy_growth_pct
            FROM (SELECT *, lag(monthly_revenue) OVER (PARTITION BY order_month ORDER BY order_year ASC NULLS LAST) AS prior_year_same_month_revenue
                  FROM {a}.mart_monthly_sales)
            ORDER BY month_start ASC NULLS LAST""",
        "vw_exec_segment_summary": f"""
            WITH per AS ({year_sales}), cust AS ({_customers(s, 'customer_segment')}),
            g AS (SELECT order_year AS year, customer_segment AS segment, count(DISTINCT customer_id) AS customer_count,
                         sum(rev * k) AS rev, sum(profit * k) AS profit
                  FROM per JOIN cust USING (customer_id) GROUP BY order_year, customer_segment),
            h AS (SELECT *, sum(rev) OVER (PARTITION BY year) AS year_rev FROM g)
            SELECT year, segment, customer_count, CAST(rev AS {TOTAL}) AS total_revenue, CAST(profit AS {TOTAL}) AS total_profit,
                   {f}.pct(profit, rev) AS margin_pct, {f}.pct(rev, year_rev) AS revenue_share_pct
            FROM h ORDER BY year ASC NULLS LAST, total_revenue DESC NULLS FIRST""",
        "vw_customer_performance": f"""
            SELECT customer_id, customer_segment, country, discount_premium_band, total_orders, total_units, total_revenue, total_profit,
                   profit_margin_pct, first_order_date, last_order_date, active_years, avg_order_value, total_discount_premium
            FROM {a}.mart_customer_sales ORDER BY total_revenue DESC NULLS FIRST""",
        "vw_customer_yearly_revenue": f"""
            WITH per AS ({year_sales}), cust AS ({_customers(s, 'customer_segment', 'country')})
            SELECT customer_id, customer_segment, country, order_year AS year, CAST(rev * k AS {TOTAL}) AS revenue,
                   CAST(profit * k AS {TOTAL}) AS profit, units * k AS units_sold, orders
            FROM per JOIN cust USING (customer_id) ORDER BY customer_id ASC NULLS LAST, year ASC NULLS LAST""",
        "vw_customer_country_summary": f"""
            WITH per AS (SELECT customer_id, order_year, order_id, sum(revenue) AS rev, sum(calculated_profit) AS profit, sum(units_sold) AS units
                         FROM {s}.stg_sales WHERE customer_id IS NOT NULL GROUP BY customer_id, order_year, order_id),
            cust AS ({_customers(s, 'country', 'customer_segment')}),
            g AS (SELECT country, customer_segment, order_year AS year, count(DISTINCT customer_id) AS customer_count, sum(rev * k) AS rev,
                         sum(profit * k) AS profit, sum(units * k) AS units, count(DISTINCT order_id) AS total_orders
                  FROM per JOIN cust USING (customer_id) GROUP BY country, customer_segment, order_year)
            SELECT country, customer_segment, year, customer_count, CAST(rev AS {TOTAL}) AS total_revenue, CAST(profit AS {TOTAL}) AS total_profit,
                   {f}.pct(profit, rev) AS margin_pct, units AS total_units, total_orders
            FROM g ORDER BY total_revenue DESC NULLS FIRST""",
        "vw_customer_rfm": _rfm(s, as_of),
        "vw_product_performance": f"""
            SELECT product_id, total_units_sold, total_revenue, total_cogs, total_profit, gross_margin_pct, avg_unit_mfg_cost, avg_unit_revenue,
                   avg_unit_profit, total_orders, customer_reach, first_sale_date, last_sale_date
            FROM {a}.mart_product_sales ORDER BY total_revenue DESC NULLS FIRST""",
        "vw_product_monthly_trend": f"""
            WITH g AS (SELECT product_id, order_year, order_month, make_date(order_year, order_month, 1) AS month_start, sum(units_sold) AS units,
                              sum(revenue) AS rev, sum(calculated_profit) AS p
                       FROM {s}.stg_sales GROUP BY product_id, order_year, order_month)
            SELECT product_id, month_start, order_year, order_month, quarter(month_start) AS order_quarter, units AS units_sold,
                   CAST(rev AS {TOTAL}) AS revenue, CAST(p AS {TOTAL}) AS profit, {f}.pct(p, rev) AS margin_pct
            FROM g ORDER BY product_id ASC NULLS LAST, month_start ASC NULLS LAST""",
        "vw_product_segment_matrix": f"""
            WITH per AS (SELECT product_id, customer_id, order_year, sum(units_sold) AS units, sum(revenue) AS rev, sum(calculated_profit) AS profit
                         FROM {s}.stg_sales WHERE customer_id IS NOT NULL GROUP BY product_id, customer_id, order_year),
            cust AS ({_customers(s, 'customer_segment')}),
            g AS (SELECT product_id, customer_segment AS segment, order_year AS year, sum(units * k) AS units, sum(rev * k) AS rev,
                         sum(profit * k) AS p, count(DISTINCT customer_id) AS customers
                  FROM per JOIN cust USING (customer_id) GROUP BY product_id, customer_segment, order_year)
            SELECT product_id, segment, year, units AS units_sold, CAST(rev AS {TOTAL}) AS revenue, CAST(p AS {TOTAL}) AS profit,
                   {f}.pct(p, rev) AS margin_pct, customers, {f}.price2(rev, units) AS avg_unit_price
            FROM g ORDER BY product_id ASC NULLS LAST, revenue DESC NULLS FIRST""",
        "vw_product_pricing": f"""
            WITH g AS (SELECT product_id, order_year AS year, sum(manufacturing_price) AS mfg, count(manufacturing_price) AS mfg_n,
                              sum(target_sale_price) AS target, count(target_sale_price) AS target_n, sum(revenue) AS rev, sum(units_sold) AS units,
                              sum({f}.round_div(revenue - gross_sales, gross_sales, {10 ** RATIO_UNIT_DIGITS})) AS off,
                              count({f}.round_div(revenue - gross_sales, gross_sales, {10 ** RATIO_UNIT_DIGITS})) AS off_n,
                              sum(discount_premium) AS disc, sum(gross_sales) AS gross
                       FROM {s}.stg_sales GROUP BY product_id, order_year)
            SELECT product_id, year, {f}.price4(mfg, mfg_n) AS avg_mfg_price, {f}.price4(target, target_n) AS avg_target_price,
                   {f}.price4(rev, units) AS avg_actual_unit_price, {f}.mean_pct(off, off_n) AS avg_discount_premium_pct,
                   CAST(disc AS {TOTAL}) AS total_discount_premium, CAST(gross AS {TOTAL}) AS total_gross_sales, CAST(rev AS {TOTAL}) AS total_net_revenue
            FROM g ORDER BY product_id ASC NULLS LAST, year ASC NULLS LAST""",
    }
    p = f
    out["vw_revenue_actual_vs_target"] = f"""
        SELECT performance_year, targeted_revenue, actual_revenue, actual_profit, target_variance, target_achievement_pct, target_status
        FROM {p}.vw_exec_kpi_scorecard ORDER BY performance_year ASC NULLS LAST"""
    out["vw_revenue_growth"] = f"""
        WITH base AS (
            SELECT performance_year AS year, actual_revenue, actual_profit, actual_cogs, gross_margin_pct, prior_year_revenue, yoy_revenue_growth_pct,
                   first(actual_revenue) OVER (ORDER BY performance_year ASC NULLS LAST) AS base_rev,
                   first(performance_year) OVER (ORDER BY performance_year ASC NULLS LAST) AS base_year
            FROM {p}.vw_exec_kpi_scorecard)
        SELECT year, actual_revenue, actual_profit, actual_cogs, gross_margin_pct, prior_year_revenue, yoy_revenue_growth_pct,
               CAST(CASE WHEN year = base_year OR base_rev IS NULL OR base_rev = 0 THEN NULL
                         ELSE round((exp(ln(CAST(actual_revenue AS DOUBLE) / CAST(base_rev AS DOUBLE)) / nullif(CAST(year - base_year AS DOUBLE), 0.0D)) - 1) * 100, 2)
                    END AS {_t(PCT)}) AS cagr_from_base_pct
        FROM base ORDER BY year ASC NULLS LAST"""
    out["vw_revenue_forecast_linear"] = f"""
        WITH reg AS (
            SELECT regr_slope(CAST(actual_revenue AS DOUBLE), CAST(performance_year AS DOUBLE)) AS slope,
                   regr_intercept(CAST(actual_revenue AS DOUBLE), CAST(performance_year AS DOUBLE)) AS intercept, max(performance_year) AS last_year
            FROM {a}.mart_annual_performance),
        ahead AS (SELECT slope, intercept, explode(sequence(last_year + 1, last_year + {FORECAST_YEARS})) AS year FROM reg)
        SELECT CAST(year AS INT) AS year, 'Forecast' AS record_type, CAST(round(slope * year + intercept, 0) AS {TOTAL}) AS projected_revenue,
               CAST(NULL AS {TOTAL}) AS actual_revenue
        FROM ahead
        UNION ALL
        SELECT CAST(performance_year AS INT), 'Actual', CAST(NULL AS {TOTAL}), CAST(actual_revenue AS {TOTAL}) FROM {a}.mart_annual_performance
        ORDER BY year ASC NULLS LAST"""
    out["vw_revenue_seasonality"] = f"""
        WITH monthly AS (
            SELECT order_month AS month_num, monthly_revenue AS m, sum(monthly_revenue) OVER (PARTITION BY order_year) AS year_rev
            FROM {a}.mart_monthly_sales WHERE order_year IS NOT NULL),
        shares AS (SELECT month_num, m, {f}.round_div(m, year_rev, {10 ** RATIO_UNIT_DIGITS}) AS share FROM monthly)
        SELECT month_num, date_format(make_date(2000, month_num, 1), 'MMM') AS month_abbr, {f}.mean_pct(sum(share), count(share)) AS avg_month_share_pct,
               {f}.whole(sum(m), count(m)) AS avg_monthly_revenue, CAST(max(m) AS {TOTAL}) AS max_monthly_revenue, CAST(min(m) AS {TOTAL}) AS min_monthly_revenue
        FROM shares GROUP BY month_num ORDER BY month_num ASC NULLS LAST"""
    out["vw_capex_cashflow_schedule"] = f"""
        SELECT product_id, cashflow_year AS year, cashflow_date, operational_cashflow, assigned_discount_rate, flow_type, period_t,
               discounted_cashflow, cumulative_cashflow
        FROM {a}.mart_product_cashflow ORDER BY product_id ASC NULLS LAST, cashflow_date ASC NULLS LAST"""
    out["vw_capex_project_summary"] = f"""
        WITH g AS (
            SELECT product_id, max(assigned_discount_rate) AS discount_rate, sum(operational_cashflow) AS total, sum(discounted_cashflow) AS dcf,
                   min(operational_cashflow) AS least,
                   sum(CASE WHEN operational_cashflow > 0 THEN operational_cashflow ELSE 0 END) AS inflows,
                   sum(CASE WHEN operational_cashflow < 0 THEN operational_cashflow ELSE 0 END) AS outflows,
                   count(*) AS num_periods, min(cashflow_date) AS project_start, max(cashflow_date) AS project_end,
                   min(CASE WHEN cumulative_cashflow >= 0 THEN period_t END) AS first_positive
            FROM {a}.mart_product_cashflow GROUP BY product_id),
        h AS (SELECT *, CAST(dcf AS {TOTAL}) AS npv, CAST(least AS {TOTAL}) AS initial_investment FROM g)
        SELECT product_id, project_start, project_end, CAST(discount_rate AS {_t(RATE)}) AS discount_rate, initial_investment,
               CAST(inflows AS {TOTAL}) AS total_inflows, CAST(outflows AS {TOTAL}) AS total_outflows, CAST(total AS {TOTAL}) AS total_undiscounted_cf,
               npv, CASE WHEN npv > 0 THEN 'Viable' ELSE 'Not Viable' END AS viability,
               CASE WHEN product_id IS NOT NULL THEN first_positive END AS payback_period,
               {f}.index3(npv + abs(initial_investment), abs(initial_investment)) AS profitability_index, num_periods
        FROM h ORDER BY npv DESC NULLS FIRST"""
    sums = ", ".join(f"sum({f}.pv_units(operational_cashflow, CAST({r} AS {_t(RATE)}), period_t)) AS npv{i}" for i, r in enumerate(SENSITIVITY_RATES))
    rows = ", ".join(f"named_struct('discount_rate', CAST({r} AS DECIMAL(3,2)), 'units', npv{i})" for i, r in enumerate(SENSITIVITY_RATES))
    out["vw_capex_sensitivity"] = f"""
        WITH g AS (SELECT product_id, {sums} FROM {a}.mart_product_cashflow GROUP BY product_id),
        h AS (SELECT product_id, inline(array({rows})) FROM g)
        SELECT product_id, discount_rate, CAST({f}.round_div(units, {10 ** PV_DIGITS}, 1) * 0.01BD AS {TOTAL}) AS npv,
               CASE WHEN units > 0 THEN 'Positive' ELSE 'Negative' END AS npv_sign
        FROM h ORDER BY product_id ASC NULLS LAST, discount_rate ASC NULLS LAST"""
    out["vw_employee_dept_summary"] = f"""
        WITH g AS (
            SELECT department, count(employee_id) AS headcount, sum(tenure_years) AS t, count(tenure_years) AS n, min(tenure_years) AS lo,
                   max(tenure_years) AS hi, count(CASE WHEN tenure_years >= {SENIOR_YEARS} THEN 1 END) AS senior_count,
                   count(CASE WHEN tenure_years < {SENIOR_YEARS} THEN 1 END) AS junior_count
            FROM {s}.stg_employees GROUP BY department),
        h AS (SELECT *, sum(headcount) OVER () AS all_staff FROM g)
        SELECT department, headcount, {f}.mean2(t, n) AS avg_tenure_years, lo AS min_tenure_years, hi AS max_tenure_years, senior_count, junior_count,
               {f}.pct1(senior_count, headcount) AS senior_pct, {f}.pct1(headcount, all_staff) AS dept_headcount_share_pct
        FROM h ORDER BY headcount DESC NULLS FIRST"""
    out["vw_employee_tenure_distribution"] = f"""
        SELECT department, tenure_years,
               CASE WHEN tenure_years <= 1 THEN '0-1 Year' WHEN tenure_years <= 2 THEN '1-2 Years' WHEN tenure_years <= 3 THEN '2-3 Years'
                    WHEN tenure_years <= 4 THEN '3-4 Years' WHEN tenure_years <= 5 THEN '4-5 Years' ELSE '5+ Years' END AS tenure_band,
               count(employee_id) AS headcount
        FROM {s}.stg_employees GROUP BY department, tenure_years ORDER BY department ASC NULLS LAST, tenure_years ASC NULLS LAST"""
    out["vw_employee_hiring_cohort"] = f"""
        SELECT year(start_date) AS hire_year, department, count(employee_id) AS hires, {f}.mean2(sum(tenure_years), count(tenure_years)) AS avg_current_tenure
        FROM {s}.stg_employees GROUP BY year(start_date), department ORDER BY hire_year ASC NULLS LAST, department ASC NULLS LAST"""
    out["vw_employee_roster"] = f"""
        SELECT employee_id, employee_name, department, start_date, tenure_years,
               CASE WHEN tenure_years >= {SENIOR_YEARS} THEN 'Senior' WHEN tenure_years >= {MID_LEVEL_YEARS} THEN 'Mid-Level' ELSE 'Junior' END AS seniority_level
        FROM {s}.stg_employees ORDER BY department ASC NULLS LAST, employee_name ASC NULLS LAST"""
    return out


def define(spark: SparkSession, database: str, statements: dict[str, str]) -> list[str]:
    """Create or redefine the views, in order. A view that exists is altered
    in one step, so that its readers never miss it."""
    written = []
    for name, text in statements.items():
        full = f"{database}.{name}"
        exists = spark.catalog.tableExists(full)
        if exists and spark.catalog.getTable(full).tableType != "VIEW":
            spark.sql(f"DROP TABLE {full}")     # written as a table by an earlier layout
            exists = False
        spark.sql(f"{'ALTER' if exists else 'CREATE'} VIEW {full} AS {text.strip()}")
        written.append(full)
    return written
