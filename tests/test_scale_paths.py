"""The paths that exist for scale: hot keys and wide magnitudes.

* NTILE when one metric value holds a third of all rows;
* exact rounding across magnitudes up to money aggregated at 100 TB;
* a customer id copied across a third of the customer table: the
  pre-aggregated multiplicity path equals brute-force join-then-aggregate.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.functions import pct, ratio
from revmart.operators.ntile import add_ntile, add_ntiles
from revmart.plans.warehouse import Warehouse
from revmart.sources import schema as S
from revmart.sources.raw import Sources


def test_ntile_with_a_hot_metric_value(spark):
    rows = [(f"c{i:05d}", 1 if i % 3 == 0 else i) for i in range(3000)]  # value 1 x 1000
    df = spark.createDataFrame(rows, "id string, m long")
    order = [F.col("m").asc_nulls_last(), F.col("id").asc_nulls_last()]
    out = add_ntile(df, 5, order, "t", num_partitions=6)
    got = {r["id"]: r["t"] for r in out.collect()}
    ref = {r["id"]: r["t"] for r in df.withColumn("t", F.ntile(5).over(Window.orderBy(*order))).collect()}
    assert got == ref
    # the hot value is spread over several range partitions, not one task
    parts = (df.repartitionByRange(6, *order).withColumn("p", F.spark_partition_id())
               .where("m = 1").select("p").distinct().count())
    assert parts >= 2


def _round_half_away(x: Fraction, scale: int) -> D:
    u = x * 10 ** scale
    s = -1 if u < 0 else 1
    a = abs(u)
    q = int(a) + (1 if a - int(a) >= Fraction(1, 2) else 0)
    return D(s * q).scaleb(-scale)


money = st.integers(min_value=-10 ** 20, max_value=10 ** 20).map(lambda c: D(c).scaleb(-2))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(money, money), min_size=1, max_size=40))
def test_exact_rounding_property(spark, pairs):
    schema = T.StructType([T.StructField("n", T.DecimalType(38, 2)), T.StructField("d", T.DecimalType(38, 2))])
    df = spark.createDataFrame(pairs, schema)
    out = df.select("n", "d", pct(F.col("n"), F.col("d"), T.DecimalType(38, 2)).alias("p"),
                    ratio(F.col("n"), F.col("d"), 4, T.DecimalType(38, 4)).alias("r")).collect()
    for r in out:
        if r["d"] == 0:
            assert r["p"] is None and r["r"] is None
            continue
        q = Fraction(r["n"]) / Fraction(r["d"])
        if abs(q) < 10 ** 12:
            assert r["p"] == _round_half_away(q * 100, 2)
            assert r["r"] == _round_half_away(q, 4)


def test_hot_duplicated_customer_matches_join_then_aggregate(spark):
    sales = [(f"o{i}", dt.date(2020, 1 + i % 12, 1), "HOT" if i % 2 else f"c{i % 7}", "P1", 1,
              D("1.00"), D("2.00"), D("10.00"), D("-1.00"), D(f"{9 + i}.00"), D("1.00"), D(f"{8 + i}.00"))
             for i in range(60)]
    customers = ([("HOT", "SMB", "Peru", D("0.0100"))] * 40
                 + [("HOT", "RETAIL", "Peru", D("0.0100"))] * 5
                 + [(f"c{j}", "SMB" if j % 2 else "GOV", "Chile", D("0.0200")) for j in range(7)])
    w = Warehouse(Sources(sales=spark.createDataFrame(sales, S.SALES),
                          customers=spark.createDataFrame(customers, S.CUSTOMERS)), spark)
    s, c = w["stg_sales"], w["stg_customers"]
    brute = (s.join(c, "customer_id")
              .groupBy("customer_id", "customer_segment", "country", "discount_premium_band")
              .agg(F.sum("revenue").alias("rev"), F.countDistinct("order_id").alias("orders")))
    want = sorted((r["customer_id"], r["customer_segment"], r["rev"], r["orders"]) for r in brute.collect())
    got = sorted((r["customer_id"], r["customer_segment"], r["total_revenue"], r["total_orders"])
                 for r in w["mart_customer_sales"].collect())
    assert got == want
    seg_brute = (s.join(c, "customer_id").groupBy("order_year", "customer_segment")
                  .agg(F.sum("revenue").alias("rev"), F.countDistinct("customer_id").alias("n")))
    want = sorted((r["order_year"], r["customer_segment"], r["rev"], r["n"]) for r in seg_brute.collect())
    got = sorted((r["year"], r["segment"], r["total_revenue"], r["customer_count"])
                 for r in w["vw_exec_segment_summary"].collect())
    assert got == want


def test_several_ntiles_in_one_pass(spark):
    rows = [(None if i % 11 == 0 else f"c{i:04d}", None if i % 7 == 0 else i % 13) for i in range(500)]
    df = spark.createDataFrame([r for r in rows if r[0]] + [(None, 3)], "id string, m int")
    for n in (3, 7, 400):
        few = df.orderBy("id").limit(n)
        key = [F.col("m").isNull(), F.col("m"), F.col("id").isNull(), F.col("id")]
        back = [F.col("m").isNotNull(), -F.col("m"), F.col("id").isNull(), F.col("id")]
        got = sorted(map(repr, map(tuple, add_ntiles(few, 5, {"t": key, "u": back}, 4).collect())))
        w = [F.col("m").asc_nulls_last(), F.col("id").asc_nulls_last()]
        v = [F.col("m").desc_nulls_first(), F.col("id").asc_nulls_last()]
        ref = few.withColumn("t", F.ntile(5).over(Window.orderBy(*w))).withColumn("u", F.ntile(5).over(Window.orderBy(*v)))
        assert got == sorted(map(repr, map(tuple, ref.collect())))


def _sale(order, day, customer, cents):
    m = D(cents).scaleb(-2)
    return (order, day, customer, "P1", 1, D("1.00"), D("2.00"), m, D("0.00"), m, D("0.00"), m)


def test_rfm_with_a_hot_customer_row(spark):
    """An id copied over a third of the customers is joined once and spelled
    out after the join; the sort key is finer than the 13 totals."""
    sales = [_sale(f"o{i}", dt.date(2020, 1, 1 + i % 28), f"c{i % 40:02d}", 100 + i) for i in range(200)]
    customers = [(f"c{j:02d}", "SMB", "Peru", None) for j in range(40)] + [("c07", "SMB", "Peru", None)] * 20
    w = Warehouse(Sources(sales=spark.createDataFrame(sales, S.SALES), customers=spark.createDataFrame(customers, S.CUSTOMERS)),
                  spark, as_of=dt.date(2021, 1, 1))
    out = w["vw_customer_rfm"]
    rows = out.collect()
    assert len(rows) == 60 and sum(r["customer_id"] == "c07" for r in rows) == 21
    assert [(-r["rfm_total"], r["customer_id"]) for r in rows] == sorted((-r["rfm_total"], r["customer_id"]) for r in rows)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Join")  # repeated above the join


def test_targets_and_cash_flows_of_1e15(spark):
    big = 10 ** 17  # cents
    sales = [_sale("o1", dt.date(2020, 1, 1), "A", 10 ** 14), _sale("o2", dt.date(2021, 1, 1), "A", 10 ** 14)]
    flows = [(dt.date(2020 + t, 1, 1), "P1", D("0.0500"), D((-1 if t == 0 else 1) * big).scaleb(-2)) for t in range(4)]
    w = Warehouse(Sources(
        sales=spark.createDataFrame(sales, S.SALES), customers=spark.createDataFrame([("A", "SMB", "Peru", None)], S.CUSTOMERS),
        targets=spark.createDataFrame([(D(big).scaleb(-2), dt.date(2020, 1, 1))], S.TARGETS),
        cash_flow=spark.createDataFrame(flows, S.CASH_FLOW)), spark)
    t = {r["performance_year"]: r for r in w["vw_revenue_actual_vs_target"].collect()}
    assert t[2020]["targeted_revenue"] == D("1e15") and t[2021]["target_status"] == "No Target"
    s = w["vw_capex_project_summary"].first()
    assert s["total_inflows"] == D("3e15") and s["initial_investment"] == D("-1e15")
    assert w["vw_capex_sensitivity"].count() == 7


def _present(cents: int, rate: D, t: int) -> Fraction:
    return Fraction(cents) / (1 + Fraction(rate)) ** t


def test_present_values_are_exact_to_the_cent(spark):
    """Flows up to 1e15 against rational arithmetic; sums don't depend on the
    order of rows."""
    import random
    rng = random.Random(11)
    rates = [D(r) for r in ("0.0000", "0.0300", "0.0725", "0.1000", "0.2500", "0.6000", "1.0000", "-0.0500")]
    flows = []
    for k, rate in enumerate(rates):
        for t in range(12):
            cents = rng.choice([1, 5, 90_000_000_000_000_001, rng.randrange(10 ** 17), 12_345]) if t else -10 ** 16 - k
            flows.append((dt.date(2000 + t, 1, 1), f"P{k}", rate, D(cents).scaleb(-2)))
    frame = spark.createDataFrame(flows, S.CASH_FLOW)
    seen = []
    for df in (frame, frame.orderBy(F.rand(3)).repartition(7), frame.coalesce(1)):
        w = Warehouse(Sources(cash_flow=df), spark)
        rows = w["mart_product_cashflow"].collect()
        assert len(rows) == len(flows)
        for r in rows:
            want = _present(int(r["operational_cashflow"].scaleb(2)), r["assigned_discount_rate"], r["period_t"])
            assert int(r["discounted_cashflow"].scaleb(2)) == int(_round_half_away(want, 0)), r
        npv = {(r["product_id"], r["discount_rate"]): (r["npv"], r["npv_sign"]) for r in w["vw_capex_sensitivity"].collect()}
        for (p, rate), (value, sign) in npv.items():
            want = sum(_present(int(c.scaleb(2)), rate, d.year - 2000) for d, q, _, c in flows if q == p)
            assert int(value.scaleb(2)) == int(_round_half_away(want, 0)) and (sign == "Positive") == (want > 0)
        summary = {r["product_id"]: r["npv"] for r in w["vw_capex_project_summary"].collect()}
        for p in summary:
            assert summary[p] == sum(r["discounted_cashflow"] for r in rows if r["product_id"] == p)
        seen.append((sorted(npv.items()), sorted(summary.items())))
    assert seen[0] == seen[1] == seen[2]


def test_a_rate_of_minus_one_has_no_present_value(spark):
    w = Warehouse(Sources(cash_flow=spark.createDataFrame([(dt.date(2000 + t, 1, 1), "P", D("-1.0000"), D("5.00")) for t in range(2)], S.CASH_FLOW)), spark)
    assert [r["discounted_cashflow"] for r in w["mart_product_cashflow"].orderBy("period_t").collect()] == [D("5.00"), None]


def _exchanged_below(df, column: str) -> bool:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return any("Exchange hashpartitioning" in ln and column in ln for ln in plan.splitlines())


def test_plain_sums_move_no_orders(spark):
    """Relations without distinct counts aggregate the fact at their own grain;
    the fixture's own joins are taken out by reading written sources."""
    from tests.conftest import SF_SMALL
    src = Warehouse.from_testdata(spark, SF_SMALL).sources
    held = {n: getattr(src, n).checkpoint(eager=True) for n in Sources.NAMES}
    w = Warehouse(Sources(**held), spark)
    for name in ("vw_revenue_actual_vs_target", "vw_revenue_growth", "vw_revenue_forecast_linear", "vw_revenue_seasonality"):
        assert not _exchanged_below(w[name], "order_id"), name
    for name in ("dim_products", "vw_product_pricing"):
        assert not _exchanged_below(w[name], "order_month"), name
    assert _exchanged_below(w["mart_annual_performance"], "order_id")     # the guard sees what it looks for


def test_the_fact_is_read_for_two_roll_ups_only(spark):
    """Relations over the roll-ups never touch the fact again."""
    from tests.conftest import SF_SMALL
    w = Warehouse.from_testdata(spark, SF_SMALL).share_rollups()
    reads = []
    from revmart.plans.warehouse import DIMS_MARTS, RELATIONS, STAGING
    for name, (group, _) in RELATIONS.items():
        if group != STAGING and name not in ("vw_customer_rfm", "dim_date") and "cap" not in name and "cash" not in name:
            plan = w[name]._jdf.queryExecution().optimizedPlan().toString()
            if "l_orderkey" in plan:
                reads.append(name)
    assert sorted(reads) == ["mart_product_sales", "vw_product_performance", "vw_product_segment_matrix"]
    assert DIMS_MARTS


def test_product_sums_are_not_spread_with_the_distinct_ids(spark):
    """Distinct orders and customers are counted apart from the sums."""
    from tests.conftest import SF_SMALL
    w = Warehouse.from_testdata(spark, SF_SMALL)
    assert "Expand" not in w["mart_product_sales"]._jdf.queryExecution().optimizedPlan().toString()


def test_product_mart_over_null_keys(spark):
    from revmart.plans.marts import mart_product_sales
    from revmart.plans.staging import stg_sales
    raw = spark.sql("""SELECT o AS order_id, DATE'2001-02-03' AS order_date, c AS customer_id, p AS product_id, 2 AS units_sold,
        CAST(1 AS DECIMAL(12,2)) AS manufacturing_price, CAST(3 AS DECIMAL(12,2)) AS target_sale_price, CAST(6 AS DECIMAL(15,2)) AS gross_sales,
        CAST(0 AS DECIMAL(15,2)) AS discount_premium, CAST(6 AS DECIMAL(15,2)) AS revenue, CAST(2 AS DECIMAL(15,2)) AS cogs, CAST(4 AS DECIMAL(15,2)) AS profit
        FROM VALUES ('1', 'a', 'P'), ('1', 'a', 'P'), ('2', 'a', 'P'), ('a', NULL, 'P'), ('3', NULL, 'Q'), ('4', 'b', NULL), ('4', 'c', NULL) AS t(o, c, p)""")
    got = {r["product_id"]: r for r in mart_product_sales(stg_sales(raw)).collect()}
    assert {p: (r["total_orders"], r["customer_reach"], r["total_units_sold"], int(r["total_revenue"])) for p, r in got.items()} == {
        "P": (3, 1, 8, 24), "Q": (1, 0, 2, 6), None: (1, 2, 4, 12)}
    assert mart_product_sales(stg_sales(raw.limit(0))).count() == 0


def test_profile_puts_the_fact_together_once(spark):
    """Once staging is written, nothing reads the sources of the fact again."""
    from tests.conftest import SF_SMALL
    w = Warehouse.from_testdata(spark, SF_SMALL).write_once(("stg_sales", "mart_product_sales"))
    for name in ("stg_sales", "mart_product_sales", "vw_product_segment_matrix"):
        assert "l_orderkey" not in w[name]._jdf.queryExecution().optimizedPlan().toString(), name
    assert {r[0] for r in w.counted} == {"stg_sales", "mart_product_sales"}
