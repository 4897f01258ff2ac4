"""Landing (L1-L5), unique-key assertion (L7), profiles (L8) and the
materialize step, including an end-to-end run from files to views."""

from __future__ import annotations

import datetime as dt
import os
import tempfile
import uuid

import pytest

from revmart.operators import quality
from revmart.plans.warehouse import Warehouse
from revmart.sources import landing
from revmart.sources.schema import RAW_TABLES
from tests.conftest import SF_SMALL


def _db() -> str:
    return "t_" + uuid.uuid4().hex[:8]


def _write(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_clean_name():
    assert landing.clean_name("  Order ID ") == "order_id"
    assert landing.clean_name("Order-Date.x/y") == "order_date_x_y"
    assert landing.clean_name("Revenue $") == "revenue_"
    assert landing.clean_name("Tenure (Years)") == "tenure_(years)"


def test_land_folder(spark):
    root = tempfile.mkdtemp(prefix="landing-", dir="/tmp")
    _write(f"{root}/Sales Data.csv", "Order ID,Order-Date,Units.Sold,Price/Unit,Revenue $,Empty Col\n"
                                     "1,2020-01-01,3,2.50,7.50,\n2,2020-01-02,1,4.00,4.00,\n")
    _write(f"{root}/Book/Sheet1.csv", "a,b\n1,x\n")
    _write(f"{root}/empty.csv", "a,b\n")
    _write(f"{root}/collide.csv", "A B,a_b\n1,2\n")
    _write(f"{root}/notes.txt", "ignored")
    db = _db()
    res = {r["table_name"]: r for r in landing.land(spark, root, db)}
    assert set(res) == {"sales_data", "book_sheet1", "empty", "collide", "notes.txt".replace(".", "_")}
    assert res["notes_txt"]["run_mode"] == landing.SKIPPED_UNSUPPORTED
    assert res["sales_data"]["run_mode"] == landing.INITIAL_LOAD and res["sales_data"]["row_count"] == 2
    assert res["sales_data"]["null_columns"] == ("empty_col",)
    assert res["empty"]["run_mode"] == landing.SKIPPED_EMPTY
    assert res["collide"]["run_mode"] == landing.FAILED and "clean" in res["collide"]["error"]
    t = spark.table(f"{db}.sales_data")
    assert t.columns == ["order_id", "order_date", "units_sold", "price_unit", "revenue_", "empty_col"]
    assert t.count() == 2
    assert spark.table(f"{db}.book_sheet1").count() == 1

    # second run: full refresh; an extract that became empty keeps old data
    _write(f"{root}/Book/Sheet1.csv", "a,b\n")
    res2 = {r["table_name"]: r for r in landing.land(spark, root, db)}
    assert res2["sales_data"]["run_mode"] == landing.FULL_REFRESH
    assert res2["book_sheet1"]["run_mode"] == landing.SKIPPED_EMPTY
    assert spark.table(f"{db}.book_sheet1").count() == 1
    log = spark.table(f"{db}.{landing.AUDIT_TABLE}").collect()
    assert len(log) == 10
    modes = sorted((r["table_name"], r["run_mode"]) for r in log if r["table_name"] == "sales_data")
    assert modes == [("sales_data", "full_refresh"), ("sales_data", "initial_load")]
    assert all(r["ingested_at"] is not None for r in log)
    assert sorted(r["id"] for r in log) == list(range(1, 11))


def test_end_to_end_files_to_views(spark):
    """Sources written as parquet extracts, landed, then the warehouse is
    built over the raw tables: results equal the direct build."""
    direct = Warehouse.from_testdata(spark, SF_SMALL, as_of=dt.date(2001, 12, 31))
    root = tempfile.mkdtemp(prefix="extracts-", dir="/tmp")
    for logical, table in RAW_TABLES.items():
        getattr(direct.sources, logical).write.parquet(os.path.join(root, table))
    db = _db()
    res = landing.land(spark, root, db)
    assert sorted(r["table_name"] for r in res) == sorted(RAW_TABLES.values())
    assert all(r["run_mode"] == landing.INITIAL_LOAD for r in res)
    landed = Warehouse.from_tables(spark, db, as_of=dt.date(2001, 12, 31))
    for name in ("vw_exec_kpi_scorecard", "vw_capex_project_summary", "vw_employee_dept_summary"):
        a = sorted(map(tuple, direct[name].collect()))
        b = sorted(map(tuple, landed[name].collect()))
        assert a == b, name

    # materialize dims/marts (with key checks) and presentation tables
    an, pr = _db(), _db()
    written = landed.materialize(an, presentation_database=pr)
    assert f"{an}.mart_annual_performance" in written and f"{pr}.vw_exec_kpi_scorecard" in written
    a = sorted(map(tuple, direct["vw_exec_kpi_scorecard"].collect()))
    b = sorted(map(tuple, spark.table(f"{pr}.vw_exec_kpi_scorecard").collect()))
    assert a == b


def test_assert_unique_and_report(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    with pytest.raises(quality.DuplicateKeyError, match="'a' x2"):
        quality.assert_unique(df, "k", "t")
    quality.assert_unique(df.where("k <> 'a' OR k IS NULL"), "k", "t")  # NULLs never collide
    r = quality.key_stats(df, "k").first()
    assert (r["row_count"], r["null_keys"], r["distinct_keys"], r["duplicate_keys"]) == (5, 2, 2, 1)


def test_profile_counts_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    got = {r["column_name"]: (r["data_type"], r["row_count"], r["null_count"])
           for r in quality.profile(df, "t", "g").collect()}
    assert got == {"a": ("int", 3, 1), "b": ("string", 3, 2)}
    assert quality.preview(df, 2).count() == 2


def test_register_views_and_inspect(spark):
    from revmart.plans.warehouse import register_views
    w = Warehouse.from_testdata(spark, SF_SMALL, as_of=dt.date(2001, 12, 31))
    names = register_views(w, ["vw_employee_dept_summary", "mart_annual_performance"], prefix="t_")
    assert names == ["t_vw_employee_dept_summary", "t_mart_annual_performance"]
    total = spark.sql("SELECT sum(headcount) AS n FROM t_vw_employee_dept_summary").first()["n"]
    assert total == 10
    prof, previews = quality.inspect(w, group="EMPLOY", rows=3)
    assert set(previews) == {"vw_employee_dept_summary", "vw_employee_tenure_distribution",
                             "vw_employee_hiring_cohort", "vw_employee_roster"}
    assert all(p.count() <= 3 for p in previews.values())
    assert {r["relation"] for r in prof.collect()} == set(previews)
    with pytest.raises(KeyError):
        quality.inspect(w, group="nope")


def test_materialize_duplicate_key_keeps_previous_table(spark):
    """A customer id with two different segments gives two customer-mart rows
    with one key: materialize raises and the previous table stays."""
    from decimal import Decimal as D

    from revmart.sources import schema as S
    from revmart.sources.raw import Sources

    sale = ("o1", dt.date(2020, 1, 1), "A", "P1", 1, D("1.00"), D("2.00"), D("10.00"),
            D("-1.00"), D("9.00"), D("1.00"), D("8.00"))

    def wh(customers):
        return Warehouse(Sources(sales=spark.createDataFrame([sale], S.SALES),
                                 customers=spark.createDataFrame(customers, S.CUSTOMERS)), spark)
    db = _db()
    wh([("A", "SMB", "Peru", None)]).materialize(db, names=["mart_customer_sales"])
    assert spark.table(f"{db}.mart_customer_sales").count() == 1
    with pytest.raises(quality.DuplicateKeyError, match="customer_sales_key"):
        wh([("A", "SMB", "Peru", None), ("A", "RETAIL", "Peru", None)]).materialize(
            db, names=["mart_customer_sales"])
    t = spark.table(f"{db}.mart_customer_sales").collect()
    assert len(t) == 1 and t[0]["customer_segment"] == "SMB"


def test_land_json_and_parquet_files(spark):
    root = tempfile.mkdtemp(prefix="landing-fmt-", dir="/tmp")
    _write(f"{root}/Targets.jsonl", '{"Revenue Target": 10.5, "Target Date": "2020-01-01"}\n'
                                    '{"Revenue Target": null, "Target Date": "2021-01-01"}\n')
    import pandas as pd
    pd.DataFrame({"Employee ID": [1], "Tenure (Years)": ["a"]}).to_parquet(f"{root}/Staff List.parquet")
    db = _db()
    res = {r["table_name"]: r for r in landing.land(spark, root, db)}
    assert res["targets"]["run_mode"] == landing.INITIAL_LOAD and res["targets"]["row_count"] == 2
    assert sorted(spark.table(f"{db}.targets").columns) == ["revenue_target", "target_date"]
    assert spark.table(f"{db}.staff_list").columns == ["employee_id", "tenure_(years)"]


def test_land_compressed_typed_and_by_uri(spark):
    import gzip
    root = tempfile.mkdtemp(prefix="landing-gz-", dir="/tmp")
    os.makedirs(f"{root}/book")
    with gzip.open(f"{root}/book/staff.csv.gz", "wt") as f:
        f.write("employee_id,name,start_date,tenure_(years),department\n007,A,2020-01-01,1.50,X\n")
    os.makedirs(f"{root}/mixed/sheet")
    _write(f"{root}/mixed/sheet/a.csv", "a\n1\n")
    _write(f"{root}/mixed/sheet/b.json", "{}\n")
    from revmart.sources.schema import SCHEMAS
    db = _db()
    res = {r["table_name"]: r for r in landing.land(spark, f"file://{root}", db, schemas=SCHEMAS, tables={"employees": "book_staff"})}
    assert res["book_staff"]["row_count"] == 1 and res["mixed_sheet"]["run_mode"] == landing.SKIPPED_UNSUPPORTED
    row = spark.table(f"{db}.book_staff").first()
    assert row["employee_id"] == "007" and row["start_date"] == dt.date(2020, 1, 1)
    log = {r["table_name"]: r["run_mode"] for r in spark.table(f"{db}.{landing.AUDIT_TABLE}").collect()}
    assert log == {"book_staff": landing.INITIAL_LOAD, "mixed_sheet": landing.SKIPPED_UNSUPPORTED}


def test_two_inputs_for_one_table_fail_before_any_write(spark):
    root = tempfile.mkdtemp(prefix="landing-clash-", dir="/tmp")
    _write(f"{root}/dup.csv", "a\n1\n")
    _write(f"{root}/dup.json", '{"a": 2}\n')
    db = _db()
    with pytest.raises(landing.TableNameClashError, match="dup"):
        landing.land(spark, root, db)
    assert not spark.catalog.tableExists(f"{db}.dup")


def test_loads_at_once_get_ids_of_their_own(spark):
    """Four loads at the same time: distinct ids without a gap, every line there."""
    import threading
    root = tempfile.mkdtemp(prefix="landing-once-", dir="/tmp")
    db, sizes, failed = _db(), (1, 3, 2, 2), []
    for k, n in enumerate(sizes):
        for j in range(n):
            _write(f"{root}/{k}/s{k}_{j}.csv", "a\n1\n")

    def load(k):
        try:
            landing.land(spark, f"{root}/{k}", db)
        except Exception as e:
            failed.append(e)
    threads = [threading.Thread(target=load, args=(k,)) for k in range(len(sizes))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed, failed[0]
    log = spark.table(f"{db}.{landing.AUDIT_TABLE}").collect()
    assert sorted(r["id"] for r in log) == list(range(1, sum(sizes) + 1))
    assert {r["table_name"] for r in log} == {f"s{k}_{j}" for k, n in enumerate(sizes) for j in range(n)}
    for k, n in enumerate(sizes):
        own = sorted(r["id"] for r in log if r["table_name"].startswith(f"s{k}_"))
        assert own == list(range(own[0], own[0] + n))


def test_a_claim_without_a_size_does_not_block(spark, monkeypatch):
    monkeypatch.setattr(landing, "CLAIM_SECONDS", 0.2)
    db = _db()
    landing.ensure_audit_table(spark, db)
    assert landing.reserve_ids(spark, db, 4) == 1 and landing.reserve_ids(spark, db, 1) == 5
    folder = landing.log_folder(spark, db).removeprefix("file:")
    open(f"{folder}/{landing.CLAIMS}/{6:018d}", "w").close()      # its maker died here
    assert landing.reserve_ids(spark, db, 2) == 7


def test_build_from_a_book_of_sheets(spark):
    direct = Warehouse.from_testdata(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="book-", dir="/tmp")
    os.makedirs(f"{root}/book")
    tables = {}
    for logical in RAW_TABLES:
        getattr(direct.sources, logical).coalesce(1).write.parquet(f"{root}/book/{logical}")
        tables[logical] = f"book_{logical}"
    db = _db()
    assert {r["table_name"] for r in landing.land(spark, root, db)} == set(tables.values())
    w = Warehouse.from_tables(spark, db, tables=tables)
    assert w["vw_exec_kpi_scorecard"].count() == 7
