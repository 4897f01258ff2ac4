"""Every registered query agrees with its DuckDB oracle at sf0.001
(row count, names + types, order-insensitive value hash)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from tools import oracle
from revmart.plans.warehouse import Warehouse
from tests.conftest import SF_SMALL
from tools.check_oracle import compare

QUERIES = E.queries()
SQL = E.oracle_sql()


def test_every_query_has_an_oracle():
    own = {n for n in QUERIES if n != "pipeline" and not n.startswith("op")}
    assert own <= set(SQL) <= set(QUERIES)
    assert len(own) >= 36


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck_small, name):
    r = compare(spark, duck_small, name, QUERIES[name], SQL[name], SF_SMALL, verbose=True)
    assert r["rows"][0] == r["rows"][1], r
    assert r["schema_ok"], r
    assert r["values_ok"], r


def test_dim_date_matches_oracle(spark, duck_small):
    """dim_date is built from constants only, so it is not a registered
    query; it is checked here against the oracle's calendar."""
    w = Warehouse.from_testdata(spark, SF_SMALL)
    r = compare(spark, duck_small, "dim_date", lambda s, d: w["dim_date"],
                oracle.relation_sql("dim_date"), SF_SMALL, verbose=True)
    assert r["rows"] == (7670, 7670) and r["schema_ok"] and r["values_ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 7
    assert df.columns[0] == "performance_year"
