"""The three jobs (land, build, inspect) end to end through the CLI."""

from __future__ import annotations

import datetime as dt
import os
import tempfile
import uuid

from revmart import cli
from revmart.plans.warehouse import Warehouse
from revmart.sources.schema import RAW_TABLES
from tests.conftest import SF_SMALL


def test_cli_land_build_inspect(spark, capsys):
    src = Warehouse.from_testdata(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="cli-", dir="/tmp")
    for logical, table in RAW_TABLES.items():
        getattr(src.sources, logical).write.parquet(os.path.join(root, table))
    tag = uuid.uuid4().hex[:6]
    dbs = ["--raw-db", f"r_{tag}", "--analytics-db", f"a_{tag}", "--staging-db", f"s_{tag}", "--presentation-db", f"p_{tag}"]
    assert cli.main(["all", "--source", root, *dbs, "--as-of", "2001-12-31"]) == 0
    out = capsys.readouterr().out
    assert f"built a_{tag}.mart_annual_performance" in out
    assert f"built p_{tag}.vw_capex_sensitivity" in out
    assert "== vw_employee_roster (employee)" in out and "tenure_years" in out and "decimal(5,2)" in out
    assert cli.main(["inspect", *dbs, "--group", "capex", "--rows", "2"]) == 0
    out = capsys.readouterr().out
    assert out.count("== ") == 3 and "vw_capex_project_summary" in out
    want = sorted(map(tuple, Warehouse.from_testdata(spark, SF_SMALL, as_of=dt.date(2001, 12, 31))
                      ["vw_customer_rfm"].collect()))
    got = sorted(map(tuple, spark.table(f"p_{tag}.vw_customer_rfm").collect()))
    assert got == want
    assert spark.table(f"s_{tag}.stg_employees").count() == 10
