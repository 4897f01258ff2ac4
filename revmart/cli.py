"""Command-line jobs (run with ``spark-submit`` or ``python -m revmart.cli``).

    land     --source DIR [--raw-db raw]                       extracts -> raw tables + audit log
    build    [--raw-db raw] [--analytics-db analytics]
             [--staging-db staging] [--presentation-db presentation]
             [--table SOURCE=TABLE] [--as-of DATE]             dims/marts (+ key checks), views
    inspect  [--group NAME | --relation NAME] [--rows 5]       row counts, columns, previews
    all      --source DIR ...                                  land, build, inspect in order

``build`` exits non-zero when a unique key is duplicated; ``land`` confines
errors to the failing sheet and exits non-zero if one of the five sources
failed, which stops ``all``. Previews print at most ``--rows`` rows per
relation; everything else runs as distributed jobs.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import logging
import sys

from pyspark.sql import functions as F

from revmart.operators.quality import DuplicateKeyError, preview, profile
from revmart.plans.warehouse import DIMS_MARTS, PROFILE_TABLE, RELATIONS, STAGING, Warehouse, group_of
from revmart.sources import landing
from revmart.sources.schema import RAW_TABLES, SCHEMAS

log = logging.getLogger("revmart.cli")


def _session(args):
    from pyspark.sql import SparkSession
    if args.master:
        from revmart.session import build_session
        return build_session(args.master, args.shuffle_partitions)
    return SparkSession.builder.getOrCreate()


def _tables(args) -> dict[str, str]:
    """``--table source=raw_table`` pairs."""
    out = {}
    for pair in args.table or []:
        source, eq, name = pair.partition("=")
        if not eq or source not in RAW_TABLES:
            raise SystemExit(f"--table wants SOURCE=TABLE with a source of {', '.join(RAW_TABLES)}; got {pair!r}")
        out[source] = name
    return out


def cmd_land(spark, args) -> int:
    tables = _tables(args)
    res = landing.land(spark, args.source, args.raw_db, schemas=SCHEMAS if args.typed else None, tables=tables)
    for r in res:
        print(f"{args.raw_db}.{r['table_name']:40s} rows={r['row_count']} [{r['run_mode']}]")
    needed = set(dict(RAW_TABLES, **tables).values())
    failed = sorted(r["table_name"] for r in res if r["run_mode"] == landing.FAILED and r["table_name"] in needed)
    if failed:
        log.error("sources that failed: %s", ", ".join(failed))
    return 1 if failed else 0


def _warehouse(spark, args) -> Warehouse:
    as_of = _dt.date.fromisoformat(args.as_of) if args.as_of else None
    return Warehouse.from_tables(spark, args.raw_db, as_of=as_of, tables=_tables(args))


def cmd_build(spark, args) -> int:
    w = _warehouse(spark, args)
    try:
        written = w.materialize(args.analytics_db)
    except DuplicateKeyError as e:
        log.error("%s", e)
        return 1
    written += w.publish_views(args.staging_db, args.presentation_db)
    for t in written:
        print(f"built {t}")
    return 0


def _relations_for(args) -> list[str]:
    if args.relation:
        return [args.relation]
    if args.group:
        return [n for n in RELATIONS if args.group.lower() in group_of(n).lower()]
    return list(RELATIONS)


def cmd_inspect(spark, args) -> int:
    w = _warehouse(spark, args)
    # read materialized tables where they exist instead of recomputing
    for n, (g, _) in RELATIONS.items():
        db = None if g == STAGING else (args.analytics_db if g == DIMS_MARTS else args.presentation_db)
        if db and spark.catalog.tableExists(f"{db}.{n}"):
            w.use_table(n, f"{db}.{n}")
    names = _relations_for(args)
    kept = f"{args.analytics_db}.{PROFILE_TABLE}"
    stored = spark.table(kept) if spark.catalog.tableExists(kept) else None
    written = {r["relation"] for r in stored.select("relation").distinct().collect()} if stored else set()
    if not names:
        print(f"no relation matches {args.group or args.relation!r}")
        return 1
    for n in names:
        try:
            # what was written has been counted by that write
            counts = stored.where(F.col("relation") == n) if n in written else profile(w.relation(n), n, group_of(n))
            columns = counts.select("column_name", "data_type", "null_count", "row_count")
            print(f"\n== {n} ({group_of(n)})")
            columns.show(1000, truncate=False)
            preview(w.relation(n), args.rows).show(truncate=False)
        except Exception as e:  # the other relations still print
            print(f"!! {n}: {e}")
    return 0


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="revmart")
    ap.add_argument("--master", help="e.g. local[8]; default: the submitted session")
    ap.add_argument("--shuffle-partitions", type=int, default=200)
    sub = ap.add_subparsers(dest="cmd", required=True)

    def common(p):
        p.add_argument("--raw-db", default="raw")
        p.add_argument("--analytics-db", default="analytics")
        p.add_argument("--staging-db", default="staging")
        p.add_argument("--presentation-db", default="presentation")
        p.add_argument("--table", action="append", metavar="SOURCE=TABLE", help="raw table of a source, e.g. sales=book_sheet")
        p.add_argument("--as-of", help="RFM reference date (YYYY-MM-DD); default today")

    p = sub.add_parser("land")
    p.add_argument("--source", required=True)
    p.add_argument("--raw-db", default="raw")
    p.add_argument("--table", action="append", metavar="SOURCE=TABLE", help="table that a source's input becomes")
    p.add_argument("--typed", action="store_true", help="read the five sources by their declared types")
    p = sub.add_parser("build")
    common(p)
    p = sub.add_parser("inspect")
    common(p)
    g = p.add_mutually_exclusive_group()
    g.add_argument("--group")
    g.add_argument("--relation")
    p.add_argument("--rows", type=int, default=5)
    p = sub.add_parser("all")
    p.add_argument("--source", required=True)
    p.add_argument("--typed", action="store_true")
    common(p)
    p.add_argument("--rows", type=int, default=5)
    args = ap.parse_args(argv)
    if args.cmd == "all":
        args.group = args.relation = None

    logging.basicConfig(level=logging.INFO, format="%(asctime)s [%(levelname)s] %(message)s")
    spark = _session(args)
    if args.cmd == "land":
        return cmd_land(spark, args)
    if args.cmd == "build":
        return cmd_build(spark, args)
    if args.cmd == "inspect":
        return cmd_inspect(spark, args)
    rc = cmd_land(spark, args)
    rc = rc or cmd_build(spark, args)
    return rc or cmd_inspect(spark, args)


if __name__ == "__main__":
    sys.exit(main())
