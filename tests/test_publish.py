"""Versioned publishing: a name always shows old rows or new ones."""

from __future__ import annotations

import threading
import uuid

import pytest

from revmart.sources import publish as P
from revmart.sources.landing import load_table


@pytest.fixture
def db(spark):
    name = "v_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {name}")
    return name


def test_counts_are_taken_by_the_write(spark, db):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "`a b` int, `tenure_(years)` string, c string")
    v = P.stage(spark, df, db, "t")
    assert v.row_count == 2 and v.null_counts() == [("a b", "int", 0), ("tenure_(years)", "string", 2), ("c", "string", 1)]
    empty = P.stage(spark, df.where("c = 'y'"), db, "t")
    assert empty.row_count == 0 and [n for *_, n in empty.null_counts()] == [0, 0, 0]


def test_a_killed_run_leaves_the_old_rows(spark, db):
    assert load_table(spark, spark.range(1), db, "t") == P.INITIAL_LOAD
    P.stage(spark, spark.range(2), db, "t")                 # written, never published
    assert spark.table(f"{db}.t").count() == 1
    assert load_table(spark, spark.range(3), db, "t") == P.FULL_REFRESH
    assert spark.table(f"{db}.t").count() == 3


def test_a_changed_schema_moves_with_the_name(spark, db):
    load_table(spark, spark.range(2), db, "t")
    spark.sql(f"CREATE VIEW {db}.u AS SELECT id FROM {db}.t")
    load_table(spark, spark.range(5).selectExpr("id", "id + 1 AS k", "'x' AS `odd (name)`"), db, "t")
    assert spark.table(f"{db}.t").columns == ["id", "k", "odd (name)"] and spark.table(f"{db}.u").count() == 5


def test_a_plain_table_becomes_a_version(spark, db):
    spark.range(4).write.saveAsTable(f"{db}.t")
    assert P.current(spark, db, "t") is None
    assert load_table(spark, spark.range(7), db, "t") == P.FULL_REFRESH
    assert spark.table(f"{db}.t").count() == 7 and len(P.versions(spark, db, "t")) == 2


def test_old_versions_go_and_the_one_before_stays(spark, db):
    for n in range(1, 5):
        P.publish(spark, P.stage(spark, spark.range(n), db, "t"), db, "t", grace_seconds=0)
    load_table(spark, spark.range(9), db, "t2")             # a name that starts alike
    kept = P.versions(spark, db, "t")
    assert [spark.table(v).count() for v in kept] == [3, 4] and kept[-1] == P.current(spark, db, "t")
    for n in range(5, 8):                                    # within the grace nothing goes
        load_table(spark, spark.range(n), db, "t")
    assert len(P.versions(spark, db, "t")) == 5
    assert spark.table(f"{db}.t2").count() == 9


def test_a_reader_in_a_loop_never_misses_the_table(spark, db):
    """Every read while the name moves sees one whole version."""
    load_table(spark, spark.range(1), db, "t")
    seen, failed, done = set(), [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.add(tuple(spark.table(f"{db}.t").selectExpr("count(*) AS n", "coalesce(max(id), -1) AS m").first()))
            except Exception as e:                            # what the test is about
                failed.append(e)
    readers = [threading.Thread(target=read) for _ in range(2)]
    for r in readers:
        r.start()
    for n in range(2, 9):
        load_table(spark, spark.range(n), db, "t")
    done.set()
    for r in readers:
        r.join()
    assert not failed, failed[0]
    assert seen and all(m == n - 1 for n, m in seen)


def test_two_loads_at_once(spark, db):
    sizes = list(range(1, 7))
    threads = [threading.Thread(target=load_table, args=(spark, spark.range(n), db, "t")) for n in sizes]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert spark.table(f"{db}.t").count() in sizes and len(P.versions(spark, db, "t")) == len(sizes)
