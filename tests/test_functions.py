"""Expression helpers: exact rounding, uuid5, text and cast rules."""

from __future__ import annotations

import datetime as dt
import random
import uuid
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.functions import (
    PCT, month_name_padded, pct, pg_int, ratio, round_div_int, uuid5, varchar,
    year_month_label,
)


def _expected(n: Decimal, d: Decimal, scale: int, mult: int = 1):
    """ROUND(n / d * mult, scale), half away from zero, in exact rationals."""
    if n is None or d is None or d == 0:
        return None
    exact = Fraction(n) * mult / Fraction(d)
    step = Fraction(1, 10 ** scale)
    units = exact / step
    sign = -1 if units < 0 else 1
    au = abs(units)
    r = int(au) + (1 if au - int(au) >= Fraction(1, 2) else 0)
    return Decimal(sign * r).scaleb(-scale)


def test_ratio_matches_exact_half_away_rounding(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(400):
        n = Decimal(rnd.randint(-10**9, 10**9)).scaleb(-2)
        d = Decimal(rnd.choice([rnd.randint(-10**7, 10**7), rnd.randint(1, 100), 0])).scaleb(-2)
        rows.append((n, d))
    # constructed ties: n/d*100 ends exactly in 5 at the third decimal
    rows += [(Decimal("1.00"), Decimal("800.00")), (Decimal("-1.00"), Decimal("800.00")),
             (Decimal("0.01"), Decimal("0.08")), (None, Decimal("1.00")), (Decimal("1.00"), None)]
    schema = T.StructType([T.StructField("n", T.DecimalType(15, 2)), T.StructField("d", T.DecimalType(15, 2))])
    df = spark.createDataFrame(rows, schema)
    out = df.select("n", "d",
                    pct(F.col("n"), F.col("d"), T.DecimalType(20, 2)).alias("p"),
                    ratio(F.col("n"), F.col("d"), 4, T.DecimalType(24, 4)).alias("r4"),
                    ratio(F.col("n"), F.col("d"), 0, T.DecimalType(24, 0)).alias("r0")).collect()
    for r in out:
        assert r["p"] == _expected(r["n"], r["d"], 2, 100), (r["n"], r["d"], r["p"])
        assert r["r4"] == _expected(r["n"], r["d"], 4), (r["n"], r["d"], r["r4"])
        assert r["r0"] == _expected(r["n"], r["d"], 0), (r["n"], r["d"], r["r0"])


def test_ratio_tie_rounds_away_from_zero(spark):
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("800.00"))],
                               "n decimal(15,2), d decimal(15,2)")
    r = df.select(pct(F.col("n"), F.col("d")).alias("p"),
                  pct(-F.col("n"), F.col("d")).alias("m")).first()
    assert r["p"] == Decimal("0.13") and r["m"] == Decimal("-0.13")
    assert df.select(pct(F.col("n"), F.col("d"))).schema[0].dataType == PCT


def test_round_div_int_integers(spark):
    df = spark.createDataFrame([(7, 2), (-7, 2), (5, 3), (0, 5), (3, 0)], "a long, b long")
    got = [r[0] for r in df.select(round_div_int(F.col("a"), F.col("b"))).collect()]
    assert [None if g is None else int(g) for g in got] == [4, -4, 2, 0, None]


def test_uuid5_matches_python(spark):
    names = ["1", "42", "Brand#13", "2015", "2015-07", "Brand#21_1996-01-01", "", "Zürich ünïcode", "日本"]
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "n string")
    got = [r[0] for r in df.select(uuid5(F.col("n"))).collect()]
    want = [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names] + [None]
    assert got == want


def test_month_name_padding_and_labels(spark):
    df = spark.createDataFrame([(dt.date(2020, 5, 17), 2020, 5), (dt.date(2020, 9, 1), None, 9)],
                               "d date, y int, m int")
    r = df.select(month_name_padded(F.col("d")).alias("p"),
                  year_month_label(F.col("y"), F.col("m")).alias("l")).collect()
    assert r[0]["p"] == "May      " and len(r[1]["p"]) == 9 and r[1]["p"] == "September"
    assert r[0]["l"] == "2020-05" and r[1]["l"] == "-09"  # concat skips NULL


def test_varchar_truncates_and_pg_int_rounds(spark):
    df = spark.createDataFrame([("x" * 60, 2.5, Decimal("2.50")), ("ab", -1.5, Decimal("-1.50"))],
                               "s string, f double, d decimal(5,2)")
    r = df.select(varchar(F.col("s")).alias("v"),
                  pg_int(F.col("f"), T.DoubleType()).alias("fi"),
                  pg_int(F.col("d"), T.DecimalType(5, 2)).alias("di")).collect()
    assert len(r[0]["v"]) == 50 and r[1]["v"] == "ab"
    # float8 -> int rounds half to even; numeric -> int rounds half away from zero
    assert (r[0]["fi"], r[1]["fi"]) == (2, -2)
    assert (r[0]["di"], r[1]["di"]) == (3, -2)
