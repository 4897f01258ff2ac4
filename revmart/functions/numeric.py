"""Decimal-exact arithmetic for money, ratios and averages.

Spark narrows the scale of a decimal quotient as its operands widen and
computes ``avg`` at a fixed scale, so ``round(sum(a) / sum(b) * 100, 2)``
can round twice. The helpers here compute a quotient rounded half away from
zero (the rounding of a numeric ROUND) directly as an integer with an exact
floor division, then rescale it by an exact multiplication. Everything is a
built-in Catalyst expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared output types of the warehouse (fixed values of the data model).
MONEY = T.DecimalType(15, 2)          # money on one sales row
# Money that is a sum: totals of the sales fact, yearly targets, project cash
# flows. Wider than a row's NUMERIC(15,2): such sums pass 1e13 long before
# 100 TB of sales, and a narrower type would abort the job (ANSI).
MONEY_TOTAL = T.DecimalType(38, 2)
MONEY_DIFF = T.DecimalType(16, 2)     # revenue - cogs on one row
UNIT_PRICE = T.DecimalType(12, 2)     # per-unit prices
UNIT_PRICE4 = T.DecimalType(12, 4)    # per-unit averages at 4 decimals
BAND = T.DecimalType(10, 4)           # customer discount/premium band
RATE = T.DecimalType(5, 4)            # discount rate of a project
PCT = T.DecimalType(7, 2)             # percentages, stored x100
PCT1 = T.DecimalType(5, 1)            # head-count percentages
TENURE = T.DecimalType(5, 2)          # tenure in years
INDEX3 = T.DecimalType(8, 3)          # profitability index


def _lit_dec(value: int) -> Column:
    """An integer literal typed as the narrowest decimal that holds it."""
    return F.lit(Decimal(int(value)))


def floor_div(a: Column, b: Column) -> Column:
    """Exact ``floor(a / b)`` for non-negative decimals, as decimal(38, 0).

    ``a - pmod(a, b)`` is a multiple of ``b``, so the quotient is an integer
    that Spark's decimal division represents without rounding.
    """
    return ((a - F.pmod(a, b)) / b).cast(T.DecimalType(38, 0))


def round_div_int(num: Column, den: Column, factor: int = 1) -> Column:
    """``round(num * factor / den)`` to an integer, ties away from zero.

    Null when ``den`` is null or zero (the NULLIF guard of the reference),
    or when ``num`` is null. Both operands may be integers or decimals.
    """
    d = F.nullif(den, F.lit(0))
    ad = F.abs(d).cast(T.DecimalType(38, 4))
    an = F.abs(num).cast(T.DecimalType(38, 4))
    q = floor_div(an * _lit_dec(2 * factor) + ad, ad * _lit_dec(2))
    negative = (num < 0) != (d < 0)
    return F.when(negative, -q).otherwise(q)


def scaled(q: Column, scale: int, dtype: T.DecimalType) -> Column:
    """Integer ``q`` times ``10**-scale`` as ``dtype`` (exact)."""
    if scale == 0:
        return q.cast(dtype)
    step = F.lit(Decimal(1).scaleb(-scale))
    return (q.cast(T.DecimalType(30, 0)) * step).cast(dtype)


def ratio(num: Column, den: Column, scale: int, dtype: T.DecimalType,
          mult: int = 1) -> Column:
    """``ROUND(num / NULLIF(den, 0) * mult, scale)`` cast to ``dtype``."""
    return scaled(round_div_int(num, den, mult * 10 ** scale), scale, dtype)


def pct(num: Column, den: Column, dtype: T.DecimalType = PCT,
        scale: int = 2) -> Column:
    """Percentage ``ROUND(num / NULLIF(den, 0) * 100, scale)``."""
    return ratio(num, den, scale, dtype, mult=100)


def growth_pct(cur: Column, prev: Column) -> Column:
    """``ROUND((cur - prev) / NULLIF(prev, 0) * 100, 2)`` as decimal(7,2)."""
    return pct(cur - prev, prev)


def pg_int(c: Column, source_type: T.DataType) -> Column:
    """``::INT`` as a numeric cast would do it: round, do not truncate."""
    if isinstance(source_type, (T.DoubleType, T.FloatType)):
        return F.rint(c).cast(T.IntegerType())
    if isinstance(source_type, T.DecimalType):
        return F.round(c, 0).cast(T.IntegerType())
    return c.cast(T.IntegerType())


# Per-row ratios that are averaged are kept as integers in units of 1e-15
# (exact rounding, half away from zero), summed exactly, and the mean is
# rounded once at the end.
RATIO_UNIT_DIGITS = 15


def ratio_units(num: Column, den: Column) -> Column:
    """Per-row ``num / NULLIF(den, 0)`` as an integer count of 1e-15 units."""
    return round_div_int(num, den, 10 ** RATIO_UNIT_DIGITS)


def mean_ratio_pct(sum_units: Column, count: Column) -> Column:
    """``ROUND(AVG(ratio) * 100, 2)`` from the exact sum of ratio units."""
    den = count.cast(T.DecimalType(20, 0)) * F.lit(10 ** (RATIO_UNIT_DIGITS - 4)).cast(T.DecimalType(20, 0))
    return scaled(round_div_int(sum_units, den, 1), 2, PCT)


# Present values are kept as integers of 10**-PV_DIGITS cents, rounded at every
# period, so they are off by less than one such unit a period (for rates of 0
# and more): the cents are those of the exact quotient, and sums don't depend
# on the order of their terms. Flows up to 1e17 fit.
PV_DIGITS = 12
_UNITS = T.DecimalType(38, 0)


def pv_units(cashflow: Column, rate: Column, period: Column) -> Column:
    """``cashflow / (1 + rate) ** period`` in units of 10**-PV_DIGITS cents:
    the flow is divided by the exact ``1 + rate`` once per period. Null for a
    rate of -1."""
    growth = F.nullif(((F.lit(1) + rate) * F.lit(10_000)).cast(T.DecimalType(10, 0)), F.lit(0))
    start = (F.abs(cashflow).cast(T.DecimalType(38, 2)) * _lit_dec(10 ** (PV_DIGITS + 2))).cast(_UNITS)

    def step(v: Column, m: Column) -> Column:
        return floor_div(v * _lit_dec(20_000) + m, m * _lit_dec(2)).cast(_UNITS)
    value = F.aggregate(F.array_repeat(growth, period.cast("int")), start, step)
    return F.when(cashflow < 0, -value).otherwise(value)


def pv_round(units: Column, dtype: T.DecimalType) -> Column:
    """Units of :func:`pv_units` rounded to cents, ties away from zero."""
    return scaled(round_div_int(units, F.lit(Decimal(10 ** PV_DIGITS))), 2, dtype)
