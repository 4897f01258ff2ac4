"""String and calendar helpers with the reference's formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID_LENGTH = 50  # ids are VARCHAR(50); an explicit cast truncates silently


def varchar(c: Column, length: int = ID_LENGTH) -> Column:
    """``x::VARCHAR(n)``: string, cut to ``n`` characters."""
    return F.substring(c.cast(T.StringType()), 1, length)


def month_name_padded(d: Column) -> Column:
    """Full month name blank-padded to 9 characters (``TO_CHAR(d,'Month')``)."""
    return F.rpad(F.date_format(d, "MMMM"), 9, " ")


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def month_abbr(d: Column) -> Column:
    return F.date_format(d, "MMM")


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def year_month_label(year: Column, month: Column) -> Column:
    """``CONCAT(year, '-', LPAD(month, 2, '0'))`` (null-skipping concat)."""
    return F.concat_ws("", year.cast("string"), F.lit("-"),
                       F.lpad(month.cast("string"), 2, "0"))
