"""Column-expression helpers (built-in Catalyst expressions only)."""

from revmart.functions.keys import uuid5
from revmart.functions.numeric import (
    BAND, INDEX3, MONEY, MONEY_DIFF, MONEY_TOTAL, PCT, PCT1, PV_DIGITS, RATE, RATIO_UNIT_DIGITS,
    TENURE, UNIT_PRICE, UNIT_PRICE4, growth_pct, mean_ratio_pct, pct, pg_int, pv_round, pv_units,
    ratio, ratio_units, round_div_int, scaled,
)
from revmart.functions.text import (
    month_abbr, month_name, month_name_padded, month_start, varchar,
    year_month_label,
)

__all__ = [
    "uuid5", "BAND", "INDEX3", "MONEY", "MONEY_DIFF", "MONEY_TOTAL", "PCT", "PCT1", "RATE",
    "TENURE", "UNIT_PRICE", "UNIT_PRICE4", "growth_pct", "mean_ratio_pct", "pct", "ratio_units",
    "PV_DIGITS", "RATIO_UNIT_DIGITS", "pv_round", "pv_units", "pg_int", "ratio", "round_div_int", "scaled",
    "month_abbr", "month_name", "month_name_padded", "month_start", "varchar",
    "year_month_label",
]
