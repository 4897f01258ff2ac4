"""Operations of a large-scale training-data pipeline, one module per operator.

Each module holds the operator with its general interface, the thin
``opN_<name>`` query over the shared tables and, where SQL can express the
result, the DuckDB statement that checks it. :func:`queries` and
:func:`oracle_sql` gather them.
"""

from __future__ import annotations

import importlib
import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value: executors need not have
# this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MODULES = (
    "exact_dedup",
    "byte_bpe",
    "chat_format",
    "decontaminate",
    "line_dedup",
    "token_files",
    "toxicity",
    "lm_score",
    "near_dedup",
    "html_extract",
    "secret_scan",
    "token_align",
    "whitening",
)


def _modules():
    return [importlib.import_module(f"{__name__}.{m}") for m in MODULES]


def queries() -> dict:
    """``opN_<name>`` -> callable(spark, sf_dir) returning the whole result."""
    return {m.QUERY_NAME: m.query for m in _modules()}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return {m.QUERY_NAME: m.ORACLE_SQL for m in _modules() if m.ORACLE_SQL}
