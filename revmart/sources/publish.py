"""Versioned publishing: a table's name is a view on one of its versions.

Every load writes a table of its own, ``<table>__v<time>_<id>``, and then moves
the name ``<table>`` to it by one change in the catalog (``ALTER VIEW``). So a
reader finds the old rows or the new ones at every moment, and a run that is
killed has either moved the name or not; what it leaves behind is a version
that nobody reads. A changed schema moves with the name.

The version before stays, for readers that have already resolved it; older
versions go once they are older than ``GRACE_SECONDS``, so that neither a long
read nor another load that is still writing loses its files.

While a version is written, ``DataFrame.observe`` counts its rows and the
values of every column: validation and profiles of what was written need no
scan of their own. The counts are taken in the tasks that write, whose results
Spark counts once however often a task is repeated.
"""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INITIAL_LOAD = "initial_load"
FULL_REFRESH = "full_refresh"
GRACE_SECONDS = 24 * 3600
_MARK = "__v"


@dataclass(frozen=True)
class Version:
    """A written version: its full name, schema, rows, and values a column."""
    name: str
    schema: T.StructType
    row_count: int
    values: tuple[int, ...]

    def null_counts(self) -> list[tuple[str, str, int]]:
        """(column, type, nulls) in column order."""
        return [(f.name, f.dataType.simpleString(), self.row_count - v) for f, v in zip(self.schema, self.values)]


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df``, and the counts (``n``, ``c0``, ``c1`` ...) that its next action takes."""
    counts = Observation(uuid.uuid4().hex)
    values = [F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]
    return df.observe(counts, F.count(F.lit(1)).alias("n"), *values), counts


def stage(spark: SparkSession, df: DataFrame, database: str, table: str) -> Version:
    """Write the next version of a table, beside the one that is read."""
    name = f"{database}.{table}{_MARK}{time.time_ns() // 1_000_000:013d}_{uuid.uuid4().hex[:8]}"
    counted, counts = observed(df)
    counted.write.format("parquet").saveAsTable(name)
    got = counts.get
    return Version(name, df.schema, got["n"], tuple(got[f"c{i}"] for i in range(len(df.columns))))


def discard(spark: SparkSession, version: Version) -> None:
    """Drop a version that is not to be read."""
    spark.sql(f"DROP TABLE IF EXISTS {version.name}")


def current(spark: SparkSession, database: str, table: str) -> str | None:
    """Full name of the version that is read, if any."""
    full = f"{database}.{table}"
    if not spark.catalog.tableExists(full) or spark.catalog.getTable(full).tableType != "VIEW":
        return None
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {full}").where("col_name = 'View Text'").first()
    return text["data_type"].split()[-1] if text else None


def versions(spark: SparkSession, database: str, table: str) -> list[str]:
    """All versions of a table, oldest first."""
    found = spark.sql(f"SHOW TABLES IN {database} LIKE '{table}{_MARK}*'").collect()
    own = re.compile(re.escape(table + _MARK) + r"\d{13}_[0-9a-f]{8}")
    return sorted(f"{database}.{r['tableName']}" for r in found if own.fullmatch(r["tableName"]))


def publish(spark: SparkSession, version: Version, database: str, table: str, grace_seconds: float = GRACE_SECONDS) -> str:
    """Move the table's name to ``version``. Returns the run mode."""
    full, rows = f"{database}.{table}", f"SELECT * FROM {version.name}"
    before = current(spark, database, table)
    if before is None and spark.catalog.tableExists(full):
        # A plain table of that name becomes the oldest version; only this
        # one change of layout has a moment without the name.
        before = f"{full}{_MARK}{0:013d}_{uuid.uuid4().hex[:8]}"
        spark.sql(f"ALTER TABLE {full} RENAME TO {before}")
    if before is None or not spark.catalog.tableExists(full):
        try:
            spark.sql(f"CREATE VIEW {full} AS {rows}")
        except AnalysisException as e:
            if "ALREADY_EXISTS" not in (e.getCondition() or ""):
                raise
            spark.sql(f"ALTER VIEW {full} AS {rows}")  # another load was first
    else:
        spark.sql(f"ALTER VIEW {full} AS {rows}")
    if before is not None:
        clean(spark, database, table, {before, version.name}, grace_seconds)
    return INITIAL_LOAD if before is None else FULL_REFRESH


def clean(spark: SparkSession, database: str, table: str, keep: set[str], grace_seconds: float) -> None:
    """Drop the versions that are old enough, but for ``keep`` and the one read."""
    limit = time.time_ns() // 1_000_000 - int(grace_seconds * 1000)
    keep = keep | {current(spark, database, table)}
    for name in versions(spark, database, table):
        if name not in keep and int(name.rpartition(_MARK)[2].split("_")[0]) <= limit:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
