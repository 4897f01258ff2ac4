"""Landing (L1-L5): tabular extracts -> raw tables, with validation and an
ingestion audit log.

Layout of a landing folder (the re-aimed form of "one workbook, several
sheets"): a file ``<root>/<name>.<ext>`` is one table named ``clean(name)``;
a folder ``<root>/<book>/`` holds one file or dataset folder per sheet,
each landed as ``clean(<book>_<sheet>)``. Formats: csv (header row), parquet,
json / jsonl, csv and json also with ``.gz`` or ``.bz2``. The folder may be any
path that Spark reads. Entries are processed in sorted order; a failure is
confined to its sheet: it is logged and the rest continues.

Per sheet:
  1. read with Spark (distributed scan; csv types inferred like the
     reference's reader, or an explicit schema when given),
  2. clean the column names (Python on the names only, rows stay in Spark);
     two columns that clean to the same name are an error,
  3. write the sheet once, as the next version of its table (the only pass
     over the extract besides csv type inference),
  4. validate from what was counted while it was written (rows, values per
     column), without reading anything again: an empty sheet is skipped (the
     version is dropped, what was landed before stays), all-null columns only
     warn,
  5. full refresh: move the table's name to the new version in one step, so
     that readers always find the old rows or the new (see ``publish``),
  6. after the last sheet, append one audit row per input (file, sheet,
     table, row count from step 4, run mode, timestamp) to
     ``<database>.ingestion_log`` in one write.
"""

from __future__ import annotations

import logging
import time
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.sources.publish import FULL_REFRESH, INITIAL_LOAD, Version, discard, publish, stage  # noqa: F401
from revmart.sources.schema import RAW_TABLES

log = logging.getLogger("revmart.landing")

AUDIT_TABLE = "ingestion_log"
AUDIT_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("sheet_name", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("run_mode", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
])

SKIPPED_EMPTY = "skipped_empty"
FAILED = "failed"
SKIPPED_UNSUPPORTED = "skipped_unsupported"

COMPRESSIONS = (".gz", ".bz2")
FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json", ".jsonl": "json"}

# Characters replaced by '_' in names; characters removed.
_TO_UNDERSCORE = (" ", "-", ".", "/")
_REMOVED = ("$",)


def clean_name(name: str) -> str:
    """strip, lower-case, ``' ' - . /`` -> ``_``, drop ``$``. Parentheses stay."""
    s = str(name).strip().lower()
    for ch in _TO_UNDERSCORE:
        s = s.replace(ch, "_")
    for ch in _REMOVED:
        s = s.replace(ch, "")
    return s


class ColumnCollisionError(ValueError):
    pass


def sanitize_columns(df: DataFrame) -> DataFrame:
    names = [clean_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for raw, new in zip(df.columns, names):
        if new in seen:
            raise ColumnCollisionError(
                f"columns {seen[new]!r} and {raw!r} both clean to {new!r}")
        seen[new] = raw
    return df.toDF(*names)


@dataclass(frozen=True)
class Validation:
    row_count: int
    null_columns: tuple[str, ...]

    @property
    def empty(self) -> bool:
        return self.row_count == 0


def validate(version: Version) -> Validation:
    """Row count and all-null columns, from the counts taken by the write."""
    nulls = tuple(c for c, _, n in version.null_counts() if version.row_count and n == version.row_count)
    return Validation(version.row_count, nulls)


@dataclass(frozen=True)
class Sheet:
    file_name: str
    sheet_name: str
    table_name: str
    path: str
    fmt: str | None


class TableNameClashError(ValueError):
    pass


def _split_name(name: str) -> tuple[str, str | None]:
    """(stem, format) of a file name; a compression suffix does not count."""
    stem = name
    for suffix in COMPRESSIONS:
        if stem.lower().endswith(suffix):
            stem = stem[:-len(suffix)]
            break
    base, dot, ext = stem.rpartition(".")
    fmt = FORMATS.get("." + ext.lower()) if dot else None
    return (base, fmt) if fmt else (stem, None)


def _list(spark: SparkSession, path: str) -> list[tuple[str, str, bool]]:
    """(name, path, is a folder) of the visible entries of a folder, sorted,
    through Spark's Hadoop file system: any path that Spark reads will do."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    out = [(st.getPath().getName(), st.getPath().toString(), st.isDirectory()) for st in fs.listStatus(hadoop)]
    return sorted(e for e in out if not e[0].startswith((".", "_")))


def _dataset_format(entries: list[tuple[str, str, bool]]) -> tuple[str | None, bool]:
    """(format, whether it looks written by Spark) of a folder's files: the
    format is None unless all its files share one."""
    fmts = {_split_name(n)[1] for n, _, is_dir in entries if not is_dir}
    return (fmts.pop() if len(fmts) == 1 else None), any(n.startswith("part-") for n, _, _ in entries)


def discover(spark: SparkSession, root: str) -> list[Sheet]:
    """Every input under ``root`` in sorted order (names only, no data read).
    One that can't be landed has ``fmt`` None, so that it can be logged."""
    sheets: list[Sheet] = []
    for name, path, is_dir in _list(spark, root):
        if not is_dir:
            stem, fmt = _split_name(name)
            sheets.append(Sheet(name, stem, clean_name(stem), path, fmt))
            continue
        inner = _list(spark, path)
        fmt, written = _dataset_format(inner)
        if written:  # a folder of part files is one table on its own
            sheets.append(Sheet(name, name, clean_name(name), path, fmt))
            continue
        for sub, sub_path, sub_dir in inner:
            stem, sub_fmt = (sub, _dataset_format(_list(spark, sub_path))[0]) if sub_dir else _split_name(sub)
            sheets.append(Sheet(name, stem, clean_name(f"{name}_{stem}"), sub_path, sub_fmt))
    return sheets


def read_sheet(spark: SparkSession, sheet: Sheet, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read.format(sheet.fmt)
    if sheet.fmt == "csv":
        r = r.option("header", "true")
        r = r.schema(schema) if schema is not None else r.option("inferSchema", "true")
    elif schema is not None:
        r = r.schema(schema)
    return r.load(sheet.path)


def load_table(spark: SparkSession, df: DataFrame, database: str, table: str) -> str:
    """Full refresh: write the next version, then move the name. Returns the run mode."""
    return publish(spark, stage(spark, df, database, table), database, table)


CLAIMS = "_ids"           # folder beside the log's files; Spark skips names that start so
CLAIM_SECONDS = 30.0      # how long a claim without a size is waited for


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _claim(spark: SparkSession, path: str, n: int) -> bool:
    """Make a file that holds ``n``; False if it is there already. Of several
    callers one at most makes it."""
    fs, hadoop = _fs(spark, path)
    fs.mkdirs(hadoop.getParent())
    if fs.getScheme() == "file":      # Hadoop's local file system looks first and writes then
        if not spark._jvm.java.io.File(hadoop.toUri().getPath()).createNewFile():
            return False
        out = fs.create(hadoop, True)
    else:
        try:
            out = fs.create(hadoop, False)
        except Py4JJavaError:
            if fs.exists(hadoop):
                return False
            raise
    out.writeBytes(str(n))
    out.close()
    return True


def _claimed(spark: SparkSession, folder: str) -> int:
    """Last id that is claimed."""
    fs, hadoop = _fs(spark, folder)
    names = [st.getPath().getName() for st in fs.listStatus(hadoop)] if fs.exists(hadoop) else []
    names = [n for n in names if n.isdigit()]
    if not names:
        return 0
    last, until = max(names), time.monotonic() + CLAIM_SECONDS
    while True:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{last}")
        stream = fs.open(path)
        size = bytes(stream.readAllBytes()).decode()
        stream.close()
        if size or time.monotonic() > until:      # its maker died before it wrote the size
            return int(last) + int(size or 1) - 1
        time.sleep(0.05)


def reserve_ids(spark: SparkSession, database: str, n: int) -> int:
    """First of ``n`` consecutive ids of the audit log that no other load has
    or gets. A range is taken by making the file of its first id; who comes
    second takes the next range. Ids are gap-free but for loads that were
    killed between here and their log lines."""
    folder = f"{log_folder(spark, database)}/{CLAIMS}"
    while True:
        start = max(spark.table(f"{database}.{AUDIT_TABLE}").agg(F.max("id")).first()[0] or 0, _claimed(spark, folder)) + 1
        if _claim(spark, f"{folder}/{start:018d}", n):
            return start


def log_folder(spark: SparkSession, database: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{AUDIT_TABLE}").where("col_name = 'Location'").first()["data_type"].rstrip("/")


def _audit(spark: SparkSession, database: str, rows: list[tuple]) -> None:
    """Append audit rows with the next sequential ids. The rows are written
    aside and moved in as a file of their own: two loads that append to one
    folder at once would share its temporary files."""
    if not rows:
        return
    start, folder = reserve_ids(spark, database, len(rows)), log_folder(spark, database)
    df = spark.createDataFrame([(start + i,) + r + (None,) for i, r in enumerate(rows)], AUDIT_SCHEMA).withColumn("ingested_at", F.current_timestamp())
    aside = f"{folder}/_incoming-{uuid.uuid4().hex}"
    df.coalesce(1).write.parquet(aside)
    fs, hadoop = _fs(spark, aside)
    for st in fs.listStatus(hadoop):
        name = st.getPath().getName()
        if name.startswith("part-") and not fs.rename(st.getPath(), spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")):
            raise OSError(f"could not move {st.getPath()} into the audit log")
    fs.delete(hadoop, True)
    spark.catalog.refreshTable(f"{database}.{AUDIT_TABLE}")


def ensure_audit_table(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in AUDIT_SCHEMA)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{AUDIT_TABLE} ({columns}) USING parquet")


def land(spark: SparkSession, root: str, database: str = "raw",
         schemas: dict[str, T.StructType] | None = None, tables: dict[str, str] | None = None) -> list[dict]:
    """Land every input under ``root`` into ``database``; returns one result
    dict per input (the rows appended to the audit log, plus warnings).

    ``schemas`` is keyed by source (``sales``, ``customers`` ...), with
    ``tables`` giving a source's table name where it is not the usual one, or
    by table name. Inputs of an unknown kind are logged as skipped; two inputs
    for one table are an error before anything is written.
    """
    ensure_audit_table(spark, database)
    names = dict(RAW_TABLES, **(tables or {}))
    by_table = {names.get(k, k): v for k, v in (schemas or {}).items()}
    sheets = discover(spark, root)
    if not sheets:
        log.warning("no source files found in %s", root)
    seen: dict[str, str] = {}
    for sh in sheets:
        if sh.fmt and seen.setdefault(sh.table_name, sh.path) != sh.path:
            raise TableNameClashError(f"{seen[sh.table_name]} and {sh.path} would both become table {sh.table_name!r}")
    results = [_land_sheet(spark, sh, database, by_table.get(sh.table_name)) for sh in sheets]
    _audit(spark, database, [(r["file_name"], r["sheet_name"], r["table_name"], r["row_count"], r["run_mode"]) for r in results])
    return results


def _land_sheet(spark: SparkSession, sh: Sheet, database: str, schema: T.StructType | None) -> dict:
    res = {"file_name": sh.file_name, "sheet_name": sh.sheet_name,
           "table_name": sh.table_name, "row_count": None, "run_mode": None,
           "null_columns": (), "error": None}
    if sh.fmt is None:
        log.warning("%s is of no kind that can be landed; skipped", sh.path)
        return res | {"run_mode": SKIPPED_UNSUPPORTED}
    try:
        df = sanitize_columns(read_sheet(spark, sh, schema))
        version = stage(spark, df, database, sh.table_name)
        v = validate(version)
        res["row_count"] = v.row_count
        res["null_columns"] = v.null_columns
        if v.null_columns:
            log.warning("no value at all in columns %s of %s", ", ".join(v.null_columns), sh.table_name)
        if v.empty:
            discard(spark, version)
            log.warning("%s has no rows; what was landed before stays", sh.table_name)
            res["run_mode"] = SKIPPED_EMPTY
        else:
            res["run_mode"] = publish(spark, version, database, sh.table_name)
            log.info("%s.%s: %d rows, %s", database, sh.table_name, v.row_count, res["run_mode"])
    except Exception as e:  # an error stays within its input
        log.error("could not land %s: %s", sh.path, e)
        res["run_mode"] = FAILED
        res["error"] = str(e)
    return res
