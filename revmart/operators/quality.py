"""Data-quality operators: unique-key checks (L7) and relation profiles.

Spark enforces no unique keys. The reference's unique indexes become
(a) ``unique_key_report``: one row per checked key with row, null, distinct
and duplicated-key counts, and (b) ``assert_unique``: raise when a key is
duplicated (used by ``Warehouse.materialize`` on each table it writes,
as a failed index build stops the reference's run). NULL keys never collide.

Both are two-level aggregations: ``groupBy(key).count()`` in the key's own
type (partial + final, so a hot key is pre-combined per map task) and then a
global aggregate over the per-key counts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG = T.LongType()

# Fixed values: (relation, key column) pairs the warehouse keeps unique --
# the reference's eleven unique indexes -- plus two staging keys whose
# duplicates fan out joins (customers) and annual sums (targets).
UNIQUE_KEYS = (
    ("dim_customers", "customer_key"),
    ("dim_customers", "customer_id"),
    ("dim_products", "product_key"),
    ("dim_products", "product_id"),
    ("dim_date", "date_key"),
    ("dim_date", "calendar_date"),
    ("mart_annual_performance", "annual_performance_key"),
    ("mart_monthly_sales", "monthly_sales_key"),
    ("mart_customer_sales", "customer_sales_key"),
    ("mart_product_sales", "product_sales_key"),
    ("mart_product_cashflow", "product_cashflow_key"),
    ("stg_customers", "customer_id"),
    ("stg_revenue_targets", "target_year"),
)


class DuplicateKeyError(ValueError):
    pass


def key_stats(df: DataFrame, *keys: str) -> DataFrame:
    """One row per key: key_column, row_count, null_keys, distinct_keys,
    duplicate_keys. The relation is worked out once and grouped by all its keys
    together, in their own types; each key is then counted over that one
    shuffled result (Spark reuses the exchange)."""
    together = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    return _union([_one_key(together if len(keys) == 1 else together.groupBy(k).agg(F.sum("_c").alias("_c")), k) for k in keys])


def _one_key(per_key: DataFrame, key: str) -> DataFrame:
    k, c = F.col(key), F.col("_c")
    counts = {"row_count": F.sum(c), "null_keys": F.sum(F.when(k.isNull(), c)), "distinct_keys": F.count(k),
              "duplicate_keys": F.count(F.when(k.isNotNull() & (c > 1), 1))}
    return per_key.agg(*[F.coalesce(v, F.lit(0)).cast(LONG).alias(n) for n, v in counts.items()]).select(F.lit(key).alias("key_column"), *counts)


def _union(parts: list[DataFrame]) -> DataFrame:
    """Union as a flat tree, so that no frame is analysed again and again."""
    while len(parts) > 1:
        parts = [a.union(b) for a, b in zip(parts[::2], parts[1::2])] + (parts[-1:] if len(parts) % 2 else [])
    return parts[0]


def unique_key_report(warehouse, checks=UNIQUE_KEYS) -> DataFrame:
    by_relation: dict[str, list[str]] = {}
    for rel, key in checks:
        by_relation.setdefault(rel, []).append(key)
    return _union([key_stats(warehouse.relation(rel), *keys).select(F.lit(rel).alias("relation"), "*")
                   for rel, keys in by_relation.items()])


def assert_unique(df: DataFrame, key: str, relation: str = "relation") -> None:
    """Raise ``DuplicateKeyError`` listing a few duplicated keys, if any."""
    dups = (df.where(F.col(key).isNotNull()).groupBy(key).count()
              .where(F.col("count") > 1).limit(5).collect())
    if dups:
        sample = ", ".join(f"{r[key]!r} x{r['count']}" for r in dups)
        raise DuplicateKeyError(f"{relation}.{key} is not unique: {sample}")


def profile(df: DataFrame, relation: str, group: str) -> DataFrame:
    """Per column: type, row count and null count, from one aggregate pass."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(cols)])
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
                 F.col(f"_c{i}").alias("_nn"))
        for i, c in enumerate(cols)
    ])
    return agg.select(F.col("_n"), F.explode(entries).alias("_e")).select(
        F.lit(relation).alias("relation"),
        F.lit(group).alias("page_group"),
        F.col("_e.column_name").alias("column_name"),
        F.col("_e.data_type").alias("data_type"),
        F.col("_n").cast(LONG).alias("row_count"),
        (F.col("_n") - F.col("_e._nn")).cast(LONG).alias("null_count"),
    )


def relation_profile(warehouse, names) -> DataFrame:
    """Profile of several relations. Staging relations, dimensions and marts
    are written once and counted by that write; every other relation is one
    aggregate over what is written, so none is worked out twice. One row per
    column comes to the driver, what is written goes no further than its
    folder."""
    from revmart.plans.warehouse import DIMS_MARTS, PROFILE_SCHEMA, STAGING, group_of
    warehouse.write_once(names)
    rest = [profile(warehouse.relation(n), n, group_of(n)) for n in names if group_of(n) not in (STAGING, DIMS_MARTS)]
    rows = [r for r in warehouse.counted if r[0] in names] + [tuple(r) for r in (_union(rest).collect() if rest else [])]
    return warehouse.spark.createDataFrame(rows, PROFILE_SCHEMA)


def landing_validation(sources) -> DataFrame:
    """What landing finds in each source: per cleaned column name the row
    count and whether the column has no value at all."""
    from revmart.sources.landing import sanitize_columns
    parts = [profile(sanitize_columns(getattr(sources, n)), n, "source") for n in sources.NAMES]
    return _union(parts).select(F.col("relation").alias("source"), "column_name", "row_count",
                                ((F.col("row_count") > 0) & (F.col("null_count") == F.col("row_count"))).alias("all_null"))


LOG_COLUMNS = ("id", "file_name", "sheet_name", "table_name", "row_count", "run_mode")


def landing_round_trip(sources) -> DataFrame:
    """The five sources written as extracts of several kinds below the scratch
    folder and landed twice: one row per line of the audit log (without its
    time), with the rows and a sum of row hashes of the table that readers then
    find."""
    from revmart.session import ensure_checkpoint_dir
    from revmart.sources import landing
    from revmart.sources.schema import RAW_TABLES, SCHEMAS
    frames = {n: getattr(sources, n) for n in sources.NAMES}
    spark = next(iter(frames.values())).sparkSession
    tag = uuid.uuid4().hex
    root, db = f"{ensure_checkpoint_dir(spark).rstrip('/')}/extracts-{tag}", f"round_trip_{tag[:12]}"
    for n, df in frames.items():
        kind = EXTRACT_KINDS[n]
        df.write.format(kind).options(**({"header": "true"} if kind == "csv" else {})).save(f"{root}/{RAW_TABLES[n]}")
    for _ in range(2):
        landing.land(spark, root, db, schemas=SCHEMAS)
    found = _union([_content(spark.table(f"{db}.{t}"), SCHEMAS[n].fieldNames()).select(F.lit(t).alias("table_name"), "*") for n, t in RAW_TABLES.items()])
    result = spark.table(f"{db}.{landing.AUDIT_TABLE}").select(*LOG_COLUMNS).join(found, "table_name").select(*LOG_COLUMNS, "landed_rows", "content")
    result = result.checkpoint(eager=True)          # one row per line of the log
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return result


# Extract format of each source in the round trip.
EXTRACT_KINDS = {"sales": "parquet", "customers": "csv", "targets": "json", "cash_flow": "csv", "employees": "parquet"}


def _content(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, and the sum of their hashes: the first 32 bits of the md5 of the
    columns as text, so the order of rows does not matter."""
    line = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("-")) for c in columns])
    part = F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast(LONG)
    return df.agg(F.count(F.lit(1)).alias("landed_rows"), F.coalesce(F.sum(part), F.lit(0)).cast(LONG).alias("content"))


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows of a relation (the inspector's preview)."""
    return df.limit(rows)


def inspect(warehouse, group: str | None = None, relation: str | None = None,
            rows: int = 5) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The inspector's three modes: every relation, one page group (matched
    by substring, case-insensitive) or one relation. Returns the profile
    frame and a preview frame per relation (both lazy)."""
    from revmart.plans.warehouse import RELATIONS
    if relation is not None:
        names = [relation]
    elif group is not None:
        names = [n for n, (g, _) in RELATIONS.items() if group.lower() in g.lower()]
    else:
        names = [n for n in RELATIONS]
    if not names:
        raise KeyError(f"no relation matches group={group!r} relation={relation!r}")
    return relation_profile(warehouse, names), {n: preview(warehouse.relation(n), rows) for n in names}


# Relations that the registered profile and key queries look at: every layer
# but the calendar, which is made from constants.
def _all_relations() -> tuple[str, ...]:
    from revmart.plans.warehouse import RELATIONS
    return tuple(n for n in RELATIONS if n != "dim_date")


PROFILED = _all_relations()
DERIVED_KEYS = tuple((r, k) for r, k in UNIQUE_KEYS if r != "dim_date")
