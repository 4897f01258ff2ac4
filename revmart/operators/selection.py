"""Exact NTILE by selection: the cut points are found without sorting the rows.

A tile needs only the rows at its first ranks, k - 1 of them per metric. Each
is closed in on by counts, which Spark combines in every task before anything
moves:

1. a quantile sketch per metric (``percentile_approx``, whose rank error is
   bounded) gives a value below and one above each cut point;
2. the rows below the lower one are counted exactly, and the rows between the
   two are grouped by value: the running count names the exact value at the
   rank (a sketch that missed it is replaced by the whole range);
3. where several rows share that value, the id decides: rows are counted by the
   next characters of their id until one is left. So a value that a third of
   all rows hold is counted by id prefixes, never gathered.

Only the picked rows (one per cut point and step) come to the driver. A last
map-side pass gives every row its tiles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ACCURACY = 100_000        # rank error of the sketch: one row in so many
PREFIX = 4                # characters of the id that one step looks at


@dataclass
class Cut:
    """First row of a tile: its rank among rows that are like it in all that
    is known so far."""
    metric: str
    rank: int
    null: bool = False
    value: object = None
    prefix: str = ""
    id: str | None = None
    done: bool = False


def _starts(n: int, k: int) -> list[int]:
    """Ranks (from 1) of the first rows of tiles 2..k that exist."""
    q, r = divmod(n, k)
    return [s for s in (j * q + min(j, r) + 1 for j in range(1, k)) if 1 < s <= n]


def _numbered(flags: list[Column]) -> Column:
    """Numbers of the flags that hold."""
    return F.array_compact(F.array(*[F.when(f, F.lit(i)) for i, f in enumerate(flags)]))


def _pick(grouped: DataFrame, key: str, ranks: list[int], *more: str) -> list:
    """Per cut, the group that holds its rank: the groups of a cut are counted
    up in the order of ``key`` (nulls last)."""
    w = Window.partitionBy("cut").orderBy(F.col(key).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rank = F.element_at(F.array(*[F.lit(r).cast("long") for r in ranks]), F.col("cut") + 1)
    upto = grouped.withColumn("upto", F.sum("n").over(w)).withColumn("rank", rank)
    return upto.where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank"))) \
        .select("cut", key, "n", *more, (F.col("rank") - F.col("upto") + F.col("n")).alias("inside")).collect()


def _settle_values(df: DataFrame, value: Column, cuts: list[Cut], known: int) -> None:
    """Exact metric value of every cut, and the rank among its equals."""
    spread = 2 / ACCURACY
    at = [p for c in cuts for p in (max(0.0, c.rank / known - spread), min(1.0, c.rank / known + spread))]
    sketch = df.agg(F.percentile_approx(value, at, ACCURACY).alias("q")).first()["q"]
    # The sketch works in doubles: a little wider than its rounding.
    wide = [abs(float(q)) * 1e-12 + 1 for q in sketch]
    dtype = df.select(value.alias("v")).schema["v"].dataType
    low = [(value.cast("double") >= float(q) - w) for q, w in zip(sketch[::2], wide[::2])]
    high = [(value.cast("double") <= float(q) + w) for q, w in zip(sketch[1::2], wide[1::2])]
    todo = list(range(len(cuts)))
    while todo:
        below = df.agg(*[F.sum((~low[i]).cast("long")).alias(f"b{i}") for i in todo]).first()
        between = df.select(F.explode(_numbered([low[i] & high[i] for i in todo])).alias("cut"), value.alias("v"))
        found = _pick(between.groupBy("cut", "v").agg(F.count("*").alias("n")), "v", [cuts[i].rank - (below[f"b{i}"] or 0) for i in todo])
        for r in found:
            cut = cuts[todo[r["cut"]]]
            cut.value, cut.rank = F.lit(r["v"]).cast(dtype), r["inside"]
        missed = [i for k, i in enumerate(todo) if k not in {r["cut"] for r in found}]
        for i in missed:
            low[i] = high[i] = value.isNotNull()
        todo = missed


def _settle_ids(df: DataFrame, values: dict[str, Column], id_col: Column, cuts: list[Cut]) -> None:
    """The id of every cut among the rows that share its value."""
    length = 0
    while todo := [c for c in cuts if not c.done]:
        alike = [(values[c.metric].isNull() if c.null else values[c.metric] == c.value)
                 & (F.lit(True) if not length else F.coalesce(F.substring(id_col, 1, length) == F.lit(c.prefix), F.lit(False))) for c in todo]
        length += PREFIX
        rows = df.select(F.explode(_numbered(alike)).alias("cut"), F.substring(id_col, 1, length).alias("part"), id_col.alias("id"))
        groups = rows.groupBy("cut", "part").agg(F.count("*").alias("n"), F.min("id").alias("first"), F.max("id").alias("last"))
        for r in _pick(groups, "part", [c.rank for c in todo], "first", "last"):
            c = todo[r["cut"]]
            c.prefix, c.rank, c.id = r["part"], r["inside"], r["first"]
            c.done = r["part"] is None or r["first"] == r["last"]


def select_ntiles(df: DataFrame, k: int, metrics: dict[str, Column], id_name: str, nulls_first: frozenset = frozenset()) -> DataFrame:
    """``df`` with an NTILE(k) column per entry of ``metrics`` (integers or
    decimals, ascending), ties broken by the string column ``id_name``. Null
    metrics come last, or first where the entry is in ``nulls_first``; null ids
    come last among equals. Rows with equal metric and id share the tile of the
    first of them. ``df`` is read several times: hand it in checkpointed."""
    id_col = F.col(id_name)
    counted = df.agg(F.count("*").alias("n"), *[F.count(v).alias(f"v{i}") for i, v in enumerate(metrics.values())]).first()
    n, cuts = counted["n"], []
    for i, (out, value) in enumerate(metrics.items()):
        known = counted[f"v{i}"]
        own = []
        for s in _starts(n, k):
            nulls = n - known
            in_nulls = s <= nulls if out in nulls_first else s > known
            own.append(Cut(out, s if in_nulls and out in nulls_first else s - known if in_nulls else s - nulls if out in nulls_first else s, null=in_nulls))
        valued = [c for c in own if not c.null]
        if valued:
            _settle_values(df, value, valued, known)
        cuts += own
    _settle_ids(df, metrics, id_col, cuts)
    tiles = {}
    for out, value in metrics.items():
        tile = F.lit(1)
        for c in (c for c in cuts if c.metric == out):
            first = out in nulls_first
            # behind the cut: a later value, or its value and no earlier id
            same = value.isNull() if c.null else F.coalesce(value == c.value, F.lit(False))
            later = F.lit(False) if c.null and not first else value.isNotNull() if c.null else \
                F.coalesce(value > c.value, F.lit(False)) if first else F.coalesce(value > c.value, F.lit(True))
            own_id = id_col.isNull() if c.id is None else F.coalesce(id_col >= F.lit(c.id), F.lit(True))
            tile = tile + (later | (same & own_id)).cast(T.IntegerType())
        tiles[out] = tile.cast(T.IntegerType())
    return df.withColumns(tiles)
