"""Exact NTILE over a whole relation without a single-partition window.

``ntile(k) OVER (ORDER BY m)`` with no PARTITION BY makes Spark move every
row into one task. Here the global row number is built in parallel:

1. range-partition the rows by the full sort key (metric, then tie-break
   column) and sort inside each partition;
2. checkpoint that layout (reliable checkpoint, so a lost executor cannot
   make the two passes below see different range boundaries);
3. count rows per partition -- one tiny row per partition -- and turn the
   counts into exclusive prefix offsets (a window over those few rows);
4. global row number = offset of the partition + position in it, where the
   position comes from ``monotonically_increasing_id`` recorded before the
   checkpoint (consecutive within a partition);
5. tile from the row number in closed form, with q, r = divmod(n, k):
   rows 1..r(q+1) fall in tiles of q+1 rows, the rest in tiles of q rows.

Only the per-partition count frame (bounded by the partition count) is ever
gathered, and it is joined back with an explicit broadcast of that bounded
frame. Ties in the metric are broken by the tie-break column, which makes
the result deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.session import ensure_checkpoint_dir

_PID = "__nt_pid"
_MID = "__nt_mid"


def ntile_tile(rn: Column, n: Column, k: int) -> Column:
    """Closed-form NTILE(k) for 1-based row number ``rn`` out of ``n`` rows."""
    q = F.floor(n / F.lit(k)).cast(T.LongType())
    r = n - q * F.lit(k)
    big = r * (q + 1)
    first = F.floor((rn - 1) / (q + 1)) + 1
    rest = r + F.floor((rn - big - 1) / F.greatest(q, F.lit(1))) + 1
    return F.when(rn <= big, first).otherwise(rest).cast(T.IntegerType())


def with_global_row_number(df: DataFrame, order: list[Column], out: str,
                           num_partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Add 1-based global row number ``out`` in the given order.

    Returns (frame with the row number, per-partition offsets frame with the
    total ``__nt_n``).
    """
    ensure_checkpoint_dir(df.sparkSession)
    # Without an explicit count AQE may coalesce the range partitions; it
    # merges only neighbouring ranges, in order, so the partition index read
    # below still orders the rows globally.
    ranged = (df.repartitionByRange(*order) if num_partitions is None
              else df.repartitionByRange(num_partitions, *order))
    laid = (ranged
              .sortWithinPartitions(*order)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_MID, F.monotonically_increasing_id())
              .checkpoint(eager=True))
    counts = laid.groupBy(_PID).agg(F.count(F.lit(1)).alias("__nt_cnt"),
                                    F.min(_MID).alias("__nt_first"))
    # One row per range partition: the windows below see only these rows.
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        _PID, "__nt_first",
        F.coalesce(F.sum("__nt_cnt").over(w), F.lit(0)).alias("__nt_off"),
        F.sum("__nt_cnt").over(Window.partitionBy()).alias("__nt_n"),
    )
    numbered = (laid.join(F.broadcast(offsets), _PID)
                    .withColumn(out, F.col("__nt_off") + (F.col(_MID) - F.col("__nt_first")) + 1))
    return numbered, offsets


def cut_points(keys: DataFrame, k: int, num_partitions: int | None = None) -> list:
    """First row of each of the tiles 2..k when the rows of ``keys`` are
    sorted by all its columns, ascending (at most k - 1 rows)."""
    numbered, _ = with_global_row_number(keys, [F.col(c) for c in keys.columns], "__nt_rn", num_partitions)
    n = F.col("__nt_n")
    q = F.floor(n / F.lit(k)).cast(T.LongType())
    starts = [F.lit(j) * q + F.least(F.lit(j), n - q * F.lit(k)) + 1 for j in range(1, k)]
    rows = numbered.where(F.col("__nt_rn").isin(starts) & (F.col("__nt_rn") > 1)).orderBy("__nt_rn")
    return rows.select(*keys.columns).distinct().collect()


def add_ntiles(df: DataFrame, k: int, orders: dict[str, list[Column]],
               num_partitions: int | None = None) -> DataFrame:
    """Add NTILE(k) columns for several orders in one pass over ``df``.

    Each order is a list of key columns, ascending, nulls first, ending in a
    unique one. Only these narrow keys are sorted; the k - 1 cut points of
    each order become literals, and a row's tile is one more than the number
    of cut points it does not precede.
    """
    tiles = {}
    for out, order in orders.items():
        names = [f"__nt_k{i}" for i in range(len(order))]
        keys = df.select(*[c.alias(n) for c, n in zip(order, names)])
        own = F.struct(*[c.alias(n) for c, n in zip(order, names)])
        tile = F.lit(1)
        for row in cut_points(keys, k, num_partitions):
            cut = F.struct(*[F.lit(row[n]).cast(keys.schema[n].dataType).alias(n) for n in names])
            tile = tile + (own >= cut).cast(T.IntegerType())
        tiles[out] = tile.cast(T.IntegerType())
    return df.withColumns(tiles)


def add_ntile(df: DataFrame, k: int, order: list[Column], out: str,
              num_partitions: int | None = None) -> DataFrame:
    """Add column ``out`` = NTILE(k) OVER (ORDER BY ``order``), exactly.

    ``order`` must be a total order (end it with a unique column) for the
    result to be deterministic.
    """
    numbered, _ = with_global_row_number(df, order, "__nt_rn", num_partitions)
    res = numbered.withColumn(out, ntile_tile(F.col("__nt_rn"), F.col("__nt_n"), k))
    return res.drop(_PID, _MID, "__nt_first", "__nt_off", "__nt_n", "__nt_rn")
