"""Embedding whitening by bit-sliced scatter.

Entries become integers x, every distinct x vector once is the fit list. A
task shifts its vectors to be non-negative and packs, per dimension and bit,
that bit of many rows into 64-bit words. The cross-product of two dimensions
is then a sum of AND-popcounts of their planes, each weighted by a power of
two: exact whatever the number of rows. One more dimension that is always 1
gives the row count and the sums the same way. The parts of all tasks (one
number per pair of dimensions) are summed by Spark as decimals; the driver
centres them as integers (n * cross-product - sum * sum) and solves the
symmetric eigenproblem of one d x d matrix, whose size the data's rows do not
enter. A last pass projects every row.

Defined cases: rows whose vector is null, empty or holds a null, NaN or
infinite entry are dropped, and so are entries of 2**44 and more, whose x a
double does not hold exactly; a vector of any length is taken whole; vectors of
another length live in another space, so each length is fitted on its own;
repeated rows and null ids are returned as they come, and count once in the
fit list; a component without variance (constant or too few vectors) has
whitened and explained 0; ties between eigenvalues are ordered by the solver;
``deviation`` is null where it does not fit in a long, and
``deviation_exact`` holds it up to 38 digits (null beyond); other columns are
ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, table

QUERY_NAME = "op13_whitening"
SCALE = 256
COMPONENTS = 4
LARGEST = float(1 << 44)
BLOCK_CELLS = 1 << 24                   # bits of one block of planes before they are packed: 16 MB
BLOCK_ROWS = 1 << 14
INTEGERS = (("smallint", 15), ("int", 31), ("bigint", 63))
DIGITS = 10 ** 38


def quantised(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, x): x = floor(256 c) of every usable row."""
    v = F.col("v")
    usable = F.forall(v, lambda c: c.isNotNull() & (F.abs(c) < F.lit(LARGEST)))
    return (df.select(df[id_col].alias("vec_id"), df[vec_col].cast("array<double>").alias("v"))
            .where((F.size(v) > 0) & usable)
            .select("vec_id", F.transform(v, lambda c: F.floor(c * F.lit(float(SCALE))).cast("bigint")).alias("x")))


def vectors(column: pa.Array) -> dict[int, np.ndarray]:
    """Integer matrices of a list column, one per length."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("int64")
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    out = {}
    for d in np.unique(lengths).tolist():
        at = starts[lengths == d]
        out[d] = flat[at[:, None] + np.arange(d)[None, :]]
    return out


def bit_planes(u: np.ndarray, bits: int) -> np.ndarray:
    """(dimension, bit, word): bit planes of non-negative integers (row,
    dimension), 64 rows a word."""
    rows, dims = u.shape
    planes = np.zeros((dims, bits, -(-rows // 64) * 8), "uint8")
    columns = u.T
    for b in range(bits):
        packed = np.packbits((columns >> b) & 1 != 0, axis=1, bitorder="little")
        planes[:, b, :packed.shape[1]] = packed
    return planes.view("uint64")


def scatter(u: np.ndarray, bits: int) -> np.ndarray:
    """Exact cross-products of the columns of ``u`` (upper triangle), as
    Python integers where 64 bits would not do."""
    planes = bit_planes(u, bits)
    dims = planes.shape[0]
    safe = 2 * bits + len(u).bit_length() < 63
    weights = np.array([1 << b for b in range(bits)], "int64" if safe else "object")
    out = np.zeros((dims, dims), weights.dtype)
    for i in range(dims):
        rest = planes[i:].reshape((dims - i) * bits, -1)
        for a in range(bits):
            if not planes[i, a].any():
                continue
            ones = np.bitwise_count(rest & planes[i, a]).sum(axis=1, dtype="int64").reshape(dims - i, bits)
            out[i, i:] += (ones.astype(weights.dtype) @ weights) * weights[a]
    return out


def _scatter_parts(ranges: dict[int, tuple[int, int]]):
    """Arrow batches of x -> (dim, i, j, v): the task's cross-products of the
    shifted vectors; i = d stands for the dimension that is always 1."""
    def run(batches):
        waiting: dict[int, list] = {}
        total: dict[int, np.ndarray] = {}

        def add(d):
            lo, hi = ranges[d]
            u = np.concatenate(waiting.pop(d)) - lo
            u = np.concatenate([u, np.ones((len(u), 1), "int64")], axis=1)
            bits = max(1, (hi - lo).bit_length())
            step = max(64, min(BLOCK_ROWS, BLOCK_CELLS // (bits * (d + 1))))
            for at in range(0, len(u), step):
                part = scatter(u[at:at + step], bits).astype("object")
                total[d] = total[d] + part if d in total else part

        for batch in batches:
            for d, x in vectors(batch.column(0)).items():
                waiting.setdefault(d, []).append(x)
                if sum(map(len, waiting[d])) >= BLOCK_ROWS:
                    add(d)
        for d in list(waiting):
            add(d)
        for d, m in total.items():
            i, j = np.triu_indices(d + 1)
            v = pa.array([Decimal(int(x)) for x in m[i, j]], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), v],
                                             names=["dim", "i", "j", "v"])
    return run


def solve(cross: np.ndarray, lo: int, components: int) -> dict:
    """Model of one length from the exact cross-products of x - lo and 1."""
    d = len(cross) - 1
    n = int(cross[d, d])
    sums = [int(s) for s in cross[:d, d]]
    centred = [[n * int(cross[min(i, j), max(i, j)]) - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    v = np.array([[c / (n * n) for c in row] for row in centred], "float64")
    values, axes = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:components]
    values, axes = values[order], axes[:, order]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)
    spread = values > max(values[0], 0.0) * d * np.finfo("float64").eps
    trace = sum(centred[i][i] for i in range(d)) / (n * n)
    return {"n": n, "sums": [s + n * lo for s in sums], "explained": np.where(spread, values, 0.0) / (trace or 1.0), "spread": spread,
            "project": np.where(spread, axes / np.sqrt(np.where(spread, values, 1.0)), 0.0)}


def fit(rows: DataFrame, components: int = COMPONENTS) -> tuple[dict[int, dict], DataFrame]:
    """Models by vector length, and the checkpointed fit list (x)."""
    bounds = rows.groupBy(F.size("x").alias("dim")).agg(F.min(F.array_min("x")).alias("lo"), F.max(F.array_max("x")).alias("hi")).collect()
    ranges = {r["dim"]: (r["lo"], r["hi"]) for r in bounds}
    need = max((max(-lo, hi + 1).bit_length() for lo, hi in ranges.values()), default=0)
    small = next(name for name, bits in INTEGERS if need <= bits)
    distinct = checkpointed(rows.select(F.col("x").cast(f"array<{small}>").alias("x")).distinct())
    parts = distinct.mapInArrow(_scatter_parts(ranges), "dim int, i int, j int, v decimal(38,0)")
    sums = parts.groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).collect()
    cross = {d: np.zeros((d + 1, d + 1), "object") for d in ranges}
    for r in sums:
        cross[r["dim"]][r["i"], r["j"]] = int(r["v"])
    return {d: solve(m, ranges[d][0], components) for d, m in cross.items()}, distinct


def _exact(d: list) -> list:
    return [Decimal(int(v)) if v < DIGITS else None for v in d]


def project(models: dict[int, dict]):
    """UDF of x: the exact deviation from the mean and the whitened components."""
    def run(x: pd.Series) -> pd.DataFrame:
        column = x.tolist()
        lengths = np.array([len(v) for v in column])
        out = {name: np.empty(len(x), "object") for name in ("n", "deviation", "whitened", "explained")}
        for d in np.unique(lengths).tolist():
            m, at = models[d], np.flatnonzero(lengths == d)
            v = np.stack([column[k] for k in at]).astype("int64")
            far = m["n"] * int(np.abs(v).max()) + max(abs(s) for s in m["sums"])
            kind = "int64" if d * far * far < 1 << 63 else "object"
            off = v.astype(kind) * m["n"] - np.array(m["sums"], kind)
            white = (off / m["n"]).astype("float64") @ m["project"]
            rows = {"n": [m["n"]] * len(at), "deviation": _exact((off * off).sum(axis=1)), "whitened": list(white), "explained": [m["explained"]] * len(at)}
            for name, values in rows.items():
                for k, value in zip(at.tolist(), values):
                    out[name][k] = value
        return pd.DataFrame(out)
    return F.pandas_udf(run, "struct<n:bigint,deviation:decimal(38,0),whitened:array<double>,explained:array<double>>")


def identity_error(models: dict[int, dict], distinct: DataFrame) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the
    identity, over all lengths (components without variance apart)."""
    most = max((len(m["spread"]) for m in models.values()), default=0)
    if not most:
        return 0.0
    white = distinct.select(F.size("x").alias("dim"), project(models)(F.col("x"))["whitened"].alias("w"))
    pairs = [(a, b) for a in range(most) for b in range(a, most)]
    found = white.groupBy("dim").agg(*[F.covar_pop(F.get("w", F.lit(a)), F.get("w", F.lit(b))).alias(f"c{a}_{b}") for a, b in pairs]).collect()
    off = [abs(r[f"c{a}_{b}"] - (a == b)) for r in found for a, b in pairs
           if b < len(models[r["dim"]]["spread"]) and models[r["dim"]]["spread"][a] and models[r["dim"]]["spread"][b]]
    return float(max(off, default=0.0))


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable row and component (from 1)."""
    rows = quantised(df, id_col, vec_col)
    models, distinct = fit(rows, components)
    error = identity_error(models, distinct)
    placed = rows.select("vec_id", project(models)(F.col("x")).alias("m"))
    each = placed.select("vec_id", "m.n", F.col("m.deviation").alias("deviation_exact"), F.posexplode(F.arrays_zip("m.whitened", "m.explained")).alias("k", "c"))
    return each.select("vec_id", (F.col("k") + 1).cast("int").alias("component"), "n", F.expr("try_cast(deviation_exact AS BIGINT)").alias("deviation"),
                       F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"),
                       F.lit(error).alias("identity_error"), "deviation_exact")


def query(spark, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


# Eigenvectors are not SQL.
ORACLE_SQL = None
