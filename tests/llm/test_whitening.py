from decimal import Decimal
from math import floor, inf, isfinite, nan

import numpy as np
import pytest

from revmart.llm import whitening as op
from revmart.llm.common import table

from .helpers import CLASHES

EXTRA = [*CLASHES, "x", "v", "n", "m", "component", "dim"]


def vec_table(spark, rows, kind="float"):
    extra = ", ".join(f"`{c}` string" for c in EXTRA)
    return spark.createDataFrame([(i, v if v is None else [c if c is None else float(c) for c in v], *["x"] * len(EXTRA)) for i, v in rows], f"vec_id long, embedding array<{kind}>, {extra}")


def brute(rows, components=4):
    """Model by plain Python integers and one eigh, for vectors of one length."""
    xs = [(i, tuple(floor(256 * float(np.float32(c))) for c in v)) for i, v in rows if v and all(c is not None and isfinite(c) for c in v)]
    fit = sorted({x for _, x in xs})
    n, d = len(fit), len(fit[0])
    s = [sum(x[k] for x in fit) for k in range(d)]
    off = [[n * x[k] - s[k] for k in range(d)] for x in fit]
    v = np.array([[sum(o[a] * o[b] for o in off) / n ** 3 for b in range(d)] for a in range(d)])
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1][:components], axes[:, ::-1][:, :components]
    out = []
    for i, x in xs:
        o = np.array([n * x[k] - s[k] for k in range(d)], "object")
        w = (o / n).astype(float) @ axes / np.sqrt(e)
        out += [(i, k + 1, n, int((o * o).sum()), abs(w[k]), e[k] / np.trace(v)) for k in range(len(e))]
    return sorted(out, key=repr)


def check(got, want):
    rows = sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"]) for r in got), key=repr)
    assert [r[:4] for r in rows] == [r[:4] for r in want]
    assert np.allclose([r[4:] for r in rows], [r[4:] for r in want], rtol=1e-9, atol=1e-9)
    assert all(r["identity_error"] < 1e-9 for r in got)


def test_against_plain_integers(spark):
    r = np.random.default_rng(3)
    rows = [(k, r.normal(0, [.1, .5, .2, 1, .05], 5).tolist()) for k in range(300)]
    rows += [(1, rows[1][1]), (None, rows[7][1]), (400, rows[2][1])]
    bad = [(500, None), (501, []), (502, [1.0, None, 0, 0, 0]), (503, [nan, 0, 0, 0, 0.0]), (504, [0, 0, inf, 0, 0.0]), (505, [0, 0, -inf, 0, 0.0])]
    check(op.whiten(vec_table(spark, rows + bad)).collect(), brute(rows))


def test_given_rows(spark):
    df = table(spark, "/root/testdata/sf0.001", "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    check(op.whiten(df).collect(), brute(rows))


def test_hot_vector_counts_once(spark):
    rows = [(k, [float(k % 7), float(k % 5), 1.5 * (k % 3)]) for k in range(60)]
    check(op.whiten(vec_table(spark, rows + [(k, rows[0][1]) for k in range(100, 400)])).collect(), brute(rows + [(k, rows[0][1]) for k in range(100, 400)]))


def test_small_blocks_and_wide_values(spark, monkeypatch):
    u = np.random.default_rng(1).integers(0, 1 << 40, (130, 4))
    for rows in (u, u >> 25):
        want = rows.astype("object").T @ rows.astype("object")
        got = op.scatter(rows, int(rows.max()).bit_length())
        assert np.array_equal(np.triu(got), np.triu(want))
    big = [(k, [float(1 << 40) * (k % 5), -float(k % 3), float(k)]) for k in range(30)]
    got = {(r["vec_id"], r["component"]): r for r in op.whiten(vec_table(spark, big, "double")).collect()}
    xs = [[256 * int(c) for c in v] for _, v in big]
    s = [sum(c) for c in zip(*xs)]
    for k, x in enumerate(xs):
        exact = sum((30 * c - t) ** 2 for c, t in zip(x, s))
        assert got[k, 1]["deviation_exact"] == Decimal(exact)
        assert got[k, 1]["deviation"] == (exact if exact < 1 << 63 else None)


def test_lengths_are_spaces_of_their_own(spark):
    r = np.random.default_rng(5)
    two = [(k, r.normal(0, 1, 2).tolist()) for k in range(40)]
    six = [(100 + k, r.normal(0, 1, 6).tolist()) for k in range(50)]
    got = op.whiten(vec_table(spark, two + six)).collect()
    check([g for g in got if g["vec_id"] < 100], brute(two))
    check([g for g in got if g["vec_id"] >= 100], brute(six))


@pytest.mark.parametrize("rows,n", [([(1, [0.5, 0.25])], 1), ([(1, [0.5, 2.0]), (2, [0.5, 2.0])], 1)])
def test_no_variance(spark, rows, n):
    got = op.whiten(vec_table(spark, rows)).collect()
    assert len(got) == 2 * len(rows)
    assert all((g["n"], g["deviation"], g["whitened"], g["explained"], g["identity_error"]) == (n, 0, 0.0, 0.0, 0.0) for g in got)


def test_one_direction_only(spark):
    got = op.whiten(vec_table(spark, [(k, [float(k), 1.0]) for k in range(5)])).collect()
    assert sorted({(g["component"], round(g["explained"], 9)) for g in got}) == [(1, 1.0), (2, 0.0)]
    assert all(g["identity_error"] < 1e-9 for g in got)


def test_long_vectors(spark):
    r = np.random.default_rng(9)
    rows = [(k, r.normal(0, 1, 300).tolist()) for k in range(40)]
    check(op.whiten(vec_table(spark, rows), components=3).collect(), brute(rows, 3))


def test_empty_table(spark):
    assert op.whiten(vec_table(spark, [])).collect() == []
    assert op.whiten(vec_table(spark, [(1, None)])).collect() == []
