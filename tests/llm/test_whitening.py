import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from cadence.llm import whitening
from tests.llm.conftest import SMALL

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
    *[T.StructField(n, T.StringType()) for n in ("label", "x", "d", "n", "component", "scaled")],
])


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, *["clash"] * 6) for i, v in rows], SCHEMA)


def plainly(rows, components=4):
    """(vec_id, component) -> values, by the eigenvalue routine of numpy."""
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) and -2**63 <= 256 * c < 2**63 for c in v)]
    out = []
    for d in sorted({len(x) for _, x in kept}):
        fit = sorted({tuple(x) for _, x in kept if len(x) == d})
        n, s = len(fit), [sum(c) for c in zip(*fit)]
        centred = np.array([[(n * c - t) / n for c, t in zip(x, s)] for x in fit])
        values, vectors = np.linalg.eigh(centred.T @ centred / n)
        values, vectors = values[::-1], vectors[:, ::-1]
        total = values.sum()
        for i, x in kept:
            if len(x) == d:
                deviation = sum((n * c - t) ** 2 for c, t in zip(x, s))
                for k in range(min(components, d)):
                    known = values[k] > 1e-9 * total and total > 0
                    projected = (np.array([(n * c - t) / n for c, t in zip(x, s)]) @ vectors[:, k]) / math.sqrt(values[k]) if known else None
                    out.append((i, k + 1, n, deviation, projected, values[k] / total if total > 0 else None))
    return out


def check(got, expect):
    """Equal rows, up to rounding and the sign of a component."""
    assert len(got) == len(expect)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2], int(r[3]), abs(r[4]) if r[4] is not None else -1)
    signs = {}
    for g, e in zip(sorted([tuple(r)[:6] for r in got], key=key), sorted(expect, key=key)):
        assert g[:3] == e[:3] and int(g[3]) == e[3]
        assert (g[4] is None) == (e[4] is None) and (g[5] is None) == (e[5] is None)
        if g[5] is not None:
            assert g[5] == pytest.approx(e[5], rel=1e-6, abs=1e-12)
        if g[4] is not None:
            assert abs(g[4]) == pytest.approx(abs(e[4]), rel=1e-6, abs=1e-7)
            if abs(e[4]) > 1e-3:
                signs.setdefault((g[2], g[1]), set()).add(g[4] * e[4] > 0)
    assert all(len(s) == 1 for s in signs.values())


def test_the_table(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    got = whitening.whitened(df).collect()
    check(got, plainly([(r["vec_id"], r["embedding"]) for r in df.collect()]))
    assert max(r["identity_error"] for r in got) < 1e-8 and len({r["identity_error"] for r in got}) == 1


def test_edge_cases(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(5).tolist()) for i in range(40)]
    rows += [(3, rows[3][1])] * 5 + [(None, rows[4][1]), (50, None), (51, []), (52, [1.0, None, 0.0, 0.0, 0.0]),
                                     (53, [float("nan")] * 5), (54, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
                                     (55, [1e300, 0.0, 0.0, 0.0, 0.0]), (56, [1e18, 0.0, 0.0, 0.0, 0.0])]
    # Other lengths are fitted apart: two entries, one vector alone, all equal.
    rows += [(60 + i, [float(i), 2.0 * i + (i == 2)]) for i in range(4)] + [(70, [1.5])] + [(80 + i, [1.0, 2.0, 3.0]) for i in range(3)]
    wide = [r for r in rows if r[0] != 56]
    check(whitening.whitened(frame_of(spark, wide)).collect(), plainly(wide))
    alone = {r["component"]: r for r in whitening.whitened(frame_of(spark, [(70, [1.5])])).collect()}
    assert [alone[1][c] for c in ("whitened", "explained", "identity_error")] == [None, None, None]
    # A vector far off does not spoil sums and deviations.
    far = whitening.whitened(frame_of(spark, rows)).where("vec_id = 56 or vec_id = 0").collect()
    expect = {(r[0], r[1]): r[3] for r in plainly(rows) if r[0] in (56, 0)}
    assert {(r["vec_id"], r["component"]): int(r["deviation"]) for r in far if r["deviation"] is not None} == {
        k: v for k, v in expect.items() if v < 10**38}
    assert whitening.whitened(frame_of(spark, [])).collect() == []
    assert whitening.whitened(frame_of(spark, [(1, None)])).collect() == []


def matrices():
    rng = np.random.default_rng(0)
    square = lambda a: a @ a.T
    turn = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    yield from (square(rng.standard_normal((24, 24))), square(rng.standard_normal((24, 2))), np.diag([5.0, 5, 5, 1, 0, 0]),
                np.ones((5, 5)), np.eye(7), np.zeros((3, 3)), np.array([[3.0]]), np.diag(10.0 ** -np.arange(12)),
                turn @ np.diag([9.0] + [1.0] * 11) @ turn.T, turn @ np.diag([4.0] * 6 + [4 - 1e-9] * 6) @ turn.T,
                np.array([[1.0, 0], [0, -1]]))


@pytest.mark.parametrize("wanted", [1, 4, None])
def test_components_of_matrices(wanted):
    for matrix in matrices():
        values, vectors = whitening.components_of(matrix, wanted)
        size = max(np.linalg.norm(matrix), 1e-300)
        k = len(matrix) if wanted is None else min(wanted, len(matrix))
        assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1][:k]).max() < 1e-13 * size
        assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13
        assert np.linalg.norm(matrix @ vectors - vectors * values) < 1e-13 * size


def test_polar_factor_is_the_matrix_sign():
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.standard_normal((10, 10)))[0]
    values = np.array([3, 1, 1e-3, 1e-8, 1e-12, -1e-10, -1e-5, -0.5, -2, -7])
    sign = whitening.polar_factor(turn @ np.diag(values) @ turn.T)
    assert np.abs(sign @ sign - np.eye(10)).max() < 1e-13
    assert round(np.trace(sign)) == 0


def test_sums_are_exact(spark):
    big = 2.0**52
    rows = [(i, [big + 2 * i, -big]) for i in range(50)]
    fit = whitening.integers(frame_of(spark, rows)).select("x").distinct()
    sums = whitening.sums_of(fit)[2]
    assert sums.n == 50 and sums.s == [sum(256 * (2**52 + 2 * i) for i in range(50)), -50 * 256 * 2**52]
    x = np.array([[256 * (2**52 + 2 * i), -256 * 2**52] for i in range(50)])
    assert np.allclose(sums.centred(x)[:, 0], 512 * (np.arange(50) - 24.5)) and not sums.centred(x)[:, 1].any()
