"""Whitening against numpy on one machine."""

import math

import numpy as np
import pytest

from orderflow.llm import whitening
from orderflow.llm.whitening import whiten

VECTORS = "vec_id long, embedding array<float>, x string, component int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v and [c if c is None else float(c) for c in v], "a", 1) for i, v in rows], VECTORS)


def plain(rows):
    """``{id: (deviation, projections)}``, shares and n over float32 entries."""
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.floor(256 * np.array([v for _, v in good])).astype(int)
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    centred = u - s / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    z = (x - s / n) @ axes[:, :4] / np.sqrt(values[:4])
    return [(i, int(((n * v - s) ** 2).sum()), w) for (i, _), v, w in zip(good, x, z, strict=True)], values / values.sum(), n


def check(got, want, shares, n):
    k = min(4, len(shares))
    assert len(got) == k * len(want) and {r.n for r in got} <= {n}
    own = sorted((r.vec_id, r.deviation, r.component, r.whitened) for r in got)
    signs = {}
    rows = sorted((i, d, c + 1, float(z[c])) for i, d, z in want for c in range(k))
    for a, b in zip(sorted(own, key=lambda t: (t[0], t[1], t[2], abs(t[3]))), sorted(rows, key=lambda t: (t[0], t[1], t[2], abs(t[3]))), strict=True):
        assert a[:3] == b[:3] and abs(a[3]) == pytest.approx(abs(b[3]), rel=1e-7, abs=1e-7)
        if abs(b[3]) > 1e-3:
            assert signs.setdefault(a[2], a[3] * b[3] > 0) == (a[3] * b[3] > 0)
    for r in got:
        assert r.explained == pytest.approx(shares[r.component - 1], rel=1e-9)
        assert abs(r.identity_error) < 1e-9


def test_matches_numpy_with_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 8 * 6 * 16)  # many blocks
    r = np.random.default_rng(3)
    base = (r.normal(size=(300, 6)) * [9, 5, 3, 2, 1, 0.5]).tolist()
    rows = [(i, v) for i, v in enumerate(base)]
    rows += [(1000 + i, base[0]) for i in range(150)]  # a third of the rows is one vector
    rows += [(7, base[7]), (2000, None), (2001, []), (2002, [1.0, None, 0, 0, 0, 0]), (2003, [math.nan, 0, 0, 0, 0, 0]), (2004, [math.inf, 0, 0, 0, 0, 0])]
    rows += [(2005, [-0.0, 0.0, -1e-9, 1e-9, 300.5, -300.5])]
    want, shares, n = plain(rows)
    got = whiten(frame(spark, [*rows, (2006, [1.0, 2.0])]).repartition(5)).collect()
    check(got, want, shares, n)


def test_few_dimensions_and_no_variance(spark):
    rows = [(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [3.0, 1.0])]
    got = whiten(frame(spark, rows)).collect()
    assert {r.component for r in got} == {1} and sorted(r.vec_id for r in got) == [1, 2, 3]
    assert {r.explained for r in got} == {1.0}
    assert whiten(frame(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0])])).collect() == []
    assert whiten(frame(spark, [])).collect() == whiten(frame(spark, [(1, None), (2, [])])).collect() == []


def test_deviation_beyond_a_long(spark):
    assert whitening._deviations(np.array([[1 << 40, 0]]), 1, np.array([0, 0])) == [None]
    assert whitening._deviations(np.array([[3_000_000_000, 0]]), 1, np.array([0, 1])) == [9 * 10**18 + 1]
    assert whitening._deviations(np.array([[3, 4]]), 10, np.array([5, 5])) == [25**2 + 35**2]
