"""Whitening against the eigenvectors of the covariance."""

import numpy as np
import pytest

from lakemart.llm import whitening
from lakemart.llm.whitening import deviations, solved, whitened


def brute(vectors):
    """n, sums, eigenvalues (falling), eigenvectors of the distinct vectors."""
    x = np.array(sorted({tuple(v) for v in vectors}), float)
    c = x - x.mean(axis=0)
    values, turn = np.linalg.eigh(c.T @ c / len(x))
    return len(x), x.sum(axis=0), values[::-1], turn[:, ::-1].T


def check(rows, vectors, k=4, skip=()):
    """rows of :func:`whitened` by id against ``vectors`` {id: x}."""
    n, sums, values, turn = brute(vectors.values())
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(got) == len(rows) == (len(vectors) - len(skip)) * k
    sign = [None] * k
    for (i, c), r in got.items():
        x = np.array(vectors[i], float)
        want = (x - sums / n) @ turn[c - 1] / np.sqrt(values[c - 1])
        if sign[c - 1] is None and abs(want) > 1e-3:
            sign[c - 1] = np.sign(want * r["whitened"])
        assert abs(r["whitened"] * (sign[c - 1] or 1) - want) < 1e-6
        assert r["n"] == n
        assert r["deviation"] == sum((n * int(a) - int(b)) ** 2 for a, b in zip(vectors[i], sums, strict=True))
        assert abs(r["explained"] / (values[c - 1] / values.sum()) - 1) < 1e-8
        assert r["identity_error"] < 1e-6


def table(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, n int, x string, component int")


def vectors(n=300, d=12, seed=1):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(d, d)) * np.geomspace(1, 1e-2, d)
    return (rng.normal(size=(n, d)) @ mix + rng.normal(size=d) * 3).tolist()


def integers(v):
    return [int(np.floor(256 * c)) for c in v]


def test_against_eigenvectors(spark):
    found = vectors()
    rows = [(i, v, 1, "x", 2) for i, v in enumerate(found + found[:1] * 90 + found[5:9])]   # repeated vectors count once
    got = whitened(table(spark, rows).repartition(7)).collect()
    check(got, {r[0]: integers(r[1]) for r in rows})


def test_badly_conditioned(spark):
    """Directions that differ by 1e9 in length, a constant one and a copied one."""
    rng = np.random.default_rng(2)
    base = rng.integers(-1 << 30, 1 << 30, (400, 1))
    small = rng.integers(-9, 9, (400, 4))
    x = np.hstack((base + small[:, :1], base, small[:, 1:], np.full((400, 1), 7), small[:, 1:2])).astype(object)
    rows = [(i, [float(c) / 256 for c in v], 1, "x", 2) for i, v in enumerate(x.tolist())]
    got = whitened(table(spark, rows)).collect()
    exact = {i: [int(c) for c in v] for i, v in enumerate(x.tolist())}
    n, sums, values, _ = brute(exact.values())
    assert {r["identity_error"] < 1e-6 for r in got} == {True}
    top = [r["whitened"] for r in sorted(got, key=lambda r: r["vec_id"]) if r["component"] == 1]
    assert abs(np.mean(np.square(top)) - 1) < 1e-9
    for r in got:
        assert r["deviation"] == sum((n * a - int(b)) ** 2 for a, b in zip(exact[r["vec_id"]], sums, strict=True))


def test_odd_rows(spark):
    found = vectors(40, 3, 5)
    nan, inf = float("nan"), float("inf")
    odd = [(1000, None), (1001, []), (1002, [1.0, None, 2.0]), (1003, [nan, 0.0, 0.0]), (1004, [inf, 0.0, 0.0]),
           (1005, [1.0, 2.0])]
    rows = [(i, v, 1, "x", 2) for i, v in [*enumerate(found), (None, found[0]), (7, found[7]), *odd]]
    got = whitened(table(spark, rows)).collect()
    assert len(got) == 42 * 3           # three dimensions, so three components
    assert sum(r["vec_id"] is None for r in got) == 3 and sum(r["vec_id"] == 7 for r in got) == 6
    check([r for r in got if r["vec_id"] not in (None, 7)], {i: integers(v) for i, v in enumerate(found)}, 3, skip=[7])
    one = whitened(table(spark, [(1, [1.0, 2.0], 1, "x", 2), (2, [1.0, 2.0], 1, "x", 2)]))
    assert one.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert one.count() == 0
    assert whitened(table(spark, [])).count() == 0
    with pytest.raises(Exception, match="too large"):
        whitened(table(spark, [(1, [1e30, 2.0], 1, "x", 2), (2, [1.0, 2.0], 1, "x", 2)])).collect()


def test_deviations_are_exact():
    x = np.array([[1 << 20, -5], [3, 4]])
    n, sums = 1 << 10, [1 << 30, 7]
    want = [sum((n * int(v) - s) ** 2 for v, s in zip(r, sums, strict=True)) for r in x]
    assert [int(v) for v in deviations(x, n, sums).to_pylist()] == want
    n, sums = 1 << 40, [(1 << 60) + 1, 7]
    want = [sum((n * int(v) - s) ** 2 for v, s in zip(r, sums, strict=True)) for r in x]
    assert max(want) > 1 << 64 and [int(v) for v in deviations(x, n, sums).to_pylist()] == want


def test_substitution_over_blocks(monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 3)
    rng = np.random.default_rng(3)
    r = [np.triu(rng.normal(size=(8, 8))) + 4 * np.eye(8) for _ in range(2)]
    rows = rng.normal(size=(5, 8))
    assert np.allclose(solved(rows, r), rows @ np.linalg.inv(r[0]) @ np.linalg.inv(r[1]))
