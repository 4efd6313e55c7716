"""Vector search against brute force."""

import math
import random

from lakemart.llm.vector_topk import exact_top_k


def brute(rows, k=5, every=50):
    vectors = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows
               if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, x in vectors:
        if q % every == 0:
            scores = {(-sum(a * b for a, b in zip(x, y)), c) for c, y in vectors if c != q}
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def got(df, **options):
    return sorted(tuple(r) for r in exact_top_k(df, **options).collect())


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(16)]) for i in range(700)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)]           # one vector many times
    rows += [(2000, [0.0] * 16), (2050, [0.5] * 16), (2051, [0.5] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert got(df) == brute(rows)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]),
            (None, [1.0, 1.0]), (50, [1.0, 2.0]), (50, [1.0, 2.0]), (7, [0.5]), (8, []), (100, [-1.0, 3.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                               "vec_id long, embedding array<double>, rank int, score string")
    assert got(df) == brute(rows)
    assert got(df.limit(0)) == []
    assert got(df.filter("vec_id = 0")) == []                     # no candidates


def test_large_components(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-4000, 4000) for _ in range(8)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(df, k=3) == brute(rows, k=3)
