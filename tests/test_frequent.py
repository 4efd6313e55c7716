"""Most frequent values against full counts."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.operators.frequent import Summary, frequent_values


def brute(rows, columns, k):
    out = []
    for i, c in enumerate(columns):
        n = Counter(r[i] for r in rows)
        best = sorted(n, key=lambda v: (-n[v], v is not None, v or ""))[:k]
        out += [(c, j, v, n[v]) for j, v in enumerate(best, start=1)]
    return sorted(out, key=str)


def found(df, *args, **kw):
    return sorted(map(tuple, frequent_values(df, *args, **kw).collect()), key=str)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([None, *"abcdefgh"]), max_size=30), max_size=6), st.integers(1, 6))
def test_summary_bounds(batches, capacity):
    s = Summary(capacity)
    for b in batches:
        s.add(pa.array(b, pa.string()))
    true = Counter(v for b in batches for v in b)
    kept = dict(zip(s.values.to_pylist(), s.counts.tolist(), strict=True))
    assert len(kept) <= capacity and s.lost * (capacity + 1) <= sum(true.values())
    for v, n in true.items():
        assert kept.get(v, 0) <= n <= kept.get(v, 0) + s.lost


@pytest.mark.parametrize("capacity", [2, 8, None])
def test_equal_to_full_counts(spark, capacity):
    rng = np.random.default_rng(5)
    heavy = [f"v{x}" for x in rng.zipf(1.5, 3000)]
    columns = ["heavy", "odd.name`x", "at", "value"]
    rows = [(heavy[i], None if i % 3 == 0 else str(i % 5), str(i), "only") for i in range(3000)]
    df = spark.createDataFrame(rows, "heavy string, `odd.name``x` string, at string, value string").repartition(6)
    assert found(df, k=4, capacity=capacity) == brute(rows, columns, 4)


def test_ties_empty_and_types(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 1.5), (2, 1.5), (3, 0.5)], "a int, b double")
    assert found(df, k=2) == sorted([("a", 1, "1", 2), ("a", 2, "2", 2), ("b", 1, None, 2), ("b", 2, "1.5", 2)], key=str)
    assert found(df.where("a > 9"), k=2) == []
    with pytest.raises(ValueError):
        frequent_values(df, k=0)
