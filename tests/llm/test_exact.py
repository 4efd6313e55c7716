"""Exact duplicates: the coding, the exchange and the groups."""

import hashlib
import string

import numpy as np
import pytest

from lakemart.llm import exact_dedup
from lakemart.llm.exact_dedup import exact_duplicates, rice_decode, rice_encode

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_rice_round_trip(n):
    rng = np.random.default_rng(n)
    for span in (1 << 64, (1 << 64) // 12 + 1, 5000):
        values = np.unique(rng.integers(0, min(span, (1 << 64) - 1), n, dtype=np.uint64, endpoint=False))
        coded = rice_encode(values, span)
        assert rice_decode(coded, span).tolist() == values.tolist()
    if n == 1000:
        assert len(coded) < 8 * len(values) / 2          # gaps of a dense set take few bits


def want(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    out = []
    for i, t in rows:
        form = (t or "").translate(LOWER)
        keep = max(groups[form], key=lambda x: (x is not None, x or 0))
        out.append((i, keep, len(groups[form]), i == keep, hashlib.sha256(form.encode()).hexdigest()))
    return sorted(out, key=str)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert sorted((tuple(r) for r in exact_duplicates(odd_docs).collect()), key=str) == want(rows)
    assert exact_duplicates(no_docs).count() == 0


def test_many_blocks_and_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BLOCK_ROWS", 50)
    rows = [(i, "hot TEXT" if i % 3 == 0 else f"text {i % 400} É") for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert sorted((tuple(r) for r in exact_duplicates(df, owners=5).collect()), key=str) == want(rows)
