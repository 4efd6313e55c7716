"""Targets against resharing step by step, and the draws."""

import hashlib
import re

from lakemart.llm.mixing import mix, mixed


def targets(sizes):
    """{source: size} -> {source: target} by resharing the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    rest, live, out = float(sum(sizes.values())), set(names), {}
    while live:
        share = {s: rest * weight[s] / sum(weight[t] for t in live) for s in live}
        over = [s for s in live if share[s] > 3 * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = 3.0 * sizes[s]
            rest -= out[s]
            live.discard(s)
    return out


def check(df):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = targets(sizes)
    got = mixed(df).collect()
    assert len(got) == len(rows)
    for r in got:
        source, own = r["row"]["source"], r["size"]
        assert own == size(r["row"]["text"]) and r["source_size"] == sizes[source]
        assert abs(r["target"] - want[source]) < 1e-6
        rate = min(want[source] / sizes[source], 3) if sizes[source] else 0
        draw = int(hashlib.md5(str("" if r["row"]["doc_id"] is None else r["row"]["doc_id"]).encode())
                   .hexdigest()[:8], 16) / 2 ** 32
        assert r["copies"] == int(rate) + (draw < rate - int(rate)) <= 3
    return got


def test_odd_rows(odd_docs, no_docs):
    got = check(odd_docs)
    out = mix(odd_docs)
    assert out.columns == odd_docs.columns
    assert out.count() == sum(r["copies"] for r in got)
    assert mix(no_docs).count() == 0


def test_sources_over_their_limit(spark):
    rows = [(i, "w " * (1 + i % 7), s) for i, s in enumerate("a" * 3 + "b" * 2 + "c" * 400 + "d" * 5 + "e" * 90)]
    df = spark.createDataFrame([*rows, (999, "x y", None)], "doc_id long, text string, source string")
    check(df)


def test_taken_words_come_near_targets(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = mixed(df).selectExpr("row.source", "size * copies AS taken", "target") \
        .groupBy("source", "target").sum("taken").collect()
    assert all(abs(r["sum(taken)"] / r["target"] - 1) < 0.25 for r in rows)
    assert abs(sum(r["sum(taken)"] for r in rows) / sum(r["target"] for r in rows) - 1) < 0.03
