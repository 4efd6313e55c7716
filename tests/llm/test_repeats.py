"""Removed repeats and the run-length index against brute force."""

import random

import numpy as np
import pytest

from lakemart.llm import repeats
from lakemart.llm.repeats import LENGTH, merged, without_repeats
from lakemart.llm.run_index import RunIndex, suffix_array


def brute(docs):
    """{id: (spans, kept)} of distinct (id, text) rows in order of id."""
    seen, out = set(), {}
    for doc, text in sorted(set(docs), key=lambda d: (d[0] is not None, d[0] or 0)):
        whole = text.encode()
        mask = bytearray(len(whole))
        for i in range(len(whole) - LENGTH + 1):
            window = whole[i:i + LENGTH]
            if window in seen:
                mask[i:i + LENGTH] = b"\1" * LENGTH
            seen.add(window)
        edge = np.flatnonzero(np.diff(np.concatenate(([0], np.frombuffer(bytes(mask), np.uint8), [0])).astype(int)))
        out[doc] = ([tuple(map(int, e)) for e in edge.reshape(-1, 2)],
                    bytes(b for b, m in zip(whole, mask, strict=True) if not m))
    return out


def test_suffix_array():
    rng = np.random.default_rng(3)
    text = np.append(rng.integers(1, 4, 300), 0)
    assert suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_matching_statistics():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 3, 60)
    texts = [base, np.concatenate((base[10:40], rng.integers(0, 3, 20))), rng.integers(0, 5, 30)]
    patterns = [np.concatenate((base[5:30], base[20:50])), rng.integers(0, 6, 25), base[::-1].copy(), base[:1]]
    index = RunIndex(texts)
    inside = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i, len(t) + 1)}
    for p, sizes in zip(patterns, index.matching_statistics(patterns), strict=True):
        want = [max(n for n in range(len(p) - i + 1) if tuple(p[i:i + n]) in inside) for i in range(len(p))]
        assert sizes.tolist() == want


def test_merged_spans():
    spans = np.array([(2, 0, 5), (1, 3, 9), (1, 9, 12), (1, 20, 21), (2, 4, 6), (1, 4, 5)], repeats.SPANS)
    assert merged(spans).tolist() == [(1, 3, 12), (1, 20, 21), (2, 0, 6)]


def corpus(seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, line = prose(60), "a line that stands in very many of the documents, longer than the anchor is, é"
    docs = []
    for i in range(60):
        kind = i % 6
        text = prose(60)
        if kind == 1:
            text = prose(20) + passage + prose(20)
        elif kind == 2:
            w = passage.split()
            w[rng.randrange(len(w))] = "changed"
            text = prose(5) + " ".join(w)
        elif kind == 3:
            text = text + "\n" + line + "\n" + prose(10) + "\n" + line
        elif kind == 4:
            text = "abc " * 80 + text
        docs.append((i * 3 - 30, text))
    return docs + [(5, docs[7][1]), (400, docs[7][1]), (500, "x" * 350), (501, ""), (502, "short")]


@pytest.mark.parametrize("many", [repeats.MANY, 2])
def test_against_brute_force(spark, monkeypatch, many):
    monkeypatch.setattr(repeats, "MANY", many)
    docs = corpus()
    want = brute(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for r in without_repeats(df).collect():
        spans, kept = want[r["doc_id"]]
        assert [(s["lo"], s["hi"]) for s in r["spans"]] == spans
        assert bytes(r["kept"]) == kept


def test_blocks_cut_long_texts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 1000)
    rng = random.Random(2)
    text = "".join(rng.choice("abcdef ") for _ in range(7000))
    docs = [(1, text), (2, text[500:6500]), (3, "q" + text[2999:3099])]
    want = brute(docs)
    for r in without_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        assert [(s["lo"], s["hi"]) for s in r["spans"]] == want[r["doc_id"]][0]


def test_odd_rows(odd_docs, no_docs):
    rows = odd_docs.collect()
    want = brute([(r["doc_id"], r["text"] or "") for r in rows])
    got = without_repeats(odd_docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert ([(s["lo"], s["hi"]) for s in r["spans"]], bytes(r["kept"])) == want[r["doc_id"]]
    assert without_repeats(no_docs).count() == 0


def test_suffixes_of_many_symbols():
    """Symbols beyond the 21 bits of a packed one sort as they are."""
    text = np.random.default_rng(4).choice([0, 1, 1 << 20, 1 << 21, (1 << 21) + 1, 1 << 22], 300)
    text = np.append(text, 1 << 23)
    assert suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
