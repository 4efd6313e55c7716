"""Repeated words against a plain loop over all windows."""

import random
import re

import numpy as np
import pytest

from lakemart.llm import relative_lz
from lakemart.llm.relative_lz import LENGTH, Words, factored, merged, without_repeated_words

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows):
    """{id: (n_words, kept words, places of windows that start earlier)} of
    distinct (id, text) rows."""
    seen, out = {}, {}
    for doc, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        words = WORD.findall(text or "")
        gone, starts = set(), set()
        for i in range(len(words) - LENGTH + 1):
            if seen.setdefault(tuple(words[i:i + LENGTH]), (doc, i)) != (doc, i):
                gone.update(range(i, i + LENGTH))
                starts.add(i)
        out[doc] = (len(words), [w for i, w in enumerate(words) if i not in gone], starts)
    return out


def check(got, rows):
    want, texts = brute(rows), {i: WORD.findall(t or "") for i, t in rows}
    assert len(got) == len(rows)
    for r in got:
        n, kept, starts = want[r["doc_id"]]
        assert (r["n_words"], r["n_removed"], r["kept"]) == (n, n - len(kept), " ".join(kept))
        held = set()
        for f in r["factors"]:          # a factor is an earlier copy, and together they hold every window
            assert f["hi"] - f["lo"] >= LENGTH
            assert texts[r["doc_id"]][f["lo"]:f["hi"]] == texts[f["source"]][
                f["source_lo"]:f["source_lo"] + f["hi"] - f["lo"]]
            assert (f["source"] if f["source"] is not None else -1e99, f["source_lo"]) < (
                r["doc_id"] if r["doc_id"] is not None else -1e99, f["lo"])
            held.update(range(f["lo"], f["hi"] - LENGTH + 1))
        assert held == starts


def corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(1, 7))) for _ in range(200)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, other, line = prose(70), prose(45), prose(21)
    docs = []
    for i in range(90):
        kind = i % 9
        text = prose(rng.randrange(5, 90))
        if kind == 1:
            text = prose(20) + " " + passage + "\n" + prose(20)
        elif kind == 2:
            w = passage.split()
            w[rng.randrange(len(w))] = "changed"
            text = prose(5) + "\t" + "  ".join(w)
        elif kind == 3:
            text = f"{text}\n{line} {prose(1)}\n{line}"
        elif kind == 4:
            text = "abc " * 80 + text
        elif kind == 5:         # factors of two sources meet, and windows over their ends repeat as well
            text = passage + " " + other
        elif kind == 6:
            w = (passage + " " + other).split()
            a = rng.randrange(60)
            text = " ".join(w[a:a + 40]) + " é x y " + other
        docs.append((i * 3 - 30, text))
    return docs + [(5, docs[7][1]), (400, docs[7][1]), (500, "x " * 350), (501, ""), (502, "short"), (503, None),
                   (504, "y " * (LENGTH - 1)), (505, "y " * LENGTH), (506, "y " * (LENGTH + 1))]


@pytest.mark.parametrize("block,batch,busy", [(6 << 20, 6 << 20, 2048), (3000, 2000, 2048), (700, 1, 6), (6 << 20, 1, 0)])
def test_against_brute_force(spark, monkeypatch, block, batch, busy):
    for name, value in (("BLOCK_BYTES", block), ("BATCH_BYTES", batch), ("BUSY", busy),
                        ("PART_WINDOWS", 1 << 19 if block > 1 << 20 else 100)):
        monkeypatch.setattr(relative_lz, name, value)
    rows = corpus()
    random.Random(3).shuffle(rows)
    check(without_repeated_words(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect(), rows)


def test_equal_hashes_of_other_words(monkeypatch):
    """Where hashes say nothing, words decide."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(60))) for i in range(20)] + [(50, "a " * 70)]
    rows += [(30 + i, t) for i, t in rows[:3]]
    texts = [t.encode() for _, t in rows]
    words = Words(np.array([i for i, _ in rows]), np.zeros(len(rows), np.int64), b" ".join(texts),
                  ends=np.cumsum([len(t) + 1 for t in texts]))
    monkeypatch.setattr(Words, "run_hashes", lambda self, n: np.zeros(len(self) - n + 1, np.uint64))
    spans, new = factored(words)
    want = brute(rows)
    held = {i: set() for i in want}
    for doc, lo, hi, _, _ in spans.tolist():
        held[doc].update(range(lo, hi - LENGTH + 1))
    assert held == {i: w[2] for i, w in want.items()}
    assert len(new) == sum(max(w[0] - LENGTH + 1, 0) - len(w[2]) for w in want.values())


def test_a_common_passage_before_many_endings(spark, monkeypatch):
    """One anchor in every document: its windows are sent one by one."""
    monkeypatch.setattr(relative_lz, "BUSY", 50)
    monkeypatch.setattr(relative_lz, "BLOCK_BYTES", 4000)
    passage = " ".join(f"word{i}" for i in range(25))
    rows = [(i, f"{passage} {i} " + " ".join(f"{i}x{k}" for k in range(20))) for i in range(400)] + [(999, passage)]
    sizes = []
    monkeypatch.setattr(relative_lz, "_sent", lambda docs, busy, parts, f=relative_lz._sent: (
        sizes.append(len(busy)), f(docs, busy, parts))[1])
    check(without_repeated_words(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect(), rows)
    assert sizes[0] > 0


def test_factors_that_go_on_are_one():
    spans = np.array([(1, 12, 40, 7, 2), (1, 0, 31, 5, 10), (1, 11, 35, 5, 21), (1, 90, 110, 5, 21)], relative_lz.SPAN)
    assert merged(spans) == [[0, 35, 5, 10], [12, 40, 7, 2], [90, 110, 5, 21]]


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = without_repeated_words(odd_docs)
    assert got.columns == ["doc_id", "n_words", "n_removed", "factors", "kept"]
    check(got.collect(), rows)
    assert without_repeated_words(no_docs).count() == 0
