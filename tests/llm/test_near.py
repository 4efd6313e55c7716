"""Near-duplicate documents, fuzzy lines and components against brute force."""

import os
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lakemart.llm import line_dedup, near
from lakemart.llm.common import staged
from lakemart.llm.components import components
from lakemart.llm.line_dedup import line_duplicates, line_signatures, normal, same_lines, without_duplicate_lines
from lakemart.llm.near_dedup import (Shingler, near_duplicates, prob_min_hash, probability_jaccard,
                                     same_documents, without_near_duplicates)


def classes(nodes, linked):
    """{node: smallest node of its component}."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if find(a) != find(b) and linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def prose(seed=1, groups=8):
    """Texts, and chains and stars of near copies of some."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randrange(2, 8))) for _ in range(500)]
    docs = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(120)]
        docs.append(" ".join(base))
        chain = base
        for j in range(6):
            one = list(base)
            one[rng.randrange(120)] = "edited%d" % j            # a star around the base
            docs.append(" ".join(one))
            chain = list(chain)
            chain[rng.randrange(120)] = "chained%d" % j         # a chain leading away from it
            docs.append(" ".join(chain))
    docs += [" ".join(rng.choice(words) for _ in range(60)) for _ in range(40)] + [docs[0]] * 30
    return docs


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    edges += [(200 + rng.randrange(30), 200 + rng.randrange(30)) for _ in range(25)]
    links = set(edges) | {(b, a) for a, b in edges}
    nodes = sorted({n for a, b in edges if a != b for n in (a, b)})
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == classes(nodes, lambda a, b: (a, b) in links)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_registers_agree_with_the_similarity():
    shingler = Shingler()
    docs = prose(groups=1)
    x, y = "rep rep rep rep rep rep " * 3 + docs[0], docs[1] + " rep" * 9
    for a, b in ((docs[0], docs[1]), (docs[0], docs[12]), (x, y)):
        sig = prob_min_hash([shingler.shingles(a), shingler.shingles(b)], 4096)
        exact = probability_jaccard(shingler.weighted(a), shingler.weighted(b))
        assert abs((sig[0] == sig[1]).mean() - exact) < 0.04


def test_probability_jaccard():
    x = (np.array([1, 2, 3], np.uint64), np.array([2, 1, 4]))
    y = (np.array([2, 3, 9], np.uint64), np.array([3, 4, 1]))
    p, q = {1: 2, 2: 1, 3: 4}, {2: 3, 3: 4, 9: 1}
    want = sum(1 / sum(max(p.get(t, 0) / p[s], q.get(t, 0) / q[s]) for t in {*p, *q}) for s in {*p} & {*q})
    assert abs(probability_jaccard(x, y) - want) < 1e-12
    assert probability_jaccard(x, (x[0], x[1] * 5)) == 1


def want_documents(rows):
    test, cache = same_documents(), {}
    texts = sorted({t for _, t in rows})

    def linked(a, b):
        return cache.setdefault((a, b), bool(a.strip() and b.strip()) and test(a, b))

    root = classes(texts, linked)
    members = defaultdict(list)
    for i, t in rows:
        members[root[t]].append(i)
    first = {r: min(m, key=lambda i: (i is not None, i or 0)) for r, m in members.items()}
    return {(i, t): (first[root[t]], len(members[root[t]])) for i, t in rows}


def test_documents(spark):
    rows = list(enumerate(prose(), 10))
    want = want_documents(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    text = dict(rows)
    got = near_duplicates(df).collect()
    assert {(r["doc_id"], text[r["doc_id"]]): (r["class_id"], r["class_size"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got)
    assert all((r["links"] > 0) <= (r["class_size"] > 1) for r in got)


def test_odd_documents(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"] or "") for r in odd_docs.collect()]
    want = want_documents(rows)
    got = near_duplicates(odd_docs).collect()
    assert sorted(map(str, ((r["doc_id"], r["class_id"], r["class_size"]) for r in got))) == \
        sorted(str((i, *want[i, t])) for i, t in rows)
    kept = without_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == len({want[r] + (want_documents(rows)[r][0],) for r in rows})
    assert near_duplicates(no_docs).count() == without_near_duplicates(no_docs).count() == 0


def want_lines(rows):
    """{id: removed line numbers} of distinct (id, text) rows."""
    rows = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    lines = [(i, n, normal(x)) for i, t in rows for n, x in enumerate(t.split("\n")) if normal(x)]
    root = classes(sorted({x for _, _, x in lines}), same_lines())
    first, gone = {}, defaultdict(list)
    for i, n, x in lines:
        if first.setdefault(root[x], (i, n)) != (i, n):
            gone[i].append(n)
    return gone


def line_docs(seed=6):
    rng = random.Random(seed)
    lines = prose(seed, groups=3)[:30]
    return [(i, "\n".join([rng.choice(lines)[:rng.choice((90, 400))], "own %d line %d" % (i, i * i), "",
                           rng.choice(lines), "Short"])) for i in range(25)]


def test_lines(spark):
    rows = line_docs()
    want = want_lines(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = line_duplicates(df).collect()
    assert {r["doc_id"]: r["removed"] for r in got} == {i: want[i] for i, _ in rows}
    assert all(r["n_removed"] == len(r["removed"]) and r["n_lines"] == 5 for r in got)
    left = {r["doc_id"]: r["text"] for r in without_duplicate_lines(df).collect()}
    assert left == {i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in want[i]) for i, t in rows}


def test_odd_lines(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"] or "") for r in odd_docs.collect()]
    want = want_lines(rows)
    got = line_duplicates(odd_docs).collect()
    assert sorted(map(str, ((r["doc_id"], r["removed"]) for r in got))) == sorted(str((i, want[i])) for i, _ in rows)
    out = without_duplicate_lines(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == len(rows)
    assert out.filter("text is null").count() == odd_docs.filter("text is null").count()
    assert line_duplicates(no_docs).count() == without_duplicate_lines(no_docs).count() == 0


def test_line_signatures():
    a = "the committee agreed to publish the yearly report in the second week of the month of june this year"
    sig = line_signatures([a, a, a.replace("june", "july"), "x", "unrelated words make up this other line here"], 64)
    assert (sig[0] == sig[1]).all() and 0.6 < (sig[0] == sig[2]).mean() < 1
    assert (sig[0] == sig[4]).mean() < 0.2 and len(set(sig[3])) == 1


def look_alikes(seed=5, members=200, planted=12):
    """Texts of one template, nearly all pairs just under 0.8, and copies of
    some of them with further edits, near to these (0.82 to 0.84) only."""
    rng = random.Random(seed)
    base = ["w%d" % rng.randrange(10 ** 6) for _ in range(400)]

    def edited(words, places, name):
        words = list(words)
        for at in places:
            words[at] = "%s%d" % (name, at)
        return words

    docs = [edited(base, rng.sample(range(10, 390, 10), 6), "own%dx" % i) for i in range(members)]
    docs += [edited(docs[7 * i], rng.sample(range(15, 385, 10), 7), "more%dx" % i) for i in range(planted)]
    return [" ".join(d) for d in docs]


def test_pairs_among_look_alikes(spark):
    rows = list(enumerate(look_alikes()))
    want = want_documents(rows)
    assert len(set(want.values())) > 100
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], rows[r["doc_id"]][1]): (r["class_id"], r["class_size"]) for r in got} == want


def test_agreeing_registers():
    rng = np.random.default_rng(4)
    for m in (2, 8, 34, 80):
        sig = rng.integers(0, 3, (12, m // 2), dtype=np.uint8) * 17
        words, registers = near._words(pa.array([x.tobytes() for x in sig], pa.binary()).slice(2))
        own = np.repeat(sig[2:], 2, axis=1)         # both halves of a byte are the same here
        assert registers == m
        assert (near._agreeing(words, words, m) == (own[:, None] == own).sum(axis=2)).all()


def test_chance_members_of_a_band_are_not_kept(spark):
    """Nodes that share band values but are unlike elsewhere; pairs among them are
    alike. All were kept before, and took texts and signatures through exchanges."""
    rng = np.random.default_rng(11)
    sig = rng.integers(0, 1 << 16, (400, 80), dtype=np.uint16)
    sig[1:20:2] = sig[0:20:2]
    sig[1:20:2, rng.choice(76, 12) + 4] += np.uint16(1)         # ten pairs that agree in 85 %
    sig[:, :4] = np.arange(100).repeat(4)[:, None]              # bands of four nodes
    signed = staged(spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sig)],
                                          "key long, sig binary"), "signed")
    tables = near.band_members(signed, 20, 4, line_dedup.CUT)
    assert len(tables) == near.SLICES
    nodes = [r["node"] for t in tables for r in t.collect()]
    assert set(range(20)) <= set(nodes) and len(set(nodes)) < 60
    members = [r for t in tables for r in t.collect()]
    assert len({(r["h"], r["node"]) for r in members}) == len(members)


def test_staged_tables_go_with_the_search(spark, monkeypatch):
    """Signatures and what only a step needs are gone when the search has ended."""
    made = []
    for module in (near, line_dedup):
        def kept(df, name, **options):
            out = staged(df, name, **options)
            made.append((name, out.staged_path))
            return out
        monkeypatch.setattr(module, "staged", kept)
    rows = line_docs()
    got = line_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    want = want_lines(rows)
    assert {r["doc_id"]: r["removed"] for r in got} == {i: want[i] for i, _ in rows}
    left = {name for name, path in made if os.path.exists(path.removeprefix("file:"))}
    assert {name for name, _ in made} > left
    assert not left & {"line-signatures", "band-members", "nodes", "candidate-texts", "waiting", "waiting-nodes"}


def test_bands_in_parts(spark, monkeypatch):
    """Pairs of bands of many parts: each node is near to one other only."""
    monkeypatch.setattr(near, "PART_NODES", 4)
    rng = random.Random(9)
    texts = {i: "%d %d" % (i // 2, rng.randrange(10 ** 6)) for i in range(300)}
    sig = {i: np.full(8, 7, np.uint16) for i in texts}
    for i in texts:
        sig[i][4:] = rng.choices(range(3), k=4)         # one band holds all; estimates say little
    signed = staged(spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in sig.items()],
                                          "key long, sig binary"), "signed")
    own = spark.createDataFrame(list(texts.items()), "key long, text string")
    got = near.near_components(signed, own, lambda: lambda a, b: a.split()[0] == b.split()[0],
                               bands=1, rows=4, cut=0.5).collect()
    assert {r["node"]: r["root"] for r in got} == {i: i - i % 2 for i in texts}


def test_edits_in_short_lines(spark):
    """One changed character in lines of 45 to 75, one changed word in 85 to 100."""
    rng = random.Random(12)
    rows = []
    for i in range(40):
        size = rng.randrange(45, 75) if i % 2 else rng.randrange(85, 100)
        line = list("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=size)))
        line[5::6] = " " * len(line[5::6])
        edited, at = list(line), 6 * rng.randrange(2, size // 6 - 2)
        edited[at:at + (1 if i % 2 else 5)] = "#" if i % 2 else "01234"
        rows += [(2 * i, "".join(line).strip()), (2 * i + 1, "".join(edited).strip())]
    got = line_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["n_removed"] for r in got} == {i: i % 2 for i, _ in rows}


def test_bands_of_lines_reach_the_recall():
    assert (1 - line_dedup.SIMILARITY ** line_dedup.ROWS) ** line_dedup.BANDS < 1e-4


def test_near_texts_that_are_no_links_are_not_written_as_pairs(spark, monkeypatch):
    """Copies of an absent text, alike to the cut but mostly under the threshold:
    pairs that go through the exchange grow with the texts, not with their square."""
    rng = random.Random(5)
    base = ["word%d" % i for i in range(200)]
    rows = []
    for i in range(200):
        one = list(base)
        for at in rng.sample(range(200), 3):
            one[at] = "other%d_%d" % (i, at)
        rows.append((i, " ".join(one)))
    sent, verified = [], near._verified
    monkeypatch.setattr(near, "_verified", lambda pairs, *rest: sent.append(pairs.count()) or verified(pairs, *rest))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want, text = want_documents(rows), dict(rows)
    assert {(r["doc_id"], text[r["doc_id"]]): (r["class_id"], r["class_size"]) for r in got} == want
    assert len(sent) == 2 and sum(sent) < 199 * 200 / 2 / 4


def test_long_lines_of_one_language_are_not_searched(spark, monkeypatch):
    """Lines that share a third to a half of their shingles, and two pairs of near ones:
    bands of four registers brought a tenth of them near others by chance."""
    rng = random.Random(21)
    parts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=2)) for _ in range(24)]
    lines = [" ".join("".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(150)) for _ in range(400)]
    lines += [lines[0].replace(lines[0].split()[9], "another"), lines[1].replace(lines[1].split()[5], "another")]
    searched = []

    def counted(df, name, **options):
        out = staged(df, name, **options)
        if name == "nodes":
            searched.append(out.count())
        return out

    monkeypatch.setattr(near, "staged", counted)
    got = line_duplicates(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got if r["n_removed"]} == {400, 401}
    assert 4 <= searched[0] < 20


def test_large_bands_lose_chance_members():
    """Bands of more nodes than are compared at once kept all of them."""
    rng = np.random.default_rng(2)
    sketch = rng.integers(0, 1 << 64, (3000, 2), dtype=np.uint64)
    sketch[2000:2600] = sketch[2600] ^ (np.uint64(1) << rng.integers(0, 64, (600, 2), dtype=np.uint64))
    sketch[1500] = sketch[700] ^ np.uint64(5)
    stay = near._with_partner(np.zeros(3000, np.uint64), sketch, 20, near.LARGEST)
    assert set(np.flatnonzero(stay)) == {700, 1500, *range(2000, 2601)}
    assert near._with_partner(np.zeros(50, np.uint64), sketch[:50], 20, 40).all()


def test_bands_of_the_same_nodes_are_searched_once(spark, monkeypatch):
    """A pair of near nodes shares most bands; each of them was searched."""
    made = {}

    def counted(df, name, **options):
        out = staged(df, name, **options)
        if name in ("band-members", "members"):
            rows = out.select("h", F.explode("nodes").alias("node")) if "nodes" in out.columns else out
            made.setdefault(name, []).extend((r["h"], r["node"]) for r in rows.collect())
        return out

    monkeypatch.setattr(near, "staged", counted)
    rng = np.random.default_rng(6)
    sig = rng.integers(0, 1 << 16, (60, 80), dtype=np.uint16)
    sig[1:40:2] = sig[0:40:2]
    sig[1:40:2, 40:44] += np.uint16(1)
    signed = staged(spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sig)],
                                          "key long, sig binary"), "signed")
    own = spark.createDataFrame([(i, str(i // 2)) for i in range(60)], "key long, text string")
    got = near.near_components(signed, own, lambda: lambda a, b: a == b, bands=20, rows=4, cut=0.66).collect()
    assert {r["node"]: r["root"] for r in got} == {i: i - i % 2 for i in range(40)}
    assert len(made["band-members"]) == 20 * 19 * 2 and len(made["members"]) == 40


def test_sets_of_bands(monkeypatch):
    monkeypatch.setattr(near, "PART_NODES", 4)
    bands = {5: [1, 2, 9], 6: list(range(10)), 7: [1, 2, 9], 8: [2, 9], 9: list(range(10))}
    h, node = (np.array(x, np.int64) for x in zip(*[(b, n) for b, nodes in bands.items() for n in nodes], strict=True))
    h, of, nodes = near._sets(h, node)
    assert [len(x) for x in nodes] == [3, 4, 4, 2, 3, 2, 4, 4, 2]
    assert h.tolist() == [5, 6, 6, 6, 7, 8, 9, 9, 9]
    assert of[0] == of[4] and len(set(of.tolist())) == 8
    assert near._sets(np.zeros(0, np.int64), np.zeros(0, np.int64))[2] == []
