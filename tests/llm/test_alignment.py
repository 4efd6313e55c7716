"""Aligned tokens against the two libraries and plain loops."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from lakemart.llm import alignment
from lakemart.llm.alignment import Encoder, aligned, byte_level

A, B = (str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def tokens(texts):
    """For each text the (id, bytes) of its tokens by either library, or None."""
    one, two = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    of = byte_level()
    for text in texts:
        whole = (" " + (text or "")).encode()
        e = one.encode(" " + (text or ""), add_special_tokens=False)
        a = [(i, bytes(of[c] for c in t)) for i, t in zip(e.ids, e.tokens, strict=True)]
        b = []
        for i in two.encode(text or ""):
            p = two.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode()))
        good = text and all(b"".join(x[1] for x in t) == whole for t in (a, b))
        yield (a, b) if good else None


def brute(rows):
    """One (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) per row."""
    links, groups, out = [], [], []
    for found in tokens([t for _, t in rows]):
        linked, cut, ends = [], [], []
        for side in found or ((), ()):
            at, here = 0, {}
            for i, b in side:
                at += len(b)
                here.setdefault(at, []).append(i)
            ends.append(here)
        for e in sorted(ends[0].keys() & ends[1].keys()):
            linked += [(a, b) for a in ends[0][e] for b in ends[1][e]]
        waiting = [sorted(h.items()) for h in ends]
        for e in sorted(ends[0].keys() & ends[1].keys()):
            own = []
            for w in waiting:
                own.append([])
                while w and w[0][0] <= e:
                    own[-1] += w.pop(0)[1]
            cut.append("|".join(",".join(map(str, o)) for o in own))
        links.append(linked)
        groups.append(";".join(cut))
        out.append((len(found[0]), len(found[1])) if found else (0, 0))
    count = Counter(p for x in links for p in x)
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [(i, *out[k], groups[k].count(";") + (groups[k] != ""), len(links[k]),
             sum(count[p] == best[p[1]] for p in links[k]), sum(count[p] for p in links[k]), groups[k])
            for k, (i, _) in enumerate(rows)]


def key(row):
    return tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in row)


def odd_texts(n=150, seed=1):
    rng = random.Random(seed)
    parts = ["the", "Wort", "café", "  ", " ", "\t", "\n", "\r\n", "▁", " ", "<0x41>", "<s>", "</s>", "<unk>",
             "<|endoftext|>", "ﬁ", "é", "\U0001F600", "123", "4", "'s", "　", "漢字", "-", "\x00", "x" * 40]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 14))) for _ in range(n)]


@pytest.mark.parametrize("batch", [alignment.BATCH_BYTES, 300])
def test_against_libraries(spark, monkeypatch, batch):
    monkeypatch.setattr(alignment, "BATCH_BYTES", batch)
    rows = [(i, t) for i, t in enumerate([*odd_texts(), "one and two and one", "", None, " ", "  ", "x "])]
    want = brute(rows)
    assert any(r[1] for r in want) and not all(r[1] for r in want)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((tuple(r) for r in aligned(df, A, B).collect()), key=key) == sorted(want, key=key)
    for r, w in zip(sorted(aligned(df, A, B, digest=True).collect()), want, strict=True):
        assert r["groups"] == (hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "")


def test_parts_are_encoded_as_whole_texts():
    texts = odd_texts(2000, 7)
    for path in (A, B):
        coder = Encoder(path)
        assert coder.kind.parts
        ids, parent, _ = coder.tokens(texts)
        coder.kind.parts = False
        whole = [coder.kind.encode([" " + t])[0] if t != "" else [] for t in texts]
        assert [ids[parent == i].tolist() for i in range(len(texts))] == whole


def test_the_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(alignment, "CACHE_ENTRIES", 5)
    texts = odd_texts(30, 3)
    coder = Encoder(A)
    parts = [coder.tokens(texts[i:i + 4])[0].tolist() for i in range(0, 30, 4)]
    assert sum(parts, []) == Encoder(A).tokens(texts)[0].tolist()


def test_encoders_share_pieces(monkeypatch):
    for entries in (alignment.CACHE_ENTRIES, 40):
        monkeypatch.setattr(alignment, "CACHE_ENTRIES", entries)
        both, apart = alignment.Pieces(Encoder(A), Encoder(B)), [Encoder(A), Encoder(B)]
        texts = [*odd_texts(300, 5), "a1 " + "x1" * (1 << 16) + "\n b", "one \n two\n three\n ", "\n", "\t x"]
        for at in range(0, len(texts), 25):
            some = texts[at:at + 25]
            for got, coder in zip(both.tokens(some), apart, strict=True):
                whole = [coder.kind.encode([" " + t])[0] if t else [] for t in some]
                assert [got[0][got[1] == i].tolist() for i in range(len(some))] == whole


def test_frequent_pieces_stay_known(monkeypatch):
    monkeypatch.setattr(alignment, "CACHE_ENTRIES", 50)
    coder, seen = Encoder(A), Counter()
    encode = coder.kind.encode
    monkeypatch.setattr(coder.kind, "encode", lambda pieces: seen.update(pieces) or encode(pieces))
    for i in range(40):
        coder.tokens([f"the word{i}x{j} the" for j in range(10)])
    assert seen[" the"] == 1 and len(seen) == 401


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = aligned(odd_docs, A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(brute(rows), key=key)
    assert aligned(no_docs, A, B).count() == 0
