"""Token counts and BPE against the tokenizers library."""

import random
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakemart.llm import token_counts as tc
from lakemart.llm.token_counts import PieceCounter, pieces_of, token_counts
from lakemart.llm.trie_bpe import TrieBpe, bpe_round_trip

BYTES = str(public_tokenizers.path("byte_bpe_50k.json"))
WORDS = str(public_tokenizers.path("word_bpe_49k.json"))


def strings(n, seed=5):
    rng = random.Random(seed)
    alphabets = ["abcdefghijklmnopqrstuvwxyz   '.<|>123\n\t", "aàéÉÈßñÑ '\x85\xa0\x1c\x00xX",
                 "".join(map(chr, range(0x20, 0x2FF))),
                 "".join(chr(rng.choice([rng.randrange(0x20, 0xD7FF), rng.randrange(0xE000, 0x1FFFF)]))
                         for _ in range(400))]
    out = ["", " ", "\n\n", "a" * 5000, "ab1" * 40000]
    for _ in range(n):
        s = "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(80)))
        if rng.random() < 0.3:
            s = s[:10] + rng.choice(["<|endoftext|>", "<|startoftext|> ", "<|ENDOFTEXT|>", "don't I'LL 's"]) + s[10:]
        out.append(s)
    return out


def test_counts_are_the_librarys():
    texts = strings(3000)
    library = Tokenizer.from_file(BYTES)
    assert list(PieceCounter(BYTES).counts(texts)) == [
        len(e) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_pieces_are_the_text_and_long_ones_are_cut():
    text = "abc123" * 30000 + " end"
    assert "".join(pieces_of(text)) == text
    assert max(map(len, pieces_of(text))) < tc.LONG_PIECE


def test_trie_encoding_and_decoding_are_the_librarys():
    texts = strings(3000, seed=8)
    library = Tokenizer.from_file(WORDS)
    bpe = TrieBpe(WORDS)
    for (ids, decoded), e in zip(bpe.encode_texts(texts), library.encode_batch(texts, add_special_tokens=False),
                                 strict=True):
        assert list(array("I", ids)) == e.ids
        assert decoded == bpe.decode(ids) == library.decode(e.ids, skip_special_tokens=False)


def test_round_trip_of_ids():
    bpe = TrieBpe(WORDS)
    (ids, decoded), = bpe.encode_texts(["The quick brown fox, 42 times!"])
    (again, _), = bpe.encode_texts([decoded.replace("</w> ", " ").replace("</w>", " ")])
    assert again == ids


@pytest.mark.parametrize("operator,path", [(token_counts, BYTES), (bpe_round_trip, WORDS)])
def test_odd_rows(odd_docs, no_docs, operator, path):
    library = Tokenizer.from_file(path)
    rows = [(r["doc_id"], r["text"] or "") for r in odd_docs.collect()]
    want = sorted((i or -1, len(library.encode(t, add_special_tokens=False).ids)) for i, t in rows)
    got = operator(odd_docs, path).collect()
    size = (lambda r: r["n_tokens"]) if operator is token_counts else (lambda r: len(r["token_ids"]) // 4)
    assert sorted((r["doc_id"] or -1, size(r)) for r in got) == want
    assert operator(no_docs, path).count() == 0
