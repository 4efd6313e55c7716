"""BPE encoding by prefix-sharing trie traversal, and decoding.

The distinct words of a batch are put into a trie and walked depth first. Each
trie node keeps the *last token* of the encoding of its prefix; a child's state
follows from its ancestors' states alone, so the encoding of a prefix shared by
many words is worked out once:

    the last token of prefix p is the one vocabulary token t ending p for which
    t is the only token, or the last token of the prefix before t and t stay
    apart, i.e. no merge joins them across their border.

The walk goes over the sorted words: two neighbours share their common prefix,
and the stack of states up to it is kept (the trie's nodes on the path).
"""

from __future__ import annotations

import gc
import json
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakemart.llm.common import WHITE, text_or_empty, use_package_on_workers

#: Cached chunks and token pairs per worker; a cache starts anew beyond this.
CACHE_ENTRIES = 300_000
#: Characters of text whose new words share one trie walk.
BATCH_CHARS = 4 << 20

_NEVER = 1 << 30
#: White space other than the space up to U+00FF (fixed values).
LATIN_SPACES = "\t\n\v\f\r\x85\xa0"


def byte_symbols() -> list[str]:
    """Printable stand-ins of the 256 bytes as byte-level BPE files use them:
    printable Latin-1 characters stand for themselves, the others follow from
    U+0100 on in byte order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 0x100
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


class TrieBpe:
    """Encoder and decoder for a ``tokenizers`` JSON file of the kind: NFC,
    white space and lower-case normalisation, a splitting pattern whose matches
    are the words, byte-level symbols, BPE with an end-of-word suffix."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if (model["type"], kinds, split["type"], level["type"]) != \
                ("BPE", ["NFC", "Replace", "Lowercase"], "Split", "ByteLevel"):
            raise ValueError(f"not a word-level BPE file of the supported kind: {path}")
        self.suffix = model["end_of_word_suffix"] or ""
        library = Tokenizer.from_file(path)
        self.normalizer = library.normalizer
        self.word_splitter = library.pre_tokenizer
        # White_Space as the file's library has it: without U+001C..U+001F
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"\s", WHITE)).findall
        self.byte_char = byte_symbols()
        self.vocab: dict[str, int] = model["vocab"]
        self.text_of = {i: t for t, i in self.vocab.items()}
        specials = spec["added_tokens"]
        self.special = {t["content"]: t["id"] for t in specials}
        self.text_of |= {t["id"]: t["content"] for t in specials}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.merge_rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            left, right, whole = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.merge_rank.setdefault((left, right), rank)
            self.parts.setdefault(whole, (left, right, rank))
        self.inner, self.final = self._reachable()
        self.apart: dict[int, bool] = {}
        # chunk -> packed ids, decoded text
        self.ids = {t: i.to_bytes(4, "little") for t, i in self.special.items()}
        self.texts = {t: t for t in self.special}

    # -- vocabulary ---------------------------------------------------------

    def _reachable(self) -> tuple[dict[str, int], dict[str, int]]:
        """Tokens that the merges can give, as inner and as word-final pieces
        (suffix taken off). A single symbol always is one; a merged token is
        when its two parts are and nothing joins their border earlier."""
        ok: dict[int, bool] = {}

        def good(t: int) -> bool:
            if t not in ok:
                if t not in self.parts:
                    ok[t] = True
                else:
                    left, right, rank = self.parts[t]
                    ok[t] = good(left) and good(right) and not self._joined(left, right, rank)
            return ok[t]

        inner, final = {}, {}
        special = set(self.special)
        for text, i in self.vocab.items():
            if text in special or not good(i):
                continue
            if self.suffix and text.endswith(self.suffix) and text != self.suffix:
                final[text[:-len(self.suffix)]] = i
            else:
                inner[text] = i
        return (inner, final) if self.suffix else (inner, inner)

    def _joined(self, left: int, right: int, before: int = _NEVER) -> bool:
        """Whether a merge of rank under ``before`` joins the border of the two
        tokens. A piece of ``left`` ending at the border is there until its
        parent forms, likewise for ``right``; of equal merges the leftmost goes
        first."""
        rank = self.merge_rank.get
        x, x_until = left, before
        while True:
            y, y_until = right, before
            while True:
                r = rank((x, y), _NEVER)
                if r < x_until and (r < y_until or r == y_until != before):
                    return True
                if y not in self.parts:
                    break
                y, _, y_until = self.parts[y]
            if x not in self.parts:
                return False
            _, x, x_until = self.parts[x]

    # -- trie walk ----------------------------------------------------------

    def encode_words(self, words: set[str]) -> dict[str, list[int]]:
        """Token ids of distinct ``words`` (byte-level symbols), by one depth
        first walk over their trie."""
        out: dict[str, list[int]] = {}
        if len(self.apart) > CACHE_ENTRIES:
            self.apart.clear()
        apart, inner, final = self.apart, self.inner.get, self.final.get
        start: list[int] = [0]      # start[i], last[i]: last token of the path's prefix i
        last: list[int] = [-1]
        path = ""
        for word in sorted(words):
            size = len(word)
            keep = 0
            for a, b in zip(path, word):
                if a != b:
                    break
                keep += 1
            keep = min(keep, len(last) - 1, size - 1)
            del start[keep + 1:], last[keep + 1:]
            path = word
            for end in range(keep + 1, size + 1):
                tokens = inner if end < size else final
                j = end - 1
                while j >= 0:
                    t = tokens(word[j:end])
                    if t is not None:
                        if j == 0:
                            break
                        before = last[j]
                        key = before << 20 | t
                        fits = apart.get(key)
                        if fits is None:
                            fits = apart[key] = not self._joined(before, t)
                        if fits:
                            break
                    j -= 1
                else:
                    raise ValueError(f"no encoding for {word[:end]!r}")  # symbols outside the vocabulary
                if end < size:
                    start.append(j)
                    last.append(t)
            ids = [t]
            while j > 0:
                ids.append(last[j])
                j = start[j]
            ids.reverse()
            out[word] = ids
        return out

    # -- texts --------------------------------------------------------------

    def chunks_of(self, text: str) -> list[str]:
        """Stretches without white space of the normalised text. Texts of
        Latin-1 characters are composed already, so lower-casing is all their
        stretches need."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            text = self.normalizer.normalize_str(text)
        else:
            text = text.lower()
            for c in LATIN_SPACES:
                text = text.replace(c, " ")
        return [c for c in text.split(" ") if c]

    def _words_of(self, chunk: str) -> list[str]:
        """The words of a chunk in byte-level symbols."""
        if chunk.isascii() and chunk.isprintable():
            return self.words(chunk)
        if max(chunk) <= "\xff":
            return ["".join([self.byte_char[b] for b in w.encode()]) for w in self.words(chunk)]
        # letter and number classes as the library's own Unicode tables have them
        return [w for w, _ in self.word_splitter.pre_tokenize_str(chunk)]

    def _learn(self, chunks: set[str]) -> None:
        """Put chunks into the cache: their packed ids and decoded text."""
        text_of = self.text_of
        split: dict[str, list[str]] = {}
        words: set[str] = set()
        for chunk in chunks:
            if chunk.isascii() and chunk.isalpha():
                words.add(chunk)
                continue
            found = self._words_of(chunk)
            split[chunk] = found
            words.update(found)
        coded = {w: (array("I", ids).tobytes(), " ".join([text_of[i] for i in ids]))
                 for w, ids in self.encode_words(words).items()}
        for chunk in chunks:
            if chunk not in split:
                self.ids[chunk], self.texts[chunk] = coded[chunk]
            else:
                found = [coded[w] for w in split[chunk]]
                self.ids[chunk] = b"".join([i for i, _ in found])
                self.texts[chunk] = " ".join([t for _, t in found])

    def encode_texts(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """For each whole text its ids as little-endian unsigned 32-bit
        integers, and the text they decode to."""
        if len(self.ids) > CACHE_ENTRIES:
            self.ids.clear()
            self.texts.clear()
            for token, i in self.special.items():
                self.ids[token], self.texts[token] = i.to_bytes(4, "little"), token
        cut: list[list[str]] = []
        for text in texts:
            if "<|" not in text:
                cut.append(self.chunks_of(text))
            else:
                cut.append([c for s in self.special_split.split(text)
                            for c in ((s,) if s in self.special else self.shielded(s))])
        known = self.ids
        self._learn({c for chunks in cut for c in chunks if c not in known})
        ids, out = self.ids.__getitem__, self.texts.__getitem__
        return [(b"".join(map(ids, c)), " ".join(map(out, c))) for c in cut]

    def shielded(self, text: str) -> list[str]:
        """The chunks of a text between special tokens. Lower-casing can give a
        chunk that reads like a special token but is none: such a chunk takes a
        leading space, which no special token has, as its cache key."""
        return [f" {c}" if c in self.special else c for c in self.chunks_of(text)]

    def decode(self, ids: bytes) -> str:
        """The text of packed ids: a file without a decoder joins its tokens
        with one space, special ones too."""
        return " ".join([self.text_of[i] for i in array("I", ids)])


_encoders: dict[str, TrieBpe] = {}


def encoder(path: str) -> TrieBpe:
    if path not in _encoders:
        _encoders[path] = TrieBpe(path)
    return _encoders[path]


def _grouped(texts: Iterator[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= BATCH_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def bpe_round_trip(df: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Rows ``(id, token_ids binary, decoded string)``, one per row of ``df``.

    ``token_ids`` holds the ids of the whole text as packed little-endian
    unsigned 32-bit integers, ``decoded`` what those ids decode to with special
    tokens kept. No special tokens are added; strings of special tokens inside
    a text become them, as the library's default has it.

    Null texts count as empty (no ids, empty decoded text); null and repeated
    ids are kept; other columns of ``df`` are not read; an empty table gives an
    empty result.
    """
    use_package_on_workers(df.sparkSession)
    rows = df.select(df[id_col].alias("id"), text_or_empty(text_col).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # many cached strings, no cycles: collections would only rescan them
        try:
            bpe = encoder(tokenizer_path)
            for batch in batches:
                at = 0
                ids = batch.column(0)
                for group in _grouped(t.as_py() for t in batch.column(1)):
                    coded = bpe.encode_texts(group)
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(at, len(group)), pa.array([i for i, _ in coded], pa.binary()),
                         pa.array([t for _, t in coded], pa.string())],
                        ["id", "token_ids", "decoded"])
                    at += len(group)
        finally:
            gc.enable()

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType),
                           T.StructField("token_ids", T.BinaryType()),
                           T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(encode, schema).withColumnRenamed("id", id_col)
