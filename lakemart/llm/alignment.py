"""Alignment of two tokenizers' tokens over the same bytes, in Arrow.

A batch of texts is encoded by both. Token lengths, flattened over the lists of
tokens, become byte ends by a cumulative sum that starts anew with each
document; tokens of A and B that end together meet in a hash join on (document,
end). The joined rows are the links, and the places where a document's tokens
are cut into groups. A batch counts its pairs of ids with ``group_by``; Spark
merges the batches' counts and sends each batch the totals of its own pairs.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm.common import WHITE, staged, text_or_empty, use_package_on_workers
from lakemart.llm.token_counts import LONG_PIECE, pieces_of

#: Bytes of text aligned together, unless one text is longer.
BATCH_BYTES = 1 << 20
#: Known pieces per worker; beyond this, at most half of them stay: the most used.
CACHE_ENTRIES = 150_000

#: A row holds a batch: pages are ended by their size from the first row on, not
#: from the hundredth, since a reader holds whole pages outside the heap.
ROW_PAGES = {"parquet.page.size.row.check.min": "1"}

_SPACE = "▁"                       # a space in a sentencepiece piece (fixed value)
_BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")
_SPACED = re.compile(" +[^ ]*")
# Cut before a space that follows a non-white character: both kinds of tokenizers can be cut there.
_OTHER_WHITE = WHITE.replace(" ", "")
_PIECES = re.compile(f"[{WHITE}]*[^{WHITE}]+(?:[{_OTHER_WHITE}][{WHITE}]*(?:[^{WHITE}]+|\\Z))*|[{WHITE}]+")
_BLANK = frozenset(chr(c) for c in range(1 << 16) if re.match(f"[{WHITE}]", chr(c)))
#: New pieces encoded as one string; one that changes its text has them encoded apart.
RUN = 64
_PROBES = ("a  b\tc\n d ", "ﬁ café é  x ", " 　 ½", "don't 12,345.6 -- x_y")


def byte_level() -> dict[str, int]:
    """Character -> byte of byte-level tokens: visible Latin-1 characters stand
    for themselves, the other bytes, in order, for U+0100 onwards."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteTokenizer:
    """Byte-level BPE of a ``tokenizers`` file. Special tokens' strings inside a
    text are ordinary text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True
        of = byte_level()
        self.bytes: list[bytes | None] = [None] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.bytes[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        pre = self.tokenizer.pre_tokenizer
        pre = json.loads(pre.__getstate__()) if pre else {}
        self.parts = (self.tokenizer.normalizer is None and pre.get("type") == "ByteLevel"
                      and pre.get("use_regex", True))

    def whole(self, text: str) -> bool:
        return not self.parts

    def encode(self, pieces: list[str]) -> list[list[int]]:
        # a very long piece is cut further, where only this tokenizer can be cut
        cut = [pieces_of(p) if self.parts and len(p) > LONG_PIECE else [p] for p in pieces]
        found = self.tokenizer.encode_batch_fast(list(chain.from_iterable(cut)), add_special_tokens=False)
        if len(found) == len(pieces):
            return [e.ids for e in found]
        rest = iter(found)
        return [[i for e in islice(rest, len(c)) for i in e.ids] for c in cut]


class PieceTokenizer:
    """Sentencepiece model that puts a space before the text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(_BYTE_PIECE.fullmatch(p)[1], 16)]) if self.model.is_byte(i)
                      else p.replace(_SPACE, " ").encode() for i, p in enumerate(names)]
        self.space = self.model.piece_to_id(_SPACE)
        # no piece reaches over a space into the next word: words can be encoded apart
        self.parts = self.model.id_to_piece(self.space) == _SPACE and not any(
            _SPACE in p.lstrip(_SPACE) for p in names)
        self.parts = self.parts and all(
            sum(self.encode(_SPACED.findall(" " + t)), []) == self.model.encode(t) for t in _PROBES)

    def whole(self, text: str) -> bool:
        return not self.parts or _SPACE in text

    def encode(self, pieces: list[str]) -> list[list[int]]:
        # the model adds the first space again; a lone one (a text's end) is its own piece
        found = self.model.encode([p[1:] for p in pieces], num_threads=1)
        return [ids if p != " " else [self.space] for p, ids in zip(pieces, found, strict=True)]


def follows(piece: str) -> bool:
    """Whether the piece can stand before and after others like it."""
    return piece[0] == " " and piece[-1] not in _BLANK and _SPACE not in piece


class Encoder:
    """A tokenizer with the bytes of its tokens."""

    def __init__(self, path: str):
        self.kind = (PieceTokenizer if path.endswith(".model") else ByteTokenizer)(path)
        self.bytes = pa.array([b or b"" for b in self.kind.bytes], pa.binary())
        self.size = pc.binary_length(self.bytes).to_numpy().astype(np.int64)
        self.pieces = Pieces(self)

    def same_bytes(self, texts: pa.Array, ids: pa.ListArray) -> np.ndarray:
        """Whether each list of tokens has its text's bytes."""
        found = pc.binary_join(pa.ListArray.from_arrays(ids.offsets, self.bytes.take(ids.values)), b"")
        return pc.equal(found, texts.cast(pa.binary())).to_numpy(zero_copy_only=False)

    def encode(self, pieces: list[str]) -> pa.ListArray:
        """Tokens of each of the pieces. Those that begin with a space and end
        otherwise can follow each other in one string, whose tokens are dealt to
        them by their bytes; they come first."""
        kind = pa.list_(pa.int32())
        runs = next((i for i, p in enumerate(pieces) if not follows(p)), len(pieces)) // RUN * self.kind.parts
        each = lambda some: pa.array(self.kind.encode(some), kind)
        strings = ["".join(pieces[i * RUN:(i + 1) * RUN]) for i in range(runs)]
        lists = each(strings)
        good = self.same_bytes(pa.array(strings, pa.string()), lists)
        length = pc.binary_length(pa.array(pieces[:runs * RUN], pa.string())).to_numpy(zero_copy_only=False)
        while True:
            ids = lists.filter(pa.array(good)).flatten()
            ends = np.append(np.cumsum(self.size[ids.to_numpy()]), -1)
            edge = np.cumsum(length[np.repeat(good, RUN)])
            last = np.searchsorted(ends[:-1], edge)
            off = np.flatnonzero(ends[last] != edge)
            if not len(off):
                break
            good[np.flatnonzero(good)[off // RUN]] = False      # a token reaches over a piece's end
        dealt = pa.ListArray.from_arrays(pa.array(np.append(0, last + 1), pa.int32()), ids)
        apart = np.append(np.flatnonzero(np.repeat(~good, RUN)), np.arange(runs * RUN, len(pieces)))
        found = pa.concat_arrays([dealt.cast(kind), each([pieces[i] for i in apart])])
        place = np.argsort(np.append(np.flatnonzero(np.repeat(good, RUN)), apart))
        return found.take(pa.array(place))

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """See :meth:`Pieces.tokens`."""
        return self.pieces.tokens(texts)[0]


class Pieces:
    """Tokens of texts by several encoders. Texts are cut where all of them can
    be, once, and a distinct piece is encoded once by each while it is known.
    What is known of pieces is held as one run of ids, not as a list for each."""

    def __init__(self, *encoders: Encoder):
        self.encoders = encoders
        self.known: dict[str, int] = {}
        self.uses = np.zeros(0, np.int64)
        self.lists = [pa.array([], pa.list_(pa.int32())) for _ in encoders]
        self.odd = [np.zeros(0, bool) for _ in encoders]        # pieces whose tokens have other bytes

    def cut(self, text: str) -> list[str]:
        whole = " " + text
        return [whole] if any(e.kind.whole(text) for e in self.encoders) else _PIECES.findall(whole)

    def thin(self) -> None:
        """Of the pieces used again since they were learnt, the most used stay."""
        at = np.sort(np.argsort(-self.uses, kind="stable")[:CACHE_ENTRIES // 2])
        at = at[self.uses[at] > 1]
        names = list(self.known)
        self.known = {names[i]: n for n, i in enumerate(at)}
        self.uses = self.uses[at] >> 1
        self.lists = [x.take(pa.array(at)) for x in self.lists]
        self.odd = [x[at] for x in self.odd]

    def learn(self, pieces: list[str]) -> None:
        for at in range(0, len(pieces), 20_000):
            some = sorted(pieces[at:at + 20_000], key=follows, reverse=True)
            self.known.update(zip(some, range(len(self.known), len(self.known) + len(some)), strict=True))
            for i, e in enumerate(self.encoders):
                lists = e.encode(some)
                self.lists[i] = pa.concat_arrays([self.lists[i], lists])
                self.odd[i] = np.append(self.odd[i], ~e.same_bytes(pa.array(some, pa.string()), lists))
        self.uses = np.append(self.uses, np.zeros(len(pieces), np.int64))

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each encoder: ids of all texts in order, the text each belongs to,
        and for each text whether its tokens' bytes are those of space + text. An
        empty text has no tokens."""
        cut = [self.cut(t) if t else [] for t in texts]
        flat = list(chain.from_iterable(cut))
        if len(self.known) > CACHE_ENTRIES:
            self.thin()
        self.learn(list(set(flat).difference(self.known)))
        piece = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        self.uses += np.bincount(piece, minlength=len(self.uses))
        owner = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
        return [self.taken(e, lists, odd, piece, owner, texts)
                for e, lists, odd in zip(self.encoders, self.lists, self.odd, strict=True)]

    @staticmethod
    def taken(encoder: Encoder, lists: pa.ListArray, odd: np.ndarray, piece: np.ndarray, owner: np.ndarray,
              texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        taken = lists.take(pa.array(piece))
        ids = taken.flatten().to_numpy()
        parent = owner[pc.list_parent_indices(taken).to_numpy()]
        same = np.ones(len(texts), bool)
        for i in set(owner[odd[piece]].tolist()):
            own = pa.array([ids[slice(*np.searchsorted(parent, (i, i + 1)))]], taken.type)
            same[i] = encoder.same_bytes(pa.array([" " + texts[i]]), own)[0]
        return ids, parent, same


_known: dict[tuple[str, ...], Pieces] = {}


def known_pieces(*paths: str) -> Pieces:
    if paths not in _known:
        _known[paths] = Pieces(*map(Encoder, paths))
    return _known[paths]


def byte_ends(size: np.ndarray, parent: np.ndarray, documents: int) -> pa.Array:
    """Byte offset in its document at which each token ends."""
    total = pc.cumulative_sum(pa.array(size))
    first = np.searchsorted(parent, np.arange(documents))       # a document's first token
    before = np.append(0, total.to_numpy())[first]
    return pc.subtract(total, pa.array(before[parent]))


def _joined(ids: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, memoryview]:
    """Decimal ids, each followed by its separator, run together: where each
    begins in the bytes (and where the last ends), and the bytes."""
    kind = pa.large_string()
    marks = pa.array([",", "|", ";", ""], kind).take(pa.array(after))
    text = pc.binary_join_element_wise(pa.array(ids).cast(kind), marks, pa.scalar("", kind))
    _, offsets, data = text.buffers()
    return np.frombuffer(offsets, np.int64)[text.offset:][:len(text) + 1], memoryview(data)


def group_texts(a: np.ndarray, b: np.ndarray, doc_a: np.ndarray, doc_b: np.ndarray, last_a: np.ndarray,
                last_b: np.ndarray, documents: int) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each document from all tokens in order, and the
    places of the last A and the last B token of each group."""
    if not len(a):
        return [b""] * documents
    comma, bar, semicolon, nothing = range(4)
    ends_a, ends_b = (np.zeros(n, bool) for n in (len(a), len(b)))
    ends_a[last_a] = ends_b[last_b] = True
    # a group's A tokens come after the B tokens of the groups before, its B tokens after its A tokens
    group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    place_a = np.arange(len(a)) + np.append(0, last_b + 1)[group_a]
    place_b = np.arange(len(b)) + (last_a + 1)[group_b]
    ids, after = np.empty(len(a) + len(b), np.int32), np.empty(len(a) + len(b), np.int8)
    ids[place_a], ids[place_b] = a, b
    after[place_a] = np.where(ends_a, bar, comma)
    after[place_b] = np.where(np.append(np.diff(doc_b) != 0, True), nothing, np.where(ends_b, semicolon, comma))
    begin, whole = _joined(ids, after)
    edge = begin[sum(np.searchsorted(d, np.arange(documents + 1)) for d in (doc_a, doc_b))]
    return [bytes(whole[i:j]) for i, j in zip(edge[:-1], edge[1:], strict=True)]


def align(texts: list[str], pieces: Pieces) -> dict:
    """Tokens, groups and links of a batch of texts (see :func:`aligned`)."""
    first, second = pieces.encoders
    (ids_a, doc_a, same_a), (ids_b, doc_b, same_b) = pieces.tokens(texts)
    same = same_a & same_b
    if not same.all():
        ids_a, doc_a = ids_a[same[doc_a]], doc_a[same[doc_a]]
        ids_b, doc_b = ids_b[same[doc_b]], doc_b[same[doc_b]]
    side = lambda ids, doc, size, name: pa.table({
        "doc": doc.astype(np.int32), "end": byte_ends(size[ids], doc, len(texts)),
        name: ids, "at_" + name: np.arange(len(ids), dtype=np.int32)})
    links = side(ids_a, doc_a, first.size, "a").join(
        side(ids_b, doc_b, second.size, "b"), keys=["doc", "end"], join_type="inner",
        use_threads=False).combine_chunks()
    links = links.take(pa.array(np.argsort(links["at_a"].to_numpy())))
    pairs = links.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")]).sort_by(
        [("a", "ascending"), ("b", "ascending")])
    code = lambda t: t["a"].to_numpy().astype(np.int64) << 32 | t["b"].to_numpy()
    count = lambda doc: np.bincount(doc, minlength=len(texts))
    # tokens have bytes, so one link ends a group
    linked = count(links["doc"].to_numpy())
    return {"n_a": count(doc_a), "n_b": count(doc_b), "n_groups": linked, "n_links": linked,
            "links": np.searchsorted(code(pairs), code(links)).astype(np.int32),
            "pair_a": pairs["a"].to_numpy(), "pair_b": pairs["b"].to_numpy(), "pair_n": pairs["count_all"].to_numpy(),
            "groups": group_texts(ids_a, ids_b, doc_a, doc_b, links["at_a"].to_numpy(), links["at_b"].to_numpy(),
                                  len(texts))}


def _batches(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Stretches of rows of about BATCH_BYTES."""
    reach = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = reach[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(reach, before + BATCH_BYTES, "right")))
        yield at, to
        at = to


def _encoded(docs: DataFrame, first: str, second: str, digest: bool) -> DataFrame:
    """One row per batch: its documents, links and pair counts."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pieces, number = known_pieces(first, second), TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch.columns
            for at, to in _batches(texts):
                found = align(texts.slice(at, to - at).to_pylist(), pieces)
                groups = [g if not digest else hashlib.sha256(g).hexdigest().encode() if g else b""
                          for g in found["groups"]]
                values = [number, ids.slice(at, to - at),
                          *(found[c] for c in ("n_a", "n_b", "n_groups", "n_links")), groups,
                          found["links"].tobytes(), *(found[c] for c in ("pair_a", "pair_b", "pair_n"))]
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays([0, len(v)], v if isinstance(v, pa.Array) else pa.array(v, t.value_type))
                     .cast(t) if pa.types.is_list(t) else pa.array([v], t)
                     for v, t in zip(values, kinds, strict=True)], schema.names)
                number += 1
            del batch, ids, texts
        pa.default_memory_pool().release_unused()       # the worker stays while later stages run

    long, whole = T.LongType(), T.ArrayType(T.IntegerType())
    schema = T.StructType([
        T.StructField("batch", long), T.StructField("ids", T.ArrayType(docs.schema["id"].dataType)),
        *[T.StructField(c, T.ArrayType(long)) for c in ("n_a", "n_b", "n_groups", "n_links")],
        T.StructField("groups", T.ArrayType(T.StringType())), T.StructField("links", T.BinaryType()),
        T.StructField("pair_a", whole), T.StructField("pair_b", whole),
        T.StructField("pair_n", T.ArrayType(long))])
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(schema).types
    return docs.mapInArrow(encode, schema)


def pair_counts(encoded: DataFrame) -> DataFrame:
    """Rows (a, b, n): how many links of all documents hold the pair of ids."""
    return (encoded.select(F.inline(F.arrays_zip("pair_a", "pair_b", "pair_n")))
            .groupBy(F.col("pair_a").alias("a"), F.col("pair_b").alias("b")).agg(F.sum("pair_n").alias("n")))


def aligned(df: DataFrame, first: str, second: str, *, id_col: str = "doc_id", text_col: str = "text",
            digest: bool = False) -> DataFrame:
    """Rows ``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)``, one
    per row of ``df``.

    ``first`` (A) and ``second`` (B) are files that every executor can read: a
    byte-level BPE for ``tokenizers`` (.json; encodes space + text, special
    tokens' strings are ordinary text) or a ``sentencepiece`` model that adds the
    space itself (.model). Byte offsets where a token of A and one of B both end
    cut the tokens into groups, each such pair of tokens is a link. A link's
    count is how many links of all documents have its ids; ``n_best`` links have
    the highest count of their B id (ties included), ``count_sum`` adds the
    counts. ``groups`` is ``a1,a2|b1;a3|b2,b3`` or, with ``digest``, its SHA-256
    in hex.

    Texts that are null or empty, or whose tokens' bytes are not those of
    space + text, have no tokens: zeros and the empty string. Null and repeated
    ids keep their rows (each row's links count); other columns are not read; an
    empty table gives an empty result.
    """
    use_package_on_workers(df.sparkSession)
    docs = df.select(df[id_col].alias("id"), text_or_empty(text_col).alias("text"))
    encoded = staged(_encoded(docs, first, second, digest), "aligned", **ROW_PAGES)
    # a B id meets at most the ids of A: the window's groups are bounded by the vocabulary
    counted = pair_counts(encoded).withColumn(
        "best", F.col("n") == F.max("n").over(Window.partitionBy("b")))
    asked = (encoded.select("batch", F.posexplode(F.arrays_zip("pair_a", "pair_b")).alias("at", "pair"))
             .select("batch", "at", F.col("pair.pair_a").alias("a"), F.col("pair.pair_b").alias("b")))
    totals = (asked.join(counted, ["a", "b"]).groupBy("batch")
              .agg(F.collect_list(F.struct("at", "n", "best")).alias("totals")))
    kept = ("ids", "n_a", "n_b", "n_groups", "n_links", "groups", "links")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in (*kept, "totals")}
                links = np.frombuffer(row["links"].as_py(), np.int32)
                n, best = (np.zeros(1 + int(links.max(initial=-1)), np.int64) for _ in range(2))
                if row["totals"].is_valid:
                    found = row["totals"].values
                    at = found.field("at").to_numpy()
                    n[at] = found.field("n").to_numpy()
                    best[at] = found.field("best").to_numpy(zero_copy_only=False)
                edge = np.append(0, np.cumsum(row["n_links"].values.to_numpy()))
                over = lambda v: np.diff(np.append(0, np.cumsum(v[links]))[edge])
                yield pa.RecordBatch.from_arrays(
                    [*(row[c].values for c in kept[:5]), pa.array(over(best), pa.int64()),
                     pa.array(over(n), pa.int64()), row["groups"].values], schema.names)

    long = T.LongType()
    schema = T.StructType([
        T.StructField("id", docs.schema["id"].dataType),
        *[T.StructField(c, long) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
        T.StructField("groups", T.StringType())])
    return (encoded.select("batch", *kept).join(totals, "batch", "left").select(*kept, "totals")
            .mapInArrow(finish, schema).withColumnRenamed("id", id_col))
