"""Substring deduplication by relative Lempel-Ziv parsing, over words.

Documents are factored greedily against indexed reference blocks: at a place
whose next LENGTH words also start earlier in the block, a factor runs from that
earliest source as far as the words agree; then the parse goes on with the
windows over the factor's end, whose words no single factor holds. Words under a
factor are repeats.

1. Tasks factor the documents of a block (a few megabytes of text) against the
   block itself. Windows that start no factor are new to the block.
2. New windows go to reference blocks over all documents. A window's place is its
   *anchor*: of its runs of GRAM words the one with the smallest hash, so equal
   windows are sent to one block. Neighbouring windows of one anchor travel
   together as a segment. A block indexes all that it was sent and factors every
   segment against it.
3. Anchors with very many windows (a common passage before different endings)
   would fill one block: their windows are sent one by one, by their own hash.
4. A document's factors are joined with its words.

Hashes only say where to look: words are compared before a factor is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm.common import staged, text_or_empty, use_package_on_workers
from lakemart.llm.near import mix
from lakemart.llm.repeats import _packed, _sliding_min, unpack

LENGTH = 20                    # words of a window
GRAM = 3                       # words of an anchor
#: Bytes of text factored together before anything is sent.
BLOCK_BYTES = 6 << 20
#: Bytes of sent words that are indexed together, if one part is not more.
BATCH_BYTES = 6 << 20
#: Windows new to their blocks for each reference block, about.
PART_WINDOWS = 1 << 19
#: An anchor is busy from so many windows new to their blocks on, ...
BUSY = 2048
#: ... and from this fraction of all of them on: so at most 2 ** 20 anchors are.
BUSY_SHARE = 1 << 20

_FIRST = -(1 << 63)            # the id that null stands for: before any other
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True

SPAN = np.dtype([("doc", "<i8"), ("lo", "<i4"), ("hi", "<i4"), ("source", "<i8"), ("source_lo", "<i4")])


# -- words --------------------------------------------------------------------

def _word_hashes(words: pa.LargeBinaryArray) -> np.ndarray:
    """A 64-bit hash of each word: the sum of its mixed (place, byte) pairs."""
    _, offsets, letters = words.buffers()
    edge = np.frombuffer(offsets, np.int64)[words.offset:][:len(words) + 1]
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(letters, np.uint8)[edge[0]:edge[-1]].astype(np.uint64)
    place = np.arange(len(data)) - np.repeat(edge[:-1] - edge[0], np.diff(edge))
    return mix(np.add.reduceat(mix(data + (place.astype(np.uint64) << np.uint64(8))), edge[:-1] - edge[0]))


class Words:
    """Words of several pieces of documents: ``ids`` in the block's own numbering
    (equal ids are equal words), 64-bit ``hashes`` that all blocks agree on, and
    for each word the piece it is in and its number in the document."""

    def __init__(self, doc: np.ndarray, lo: np.ndarray, texts: bytes, size: np.ndarray | None = None,
                 ends: np.ndarray | None = None):
        """Either pieces of ``size`` words, or pieces that end at bytes ``ends``."""
        data = np.frombuffer(texts, np.uint8)
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~_WHITE[data]
        edge = np.diff(inside)
        starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.piece = (np.repeat(np.arange(len(doc)), size) if size is not None
                      else np.searchsorted(ends, starts, "right"))
        offsets = np.append(0, np.cumsum(stops - starts))
        letters = data[inside[1:-1].view(bool)]
        coded = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
        self.values = coded.dictionary
        self.ids = coded.indices.to_numpy()
        self.hashes = _word_hashes(self.values)[self.ids]
        self.piece = self.piece.astype(np.int32)
        first = np.searchsorted(self.piece, np.arange(len(doc), dtype=np.int32)).astype(np.int32)
        self.stop = np.append(first[1:], np.int32(len(starts)))[self.piece] if len(doc) else first  # a piece's end
        self.docs = doc
        # each piece begins after the windows of the one before: words are in order of (document, word)
        windows = np.maximum(np.append(first[1:], len(starts)) - first - LENGTH + 1, 0)
        self.sorted = bool(np.all((doc[1:] > doc[:-1]) | ((doc[1:] == doc[:-1]) & (lo[1:] >= (lo + windows)[:-1]))))
        self.place = (lo - first).astype(np.int32)[self.piece] + np.arange(len(starts), dtype=np.int32)

    def __len__(self) -> int:
        return len(self.ids)

    def doc(self, at: np.ndarray) -> np.ndarray:
        return self.docs[self.piece[at]]

    def run_hashes(self, n: int) -> np.ndarray:
        """Hashes of all runs of ``n`` words."""
        h, width, out, done = mix(self.hashes), 1, None, 0
        while True:
            if n & width:
                part = h[done:]
                out = part if out is None else out[:len(part)] * np.uint64(0x9E3779B97F4A7C15) + mix(part)
                done += width
            if done == n:
                return mix(out)
            h = h[:-width] * np.uint64(0xC2B2AE3D27D4EB4F) + mix(h[width:]) if len(h) > width else h[:0]
            width *= 2

    def windows(self) -> np.ndarray:
        """Words at which a window starts."""
        at = np.arange(max(len(self) - LENGTH + 1, 0))
        return at[at + LENGTH <= self.stop[:len(at)]]

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the windows at ``a`` and ``b`` have the same words."""
        out = np.ones(len(a), bool)
        left = np.arange(len(a))
        for k in range(LENGTH):
            left = left[self.ids[a[left] + k] == self.ids[b[left] + k]]
        out[:] = False
        out[left] = True
        return out


def sources(words: Words, at: np.ndarray, h: np.ndarray) -> np.ndarray:
    """For the windows at ``at`` with hashes ``h`` the first place, in order of
    (document, word), of a window with the same words."""
    order = (np.argsort(h, kind="stable") if words.sorted and (np.diff(at) > 0).all()
             else np.lexsort((words.place[at], words.doc(at), h)))
    out, at, h = at.copy(), at[order], h[order]
    pending = np.arange(len(at))
    while len(pending):
        own = h[pending]
        new = np.concatenate(([True], own[1:] != own[:-1]))
        lead = pending[np.flatnonzero(new)[np.cumsum(new) - 1]]
        check = np.flatnonzero(~new)
        equal = words.same(at[pending[check]], at[lead[check]])
        out[order[pending[check[equal]]]] = at[lead[check[equal]]]
        pending = pending[check[~equal]]        # one hash, other words: among themselves again
    return out


def factored(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Greedy factors (SPAN) of the pieces against the block, each from the
    earliest source of its first window, and the places of the windows that
    start nowhere earlier in the block."""
    at = words.windows()
    source = sources(words, at, words.run_hashes(LENGTH)[at])
    place, own, other = words.place, words.doc(at), words.doc(source)
    earlier = (other < own) | ((other == own) & (place[source] < place[at]))
    hits, found, own, other = at[earlier], source[earlier], own[earlier], other[earlier]
    spans, i, ids, stop = [], 0, words.ids, words.stop
    while i < len(hits):
        p, s = int(hits[i]), int(found[i])
        most, n, step = int(min(stop[p] - p, stop[s] - s)), LENGTH, 64
        while n < most:
            to = min(n + step, most)
            differ = np.flatnonzero(ids[p + n:p + to] != ids[s + n:s + to])
            if len(differ):
                n += int(differ[0])
                break
            n, step = to, step * 4
        spans.append((own[i], place[p], place[p] + n, other[i], place[s]))
        # windows inside the factor are done; those over its end are looked up
        i = int(np.searchsorted(hits, p + n - LENGTH + 1))
    return np.array(spans, SPAN), at[~earlier]


def merged(spans: np.ndarray) -> list[list[int]]:
    """A document's factors in order as (lo, hi, source, source_lo); those that go
    on from one source, one word for one word, are joined."""
    spans = spans[np.lexsort((spans["hi"], spans["lo"]))]
    out: list[list[int]] = []
    for _, lo, hi, source, source_lo in spans.tolist():
        last = out[-1] if out else None
        if last and lo <= last[1] and source == last[2] and source_lo - lo == last[3] - last[0]:
            last[1] = max(last[1], hi)
        else:
            out.append([lo, hi, source, source_lo])
    return out


# -- blocks -------------------------------------------------------------------

def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """Words of about BLOCK_BYTES of text; a longer text is cut into pieces that
    share LENGTH - 1 words."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def block() -> Words:
        doc, lo, texts = zip(*sorted(held, key=lambda p: p[:2]), strict=True)
        ends = np.cumsum([len(t) + 1 for t in texts])
        return Words(np.array(doc, np.int64), np.array(lo, np.int64), b" ".join(texts), ends=ends)

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            whole = text.as_buffer().to_pybytes()
            pieces = [(doc, 0, whole)]
            if len(whole) > BLOCK_BYTES:
                all_words, step = whole.split(), max(BLOCK_BYTES // 8, 1)
                pieces = [(doc, k, b" ".join(all_words[k:k + step + LENGTH - 1]))
                          for k in range(0, max(len(all_words) - LENGTH + 1, 1), step)]
            for piece in pieces:
                if held and size + len(piece[2]) > BLOCK_BYTES:
                    yield block()
                    held, size = [], 0
                held.append(piece)
                size += len(piece[2])
    if held:
        yield block()


def anchors(words: Words, at: np.ndarray) -> np.ndarray:
    """Word at which the anchor of each window starts."""
    grams = words.run_hashes(GRAM)
    if len(grams) <= LENGTH - GRAM:
        return np.zeros(0, np.int64)
    low = np.uint64((1 << max(len(grams).bit_length(), 1)) - 1)     # leftmost of equals
    order = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    return (_sliding_min(order, LENGTH - GRAM + 1) & low).astype(np.int64)[at]


def _busy(docs: DataFrame, owners: int) -> tuple[np.ndarray, int]:
    """Hashes of the anchors with very many windows, sorted: more than BUSY and
    more than a BUSY_SHARE-th of all windows that are new to their block, so at
    most BUSY_SHARE of them, whatever the documents; and the number of all."""
    entry = np.dtype([("anchor", "<u8"), ("n", "<u4")])
    width = (1 << 64) // owners + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _blocks(batches):
            at = words.windows()
            if not len(at):
                continue
            _, new = np.unique(words.run_hashes(LENGTH)[at], return_index=True)
            anchor, n = np.unique(words.run_hashes(GRAM)[anchors(words, at[new])], return_counts=True)
            rows = np.zeros(len(anchor), entry)
            rows["anchor"], rows["n"] = anchor, n
            cuts = np.searchsorted(anchor // np.uint64(width), np.arange(owners + 1))
            full = np.flatnonzero(np.diff(cuts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()),
                 pa.array([rows[cuts[k]:cuts[k + 1]].tobytes() for k in full], pa.binary())], ["owner", "counts"])

    def add(key, frame):
        import pandas as pd

        rows = np.concatenate([np.frombuffer(c, entry) for c in frame["counts"]])
        anchor, which = np.unique(rows["anchor"], return_inverse=True)
        n = np.bincount(which, rows["n"]).astype(np.int64)
        many = n > BUSY
        return pd.DataFrame({"anchor": np.append(anchor[many].view(np.int64), 0),
                             "n": np.append(n[many], 0), "total": np.append(np.zeros(many.sum(), np.int64), n.sum())})

    found = staged(docs.mapInArrow(count, "owner int, counts binary").groupBy("owner")
                   .applyInPandas(add, "anchor bigint, n bigint, total bigint"), "anchors")
    total = found.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    rows = found.filter((F.col("n") > BUSY) & (F.col("n") > total // BUSY_SHARE)).select("anchor").collect()
    return np.sort(np.array([r["anchor"] for r in rows], np.int64).view(np.uint64)), total


def _sent(docs: DataFrame, busy: np.ndarray, parts: int) -> DataFrame:
    """(part, doc, lo, size, raw, words, spans): segments of windows new to a block
    by the reference block they go to (arrays as bytes, words compressed from raw
    bytes), and with one of these the block's own factors."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 3)
        for words in _blocks(batches):
            spans, at = factored(words)
            if not len(at):
                if len(spans):
                    yield rows([0], [b""], [b""], [b""], [0], [b""], [spans.tobytes()])
                continue
            where = anchors(words, at)
            home = words.run_hashes(GRAM)[where]
            alone = np.isin(home, busy)
            home[alone] = words.run_hashes(LENGTH)[at[alone]]
            new = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(where) != 0) | alone[1:] | alone[:-1]
                                  | (np.diff(words.piece[at]) != 0)))
            first = np.flatnonzero(new)
            lo, size = at[first], np.diff(np.append(first, len(at))) + LENGTH - 1
            part = (mix(home[first]) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            lo, size, part = lo[order], size[order], part[order]
            ends = np.cumsum(size)
            each = np.arange(ends[-1]) - np.repeat(ends - size - lo, size)
            spaced = pc.binary_join_element_wise(words.values, pa.scalar(b" ", pa.large_binary()),
                                                 pa.scalar(b"", pa.large_binary()))
            text = spaced.take(pa.array(words.ids[each]))
            offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:]
            letters = memoryview(text.buffers()[2])
            cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
            edge = offsets[np.append(0, ends)[cuts]]
            cut = lambda v: [v[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
            yield rows(part[cuts[:-1]], cut(words.doc(lo)), cut(words.place[lo]),
                       cut(size.astype(np.int32)), np.diff(edge),
                       [codec.compress(letters[i:j], asbytes=True) for i, j in zip(edge[:-1], edge[1:], strict=True)],
                       [spans.tobytes()] + [b""] * (len(cuts) - 2))

    def rows(*columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int32() if n in ("part", "raw") else pa.binary())
             for n, c in zip(names, columns, strict=True)], names)

    names = ["part", "doc", "lo", "size", "raw", "words", "spans"]
    return docs.mapInArrow(
        send, "part int, doc binary, lo binary, size binary, raw int, words binary, spans binary")


def _parsed(sent: DataFrame) -> DataFrame:
    """Factors (doc, lo, hi, source, source_lo) of all segments against the
    reference blocks, and those that came with them."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0
        for batch in batches:                   # sorted by part
            for row in batch.to_pylist():
                if held and row["part"] != held[-1]["part"] and size >= BATCH_BYTES:
                    yield found(held)
                    held, size = [], 0
                row["words"] = unpack(row["words"], row["raw"])
                held.append(row)
                size += row["raw"]
        if held:
            yield found(held)

    def found(held: list[dict]) -> pa.RecordBatch:
        both = lambda c, t: np.frombuffer(b"".join(r[c] for r in held), t)
        words = Words(both("doc", np.int64), both("lo", np.int32).astype(np.int64),
                      b"".join(r["words"] for r in held), size=both("size", np.int32))
        spans = np.concatenate((both("spans", SPAN), factored(words)[0]))
        return pa.RecordBatch.from_arrays([pa.array(spans[c]) for c in SPAN.names], list(SPAN.names))

    return (sent.repartition("part").sortWithinPartitions("part")
            .mapInArrow(parse, "doc bigint, lo int, hi int, source bigint, source_lo int"))


def without_repeated_words(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id, n_words long, n_removed long, factors array<struct<lo, hi,
    source, source_lo>>, kept string)``, one per row of ``df``.

    Words are runs of characters other than space and U+0009 to U+000D. A word
    goes when a window of 20 words over it also starts earlier: in a document of
    a smaller id, or earlier in the same one. Windows are judged on the input.
    ``factors`` are the repeated stretches (words from lo, up to before hi) with
    the document and word at which an earlier copy starts; they can overlap.
    ``kept`` holds the other words, joined by one space.

    Null texts have no words. A null id counts as smaller than any (as a source
    it is null). Rows that repeat an id with its text start at the same places
    and do not remove each other; under one id with different texts, each row
    loses what is found for the id. Ids are integers. Other columns are not read;
    an empty table gives an empty result.
    """
    spark = df.sparkSession
    use_package_on_workers(spark)
    owners = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.coalesce(df[id_col].cast("long"), F.lit(_FIRST)).alias("doc"),
                     text_or_empty(text_col).alias("text"))
    busy, windows = _busy(docs, owners)
    factors = (_parsed(_sent(docs, busy, max(owners, windows // PART_WINDOWS))).groupBy("doc")
               .agg(F.collect_list(F.struct("lo", "hi", "source", "source_lo")).alias("factors")))
    long, whole = T.LongType(), T.IntegerType()
    factor = T.StructType([T.StructField("lo", whole), T.StructField("hi", whole),
                           T.StructField("source", long), T.StructField("source_lo", whole)])
    schema = T.StructType([T.StructField("id", long), T.StructField("n_words", long),
                           T.StructField("n_removed", long), T.StructField("factors", T.ArrayType(factor)),
                           T.StructField("kept", T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32()),
                                    ("source", pa.int64()), ("source_lo", pa.int32())]))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                n, gone, joined, kept = [], [], [], []
                for size, z, found in zip(*(part.column(k).to_pylist() for k in (1, 2)), part.column(3), strict=True):
                    words = unpack(z, size).split()
                    n.append(len(words))
                    if not found.is_valid:
                        joined.append([])
                        gone.append(0)
                        kept.append(b" ".join(words))
                        continue
                    own = [(0, f["lo"], min(f["hi"], len(words)), f["source"], f["source_lo"])
                           for f in found.as_py() if f["lo"] < len(words)]
                    own = merged(np.array(own, SPAN))
                    stay = np.ones(len(words) + 1, bool)
                    for lo, hi, _, _ in own:
                        stay[lo:hi] = False
                    left = [words[i] for i in np.flatnonzero(stay[:-1])]
                    gone.append(len(words) - len(left))
                    joined.append([{"lo": lo, "hi": hi, "source": None if source == _FIRST else source,
                                    "source_lo": source_lo} for lo, hi, source, source_lo in own])
                    kept.append(b" ".join(left))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(joined, kinds),
                     pa.array(kept, pa.binary()).cast(pa.string())], schema.names)

    return (_packed(docs).join(factors, "doc", "left").select("doc", "size", "z", "factors").mapInArrow(cut, schema)
            .withColumn("id", F.when(F.col("id") != F.lit(_FIRST), F.col("id")))
            .withColumnRenamed("id", id_col))
