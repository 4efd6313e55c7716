"""Suffix-array deduplication with a run-length index.

Every byte covered by a string of 100 bytes that also starts earlier is taken
out. Strings meet through *anchors*: of the 69 grams of 32 bytes in a window of
100 bytes the one with the smallest hash (leftmost of equals). Equal windows
have equal anchors at equal places, so only windows of one anchor need to be
compared. Neighbouring windows with the same anchor are one *segment*.

1. Tasks find the segments of their texts. Equal segments of a block shrink to
   the earliest; the others are repeats. Segments go, packed, to the owner of
   the anchor's hash range.
2. Owners do the same over all blocks. Where an anchor has segments that differ,
   their earliest copies are asked for by place.
3. Their bytes are fetched. Of the segments of an anchor, in order of place, a
   run-length index over one half streams the matching statistics of the other
   half, over halves of halves, so that every segment meets all earlier ones:
   a window with a match of 100 bytes starts earlier too. Anchors of very many
   differing segments are parted first by longer context, up to 92 of the 100
   bytes.
4. The repeats of a document are joined with its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm.common import staged, text_or_empty, use_package_on_workers
from lakemart.llm.near import mix
from lakemart.llm.run_index import RunIndex

LENGTH = 100
GRAM = 32                      # a power of two
SPAN = LENGTH - GRAM + 1       # gram places in a window, so windows of one anchor
#: Bytes of a block; a longer text is cut into overlapping pieces.
BLOCK_BYTES = 1 << 21
#: An anchor with more differing segments is parted by longer context.
MANY = 4
#: Parts of the windows of such an anchor.
PARTS = 8
#: Symbols indexed together.
BATCH_SYMBOLS = 3 << 20

_PLACE_BITS = 22
_FIRST = -(1 << 63)            # the id that null stands for: before any other

ENTRY = np.dtype([("a", "<u4"), ("q", "<u8"), ("doc", "<i8"), ("lo", "<i4"), ("n", "u1"), ("off", "u1")])
SPANS = np.dtype([("doc", "<i8"), ("lo", "<i4"), ("hi", "<i4")])


# -- segments -----------------------------------------------------------------

def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all grams of 32 bytes, from halves of halves."""
    h = data.astype(np.uint64) + np.uint64(1)
    width = 1
    while width < GRAM:
        h = h[:-width] * np.uint64(0x9E3779B97F4A7C15) + mix(h[width:])
        width *= 2
    return mix(h)


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minima of all windows of ``width``, from running minima of stretches."""
    n = len(v)
    full = np.full(-(-n // width) * width, np.iinfo(v.dtype).max, v.dtype)
    full[:n] = v
    grid = full.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def segments(pieces: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Of pieces (document, offset, bytes), at most BLOCK_BYTES together unless
    one alone, the anchor hashes and ENTRY records (a and its hash unsorted)."""
    pieces = [p for p in pieces if len(p[2]) >= LENGTH]
    if not pieces:
        return np.zeros(0, np.uint64), np.zeros(0, ENTRY)
    data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
    sizes = np.array([len(p[2]) for p in pieces])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    h = gram_hashes(data)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    order = (mix(h) & ~low) | np.arange(len(h), dtype=np.uint64)
    anchor = (_sliding_min(order, SPAN) & low).astype(np.int64)
    valid = np.ones(len(anchor) + LENGTH, bool)         # no window reaches over a piece's end
    for k in range(1, LENGTH):
        valid[ends - k] = False
    at = np.flatnonzero(valid[:len(anchor)])
    own = anchor[at]
    first = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1))))
    lo, where = at[first], own[first]
    n = np.diff(np.append(first, len(at)))
    size = n + LENGTH - 1
    q = mix(((where - lo) * 256 + n).astype(np.uint64))
    for k in range(0, LENGTH + SPAN - GRAM, GRAM):       # grams that cover the segment, then its last
        inside = k + GRAM <= size
        q[inside] = mix(q[inside] * np.uint64(0x9E3779B97F4A7C15) + h[lo[inside] + k])
    q = mix(q * np.uint64(0x9E3779B97F4A7C15) + h[lo + size - GRAM])
    piece = np.searchsorted(ends, lo, "right")
    out = np.zeros(len(lo), ENTRY)
    out["q"], out["n"], out["off"] = q, n, where - lo
    out["doc"] = np.array([p[0] for p in pieces], np.int64)[piece]
    out["lo"] = lo - starts[piece] + np.array([p[1] for p in pieces], np.int64)[piece]
    return h[where], out


def earliest(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of entries in order of (a, q, doc, lo): mask of the first of every equal
    (a, q), the others' spans, and the group number of each entry."""
    new = np.concatenate(([True], (entries["a"][1:] != entries["a"][:-1])
                          | (entries["q"][1:] != entries["q"][:-1])))[:len(entries)]
    group = np.cumsum(new) - 1
    lead = entries[new][group] if len(entries) else entries
    # a row that repeats a whole document starts at the same place, not earlier
    late = ~new & ((entries["doc"] != lead["doc"]) | (entries["lo"] != lead["lo"]))
    spans = np.zeros(late.sum(), SPANS)
    found = entries[late]
    spans["doc"], spans["lo"] = found["doc"], found["lo"]
    spans["hi"] = found["lo"] + found["n"] + (LENGTH - 1)
    return new, spans, group


def merged(spans: np.ndarray) -> np.ndarray:
    """Overlapping and touching spans of a document joined."""
    if len(spans) == 0:
        return spans
    spans = spans[np.lexsort((spans["lo"], spans["doc"]))]
    doc = np.cumsum(np.concatenate(([0], spans["doc"][1:] != spans["doc"][:-1])))
    # furthest end so far within the document: documents are set apart by an offset
    reach = np.maximum.accumulate(spans["hi"].astype(np.int64) + (doc << 32))
    start = spans["lo"].astype(np.int64) + (doc << 32)
    first = np.flatnonzero(np.concatenate(([True], start[1:] > reach[:-1])))
    out = spans[first]
    out["hi"] = (reach[np.append(first[1:], len(spans)) - 1] & 0xFFFFFFFF).astype(np.int32)
    return out


def _sent(docs: DataFrame, owners: int) -> DataFrame:
    """(owner, entries, spans): a block's earliest segments by owner, and with
    one of them the block's own repeats."""
    width = np.uint64((1 << 64) // owners + 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                whole = text.as_py().encode()
                for at in range(0, max(len(whole) - LENGTH + 1, 0), BLOCK_BYTES):
                    piece = whole[at:at + BLOCK_BYTES + LENGTH - 1]
                    if held and size + len(piece) > BLOCK_BYTES + LENGTH:
                        yield from emit(held)
                        held, size = [], 0
                    held.append((doc.as_py(), at, piece))
                    size += len(piece)
            if held:
                yield from emit(held)

    def emit(held: list) -> Iterator[pa.RecordBatch]:
        anchor, entries = segments(held)
        entries["a"] = (anchor & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        owner = (anchor // width).astype(np.int32)
        order = np.lexsort((entries["lo"], entries["doc"], entries["q"], entries["a"], owner))
        entries, owner = entries[order], owner[order]
        if len(entries) == 0:
            return
        new, spans, _ = earliest(entries)
        new |= np.concatenate(([True], owner[1:] != owner[:-1]))
        entries, owner = entries[new], owner[new]
        cuts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1], [True])))
        own = [merged(spans).tobytes()] + [b""] * (len(cuts) - 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(owner[cuts[:-1]], pa.int32()),
             pa.array([entries[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
             pa.array(own, pa.binary())], ["owner", "entries", "spans"])

    return docs.mapInArrow(send, "owner int, entries binary, spans binary")


def _owned(sent: DataFrame) -> DataFrame:
    """Repeats (anchor null) and places of differing segments: rows (doc, lo,
    hi, anchor, off, parts)."""
    def own(key, frame):
        import pandas as pd

        entries = np.frombuffer(b"".join(frame["entries"]), ENTRY)
        entries = entries[np.lexsort((entries["lo"], entries["doc"], entries["q"], entries["a"]))]
        new, spans, _ = earliest(entries)
        spans = np.concatenate((merged(spans), np.frombuffer(b"".join(frame["spans"]), SPANS)))
        reps = entries[new]
        _, which, met = np.unique(reps["a"], return_inverse=True, return_counts=True)
        met = met[which]
        ask, met = reps[met > 1], met[met > 1]
        return pd.DataFrame({
            "doc": np.concatenate((spans["doc"], ask["doc"])),
            "lo": np.concatenate((spans["lo"], ask["lo"])),
            "hi": np.concatenate((spans["hi"], ask["lo"] + ask["n"].astype(np.int32) + (LENGTH - 1))),
            "anchor": pd.array([None] * len(spans) + (ask["a"].astype(np.int64) + (int(key[0]) << 32)).tolist(),
                               dtype="Int64"),
            "off": np.concatenate((np.zeros(len(spans), np.int32), ask["off"].astype(np.int32))),
            "parts": np.concatenate((np.zeros(len(spans), np.int32),
                                     np.where(met > MANY, PARTS, 1).astype(np.int32)))})

    return sent.groupBy("owner").applyInPandas(
        own, "doc bigint, lo int, hi int, anchor bigint, off int, parts int")


# -- bytes --------------------------------------------------------------------

def _packed(docs: DataFrame) -> DataFrame:
    """(doc, size, z): the texts' bytes compressed, to be moved."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 1)
        for batch in batches:
            texts = [t.as_py().encode() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([codec.compress(t, asbytes=True) if t else b"" for t in texts], pa.binary())],
                ["doc", "size", "z"])

    return docs.mapInArrow(pack, "doc bigint, size bigint, z binary")


def unpack(z: bytes, size: int) -> bytes:
    return pa.Codec("zstd").decompress(z, size, asbytes=True) if size else b""


def _contents(asked: DataFrame, docs: DataFrame) -> DataFrame:
    """(key, doc, lo, off, content) of the asked segments; a parted anchor's
    segment comes once per part of its windows, keyed by what all windows of
    that part share."""
    places = asked.groupBy("doc").agg(F.collect_list(F.struct("lo", "hi", "anchor", "off", "parts")).alias("asked"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                whole = unpack(r["z"], r["size"])
                rows = [x for a in r["asked"] for x in parted(whole, **a)]
                keys, lo, off, content = zip(*rows, strict=True) if rows else ([], [], [], [])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array([r["doc"]] * len(rows), pa.int64()),
                     pa.array(lo, pa.int32()), pa.array(off, pa.int32()), pa.array(content, pa.binary())],
                    ["key", "doc", "lo", "off", "content"])

    return (places.join(_packed(docs), "doc").select("doc", "size", "z", "asked")
            .mapInArrow(fetch, "key bigint, doc bigint, lo int, off int, content binary"))


def parted(whole: bytes, lo: int, hi: int, anchor: int, off: int, parts: int) -> Iterator[tuple]:
    """(key, lo, off, content) of one segment. Its windows start 0 .. SPAN - 1
    bytes before the anchor; a part holds those of a stretch of distances, which
    share the bytes from its shortest distance before to its farthest reach."""
    hi = min(hi, len(whole))
    if hi - lo < LENGTH:
        return                              # a repeated id with a shorter text
    if parts <= 1:
        yield anchor, lo, off, whole[lo:hi]
        return
    from xxhash import xxh64_intdigest

    at = lo + off                           # the anchor's place
    stretch = -(-SPAN // parts)
    for near in range(0, SPAN, stretch):
        far = min(near + stretch, SPAN) - 1
        first, last = max(lo, at - far), min(hi - LENGTH, at - near)
        if first <= last:
            shared = whole[at - near:at - far + LENGTH]
            key = xxh64_intdigest(shared, seed=near)
            yield key - (1 << 64) if key >> 63 else key, first, at - first, whole[first:last + LENGTH]


# -- the index ----------------------------------------------------------------

def repeats_in(key: np.ndarray, doc: np.ndarray, lo: np.ndarray, off: np.ndarray,
               content: list[bytes]) -> np.ndarray:
    """Spans of windows that also start in an earlier segment of the same key;
    rows are in order of (key, doc, lo)."""
    found: list[tuple[int, int, int]] = []
    # equal contents first: all but the earliest are repeats
    lead: dict[tuple[int, bytes], int] = {}
    stay = []
    for i, c in enumerate(content):
        j = lead.setdefault((int(key[i]), c), i)
        if j == i:
            stay.append(i)
        elif (doc[i], lo[i]) != (doc[j], lo[j]):
            found.append((doc[i], lo[i], lo[i] + len(c)))
    stay = np.array(stay, np.int64)
    group = np.cumsum(np.concatenate(([0], key[stay][1:] != key[stay][:-1])))
    rank = np.arange(len(stay)) - np.searchsorted(group, group)
    most = int(rank.max(initial=0))
    level = 0
    while 1 << level <= most:
        pair = (group << 32) | (rank >> (level + 1))
        right = (rank >> level) & 1 == 1
        blocks = np.unique(pair[right])
        number = np.searchsorted(blocks, pair)
        member = blocks[np.minimum(number, len(blocks) - 1)] == pair

        def symbols(rows: np.ndarray) -> list[np.ndarray]:
            out = []
            for i in rows:
                s = np.frombuffer(content[stay[i]], np.uint8).astype(np.int64)
                # the anchor's first byte, equal in the whole group, becomes the
                # block's own symbol: windows match within their block only
                s[off[stay[i]]] = 256 + number[i]
                out.append(s)
            return out

        left_rows, right_rows = np.flatnonzero(member & ~right), np.flatnonzero(right)
        index = RunIndex(symbols(left_rows))
        for i, sizes in zip(right_rows, index.matching_statistics(symbols(right_rows)), strict=True):
            hit = np.flatnonzero(sizes >= LENGTH)
            if len(hit):
                j = stay[i]
                cuts = np.flatnonzero(np.diff(hit, prepend=-2) != 1)
                for a, b in zip(hit[cuts], hit[np.append(cuts[1:], len(hit)) - 1], strict=True):
                    found.append((doc[j], lo[j] + a, lo[j] + b + LENGTH))
        level += 1
    out = np.zeros(len(found), SPANS)
    if found:
        out["doc"], out["lo"], out["hi"] = (np.array(x) for x in zip(*found, strict=True))
    return merged(out)


def _indexed(contents: DataFrame) -> DataFrame:
    """Spans (doc, lo, hi) that the indexes of the keys' segments find."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks()
            key, doc, lo, off = (table.column(i).to_numpy() for i in range(4))
            content = table.column(4).to_pylist()
            spans = repeats_in(key, doc, lo, off, content)
            return pa.RecordBatch.from_arrays([pa.array(spans[f]) for f in ("doc", "lo", "hi")], ["doc", "lo", "hi"])

        held = None
        for batch in batches:                 # sorted by key; the last key may go on
            for at in range(0, batch.num_rows, BATCH_SYMBOLS // LENGTH // 4):
                table = pa.Table.from_batches([batch.slice(at, BATCH_SYMBOLS // LENGTH // 4)])
                held = table if held is None else pa.concat_tables([held, table])
                key = held.column(0).to_numpy()
                last = int(np.searchsorted(key, key[-1]))
                if last and held.nbytes >= BATCH_SYMBOLS:
                    yield found(held.slice(0, last))
                    held = held.slice(last)
        if held is not None:
            yield found(held)

    return (contents.repartition("key").sortWithinPartitions("key", "doc", "lo")
            .mapInArrow(search, "doc bigint, lo int, hi int"))


def without_repeats(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id, n_bytes long, spans array<struct<lo, hi>>, kept binary)``, one
    per row of ``df``: the maximal runs of removed UTF-8 bytes (from lo, up to
    before hi) and the bytes that stay.

    A byte goes when a string of 100 bytes over it also starts earlier: in a
    document of a smaller id, or earlier in the same one. Strings are judged on
    the input; matches never cross documents. Null texts count as empty, a null
    id as smaller than any (the smallest long stands for null). Rows that repeat
    an id with its text start at the same places and do not remove each other;
    under one id with different texts, each row loses what is found for the id.
    Ids are integers. Other columns are not read; an empty table gives an empty
    result.
    """
    spark = df.sparkSession
    use_package_on_workers(spark)
    owners = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.coalesce(df[id_col].cast("long"), F.lit(_FIRST)).alias("doc"),
                     text_or_empty(text_col).alias("text"))
    owned = staged(_owned(_sent(docs, owners)), "segments")
    indexed = _indexed(_contents(owned.filter("anchor is not null"), docs))
    spans = (owned.filter("anchor is null").select("doc", "lo", "hi").unionAll(indexed)
             .groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256).to_pylist()
                gone, kept = [], []
                for r in part:
                    whole = unpack(r["z"], r["size"])
                    found = np.array([(0, min(s["lo"], len(whole)), min(s["hi"], len(whole)))
                                      for s in r["spans"] or ()], SPANS)
                    found = merged(found[found["lo"] < found["hi"]])
                    gone.append([{"lo": int(s["lo"]), "hi": int(s["hi"])} for s in found])
                    edges = [0, *(e for s in gone[-1] for e in (s["lo"], s["hi"])), len(whole)]
                    kept.append(b"".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["doc"] for r in part], pa.int64()),
                     pa.array([r["size"] for r in part], pa.int64()),
                     pa.array(gone, pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))),
                     pa.array(kept, pa.binary())], ["id", "n_bytes", "spans", "kept"])

    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("n_bytes", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([
            T.StructField("lo", T.IntegerType()), T.StructField("hi", T.IntegerType())]))),
        T.StructField("kept", T.BinaryType())])
    return (_packed(docs).join(spans, "doc", "left").select("doc", "size", "z", "spans")
            .mapInArrow(cut, schema)
            .withColumn("id", F.when(F.col("id") != F.lit(_FIRST), F.col("id")))
            .withColumnRenamed("id", id_col))
