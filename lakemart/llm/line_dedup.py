"""Fuzzy line deduplication by MinHash.

Lines are compared by their sets of character shingles. A signature holds, for
each of its registers, the smallest hash among the shingles dealt to it (one
hash per shingle and deal; an empty register borrows from another one of its deal
that a hash of its number names). Banding finds candidates, the exact Jaccard similarity of the
shingle sets decides, and distributed union-find keeps the first line of every
component: the one with the smallest document id and line number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm.common import staged, text_or_empty, use_package_on_workers
from lakemart.llm.near import band_columns, mix, near_components, slice_columns, thinned

#: One changed character alters four shingles: lines stay near from 39 characters
#: on, with one changed word of five letters from 75 on. Shingles of three, of
#: few kinds, would bring long unrelated lines near each other.
SHINGLE = 4
SIMILARITY = 0.8
#: A pair at 0.8 shares no band with a probability of 0.002 %. Long lines of one
#: language share a third of their shingles: bands of four registers brought
#: each of two million lines near a thousand others by chance.
BANDS, ROWS = 36, 6
#: Exchanges that the bands are sent in.
SLICES = 6
#: Registers that estimates and sketches use.
REGISTERS = 128
#: Registers filled by one hash of a shingle; more are filled by further hashes.
DEAL = 128
#: Pairs agreeing in fewer registers than this share are not tested: three
#: standard deviations under the threshold.
CUT = 0.66
#: Characters of lines signed together, and documents read together.
BATCH_CHARS = 1 << 19
BATCH_DOCS = 1000

_NONE = np.uint16(0xFFFF)


def normal(line: str) -> str:
    """What lines are compared by: white space runs as one space, lower case."""
    return " ".join(line.split()).lower()


def keyed_lines(text: str, digest) -> list[tuple[int | None, str]]:
    """(key, normal form) of each line; blank lines have no key and stay."""
    return [(digest(form), form) if form else (None, form)
            for form in map(normal, text.split("\n"))]


def line_digest():
    """A 64-bit hash of a line as a signed number."""
    from xxhash import xxh3_64_digest

    return lambda form: int.from_bytes(xxh3_64_digest(form), "little", signed=True)


def shingle_set(form: str, k: int = SHINGLE) -> set[str]:
    """Character shingles; a shorter line is its own only shingle."""
    return {form[i:i + k] for i in range(max(1, len(form) - k + 1))}


def line_signatures(forms: list[str], registers: int, k: int = SHINGLE) -> np.ndarray:
    """Signatures (lines, registers) of 16 bits of non-empty lines."""
    gap = "\0" * (k - 1)
    h = np.frombuffer(gap.join([*forms, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(f) for f in forms])
    starts = np.cumsum(sizes + k - 1) - (sizes + k - 1)
    counts = np.maximum(sizes - k + 1, 1)
    inside = np.ones(len(h) - k + 1, bool)      # places where a shingle starts
    ends = starts + counts
    for j in range(2 * k - 2):
        at = ends + j
        inside[at[(at < len(inside)) & (at < np.append(starts[1:], len(h)))]] = False
    done = 1
    while done < k:                             # hashes of longer stretches from two shorter ones
        step = min(done, k - done)
        h = h[:-step] * np.uint32(pow(0x9E3779B1, done, 1 << 32)) + h[step:]
        done += step
    h = h[:len(inside)][inside]
    line = np.repeat(np.arange(len(forms)), counts)
    turns = -(-registers // DEAL)
    size = -(-registers // turns)
    sig = [_dealt(_scramble(h + np.uint32(turn * 0x9E3779B9 & 0xFFFFFFFF)), line, len(forms), size)
           for turn in range(turns)]
    return np.concatenate(sig, axis=1)[:, :registers]


def _dealt(h: np.ndarray, line: np.ndarray, lines: int, registers: int) -> np.ndarray:
    # the upper half of a hash deals the shingle to a register, the lower half
    # is compared there
    slot = line * registers + (((h >> np.uint32(16)) * np.uint32(registers)) >> np.uint32(16))
    out = np.full(lines * registers, _NONE, np.uint16)
    np.minimum.at(out, slot, np.minimum(h.astype(np.uint16), _NONE - np.uint16(1)))
    sig, turn = out.copy(), 0
    empty = np.flatnonzero(sig == _NONE)
    while len(empty):
        turn += 1
        other = mix(np.arange(registers, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn))
        step = (other % np.uint64(registers)).astype(np.int64) - np.arange(registers)
        sig[empty] = found = out[empty + step[empty % registers]]
        empty = empty[found == _NONE]
    return sig.reshape(-1, registers)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_DOCS):
            yield batch.slice(at, BATCH_DOCS)


def _texts(rows: DataFrame) -> DataFrame:
    """(key, text) of the lines, a repeated key once per batch of a task."""
    def forms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = line_digest()
        for batch in _small(batches):
            found = dict(x for t in batch.column(0) for x in keyed_lines(t.as_py(), digest))
            found.pop(None, None)
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.int64()),
                                              pa.array(found.values(), pa.string())], ["key", "text"])

    return rows.mapInArrow(forms_of, "key bigint, text string")


def _signed(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """One reading of the texts gives two kinds of rows: (key, sig, values of its
    bands) of a line, a repeated key once per batch, and (id, keys) of a document:
    its lines' keys, null for blank lines."""
    id_type = docs.schema["id"].dataType
    values = slice_columns(bands, SLICES)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = line_digest()
        for batch in _small(batches):
            seen: set[int] = set()
            own, keys, forms, size = [], [], [], 0
            for text in batch.column(1):
                lines = keyed_lines(text.as_py(), digest)
                own.append([k for k, _ in lines])
                for key, form in lines:
                    if key is not None and key not in seen:
                        seen.add(key)
                        keys.append(key)
                        forms.append(form)
                        size += len(form)
                if size >= BATCH_CHARS:
                    yield emit(keys, forms, batch.column(0).slice(0, 0), [])
                    keys, forms, size = [], [], 0
            yield emit(keys, forms, batch.column(0), own)

    def emit(keys: list, forms: list[str], ids: pa.Array, own: list) -> pa.RecordBatch:
        n, m = len(keys), len(own)
        packed = [pa.array([], pa.binary())] * (1 + len(values))
        if forms:
            sig = line_signatures(forms, max(REGISTERS, bands * rows))
            packed = [thinned(sig[:, :REGISTERS]), *band_columns(sig, bands, rows, SLICES)]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys + [None] * m, pa.int64()),
             *(pa.concat_arrays([x, pa.nulls(m, pa.binary())]) for x in packed),
             pa.concat_arrays([pa.nulls(n, ids.type), ids]),
             pa.array([None] * n + own, pa.list_(pa.int64()))], ["key", "sig", *values, "id", "keys"])

    return docs.mapInArrow(sign, T.StructType([
        T.StructField("key", T.LongType()), *(T.StructField(c, T.BinaryType()) for c in ["sig", *values]),
        T.StructField("id", id_type), T.StructField("keys", T.ArrayType(T.LongType()))]))


def same_lines(similarity: float = SIMILARITY):
    held: list = [None, set()]

    def test(a: str, c: str) -> bool:
        if held[0] != c:
            held[:] = [c, shingle_set(c)]
        x, y = shingle_set(a), held[1]
        both = len(x & y)
        return both >= similarity * (len(x) + len(y) - both)

    return test


def removed_lines(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Rows ``(id, removed array<int>)``: the numbers (from 0, in order) of the
    lines of a document that repeat a line, exactly or nearly, which starts
    earlier by (id, line number); documents that lose nothing have no row.

    Lines are near when the Jaccard similarity of their character shingles
    (after joining white space and lower-casing) reaches ``similarity``;
    components of near lines keep one line. Blank lines are never removed.
    Null texts count as empty. A null id comes first; rows that repeat an id
    are one document: equal lines at one place of it stay or go together.
    """
    use_package_on_workers(df.sparkSession)
    docs = df.select(df[id_col].alias("id"), text_or_empty(text_col).alias("text"))
    texts = docs.select("text")
    both = staged(_signed(docs, bands, rows), "line-signatures")
    keys = staged(both.filter("keys is not null").select("id", "keys"), "line-keys")    # the signatures go earlier
    signed = both.filter("key is not null").drop("id", "keys")
    signed.staged_path = both.staged_path
    found = near_components(signed, _texts(texts), lambda: same_lines(similarity), bands=bands, rows=rows, cut=CUT,
                            slices=SLICES, sketch=REGISTERS)
    lines = keys.select("id", F.posexplode("keys").alias("line", "node")).filter("node is not null")
    rooted = staged(lines.join(found, "node", "left")
                    .select("id", "line", F.coalesce("root", "node").alias("root")), "line-classes")
    place = F.struct(F.col("id").isNotNull().alias("known"), "id", "line")
    first = rooted.groupBy("root").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return (rooted.join(first, "root").filter(place != F.col("first"))
            .groupBy("id").agg(F.array_sort(F.collect_set("line")).alias("removed")))


def line_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Rows ``(id, n_lines, n_removed, removed)``, one per row of ``df``; see
    :func:`removed_lines`. An empty or null text is one blank line."""
    own = df.select(df[id_col].alias("id"), F.size(F.split(text_or_empty(text_col), "\n")).alias("n_lines"))
    gone = removed_lines(df, id_col=id_col, text_col=text_col, **options).withColumnRenamed("id", "of")
    none = F.array().cast("array<int>")
    return own.join(gone, own["id"].eqNullSafe(gone["of"]), "left").select(
        F.col("id").alias(id_col), "n_lines", F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"),
        F.coalesce("removed", none).alias("removed"))


def without_duplicate_lines(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                            **options) -> DataFrame:
    """``df`` with the removed lines taken out of its texts; its other columns
    as they are. Null texts stay null; a text may become empty."""
    gone = removed_lines(df, id_col=id_col, text_col=text_col, **options) \
        .select(F.struct("id", "removed").alias("gone"))
    rows = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"))
    text = F.col(f"row.`{text_col}`")
    lines = F.split(text, "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone.removed"))
    left = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    joined = rows.join(gone, F.col(f"row.`{id_col}`").eqNullSafe(F.col("gone.id")), "left")
    return joined.select(*[
        F.when(F.col("gone").isNull() | text.isNull(), text).otherwise(left).alias(c) if c == text_col
        else F.col(f"row.`{c}`").alias(c) for c in df.columns])
