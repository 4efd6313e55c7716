"""Near-duplicate documents by ProbMinHash.

A document is the weighted set of its shingles of five words (weight: how often
it has the shingle). Every shingle is a Poisson process of its weight's rate,
seeded by the shingle; each arrival hits one of the signature's registers, and
a register keeps the shingle that hit it first. A shingle is done as soon as
its next arrival comes after every register of its document was hit, so most
shingles of a long document give one arrival. Two registers agree with the
probability Jaccard similarity of the documents,

    J(x, y) = sum over shared s of 1 / sum over all t of max(x_t / x_s, y_t / y_s),

which banding searches and verification computes exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import staged, text_or_empty, use_package_on_workers
from lakemart.llm.near import mix, near_components

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4
REGISTERS = 160
#: Pairs agreeing in fewer registers than this share are not verified: three
#: standard deviations under the threshold.
CUT = 0.70
#: Words of documents signed together, and cached word hashes.
BATCH_WORDS = 1 << 20
CACHE_WORDS = 1 << 20

_LOW48 = np.uint64((1 << 48) - 1)


class Shingler:
    """Shingle hashes of texts; words are parted by white space and compared
    lower-cased. Fewer than five words are one shingle, no words none."""

    def __init__(self, words: int = WORDS):
        from xxhash import xxh64_intdigest

        self.words, self.digest = words, xxh64_intdigest
        self.known: dict[str, int] = {}

    def word_hashes(self, text: str) -> np.ndarray:
        words = text.lower().split()
        known, digest = self.known, self.digest
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = digest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def shingles(self, text: str) -> np.ndarray:
        h = self.word_hashes(text)
        if len(h) == 0:
            return h
        k = min(self.words, len(h))
        out = np.full(len(h) - k + 1, k, np.uint64)
        for i in range(k):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - k + 1 + i]
            out ^= out >> np.uint64(29)
        return mix(out)

    def weighted(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(self.shingles(text), return_counts=True)


def prob_min_hash(shingles: list[np.ndarray], registers: int) -> np.ndarray:
    """Signatures (documents, registers) of 16 bits; documents without shingles
    get zeros. At most 65536 documents at a time."""
    sizes = np.array([len(s) for s in shingles])
    keys = np.sort((np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes) << np.uint64(48))
                   | (np.concatenate([*shingles, np.zeros(0, np.uint64)]) & _LOW48))
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
    weight = np.diff(np.append(first, len(keys))).astype(np.float64)
    doc = (keys[first] >> np.uint64(48)).astype(np.int64)
    item = keys[first] & _LOW48
    at = np.full(len(sizes) * registers, np.inf)        # time of a register's first hit
    who = np.zeros(len(sizes) * registers, np.uint64)
    time = np.zeros(len(item))
    turn = 0
    while len(item):
        turn += 1
        draw = mix(item * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn))
        # the upper 53 bits give the waiting time, a second mixing the register
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / weight
        slot = doc * registers + (mix(draw) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(at, slot, time)
        hit = at[slot] == time
        who[slot[hit]] = item[hit]
        on = time < at.reshape(-1, registers).max(axis=1)[doc]
        item, doc, weight, time = item[on], doc[on], weight[on], time[on]
    return (mix(who) >> np.uint64(48)).astype(np.uint16).reshape(-1, registers) \
        * (sizes > 0)[:, None].astype(np.uint16)


def probability_jaccard(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact similarity of two weighted sets (sorted items, weights)."""
    both, ix, iy = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    if len(both) == 0:
        return 1.0 if len(x[0]) == len(y[0]) == 0 else 0.0
    xs, ys = x[1][ix].astype(float), y[1][iy].astype(float)
    x_only, y_only = x[1].sum() - xs.sum(), y[1].sum() - ys.sum()
    ratio, which = np.unique(xs / ys, return_inverse=True)
    total = 0.0
    for i, r in enumerate(ratio):               # one sum per ratio of weights; mostly there is one
        whole = np.maximum(xs, r * ys).sum() + x_only + r * y_only
        total += xs[which == i].sum() / whole
    return float(total)


def same_documents(words: int = WORDS, similarity: float = SIMILARITY):
    """The exact test; texts of a group come again and again, so their shingles
    are held, up to ``BATCH_WORDS``."""
    shingler = Shingler(words)
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    size = 0

    def weighted(text: str) -> tuple[np.ndarray, np.ndarray]:
        nonlocal size
        found = held.get(text)
        if found is None:
            if size > BATCH_WORDS:
                held.clear()
                size = 0
            found = held[text] = shingler.weighted(text)
            size += len(found[0])
        return found

    def test(a: str, c: str) -> bool:
        return probability_jaccard(weighted(a), weighted(c)) >= similarity

    return test


def _signed(rows: DataFrame, words: int, registers: int) -> DataFrame:
    """(key, sig) of rows (key, text), a repeated key once per batch."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            keys, texts = batch.column(0).to_numpy(), batch.column(1)
            own, shingles, size = [], [], 0
            for i in np.sort(np.unique(keys, return_index=True)[1]):
                found = shingler.shingles(texts[i].as_py())
                if len(found):
                    own.append(keys[i])
                    shingles.append(found)
                    size += len(found)
                if size >= BATCH_WORDS or len(own) >= 1 << 14:
                    yield emit(own, shingles)
                    own, shingles, size = [], [], 0
            if own:
                yield emit(own, shingles)

    def emit(own: list, shingles: list[np.ndarray]) -> pa.RecordBatch:
        sig = prob_min_hash(shingles, registers)
        return pa.RecordBatch.from_arrays(
            [pa.array(own, pa.int64()), pa.array([s.tobytes() for s in sig], pa.binary())], ["key", "sig"])

    return rows.mapInArrow(sign, "key bigint, sig binary")


def once_per_batch(rows: DataFrame) -> DataFrame:
    """Rows (key, text) with a repeated key once per batch of a task, so that a
    text held by very many rows is not moved that often."""

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.take(pa.array(np.unique(batch.column(0).to_numpy(), return_index=True)[1]))

    return rows.mapInArrow(once, "key bigint, text string")


def _classified(df: DataFrame, id_col: str, text_col: str, words: int, similarity: float,
                bands: int, rows: int) -> DataFrame:
    """(id, node, root, links, class_id, class_size) per row of ``df``."""
    use_package_on_workers(df.sparkSession)
    key = F.xxhash64(text_or_empty(text_col))
    texts = df.select(key.alias("key"), text_or_empty(text_col).alias("text"))
    signed = staged(_signed(texts, words, max(REGISTERS, bands * rows)), "signatures")
    found = near_components(signed, once_per_batch(texts), lambda: same_documents(words, similarity),
                            bands=bands, rows=rows, cut=CUT)
    rooted = df.select(df[id_col].alias("id"), key.alias("node")).join(found, "node", "left").select(
        "id", "node", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    classes = rooted.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNotNull().alias("known"), "id"))["id"].alias("class_id"),
        F.count(F.lit(1)).alias("class_size"))
    return rooted.join(classes, "root")


def near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Rows ``(id, class_id, class_size, links, kept)``, one per row of ``df``:
    the smallest id of its class of near-duplicates, the class's row count, the
    number of verified links of its text that joined components (pairs within a
    component are not tested, so it can be near to more texts), and whether the
    row is the one that stays (its id is the class id).

    Texts are near when the probability Jaccard similarity of their weighted
    shingles reaches ``similarity``; classes are the components. Rows of equal
    texts are one node, so copies are in one class whatever their number. Null
    texts count as empty; texts without words are near to equal texts only. A
    null id is smaller than any; repeated ids with one text stay or go together.
    Other columns are not read; an empty table gives an empty result.
    """
    return _classified(df, id_col, text_col, words, similarity, bands, rows).select(
        F.col("id").alias(id_col), "class_id", "class_size", "links",
        F.col("id").eqNullSafe(F.col("class_id")).alias("kept"))


def without_near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                            words: int = WORDS, similarity: float = SIMILARITY, bands: int = BANDS,
                            rows: int = ROWS) -> DataFrame:
    """``df`` with one row of every class of near-duplicates: the row of the
    smallest id (of rows that repeat it, one), all columns as they are."""
    classified = _classified(df, id_col, text_col, words, similarity, bands, rows)
    stay = classified.filter(F.col("id").eqNullSafe(F.col("class_id"))) \
        .groupBy("id", "root").agg(F.min("node").alias("node")).select("id", "node")
    own = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"),
                    F.coalesce(df[id_col].cast("string"), F.lit("")).alias("of"),
                    F.xxhash64(text_or_empty(text_col)).alias("key"))
    stay = stay.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("of"), F.col("node").alias("key"))
    return own.join(stay.distinct(), ["of", "key"], "left_semi").dropDuplicates(["of", "key"]).select("row.*")
