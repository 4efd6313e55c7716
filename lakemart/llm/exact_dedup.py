"""Exact duplicates by a Golomb-coded fingerprint exchange.

1. Every task fingerprints its texts (64 bits of the normalised text, on the
   JVM) and deals them to *owners*, one per range of fingerprints. For each
   owner it keeps a block: the sorted fingerprints and the ids in that order.
2. Only the sorted fingerprints travel: gaps Golomb-Rice coded, a few bits over
   the information content. An owner merges its blocks and answers each with a
   bitmap: which of its fingerprints are met more than once.
3. The bitmaps go back to the blocks; the ids they mark are the suspects. Only
   suspects' texts are shuffled, grouped by their bytes.

Blocks hold a bounded number of rows, and a block's repeated fingerprints are
sent once, with a flag: a group of copies, however large, reaches its owner as
one fingerprint per block, and the grouping of suspects adds up in each task
before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm.common import staged, text_or_empty, use_package_on_workers

#: Rows of one exchanged block.
BLOCK_ROWS = 1 << 18

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text_col: str) -> Column:
    """Lower-cases A-Z and nothing else; null becomes the empty text."""
    return F.translate(text_or_empty(text_col), _UPPER, _UPPER.lower())


# -- Golomb-Rice coding of a sorted set ---------------------------------------

def rice_parameter(span: int, n: int) -> int:
    """Bits of the remainder for ``n`` values spread over ``span``."""
    return max(0, int(span // max(n, 1)).bit_length() - 1)


def rice_encode(values: np.ndarray, span: int) -> bytes:
    """Sorted distinct unsigned values below ``span`` as Golomb-Rice coded
    gaps: quotients in unary, then the remainders' low bits."""
    if len(values) == 0:
        return b""
    k = rice_parameter(span, len(values))
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotient + 1) - 1            # the 1 that ends each unary code
    unary = np.zeros(ends[-1] + 1, dtype=np.uint8)
    unary[ends] = 1
    low = (gaps[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)
    head = np.array([len(values), len(unary)], dtype="<u8").tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(low.astype(np.uint8)).tobytes()


def rice_decode(coded: bytes, span: int) -> np.ndarray:
    if not coded:
        return np.zeros(0, dtype=np.uint64)
    n, bits = (int(x) for x in np.frombuffer(coded, dtype="<u8", count=2))
    k = rice_parameter(span, n)
    cut = 16 + -(-bits // 8)
    unary = np.unpackbits(np.frombuffer(coded, np.uint8, cut - 16, 16), count=bits)
    quotient = np.diff(np.flatnonzero(unary), prepend=-1) - 1
    low = np.unpackbits(np.frombuffer(coded, np.uint8, -1, cut), count=n * k).reshape(n, k)
    rest = (low.astype(np.uint64) << np.arange(k, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum((quotient.astype(np.uint64) << np.uint64(k)) | rest, dtype=np.uint64)


# -- the exchange -------------------------------------------------------------

def _blocks(rows: DataFrame, owners: int) -> DataFrame:
    """Blocks ``(owner, block, coded, again, ids, nth)`` of rows (id, fp):
    coded distinct fingerprints less the owner's first, a bitmap of those met
    more than once in the block, the ids and each id's fingerprint number."""
    width = (1 << 64) // owners + 1

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= BLOCK_ROWS:
                yield from emit(held)
                held, count = [], 0
        if held:
            yield from emit(held)

    def emit(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        ids = table.column("id").combine_chunks()
        fp = table.column("fp").to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(fp, kind="stable")
        ids, fp = ids.take(pa.array(order)), fp[order]
        owner = (fp // np.uint64(width)).astype(np.int64)
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(owner)) + 1, [len(fp)]))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            own = int(owner[a])
            values, nth, met = np.unique(fp[a:b] - np.uint64(own * width),
                                         return_inverse=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([own], pa.int32()), pa.array([rice_encode(values, width)], pa.binary()),
                 pa.array([np.packbits(met > 1).tobytes()], pa.binary()),
                 pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), ids.slice(a, b - a)),
                 pa.array([nth.astype(np.int32)], pa.list_(pa.int32()))],
                ["owner", "coded", "again", "ids", "nth"])

    schema = T.StructType([
        T.StructField("owner", T.IntegerType()), T.StructField("coded", T.BinaryType()),
        T.StructField("again", T.BinaryType()),
        T.StructField("ids", T.ArrayType(rows.schema["id"].dataType)),
        T.StructField("nth", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(make, schema).withColumn("block", F.expr("uuid()"))


def _answers(blocks: DataFrame, owners: int) -> DataFrame:
    """One bitmap ``(block, marks)`` per block: its fingerprints that any block
    of the owner holds again. The owner's blocks arrive together in one task,
    as compressed bytes, and are dealt by owner, so no owner's share depends on
    how often a text is repeated."""
    width = (1 << 64) // owners + 1

    def answer(key, frame):
        import pandas as pd

        coded = [rice_decode(c, width) for c in frame["coded"]]
        again = [np.unpackbits(np.frombuffer(a, np.uint8), count=len(v)).astype(bool)
                 for a, v in zip(frame["again"], coded, strict=True)]
        values, met = np.unique(np.concatenate(coded), return_counts=True)
        shared = values[met > 1]
        marks = [np.packbits(a | np.isin(v, shared, assume_unique=True)).tobytes()
                 for a, v in zip(again, coded, strict=True)]
        return pd.DataFrame({"block": frame["block"], "marks": marks})

    return (blocks.select("owner", "block", "coded", "again").groupBy("owner")
            .applyInPandas(answer, "block string, marks binary"))


def _suspects(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """Ids ``(id)`` whose fingerprint is marked."""
    id_type = blocks.schema["ids"].dataType.elementType

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, nth, marks = (batch.column(n) for n in ("ids", "nth", "marks"))
            for i in range(batch.num_rows):
                bits = np.unpackbits(np.frombuffer(marks[i].as_py(), np.uint8)).astype(bool)
                keep = bits[nth[i].values.to_numpy()]
                yield pa.RecordBatch.from_arrays([ids[i].values.filter(pa.array(keep))], ["id"])

    return (blocks.select("block", "ids", "nth").join(answers, "block").select("ids", "nth", "marks")
            .mapInArrow(marked, T.StructType([T.StructField("id", id_type)])))


def exact_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                     owners: int | None = None) -> DataFrame:
    """Rows ``(id, keep_id, group_size long, kept boolean, text_sha256)``, one
    per row of ``df``: the group of equal normalised texts it belongs to, the
    largest id of the group (which stays) and the group's row count.

    Texts are equal when identical after lower-casing A-Z only. Null texts
    count as empty, so all null and empty texts are one group. A null id counts
    as smaller than any id. Of rows that repeat an id and its text, each is
    marked as kept when the id is the group's largest. Other columns are not
    read; an empty table gives an empty result.

    ``owners`` is the number of fingerprint ranges, by default the session's
    number of shuffle partitions.
    """
    spark = df.sparkSession
    use_package_on_workers(spark)
    owners = owners or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(df[id_col].alias("id"), normalised(text_col).alias("text"))
    blocks = staged(_blocks(rows.select("id", F.xxhash64("text").alias("fp")), owners), "fingerprints")
    suspects = _suspects(blocks, _answers(blocks, owners)).distinct()
    groups = (rows.join(suspects, rows["id"].eqNullSafe(suspects["id"]), "left_semi")
              .select(F.sha2("text", 256).alias("text_sha256"), "text", "id")
              # byte verification: rows group by the text itself, not only its digest
              .groupBy("text_sha256", "text")
              .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .filter("group_size > 1").drop("text"))
    hashed = rows.select("id", F.sha2("text", 256).alias("text_sha256"))
    return (hashed.join(groups, "text_sha256", "left")
            .select(F.col("id").alias(id_col),
                    F.when(F.col("group_size").isNull(), F.col("id"))
                     .otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).alias("group_size"),
                    F.when(F.col("group_size").isNull(), F.lit(True))
                     .otherwise(F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
                    "text_sha256"))
