"""Exact top-k search with vector-approximation files.

The vectors are kept in blocks: a quantised cell per component (six bits),
from which a score has a lower and an upper bound, beside the exact integers.

1. Scan: every block of queries meets the cells of every block of vectors (the
   exact integers aren't read). A pair of blocks keeps, per query, the vectors
   whose upper bound reaches the (k+1)th lower bound in the block.
2. Over all blocks the (k+1)th lower bound of a query is its threshold.
3. Exact vectors are read for what still reaches the threshold, in the order of
   the bounds, until no bound reaches the scores that are certain.

Equal vectors are one entry with its k+1 smallest ids: ties go to smaller ids,
so larger ones cannot be among the k results of any query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakemart.llm.common import staged, use_package_on_workers

#: Cells per component.
CELLS = 64
#: Vectors of one block, queries of one block.
BLOCK_VECTORS = 4096
BLOCK_QUERIES = 512
#: Exact vectors read at once for a query.
READ = 32

_BLOCK = "n int, dim int, low binary, step binary, cells binary, exact binary, ids array<array<bigint>>"


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """Distinct rows (id, v) with v = floor(scale * x) per component; rows with
    a null id, vector or component, or a non-finite one, take no part."""
    x = F.col(vector_col)
    wide = F.transform(x, lambda c: F.lit(scale) * c.cast("double"))
    fine = F.forall(wide, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (df.select(df[id_col].cast("long").alias("id"), df[vector_col].alias(vector_col))
            .filter(F.col("id").isNotNull() & x.isNotNull()).filter(fine)
            .select("id", F.transform(wide, lambda c: F.floor(c)).alias("v")).distinct())


def _pack(vectors: list[np.ndarray]) -> tuple[int, np.ndarray]:
    dim = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), dim), np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[:len(v)] = v
    return dim, out


def _vector_blocks(entries: DataFrame) -> DataFrame:
    """Blocks of entries (v, ids): the approximation and the exact integers."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK_VECTORS):
                part = batch.slice(a, BLOCK_VECTORS)
                if held and sum(b.num_rows for b in held) + part.num_rows > BLOCK_VECTORS:
                    yield emit(held)
                    held = []
                held.append(part)
        if held:
            yield emit(held)

    def emit(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        dim, exact = _pack([v.values.to_numpy() for v in table.column("v").combine_chunks()])
        low = exact.min(axis=0) if dim else np.zeros(0, np.int64)
        width = (exact.max(axis=0) - low) if dim else low
        step = width // CELLS + 1
        cells = ((exact - low) // step).astype(np.uint8)
        return pa.RecordBatch.from_arrays(
            [pa.array([len(exact)], pa.int32()), pa.array([dim], pa.int32()),
             *(pa.array([a.tobytes()], pa.binary()) for a in (low, step, cells, exact)),
             pa.array([table.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64())))],
            ["n", "dim", "low", "step", "cells", "exact", "ids"])

    return entries.select("v", "ids").mapInArrow(make, _BLOCK).withColumn("block", F.expr("uuid()"))


def _query_blocks(queries: DataFrame, blocks: int) -> DataFrame:
    """Rows (qb, q_ids, q_dim, q) of about BLOCK_QUERIES queries each."""

    def make(key, frame):
        import pandas as pd

        frame = frame.sort_values("id")
        dim, q = _pack(list(frame["v"]))
        return pd.DataFrame({"qb": [key[0]], "q_ids": [frame["id"].to_numpy()], "q_dim": [dim],
                             "q": [q.tobytes()]})

    return (queries.withColumn("qb", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int"))
            .groupBy("qb").applyInPandas(make, "qb int, q_ids array<bigint>, q_dim int, q binary"))


def _matrix(buffer: bytes, rows: int, dim: int, kind=np.int64) -> np.ndarray:
    return np.frombuffer(buffer, kind).reshape(rows, dim)


def _bounds(q: np.ndarray, low: np.ndarray, step: np.ndarray, cells: np.ndarray):
    """Lower bounds and the slack to the upper ones of all scores: a component
    lies in [low + step * cell, that + step - 1]. Shared components count (a
    shorter vector ends in zeros)."""
    d = min(q.shape[1], cells.shape[1])
    qf = q[:, :d].astype(np.float64)
    base = (qf * step[:d]) @ cells[:, :d].T.astype(np.float64) + (qf @ low[:d].astype(np.float64))[:, None]
    room = qf * (step[:d] - 1)
    return base + np.minimum(room, 0).sum(axis=1)[:, None], np.abs(room).sum(axis=1)


def _scan(pairs: DataFrame, keep: int) -> DataFrame:
    """Per pair of blocks the survivors: query number, entry number, bounds."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                q = _matrix(r["q"], r["m"], r["q_dim"])
                low, step = (np.frombuffer(r[c], np.int64) for c in ("low", "step"))
                lower, slack = _bounds(q, low, step, _matrix(r["cells"], r["n"], r["dim"], np.uint8))
                k = min(keep, r["n"])
                kth = -np.partition(-lower, k - 1, axis=1)[:, k - 1]
                if r["n"] < keep:
                    kth[:] = -np.inf
                # float sums of large integers may round: a little room keeps bounds bounds
                qi, row = np.nonzero(lower + (slack + 1)[:, None] >= kth[:, None])
                found = lower[qi, row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["qb"]], pa.int32()), pa.array([r["block"]]),
                     *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, t))
                       for x, t in ((qi, pa.int32()), (row, pa.int32()), (found, pa.float64()),
                                    (found + slack[qi] + 1, pa.float64())))],
                    ["qb", "block", "qi", "row", "lower", "upper"])

    return pairs.mapInArrow(scan, "qb int, block string, qi array<int>, row array<int>, "
                                  "lower array<double>, upper array<double>")


def _refine(found: DataFrame, keep: int) -> DataFrame:
    """Exact scores of what the bounds leave: (qi-th query's id, ids, score)."""

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                q = _matrix(r["q"], len(r["q_ids"]), r["q_dim"])
                exact = _matrix(r["exact"], r["n"], r["dim"])
                d = min(q.shape[1], exact.shape[1])
                threshold = {t["qi"]: t["kth"] for t in r["thresholds"]}
                qi, row, upper = (np.asarray(r[c]) for c in ("qi", "row", "upper"))
                order = np.lexsort((-upper, qi))
                qi, row, upper = qi[order], row[order], upper[order]
                cuts = np.flatnonzero(np.diff(qi, prepend=-1, append=-1))
                query, entry, score = [], [], []
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    i = int(qi[a])
                    certain = threshold.get(i, -np.inf)
                    scores = np.zeros(0, np.int64)
                    at = a
                    while at < b and upper[at] >= certain:
                        to = min(at + READ, b)
                        scores = np.concatenate((scores, exact[row[at:to], :d] @ q[i, :d]))
                        at = to
                        if len(scores) >= keep:
                            certain = max(certain, np.partition(scores, -keep)[-keep])
                    near = np.flatnonzero(scores >= certain)
                    query += [r["q_ids"][i]] * len(near)
                    entry += [r["ids"][row[a + j]] for j in near]
                    score += scores[near].tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query, pa.int64()), pa.array(entry, pa.list_(pa.int64())),
                     pa.array(score, pa.int64())], ["query_id", "ids", "score"])

    return found.mapInArrow(refine, "query_id bigint, ids array<bigint>, score bigint")


def exact_top_k(df: DataFrame, *, k: int = 5, every: int = 50, id_col: str = "vec_id",
                vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """Rows ``(query_id, rank int from 1, vec_id, score)``: for each row whose id
    is divisible by ``every`` the ``k`` other rows of the highest integer inner
    product, ties to smaller ids.

    Components become floor(scale * x), x as double. Rows with a null id or
    vector, or with a null or non-finite component, take no part. Rows that
    repeat id and vector count once; a row never finds rows of its own id. Of
    vectors of different lengths the shared components count. Fewer than ``k``
    candidates give fewer rows; an empty table gives an empty result. Other
    columns are not read.
    """
    spark = df.sparkSession
    use_package_on_workers(spark)
    keep = k + 1                                   # a query may meet itself
    vectors = staged(integer_vectors(df, id_col, vector_col, scale), "vectors")
    smallest = W.partitionBy("v").orderBy("id")    # the limit applies in each task before the shuffle
    entries = (vectors.withColumn("nth", F.row_number().over(smallest)).filter(F.col("nth") <= keep)
               .groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")))
    blocks = staged(_vector_blocks(entries), "va-blocks")
    queries = vectors.filter(F.col("id") % every == 0)
    n_blocks = max(1, -(-queries.count() // BLOCK_QUERIES))
    q_blocks = staged(_query_blocks(queries, n_blocks), "query-blocks")

    cells = blocks.select("block", "n", "dim", "low", "step", "cells") \
        .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    pairs = cells.join(q_blocks.withColumn("m", F.size("q_ids")), "qb") \
        .select("qb", "m", "q_dim", "q", "block", "n", "dim", "low", "step", "cells")
    found = staged(_scan(pairs, keep), "survivors")

    best = W.partitionBy("qb", "qi").orderBy(F.desc("lower"))
    thresholds = (found.select("qb", F.explode(F.arrays_zip("qi", "lower")).alias("f")).select("qb", "f.*")
                  .withColumn("nth", F.row_number().over(best)).filter(F.col("nth") == keep)
                  .groupBy("qb").agg(F.collect_list(F.struct("qi", F.col("lower").alias("kth"))).alias("thresholds")))
    exact = (found.join(q_blocks, "qb").join(thresholds, "qb", "left")
             .withColumn("thresholds", F.coalesce("thresholds", F.expr(
                 "cast(array() as array<struct<qi:int,kth:double>>)")))
             .join(blocks.select("block", "n", "dim", "exact", "ids"), "block"))
    scored = _refine(exact.select("q_ids", "q_dim", "q", "qi", "row", "upper", "thresholds",
                                  "n", "dim", "exact", "ids"), keep)
    rank = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (scored.select("query_id", F.explode("ids").alias("vec_id"), "score")
            .filter(F.col("vec_id") != F.col("query_id")).distinct()
            .withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
