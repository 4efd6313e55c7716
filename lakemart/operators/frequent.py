"""Exact most frequent values of many columns without counting every value.

1. A pass summarises each column per task: at most ``capacity`` values with lower
   bounds of their counts, and how much any value can have lost (Misra-Gries).
   Summaries add up: a value occurs at least as often as its bounds' sum, and at
   most as often as that and all tasks' losses together.
2. Where the k-th lower bound is over the losses, a value that no task kept cannot
   be among the first k: the values that can are the candidates, and a second pass
   counts them exactly in a hash join.

Columns without such a proof (ids, flat distributions) are counted in full, so
the result is always exact.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.operators.quality import value_counts
from lakemart.session import materialize

#: Values of a column that a task keeps, for each asked for; at least so many.
KEPT_PER_RESULT = 64
KEPT = 1 << 10


class Summary:
    """Misra-Gries summary of one column's values (null is one of them)."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.values, self.counts = pa.array([], pa.string()), np.zeros(0, np.int64)

    def add(self, values: pa.Array) -> None:
        found = pc.value_counts(pa.concat_arrays([self.values, values]))
        old = pc.index_in(self.values, found.field("values")).to_numpy(zero_copy_only=False)
        counts = found.field("counts").to_numpy().copy()
        counts[old] += self.counts - 1          # a kept value was put in front once
        self.values = found.field("values")
        if len(counts) > self.capacity:
            less = int(np.partition(counts, -self.capacity - 1)[-self.capacity - 1])
            self.lost += less
            counts = counts - less
            stay = counts > 0
            self.values, counts = self.values.filter(pa.array(stay)), counts[stay]
        self.counts = counts


def _summaries(df: DataFrame, columns: Sequence[str], capacity: int) -> DataFrame:
    """Rows (at, value, n, lost) from each task: its kept values of column ``at``
    with lower bounds of their counts, and a row with its losses."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Summary(capacity) for _ in columns]
        for batch in batches:
            for summary, values in zip(own, batch.columns, strict=True):
                summary.add(values)
        for i, s in enumerate(own):
            n = len(s.values)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * (n + 1), pa.int32()), pa.concat_arrays([s.values, pa.nulls(1, pa.string())]),
                 pa.concat_arrays([pa.array(s.counts), pa.nulls(1, pa.int64())]),
                 pa.array([None] * n + [s.lost], pa.int64())], ["at", "value", "n", "lost"])

    return df.mapInArrow(summarise, "at int, value string, n long, lost long")


def frequent_values(df: DataFrame, columns: Sequence[str] | None = None, k: int = 15,
                    capacity: int | None = None) -> DataFrame:
    """``(column_name, rank, value, n_rows)``: the ``k`` most frequent values (as
    text, NULL included) of each column and their exact counts; ties go to the
    smaller value, NULL before all. Fewer rows where a column has fewer values;
    none for an empty table. ``columns`` are all by default, each of a type that
    casts to string."""
    if k < 1:
        raise ValueError("k must be positive")
    columns = list(df.columns if columns is None else columns)
    capacity = capacity or max(KEPT, KEPT_PER_RESULT * k)
    # numbered columns: names need not be distinct from those used here
    texts = df.select(*[F.col("`" + c.replace("`", "``") + "`").cast("string").alias(f"c{i}")
                        for i, c in enumerate(columns)])
    kept = materialize(_summaries(texts, columns, capacity), "summaries")
    lost = kept.filter("lost is not null").groupBy("at").agg(F.sum("lost").alias("lost"))
    least = materialize(kept.filter("lost is null").groupBy("at", "value").agg(F.sum("n").alias("n_rows")), "least")
    # a row a column: its losses, and the k-th lower bound, where there are so many
    bounds = _first(least, k).groupBy("at").agg(F.min("n_rows").alias("kth"), F.count(F.lit(1)).alias("n")) \
        .join(lost, "at", "right").select("at", "lost", F.when(F.col("n") == k, F.col("kth")).alias("kth"))
    bounds = materialize(bounds, "bounds")
    proven = bounds.filter("lost = 0 or kth > lost")
    candidates = materialize(least.join(proven, "at").filter("kth is null or n_rows + lost >= kth")
                             .select("at", "value"), "candidates")
    cells = texts.select(F.inline(F.array(*[F.struct(F.lit(i).alias("at"), F.col(f"c{i}").alias("value"))
                                            for i in range(len(columns))])))
    asked = candidates.select(F.col("at").alias("of"), F.col("value").alias("kept"))
    counted = cells.join(asked, (F.col("at") == F.col("of")) & F.col("value").eqNullSafe(F.col("kept")), "left_semi") \
        .groupBy("at", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    out = _first(counted, k)
    known = {r.at for r in proven.select("at").collect()}
    rest = [i for i in range(len(columns)) if i not in known]
    if rest:
        full = value_counts(texts, [f"c{i}" for i in rest], sort=False).withColumn(
            "at", F.substring("column_name", 2, 10).cast("int")).select("at", "value", "n_rows")
        out = out.unionByName(_first(full, k))
    return out.select(F.element_at(F.array(*map(F.lit, columns)), F.col("at") + 1).alias("column_name"),
                      "rank", "value", "n_rows")


def _first(counts: DataFrame, k: int) -> DataFrame:
    """(at, rank, value, n_rows) of the first ``k`` per column; Spark drops what is
    behind them within a task before it shuffles."""
    order = Window.partitionBy("at").orderBy(F.col("n_rows").desc(), F.col("value").asc_nulls_first())
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("at", "rank", "value", "n_rows")
