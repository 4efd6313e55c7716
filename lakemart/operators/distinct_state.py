"""Mergeable distinct counts: exact bitmaps kept per finest key.

``count(DISTINCT token)`` marts are not additive: a mart of fewer keys can't be
summed from one of more keys, nor a new edition added to an old result. A
*state* can: tokens are numbered densely from 1, and for every combination of
the finest keys it holds bitmaps of the numbers seen, one row per run of 32768
numbers. Bitmaps are united by ``bitmap_or_agg`` over any subset of the keys and
over editions, and counting their bits gives the exact distinct count.

Scale notes
-----------
* A token's number comes from its place in one of ``NUMBER_PARTS`` hashed parts
  plus the sizes of the parts before: no window over all tokens.
* Tokens of a batch that were not there before get the next numbers, so a batch's
  new tokens share bitmaps; the state of older batches is not touched.
* Partial bitmaps are built in each map task, sorted by key, one buffer at a
  time; a key with a third of all rows arrives as one bitmap per task and run of
  numbers, and is spread over reducers by that run.
* A bitmap has 4096 bytes however few bits are set; zeros compress in shuffles
  and Parquet. Keys with a handful of tokens each are better counted directly
  (``marts.distinct_mart``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakemart.functions.scalar import share_pct
from lakemart.operators.marts import order_mart
from lakemart.session import materialize

#: Parts that tokens are numbered in; their sizes are summed up in one task.
NUMBER_PARTS = 4096
#: Columns of a state beside its keys.
RUN, BITS = "__run", "__bits"
_TOKEN, _NUMBER = "__token", "__number"


def number_tokens(rows: DataFrame, token: str, start: int = 1,
                  known: DataFrame | None = None) -> DataFrame:
    """``(__token, __number)`` of the tokens of ``rows`` that ``known`` (same
    columns) doesn't have: numbers from ``start`` on without a gap, the same in
    every run on the same tokens. NULL tokens get none."""
    tokens = rows.select(F.col(token).alias(_TOKEN)).where(F.col(_TOKEN).isNotNull()).distinct()
    if known is not None:
        tokens = tokens.join(known, _TOKEN, "left_anti")
    placed = materialize(tokens.withColumn("__part", F.pmod(F.xxhash64(_TOKEN), F.lit(NUMBER_PARTS))), "tokens")
    # one row a part goes through this window
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
               .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")))
    place = F.row_number().over(W.partitionBy("__part").orderBy(_TOKEN))
    return (placed.withColumn("__place", place).join(offsets, "__part")
            .select(_TOKEN, (F.col("__before") + F.col("__place") + F.lit(start - 1)).cast("long").alias(_NUMBER)))


def distinct_state(rows: DataFrame, keys: Sequence[str], token: str, numbers: DataFrame) -> DataFrame:
    """The state ``(*keys, __run, __bits)`` of ``rows``. Every non-NULL token has
    a row in ``numbers`` (:func:`number_tokens`). A key combination that has
    only NULL tokens keeps a row without bits, so that it counts as 0."""
    rows = rows.select(*keys, F.col(token).alias(_TOKEN))
    numbered = rows.where(F.col(_TOKEN).isNotNull()).join(numbers, _TOKEN)
    bits = (numbered.groupBy(*keys, F.bitmap_bucket_number(_NUMBER).alias(RUN))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(_NUMBER)).alias(BITS)))
    none = rows.where(F.col(_TOKEN).isNull()).select(*keys).distinct()
    return bits.unionByName(none.withColumns({RUN: F.lit(None).cast("long"), BITS: F.lit(None).cast("binary")}))


def roll_up(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state of a subset of the keys (or of a union of states over the same keys)."""
    return state.groupBy(*keys, RUN).agg(F.bitmap_or_agg(BITS).alias(BITS))


def merge_states(states: Sequence[DataFrame]) -> DataFrame:
    """One state of several over the same keys and numbering."""
    keys = [c for c in states[0].columns if c not in (RUN, BITS)]
    return roll_up(reduce(DataFrame.unionByName, states), keys)


def state_counts(state: DataFrame, keys: Sequence[str], measure: str = "qtd_respondentes",
                 sort: bool = True, leading: int = 1) -> DataFrame:
    """``count(DISTINCT token)`` per combination of ``keys``, a subset of the
    state's; equal to :func:`lakemart.operators.marts.distinct_mart` on the rows."""
    bits = F.when(F.col(RUN).isNotNull(), F.bitmap_count(BITS)).otherwise(0)
    out = roll_up(state, keys).groupBy(*keys).agg(F.sum(bits).cast("long").alias(measure))
    return order_mart(out, keys, measure, leading) if sort else out


def state_shares(state: DataFrame, everyone: DataFrame, group: str, keys: Sequence[str],
                 measure: str = "qtd_respondentes", pct: str = "pct_respondentes_ano",
                 digits: int = 1, sort: bool = True) -> DataFrame:
    """Distinct tokens per ``(group, *keys)`` and their share of the group's
    tokens in ``everyone``, a state that counts all of them; equal to
    :func:`lakemart.operators.marts.share_mart` on the rows."""
    counts = state_counts(state, [group, *keys], measure, sort=False)
    totals = state_counts(everyone, [group], "__total", sort=False)
    out = (counts.join(totals, on=group, how="inner")
                 .withColumn(pct, share_pct(F.col(measure), F.col("__total"), digits)).drop("__total"))
    return order_mart(out, [group, *keys], measure, leading=1 + min(1, len(keys))) if sort else out


class DistinctStore:
    """A state kept in a folder, one batch (an edition, a delivery) at a time.

    ``bits/batch=<name>`` holds a batch's state and ``numbers/`` the numbers,
    which are only ever added to. Adding a batch reads the known tokens and the
    batch; giving a batch again replaces its state. Numbers are written first:
    a run that fails after that leaves tokens that no bitmap holds, and the
    batch can be given again. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _read(self, part: str) -> DataFrame | None:
        try:
            return self.spark.read.option("mergeSchema", "false").parquet(f"{self.path}/{part}")
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None     # nothing is there yet, or only batches without rows
            raise

    def add(self, batch: str, rows: DataFrame, keys: Sequence[str], token: str) -> None:
        """Number the batch's new tokens and write (or replace) its state."""
        known = self._read("numbers")
        last = known.agg(F.max(_NUMBER)).first()[0] if known is not None else None
        new = number_tokens(rows, token, (last or 0) + 1, known)
        new.write.mode("append").parquet(f"{self.path}/numbers")
        state = distinct_state(rows, keys, token, self._read("numbers"))
        state.write.mode("overwrite").parquet(f"{self.path}/bits/batch={batch}")

    def state(self) -> DataFrame:
        """The batches' states, not united yet: counts and roll-ups unite them."""
        bits = self._read("bits")
        if bits is None:
            raise ValueError(f"no batch has been added to {self.path}")
        return bits.drop("batch")
