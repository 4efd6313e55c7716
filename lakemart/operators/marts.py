"""Mart builders: count, distinct-count, share-of-total and long format.

Scale notes
-----------
* ``count(*)`` marts aggregate partially on the map side, so a key holding a
  third of the rows arrives at the reducer as one partial row per map task.
* ``count_distinct(token)`` is planned by Catalyst as a dedupe on
  ``(keys, token)`` followed by a count on ``keys``; the first shuffle is
  hashed on the token as well, so a hot key is spread over many reducers.
* A map task's dedupe holds all of its distinct rows: where nearly every row is
  one, rows are dealt by token into :func:`parts_for` parts before, which the
  join and the dedupe on the token then share.
* The share denominator has one row per group value (e.g. per year); it is an
  aggregate, so AQE picks the join by its measured bytes.
* Long-format marts read their source once: every dimension becomes an
  element of ``array(struct(dimension, values))`` that is exploded, instead of
  one scan per dimension glued together with UNION ALL.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.scalar import share_pct
from lakemart.functions.text import split_options

#: Rows dealt to a task that holds distinct rows in memory; fewer where tasks would
#: be fewer than the cores.
PART_ROWS = 1 << 18
LEAST_PART_ROWS = 1 << 15


def parts_for(df: DataFrame) -> int:
    """Into how many parts the rows of ``df`` (a stored table: Parquet footers give
    the count) are dealt, so that what one task holds does not grow with them."""
    rows, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    return max(1, math.ceil(rows / PART_ROWS), min(cores, math.ceil(rows / LEAST_PART_ROWS)))


def mart_order(keys: Sequence[str], measure: str, leading: int = 1) -> list[Column]:
    """The order in which marts are published: the first ``leading`` keys
    ascending, the measure descending, the remaining keys ascending as tie-break."""
    keys = list(keys)
    return [*[F.col(k).asc_nulls_first() for k in keys[:leading]], F.col(measure).desc(),
            *[F.col(k).asc_nulls_first() for k in keys[leading:]]]


def order_mart(df: DataFrame, keys: Sequence[str], measure: str, leading: int = 1) -> DataFrame:
    return df.orderBy(*mart_order(keys, measure, leading))


def count_mart(df: DataFrame, keys: Sequence[str], measure: str = "qtd_respondentes",
               sort: bool = True, leading: int = 1) -> DataFrame:
    """``count(*)`` per key combination; NULL is a group of its own."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(measure))
    return order_mart(out, keys, measure, leading) if sort else out


MART_ID = "__grouping_id"


def _grouping_ids(marts: Mapping[str, Sequence[str]], all_keys: Sequence[str]) -> dict[str, int]:
    """``grouping_id()`` value of each mart's key set (bit set = key rolled up)."""
    n = len(all_keys)
    return {name: sum(1 << (n - 1 - i) for i, k in enumerate(all_keys) if k not in keys)
            for name, keys in marts.items()}


def count_marts(df: DataFrame, marts: Mapping[str, Sequence[str]],
                measure: str = "qtd_respondentes") -> DataFrame:
    """Several ``count(*)`` marts in one scan: GROUPING SETS over the union of
    their keys, one set per mart, tagged with ``grouping_id()``.

    Catalyst plans each DataFrame on its own, so N marts built separately read
    and join their source N times; here the source is read (and joined) once and
    counted at the finest keys, and only those counts are expanded per set and
    summed. A key that is
    NULL in the data stays distinguishable from a rolled-up key because rows are
    selected by grouping id (:func:`split_count_marts`).
    """
    all_keys = list(dict.fromkeys(k for keys in marts.values() for k in keys))
    # one grouping set per distinct key *set* (key order inside a set is irrelevant)
    sets = [sorted(keys, key=all_keys.index)
            for keys in dict.fromkeys(frozenset(k) for k in marts.values())]
    finest = df.groupBy(*all_keys).agg(F.count(F.lit(1)).alias("__n"))
    return (finest.groupingSets(sets, *all_keys)
                  .agg(F.sum("__n").alias(measure), F.grouping_id().alias(MART_ID)))


def split_count_marts(combined: DataFrame, marts: Mapping[str, Sequence[str]],
                      measure: str = "qtd_respondentes", sort: bool = True,
                      leading: int = 1) -> dict[str, DataFrame]:
    """The individual marts of a :func:`count_marts` result (materialise the
    combined frame first when several of them are used)."""
    all_keys = list(dict.fromkeys(k for keys in marts.values() for k in keys))
    ids = _grouping_ids(marts, all_keys)
    out = {}
    for name, keys in marts.items():
        mart = combined.where(F.col(MART_ID) == ids[name]).select(*keys, measure)
        out[name] = order_mart(mart, keys, measure, leading) if sort else mart
    return out


def mart_names(combined: DataFrame, marts: Mapping[str, Sequence[str]]) -> Column:
    """``array<string>`` of the marts each row of a :func:`count_marts` result
    belongs to (several when marts share a key set); explode it for per-mart rows."""
    all_keys = list(dict.fromkeys(k for keys in marts.values() for k in keys))
    by_id: dict[int, list[str]] = {}
    for name, gid in _grouping_ids(marts, all_keys).items():
        by_id.setdefault(gid, []).append(name)
    pairs = [x for gid, names in by_id.items()
             for x in (F.lit(gid), F.array(*[F.lit(n) for n in names]))]
    return F.create_map(*pairs)[combined[MART_ID]]


def distinct_mart(df: DataFrame, keys: Sequence[str], token: str,
                  measure: str = "qtd_respondentes", sort: bool = True,
                  leading: int = 1) -> DataFrame:
    """``count(DISTINCT token)`` per key combination (NULL tokens ignored)."""
    out = df.groupBy(*keys).agg(F.count_distinct(F.col(token)).alias(measure))
    return order_mart(out, keys, measure, leading) if sort else out


def group_totals(base: DataFrame, group: str, token: str,
                 total: str = "total_respondentes") -> DataFrame:
    """Distinct tokens per group value: the share denominator."""
    return base.groupBy(group).agg(F.count_distinct(F.col(token)).alias(total))


def share_mart(exploded: DataFrame, base: DataFrame, group: str, keys: Sequence[str],
               token: str, measure: str = "qtd_respondentes",
               pct: str = "pct_respondentes_ano", digits: int = 1,
               sort: bool = True) -> DataFrame:
    """Distinct tokens per ``(group, *keys)`` and their share of all distinct
    tokens of the group in ``base``: ``round(qtd / total * 100, digits)``.

    Shares of one group need not add up to 100 (a token may pick several
    options, and tokens without an answer still count in the denominator).
    """
    all_keys = [group, *keys]
    counts = exploded.groupBy(*all_keys).agg(F.count_distinct(F.col(token)).alias(measure))
    totals = group_totals(base, group, token, "__total")
    out = (counts.join(totals, on=group, how="inner")
                 .withColumn(pct, share_pct(F.col(measure), F.col("__total"), digits))
                 .drop("__total"))
    return order_mart(out, all_keys, measure, leading=1 + min(1, len(keys) - 1)) if sort else out


@dataclass(frozen=True)
class Dimension:
    """One question turned into rows of a long-format mart."""
    name: str                  # value of the dimension column
    column: str                # source column
    multiselect: bool = False  # split the cell as a simple multi-select
    tokens: bool = False       # the column holds an array of options already


def _values(dim: Dimension, distinct: bool) -> Column:
    c = F.col(dim.column)
    if dim.tokens:
        return c
    if dim.multiselect:
        # marts count distinct tokens: pieces repeated in a cell go before the explode
        return F.array_distinct(split_options(c)) if distinct else split_options(c)
    return F.when(c.isNotNull(), F.array(c.cast("string")))


def long_format(df: DataFrame, carry: Sequence[str], dimensions: Sequence[Dimension],
                dimension_col: str = "dimensao", value_col: str = "valor",
                distinct: bool = False) -> DataFrame:
    """Stack several questions into ``(*carry, dimension, value)`` rows in one scan.

    Single-valued dimensions keep every non-NULL value (the empty string
    included); multi-select dimensions give one row per non-empty option, with
    ``distinct`` one per different option of a cell.
    """
    if not dimensions:   # none of the questions exists: an empty, typed result
        return df.select(*carry, F.lit(None).cast("string").alias(dimension_col),
                         F.lit(None).cast("string").alias(value_col)).where(F.lit(False))
    packed = F.array(*[F.struct(F.lit(d.name).alias(dimension_col),
                                _values(d, distinct).alias("__values")) for d in dimensions])
    per_dim = df.select(*carry, F.inline(packed))
    return per_dim.select(*carry, dimension_col,
                          F.explode("__values").alias(value_col))


def base_projection(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Respondent-level table: a plain column subset (pruned at the scan)."""
    return df.select(*columns)
