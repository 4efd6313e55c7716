"""Typing and value recoding, each applied as one projection.

All recodes of a step go into a single ``withColumns`` so the plan holds one
Project, not a chain that Catalyst must collapse.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.scalar import (legacy_int, lookup, replace_values, safe_int,
                                       safe_timestamp)


def typed_columns(df: DataFrame, timestamps: Mapping[str, str] | None = None,
                  integers: Sequence[str] = (), legacy_integers: bool = False) -> DataFrame:
    """Parse text columns in place: ``{column: pattern}`` to timestamps and
    ``integers`` to int. Unparsable text becomes NULL (never an error).

    ``legacy_integers`` reproduces the lenient cast of older runtimes, which
    truncates decimal text (``'3.7'`` -> 3) instead of giving NULL."""
    to_int = legacy_int if legacy_integers else safe_int
    exprs = {c: safe_timestamp(F.col(c), fmt) for c, fmt in (timestamps or {}).items()}
    exprs.update({c: to_int(F.col(c)) for c in integers})
    return df.withColumns(exprs) if exprs else df


def recode_boolean(df: DataFrame, columns: Sequence[str], mapping: Mapping[str, str]) -> DataFrame:
    """Map-literal recode of several columns; a value not in ``mapping``
    (other spellings, empty string) and NULL become NULL."""
    return df.withColumns({c: lookup(mapping, F.col(c).cast("string")) for c in columns})


def recode_values(df: DataFrame, recodes: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Per column ``{from: to}``; unlisted values and NULL stay as they are."""
    return df.withColumns({c: replace_values(m, F.col(c)) for c, m in recodes.items()})


def unmapped_report(df: DataFrame, columns: Sequence[str], mapping: Mapping[str, str]) -> DataFrame:
    """Values that a lookup recode would turn into NULL, counted per column:
    ``(column_name, value, n_rows)``. NULL inputs are not counted.

    One scan: each row contributes one ``(column, value)`` struct per column.
    """
    known = list(mapping)
    packed = F.array(*[F.struct(F.lit(c).alias("column_name"),
                                F.col(c).cast("string").alias("value")) for c in columns])
    long = df.select(F.inline(packed))
    return (long.where(F.col("value").isNotNull() & ~F.col("value").isin(known))
                .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_rows")))
