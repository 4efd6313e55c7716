"""Typed parsing, recoding and rounding expressions.

All are built-in Catalyst expressions: they fold into whole-stage codegen and
never leave the JVM.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_timestamp(col: Column, fmt: str) -> Column:
    """Text -> timestamp; unparsable text gives NULL instead of an error.

    ANSI mode makes ``to_timestamp`` throw on bad input, so the lenient
    behaviour the pipeline relies on needs ``try_to_timestamp``.
    """
    return F.try_to_timestamp(col, F.lit(fmt))


def safe_int(col: Column) -> Column:
    """Text -> int; non-numeric text gives NULL (``'3.7'`` gives NULL too)."""
    return col.try_cast("int")


def legacy_int(col: Column) -> Column:
    """Text -> int with the non-ANSI cast rules of older Spark runtimes:
    surrounding whitespace/control characters ignored, optional sign, a
    decimal part truncated (``'3.7'`` -> 3, ``'.5'`` -> 0), anything else
    (exponents, letters, empty text) or an overflow gives NULL."""
    text = F.regexp_replace(col, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    well_formed = text.rlike(r"^[+-]?[0-9]*(\.[0-9]*)?$") & ~text.rlike(r"^[+-]?$")
    whole = F.regexp_extract(text, r"^([+-]?[0-9]*)", 1)
    digits = F.when(whole.rlike(r"[0-9]"), whole).otherwise(F.lit("0"))
    return F.when(well_formed, digits.try_cast("int"))


def lookup(mapping: Mapping[str, str], col: Column) -> Column:
    """Map-literal recode: listed value -> target, anything else -> NULL."""
    if not mapping:
        return F.lit(None).cast("string")
    literal = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return literal[col]


def replace_values(mapping: Mapping[str, str], col: Column) -> Column:
    """CASE recode: listed value -> target, other values and NULL unchanged."""
    if not mapping:
        return col
    expr = None
    for source, target in mapping.items():
        expr = (F.when(col == source, F.lit(target)) if expr is None
                else expr.when(col == source, F.lit(target)))
    return expr.otherwise(col)


def share_pct(part: Column, total: Column, digits: int = 1) -> Column:
    """``round(part / total * 100, digits)``, HALF_UP, as a double."""
    return F.round(part / total * 100, digits)
