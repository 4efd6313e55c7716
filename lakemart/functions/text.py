"""String expressions that stay inside the JVM (no Python UDF).

``ascii_fold`` reproduces "lower-case, NFKD-decompose, drop non-ASCII" on a
column. The character table is generated from ``unicodedata`` by rule, so it
covers every code point instead of a hand-picked accent list.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Must stay as published for identical column names.
SLUG_MAX_LEN = 110          # names longer than this are cut ...
SLUG_MIN_CUT = 30           # ... back to the last "_" when it lies beyond this index
SLUG_EMPTY = "col"          # name used when nothing survives sanitising
SLUG_DIGIT_PREFIX = "c_"    # prefix for names that start with a digit

MULTISELECT_SPLIT = r",\s*"   # separator regex of simple multi-select cells
OPTION_JOINER = ", "          # separator between options in a multi-select cell


# Zero-fold characters below this code point are deleted by the translate
# table itself; rarer ones (CJK, emoji, ...) by the slow path.
_DELETE_BELOW = 0x3000


@functools.lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """(from_chars, to_chars, multi) for every non-ASCII code point.

    A code point whose NFKD form keeps exactly one ASCII character maps to it
    through ``translate``; one that keeps none is deleted by the same
    ``translate`` (listed after the mapped ones, with no counterpart) when it
    lies below U+3000; one that keeps several goes into ``multi``.
    """
    src, dst, delete, multi = [], [], [], {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        folded = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")
        if len(folded) == 1:
            src.append(ch)
            dst.append(folded)
        elif len(folded) > 1:
            multi[ch] = folded
        elif cp < _DELETE_BELOW:
            delete.append(ch)
    return "".join(src) + "".join(delete), "".join(dst), multi


def ascii_fold(col: Column) -> Column:
    """NFKD fold to ASCII of an already lower-cased string column."""
    src, dst, multi = _fold_tables()
    single = F.translate(col, src, dst)
    multi_chars = "".join(multi)
    multi_map = F.create_map(*[F.lit(x) for kv in multi.items() for x in kv])

    def slow(s: Column) -> Column:
        # the text is cut into characters that expand and runs of others, so
        # only the former meet the map; what is not ASCII then is dropped
        has_multi = F.length(F.translate(s, multi_chars, "")) < F.length(s)
        expanded = F.array_join(
            F.transform(F.regexp_extract_all(s, F.lit(f"([{multi_chars}]|[^{multi_chars}]+)"), 1),
                        lambda c: F.when(F.length(c) == 1, F.coalesce(multi_map[c], c)).otherwise(c)), "")
        return F.regexp_replace(F.when(has_multi, expanded).otherwise(s),
                                r"[^\x00-\x7F]", "")

    # fast path: nothing but ASCII left (one byte per character)
    return let(single, lambda s: F.when(F.length(s) == F.octet_length(s), s)
                                 .otherwise(slow(s)))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a Column -> Column
    function that may use it many times). Catalyst does not always share a
    sub-expression used in several CASE branches; binding it as the lambda
    variable of a one-element ``transform`` guarantees a single evaluation."""
    return F.transform(F.array(value), body)[0]


def slug(col: Column, max_len: int | None = SLUG_MAX_LEN) -> Column:
    """Identifier-safe form of a text column: ``[a-z0-9_]`` only.

    lower -> ASCII fold -> runs of other characters become ``_`` -> strip
    ``_`` -> empty becomes ``col`` -> leading digit gets ``c_`` -> optional
    length cut at the last ``_``.
    """
    base = F.regexp_replace(
        F.regexp_replace(ascii_fold(F.lower(col)), "[^a-z0-9]+", "_"), "^_+|_+$", "")

    def edge_rules(s: Column) -> Column:
        s = F.when(s == "", F.lit(SLUG_EMPTY)) \
             .when(s.rlike("^[0-9]"), F.concat(F.lit(SLUG_DIGIT_PREFIX), s)).otherwise(s)
        if max_len is None:
            return s
        cut = F.substring(s, 1, max_len)
        from_end = F.locate("_", F.reverse(cut))       # 0 when the cut has no "_"
        last_us = F.when(from_end == 0, F.lit(-1)).otherwise(F.length(cut) - from_end)
        trimmed = F.when(last_us > SLUG_MIN_CUT, cut.substr(F.lit(1), last_us)).otherwise(cut)
        return F.when(F.length(s) > max_len, trimmed).otherwise(s)

    return F.when(col.isNotNull(), let(base, edge_rules))


def split_options(col: Column) -> Column:
    """Simple multi-select cell -> array of trimmed, non-empty options.

    Split on ``,\\s*``, trim spaces, drop empty pieces; duplicates and case
    are kept. A NULL cell gives a NULL array (so an explode emits no row).
    """
    return F.filter(F.transform(F.split(col, MULTISELECT_SPLIT), lambda x: F.trim(x)),
                    lambda x: x != "")
