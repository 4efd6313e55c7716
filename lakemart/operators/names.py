"""Column-name hygiene for raw headers.

Headers are schema metadata, so they are cleaned on the driver in plain
Python; the same rules exist as a column expression in
:func:`lakemart.functions.text.slug` for cleaning values.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from lakemart.functions.text import SLUG_DIGIT_PREFIX, SLUG_EMPTY, SLUG_MAX_LEN, SLUG_MIN_CUT

_NON_ALNUM = re.compile(r"[^a-z0-9]+")


def sanitize_name(raw: str | None, max_len: int | None = SLUG_MAX_LEN) -> str | None:
    """Raw header -> ``[a-z0-9_]`` identifier.

    lower; NFKD and drop non-ASCII; runs of other characters -> ``_``; strip
    ``_``; empty -> ``col``; leading digit -> ``c_`` prefix; longer than
    ``max_len`` -> cut to ``max_len`` and back to the last ``_`` when that
    ``_`` lies beyond index 30.
    """
    if raw is None:
        return None
    text = unicodedata.normalize("NFKD", raw.lower()).encode("ascii", "ignore").decode("ascii")
    text = _NON_ALNUM.sub("_", text).strip("_") or SLUG_EMPTY
    if text[0].isdigit():
        text = SLUG_DIGIT_PREFIX + text
    if max_len is not None and len(text) > max_len:
        cut = text[:max_len]
        last = cut.rfind("_")
        text = cut[:last] if last > SLUG_MIN_CUT else cut
    return text


def dedupe_names(names: Iterable[str]) -> list[str]:
    """First occurrence keeps its name; a repeat gets ``_k`` with the smallest
    ``k`` (counted per base name) that is not yet taken, so ``[a, a, a_1]``
    gives three different names."""
    names = list(names)
    taken: set[str] = set()
    reserved = set(names)
    counters: dict[str, int] = {}
    out = []
    for name in names:
        if name not in taken:
            out.append(name)
            taken.add(name)
            continue
        k = counters.get(name, 0)
        while True:
            k += 1
            candidate = f"{name}_{k}"
            if candidate not in taken and candidate not in reserved:
                break
        counters[name] = k
        taken.add(candidate)
        out.append(candidate)
    return out


def sanitize_columns(df: DataFrame, max_len: int | None = SLUG_MAX_LEN
                     ) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Rename every column positionally (raw names may contain dots, which a
    by-name rename would read as struct access). Returns the renamed frame and
    the ``(raw, sanitised)`` column map."""
    raw = df.columns
    clean = dedupe_names(sanitize_name(c, max_len) for c in raw)
    return df.toDF(*clean), list(zip(raw, clean))


def column_map_frame(spark: SparkSession, column_map: Sequence[tuple[str, str]]) -> DataFrame:
    """The column map as rows ``(position, coluna_bruta, coluna_saneada)``."""
    rows = [(i + 1, r, s) for i, (r, s) in enumerate(column_map)]
    return spark.createDataFrame(rows, "position int, coluna_bruta string, coluna_saneada string")
