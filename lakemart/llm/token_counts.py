"""Token counts: batch encoding in an Arrow function that returns lengths only.

A text is cut at safe boundaries - places where the tokenizer's own splitting
pattern always starts a new piece - so that the counts of the pieces add up to
the count of the whole text, however long it is. Distinct pieces are encoded
once, in batches of about the same number of bytes.
"""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakemart.llm.common import WHITE, text_or_empty, use_package_on_workers

#: Bytes of pieces given to one ``encode_batch`` call.
BATCH_BYTES = 1 << 20
#: Pieces longer than this are cut again where ASCII letters meet digits.
LONG_PIECE = 1 << 16
#: Cached piece counts per worker; the cache starts anew beyond this.
CACHE_ENTRIES = 1_000_000

# Before white space that follows a non-white character: no alternative of the
# splitting pattern spans that place, and no special token holds white space.
_PIECES = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
# Between an ASCII letter and an ASCII digit: \p{L}+ and \p{N}+ both end there.
_ALNUM = re.compile("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")


def pieces_of(text: str) -> list[str]:
    """``text`` cut at safe boundaries (their concatenation is ``text``)."""
    found = _PIECES.findall(text)
    if len(text) <= LONG_PIECE or all(len(p) <= LONG_PIECE for p in found):
        return found
    return [q for p in found for q in (_ALNUM.split(p) if len(p) > LONG_PIECE else (p,))]


class PieceCounter:
    """Counts of pieces, each distinct piece encoded once per worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {}

    def learn(self, pieces: Iterable[str]) -> None:
        for batch in _by_bytes(pieces):
            for piece, encoding in zip(batch, self.tokenizer.encode_batch_fast(
                    batch, add_special_tokens=False), strict=True):
                self.known[piece] = len(encoding)

    def counts(self, texts: Iterable[str]) -> Iterator[int]:
        for group in _by_bytes(texts):
            cut = [pieces_of(t) for t in group]
            if len(self.known) > CACHE_ENTRIES:
                self.known.clear()
            new = {p for pieces in cut for p in pieces if p not in self.known}
            self.learn(new)
            for pieces in cut:
                yield sum(map(self.known.__getitem__, pieces))


def _by_bytes(texts: Iterable[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= BATCH_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


_counters: dict[str, PieceCounter] = {}


def counter(path: str) -> PieceCounter:
    if path not in _counters:
        _counters[path] = PieceCounter(path)
    return _counters[path]


def token_counts(df: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Rows ``(id, n_bytes long, n_tokens long)``, one per row of ``df``.

    ``tokenizer_path`` is a ``tokenizers`` JSON file that every executor can
    read. Counts are those of ``encode(text, add_special_tokens=False)``
    without truncation or padding; strings of special tokens inside a text
    count as the library's default has it.

    Null texts count as empty (0 bytes, 0 tokens); null and repeated ids are
    kept as they are; other columns of ``df`` are not read, whatever their
    names; an empty table gives an empty result.
    """
    use_package_on_workers(df.sparkSession)
    rows = df.select(df[id_col].alias("id"), text_or_empty(text_col).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # many cached strings, no cycles: collections would only rescan them
        try:
            count = counter(tokenizer_path)
            for batch in batches:
                ids, texts = batch.columns
                n = pa.array(count.counts(t.as_py() for t in texts), pa.int64())
                size = pc.binary_length(texts).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([ids, size, n], ["id", "n_bytes", "n_tokens"])
        finally:
            gc.enable()

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType),
                           T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])
    return rows.mapInArrow(encode, schema).withColumnRenamed("id", id_col)
