"""Raw survey CSV scans.

Quoted fields may span lines. :func:`read_raw_csv` scans with ``multiLine``, one
task a file, which many files of moderate size don't mind; :func:`read_split_csv`
reads the byte ranges of a large file in as many tasks, by a prefix scan over the
state (inside a quoted field or not) in which each range begins.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import materialize

if TYPE_CHECKING:
    import pyarrow as pa

RAW_CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',          # RFC-4180: a quote inside a field is doubled
    "encoding": "UTF-8",
    "inferSchema": "false",  # every answer stays a string in bronze
    "mode": "PERMISSIVE",
    # a further file whose header differs from the first one's is an error,
    # not loaded by position
    "enforceSchema": "false",
}

CORRUPT = "__corrupt_line"


def read_raw_csv(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """All-string scan of one raw edition (header from the file).

    ``options`` override the reader settings; e.g. ``multiLine="false"`` for a
    delivery without line breaks inside fields lets Spark split large files.
    """
    settings = {**RAW_CSV_OPTIONS, **options}
    header = spark.read.options(**{**settings, "header": "false"}).csv(path).first()
    names = [(c or "").lower() for c in header or ()]
    if len(set(names)) < len(names):
        # the reader numbers repeated names, which no file's header then equals
        settings["enforceSchema"] = "true"
    return spark.read.options(**settings).csv(path)


def corrupt_lines(spark: SparkSession, path: str, **options: str) -> int:
    """Lines with more or fewer fields than the header (their extra fields are
    lost, their missing ones NULL in :func:`read_raw_csv`)."""
    schema = read_raw_csv(spark, path, **options).schema.add(CORRUPT, "string")
    lines = spark.read.schema(schema).options(**{
        **RAW_CSV_OPTIONS, "enforceSchema": "true", "columnNameOfCorruptRecord": CORRUPT, **options}).csv(path)
    # all columns are counted: Spark parses, and so checks, only those asked for
    return lines.agg(F.count(CORRUPT).alias("corrupt_lines"), *[
        F.count(F.col("`" + f.name.replace("`", "``") + "`")).alias(f"n{i}")
        for i, f in enumerate(schema.fields[:-1])]).first()["corrupt_lines"]


def read_editions(spark: SparkSession, paths: Mapping[int, str]) -> dict[int, DataFrame]:
    """One scan per edition: editions have different headers, so they are not
    read through one schema."""
    return {edition: read_raw_csv(spark, path) for edition, path in paths.items()}


# -- one file, many tasks -------------------------------------------------------

#: From the start of a record, a line that ends inside a quoted field: complete
#: fields, then an opening quote without its closing one.
_OPEN = r'^(?:(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+)?+,)*+"(?:[^"]++|"")*+$'
_PIECES = "file string, block bigint, value string, starts boolean, ends boolean, first boolean"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines by byte range (file, block), numbered in order, and what a
    line does to the two states it can begin in: whether from a record's start it
    opens a quoted field that goes on, and whether from inside a quoted field it
    comes to the record's end."""
    value = F.col("value")
    # most lines hold no quote, and change nothing
    opens = F.contains(value, F.lit('"')) & value.rlike(_OPEN)
    closes = F.contains(value, F.lit('"')) & ~F.concat(F.lit('"'), value).rlike(_OPEN)
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), opens.alias("opens"), closes.alias("closes"), "value")


def range_states(lines: DataFrame) -> DataFrame:
    """(file, block, quoted): whether a byte range begins inside a quoted field.
    Each range reports where it ends from either state; the prefix scan over a
    file's ranges (a row each) picks the state."""
    changes = F.when(F.col("opens") | F.col("closes"), F.struct("id", "opens", "closes"))
    ends = lines.groupBy("file", "block").agg(F.array_sort(F.collect_list(changes)).alias("changes")).select(
        "file", "block", *[F.aggregate("changes", F.lit(start), lambda q, c: F.when(q, ~c["closes"]).otherwise(
            c["opens"])).alias(name) for name, start in (("plain", False), ("inside", True))])
    begin = F.struct(F.lit(False).alias("quoted"),
                     F.array().cast("array<struct<block:bigint,quoted:boolean>>").alias("found"))
    scan = F.aggregate(F.array_sort(F.collect_list(F.struct("block", "plain", "inside"))), begin, lambda s, r: F.struct(
        F.when(s["quoted"], r["inside"]).otherwise(r["plain"]).alias("quoted"),
        F.concat(s["found"], F.array(F.struct(r["block"].alias("block"), s["quoted"].alias("quoted")))).alias("found")))
    return ends.groupBy("file").agg(scan.alias("scan")).select("file", F.inline("scan.found"))


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of byte ranges, from lines in order; a record that reaches over a
    range's edge comes in pieces that do not start or do not end."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    names = ["file", "block", "value", "starts", "ends", "first"]

    def rows(where, value, starts, ends, first):
        n = len(value)
        return pa.RecordBatch.from_arrays(
            [pa.array([where[0]] * n, pa.string()), pa.array([where[1]] * n, pa.int64()), value,
             pa.array([starts] * n), pa.array([ends] * n), pa.array([first and i == 0 for i in range(n)])], names)

    def piece(where, held, ends):
        return rows(where, pa.array(["\n".join(held[1])]), held[0], ends, held[2])

    # the range, whether its next line begins inside a field, the record that goes on, whether a file's first is due
    where, quoted, held, first = None, False, None, False
    for batch in batches:
        file, block, opens, closes, value, begins = batch.columns
        file, block = file.dictionary_encode(), block.to_numpy()
        code = file.indices.to_numpy()
        opens, closes = (c.to_numpy(zero_copy_only=False) for c in (opens, closes))
        edges = np.flatnonzero(np.concatenate(
            ([True], (block[1:] != block[:-1]) | (code[1:] != code[:-1]), [True]))) if len(block) else []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            own = (file.dictionary[int(code[a])].as_py(), int(block[a]))
            if own != where:
                if held is not None:
                    yield piece(where, held, False)
                where, quoted, held, first = own, begins[int(a)].as_py(), None, own[1] == 0
            lines, n, at = value.slice(a, b - a), int(b - a), 0
            inside = np.empty(n, bool)              # the state in which each line begins
            for i in np.flatnonzero(opens[a:b] | closes[a:b]):
                inside[at:i + 1] = quoted
                quoted, at = bool(not closes[a + i] if quoted else opens[a + i]), i + 1
            inside[at:] = quoted
            starts = np.flatnonzero(~inside)
            cut = int(starts[0]) if len(starts) else n
            if cut:                                 # lines of a record that began earlier
                held = held or (False, [], False)
                held[1].extend(lines.slice(0, cut).to_pylist())
                if cut < n or not quoted:
                    yield piece(where, held, True)
                    held = None
            if cut < n:
                whole = len(starts) - quoted        # the last one goes on where the state is quoted
                if whole:
                    offsets = pa.array(np.append(starts, n)[:whole + 1], pa.int32())
                    yield rows(where, pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n"), True, True, first)
                if quoted:
                    held = (True, lines.slice(int(starts[-1])).to_pylist(), first and not whole)
                first = False
    if held is not None:
        yield piece(where, held, False)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(value, first): the records of CSV files as text, line breaks inside
    quoted fields included, and which are a file's first. Every byte range of a
    file is a task of its own: one job finds the state each range begins in, the
    next cuts the ranges into records, and the pieces of records over an edge
    (two a range) are put together per file."""
    lines = _lines(spark, path)
    states = materialize(range_states(lines), "ranges")
    # in order again where the join has dealt the lines anew; a range stays together
    pieces = (lines.join(states, ["file", "block"]).select("file", "block", "id", "opens", "closes", "value", "quoted")
              .sortWithinPartitions("file", "block", "id").drop("id").mapInArrow(_records, _PIECES))
    pieces = materialize(pieces, "records")
    begin = F.struct(F.lit(None).cast("string").alias("open"), F.lit(False).alias("first"),
                     F.array().cast("array<struct<value:string,first:boolean>>").alias("done"))

    def add(s, p):
        text = F.when(p["starts"], p["value"]).otherwise(F.concat_ws("\n", s["open"], p["value"]))
        first = F.when(p["starts"], p["first"]).otherwise(s["first"])
        done = F.concat(s["done"], F.array(F.struct(text.alias("value"), first.alias("first"))))
        return F.when(p["ends"], F.struct(F.lit(None).cast("string").alias("open"), F.lit(False).alias("first"),
                                          done.alias("done"))).otherwise(
            F.struct(text.alias("open"), first.alias("first"), s["done"].alias("done")))

    def end(s):                     # a file that ends inside a quoted field
        return F.when(s["open"].isNull(), s["done"]).otherwise(F.concat(
            s["done"], F.array(F.struct(s["open"].alias("value"), s["first"].alias("first")))))

    parts = F.array_sort(F.collect_list(F.struct("block", "starts", "ends", "value", "first")))
    joined = pieces.where("not (starts and ends)").groupBy("file").agg(
        F.aggregate(parts, begin, add, end).alias("done")).select(F.inline("done"))
    return pieces.where("starts and ends").select("value", "first").unionAll(joined)


def read_split_csv(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """What :func:`read_raw_csv` reads, from many tasks a file: quoted fields may
    span lines and still each byte range (``spark.sql.files.maxPartitionBytes``)
    is a task. UTF-8, records end with LF or CR LF. Rows come in no order; blank
    lines are no rows. A further file whose header differs from the first one's
    is an error. ``options`` say how fields are read (such as ``nullValue``)."""
    raw = read_raw_csv(spark, path, **options)
    if not raw.columns:
        return raw
    names = [f"c{i}" for i in range(len(raw.columns))]
    options = {k: v for k, v in {**RAW_CSV_OPTIONS, **options}.items()
               if k not in ("header", "enforceSchema", "inferSchema", "encoding")}
    line = F.regexp_replace("value", "\r$", "")
    rows = csv_records(spark, path).select(
        "first", F.from_csv(line, ", ".join(f"{n} string" for n in names), options).alias("r"),
        (line == "").alias("blank"))
    header = spark.read.options(**{**RAW_CSV_OPTIONS, **options, "header": "false"}).csv(path).first()
    same = F.forall(F.arrays_zip(F.array(*[F.col("r")[n] for n in names]).alias("a"),
                                 F.array(*[F.lit(h) for h in header]).alias("b")),
                    lambda x: x["a"].eqNullSafe(x["b"]))
    kept = F.when(~F.col("first"), ~F.col("blank")).when(same, False).otherwise(
        F.raise_error(F.lit("a file's header differs from the first one's")).cast("boolean"))
    return rows.where(kept).select("r.*").toDF(*raw.columns)
