"""Row and null counts of Parquet layers from the files' footers.

Tasks read the footers of the files that Spark lists, a task some files, and no
data page. Every file is taken by its own columns, so files of several schemas
(columns in another order, missing or added ones) count right. What footers do
not tell is scanned: columns of nested types, and whole files that were written
without statistics or that only Spark's readers can open.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Footers read by one task, about.
FILES_PER_TASK = 64
_LISTED = ["path", "modificationTime", "length", "content"]
_COUNTS = "path string, n_rows long, names array<string>, nulls array<long>"


def footer_of(path: str) -> tuple[int, dict[str, int]] | None:
    """Rows and nulls per flat column of one file; None where the footer can't
    be had or lacks the null count of a flat column that is not empty."""
    import pyarrow.fs
    import pyarrow.parquet as pq

    try:
        if path.startswith("file:"):
            system, place = pa.fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
        else:
            system, place = pa.fs.FileSystem.from_uri(path)
        with system.open_input_file(place) as file:
            meta = pq.ParquetFile(file).metadata
    except (OSError, ValueError, NotImplementedError):      # the file is scanned instead
        return None
    nulls: dict[str, int] = {}
    for i in range(meta.num_columns):
        column = meta.schema.column(i)
        if column.path != column.name or column.max_repetition_level or column.max_definition_level > 1:
            continue                                        # within a nested column
        total = 0
        for group in range(meta.num_row_groups if column.max_definition_level else 0):
            stats = meta.row_group(group).column(i).statistics
            if meta.row_group(group).num_rows and (stats is None or not stats.has_null_count):
                return None
            total += stats.null_count if stats is not None else 0
        nulls[column.name] = total
    return meta.num_rows, nulls


def footer_counts(spark: SparkSession, path: str) -> DataFrame:
    """``(path, n_rows, names, nulls, <partition columns>)``, a row per file of a
    layer: flat columns and their null counts, ``n_rows`` NULL where the footer
    doesn't tell."""
    listed = spark.read.format("binaryFile").load(path)     # content is not read
    folders = [c for c in listed.columns if c not in _LISTED]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [footer_of(p.as_py()) for p in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f and f[0] for f in found], pa.int64()),
                 pa.array([f and list(f[1]) for f in found], pa.list_(pa.string())),
                 pa.array([f and list(f[1].values()) for f in found], pa.list_(pa.int64())),
                 *batch.columns[1:]], ["path", "n_rows", "names", "nulls", *folders])

    files = listed.select("path", *map(_col, folders))
    tasks = max(1, len(listed.inputFiles()) // FILES_PER_TASK)
    schema = T.StructType([*T.StructType.fromDDL(_COUNTS).fields, *[listed.schema[c] for c in folders]])
    return files.repartition(tasks, "path").mapInArrow(read, schema)


def stored_null_profile(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """``null_profile`` of a Parquet layer, with its row count, from footers:
    ``(position, column_name, n_rows, n_nulls, pct_nulls)``.

    A column that a file does not have is NULL in its rows, as in a scan
    (``merge_schema`` takes in the columns of all files). A layer without rows
    has NULL percentages. Nothing of the data is read but nested columns, which
    have no null count of their own, and files without usable footers.
    """
    layer = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
    exact = spark.conf.get("spark.sql.caseSensitive") == "true"
    name = (lambda c: c) if exact else str.lower
    nested = [f.name for f in layer.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]
    files = footer_counts(spark, path)
    folders = files.columns[4:]
    known = files.filter("n_rows is not null")
    # a flat column's nulls: those the file tells, all rows where it lacks the column
    names = F.col("names") if exact else F.transform("names", F.lower)
    told = F.map_from_arrays(names, F.col("nulls"))
    flat = [c for c in layer.columns if c not in nested]

    def nulls(c: str):
        if c in folders:
            return F.when(_col(c).isNull(), F.col("n_rows")).otherwise(F.lit(0))
        return F.coalesce(F.try_element_at(told, F.lit(name(c))), F.col("n_rows"))

    sums = known.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"),
                     *[F.coalesce(F.sum(nulls(c)), F.lit(0)).alias(f"c{i}") for i, c in enumerate(flat)]).first()
    n_rows, counted = sums["n"], {c: sums[f"c{i}"] for i, c in enumerate(flat)}
    # of each file without counts its path: a part of the listing that the driver has anyway
    dark = [r.path for r in files.filter("n_rows is null").select("path").collect()]
    if dark:
        # folders' columns come from the paths below the layer; without them it may be a single file
        reader = spark.read.option("basePath", path) if folders else spark.read
        rest = reader.schema(layer.schema).parquet(*dark)
        scanned = rest.agg(F.count(F.lit(1)).alias("n"), *_null_counts(flat)).first()
        n_rows += scanned["n"]
        counted = {c: counted[c] + scanned[f"c{i}"] for i, c in enumerate(flat)}
    if nested:
        scanned = layer.agg(*_null_counts(nested)).first()
        counted |= {c: scanned[f"c{i}"] for i, c in enumerate(nested)}
    return spark.createDataFrame(
        [(i + 1, c, n_rows, counted[c], counted[c] * 100.0 / n_rows if n_rows else None)
         for i, c in enumerate(layer.columns)],
        "position int, column_name string, n_rows long, n_nulls long, pct_nulls double")


def _col(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def _null_counts(columns: list[str]) -> list:
    return [F.count_if(_col(c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)]
