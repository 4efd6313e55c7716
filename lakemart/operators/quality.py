"""Data-quality checks returned as DataFrames (reports), not prints.

Each check is one aggregation pass over its input; reports are small (one row
per column, per table or per offending group).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.session import delete_path, scratch_path

OK, DIVERGENT = "OK", "DIVERGENTE"


#: Name of the checksum over whole rows in content reports.
ROW = "*"


def _q(c: str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(position, column_name, n_nulls, pct_nulls)`` for every column, from a
    single pass of conditional counts turned into rows with ``stack``."""
    columns = list(columns or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count(F.when(_q(c).isNull(), 1)).alias(f"__n{i}")
                   for i, c in enumerate(columns)])
    pairs = ", ".join(f"{i + 1}, '{c.replace(chr(39), chr(39) * 2)}', __n{i}"
                      for i, c in enumerate(columns))
    long = agg.selectExpr("__rows",
                          f"stack({len(columns)}, {pairs}) AS (position, column_name, n_nulls)")
    return long.select(F.col("position").cast("int"), "column_name", "n_nulls",
                       (F.col("n_nulls") * 100.0 / F.col("__rows")).alias("pct_nulls"))


def null_overall(df: DataFrame) -> DataFrame:
    """``(n_rows, n_columns, null_cells, pct_null_cells)`` in one pass."""
    cols = df.columns
    nulls = reduce(lambda a, b: a + b,
                   [F.count(F.when(_q(c).isNull(), 1)) for c in cols], F.lit(0))
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"), nulls.alias("null_cells"))
    return agg.select("n_rows", F.lit(len(cols)).alias("n_columns"), "null_cells",
                      (F.col("null_cells") * 100.0 /
                       (F.col("n_rows") * F.lit(len(cols)))).alias("pct_null_cells"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], measure: str = "n_rows") -> DataFrame:
    """Key combinations that occur more than once, with their row count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(measure))
              .where(F.col(measure) > 1))


def duplicate_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of duplicated key combinations (one row)."""
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("duplicated_keys"))


def rows_per_group(df: DataFrame, key: str, measure: str = "n_rows") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(measure)).orderBy(key)


def value_counts(df: DataFrame, columns: Sequence[str], measure: str = "n_rows",
                 sort: bool = True) -> DataFrame:
    """Frequency of every value of several columns in one scan:
    ``(column_name, value, n_rows)``, most frequent first within a column."""
    packed = F.array(*[F.struct(F.lit(c).alias("column_name"),
                                _q(c).cast("string").alias("value")) for c in columns])
    out = (df.select(F.inline(packed)).groupBy("column_name", "value")
             .agg(F.count(F.lit(1)).alias(measure)))
    if sort:
        out = out.orderBy("column_name", F.col(measure).desc(), F.col("value").asc_nulls_first())
    return out


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """First ``k`` rows by ``order`` (include a unique tie-break column).
    Planned as TakeOrderedAndProject: each task keeps k rows, no full sort."""
    return df.orderBy(*order).limit(k)


def invalid_rows(marts: Mapping[str, DataFrame], measure: str = "qtd_respondentes",
                 predicate=None) -> DataFrame:
    """Per mart: rows violating ``predicate`` (default ``measure <= 0``) and
    total rows, as ``(mart, invalid_rows, mart_rows)``."""
    parts = []
    for name, mart in marts.items():
        bad = predicate(mart) if predicate else (F.col(measure) <= 0)
        parts.append(mart.agg(F.count(F.when(bad, 1)).alias("invalid_rows"),
                              F.count(F.lit(1)).alias("mart_rows"))
                         .select(F.lit(name).alias("mart"), "invalid_rows", "mart_rows"))
    return reduce(DataFrame.unionByName, parts)


def write_and_reconcile(spark: SparkSession, tables: Mapping[str, DataFrame],
                        base_path: str | None = None, cleanup: bool = False) -> DataFrame:
    """Write each table as Parquet, read it back and compare shape.

    The written row count comes from an ``observe`` on the write itself (no
    second evaluation of the source); the read-back count is a metadata-light
    Parquet count. The tables are independent jobs, submitted together so they
    share the executors. Returns ``(table_name, rows_written, rows_read,
    columns_written, columns_read, status)``. With ``cleanup`` the written
    copies are deleted once counted (the report holds only numbers).
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.sql import Observation

    base = (base_path or scratch_path(spark, "reconcile")).rstrip("/")

    def one(item):
        name, df = item
        obs = Observation(f"write_{name}")
        path = f"{base}/{name}"
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        written = obs.get["rows"]
        back = spark.read.parquet(path)
        read = back.count()
        status = OK if (written, len(df.columns)) == (read, len(back.columns)) else DIVERGENT
        return (name, written, read, len(df.columns), len(back.columns), status)

    with ThreadPoolExecutor(max_workers=max(1, min(8, len(tables)))) as pool:
        rows = list(pool.map(one, tables.items()))
    if cleanup:
        delete_path(spark, base)
    return spark.createDataFrame(
        rows, "table_name string, rows_written long, rows_read long, "
              "columns_written int, columns_read int, status string")


def _hashable(value: Column, kind: T.DataType) -> Column:
    """Maps, which Spark doesn't hash, as their sorted entries, at any depth."""
    if isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.struct(
            _hashable(e["key"], kind.keyType).alias("k"), _hashable(e["value"], kind.valueType).alias("v")))
        # an entry's hash orders entries of any type
        return F.array_sort(F.transform(entries, lambda e: F.xxhash64(e)))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda e: _hashable(e, kind.elementType)) if _has_map(kind) else value
    if isinstance(kind, T.StructType) and _has_map(kind):
        return F.when(value.isNotNull(), F.struct(*[_hashable(value[f.name], f.dataType).alias(f.name) for f in kind]))
    return value


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType)


def _checksums(df: DataFrame) -> list[Column]:
    """Per column, and last for whole rows: the number of non-NULL values and
    the exact sum of their hashes. Sums don't depend on order, and values that
    come twice count twice. Spark's hash passes over NULLs, so a row's hash takes
    in which of its columns are NULL."""
    def total(hashed: Column) -> Column:
        return F.sum(hashed.cast("decimal(28,0)"))

    values = [_hashable(_q(f.name), f.dataType) for f in df.schema]
    flags = [_q(c).isNull() for c in df.columns]
    columns = [F.struct(F.count(_q(c)).alias("n"), total(F.when(_q(c).isNotNull(), F.xxhash64(v))).alias("sum"))
               for c, v in zip(df.columns, values, strict=True)]
    row = F.struct(F.count(F.lit(1)).alias("n"), total(F.xxhash64(*values, *flags)).alias("sum"))
    return [c.alias(f"c{i}") for i, c in enumerate([*columns, row])]


def _content_rows(name: str, columns: Sequence[str], left: Mapping, right: Mapping) -> list[tuple]:
    """Rows of a content report from two results of :func:`_checksums` by name."""
    rows_left, rows_right = (x[f"c{len(columns)}"]["n"] for x in (left, right))
    out = []
    for i, c in enumerate([*columns, ROW]):
        a, b = left[f"c{i}"], right[f"c{i}"]
        out.append((name, c, rows_left, rows_right, rows_left - a["n"], rows_right - b["n"],
                    OK if (rows_left, a["n"], a["sum"]) == (rows_right, b["n"], b["sum"]) else DIVERGENT))
    return out


_CONTENT = ("table_name string, column_name string, rows_written long, rows_read long, "
            "nulls_written long, nulls_read long, status string")


def compare_contents(spark: SparkSession, pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Per pair of tables and column, whether both hold the same values as often:
    ``(table_name, column_name, rows_written, rows_read, nulls_written,
    nulls_read, status)``, and a row for ``*``, which compares whole rows, so
    that values of one column that changed rows are found too.

    One pass over each table and no shuffle of rows, whatever their order or
    partitions: sums of 64-bit hashes are compared. Equal contents are always
    "OK"; other ones differ unless hashes happen to add up to the same. Both
    tables have the same columns, in any order; types that differ give other
    hashes, so they are an error.
    """
    from concurrent.futures import ThreadPoolExecutor

    def one(item):
        name, (left, right) = item
        kinds = [{f.name: f.dataType for f in x.schema} for x in (left, right)]
        if kinds[0] != kinds[1]:
            raise ValueError(f"{name}: columns or types differ: {left.schema.simpleString()} "
                             f"against {right.schema.simpleString()}")
        right = right.select(*[_q(c) for c in left.columns])
        return _content_rows(name, left.columns, *(x.agg(*_checksums(x)).first().asDict() for x in (left, right)))

    with ThreadPoolExecutor(max_workers=max(1, min(8, len(pairs)))) as pool:
        rows = [r for part in pool.map(one, pairs.items()) for r in part]
    return spark.createDataFrame(rows, _CONTENT)


def write_and_verify(spark: SparkSession, tables: Mapping[str, DataFrame],
                     base_path: str | None = None, cleanup: bool = False) -> DataFrame:
    """:func:`write_and_reconcile` by content: checksums are observed on the
    write itself, recomputed on what is read back, and compared per column and
    for whole rows as in :func:`compare_contents` (same report)."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.sql import Observation

    base = (base_path or scratch_path(spark, "verify")).rstrip("/")

    def one(item):
        name, df = item
        obs = Observation(f"contents_{name}")
        path = f"{base}/{name}"
        df.observe(obs, *_checksums(df)).write.mode("overwrite").parquet(path)
        back = spark.read.schema(df.schema).parquet(path)
        return _content_rows(name, df.columns, obs.get, back.agg(*_checksums(back)).first().asDict())

    with ThreadPoolExecutor(max_workers=max(1, min(8, len(tables)))) as pool:
        rows = [r for part in pool.map(one, tables.items()) for r in part]
    if cleanup:
        delete_path(spark, base)
    return spark.createDataFrame(rows, _CONTENT)
