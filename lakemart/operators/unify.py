"""Dictionary-driven unification of editions whose schemas drift.

The dictionary has one row per unified field and one column per edition
naming that edition's source column (NULL = absent). It is metadata: its rows
are read on the driver to build plain ``select`` lists, while the data never
leaves the executors.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIELD_COL = "campo_padronizado"


class DictionaryError(ValueError):
    """Dictionary names columns that an edition does not have."""


def dictionary_long(dictionary: DataFrame, edition_columns: Mapping[object, str],
                    field_col: str = FIELD_COL) -> DataFrame:
    """``(edition, field, column)`` rows for every non-blank dictionary cell."""
    parts = [dictionary.select(F.lit(str(ed)).alias("edition"),
                               F.col(field_col).alias("field"),
                               F.col(dict_col).alias("column"))
             for ed, dict_col in edition_columns.items()]
    long = reduce(DataFrame.unionByName, parts)
    return long.where(F.col("column").isNotNull() & (F.trim("column") != ""))


def schema_catalog(spark: SparkSession, editions: Mapping[object, DataFrame]) -> DataFrame:
    """``(edition, column)`` for every column of every edition (schema metadata)."""
    rows = [(str(ed), c) for ed, df in editions.items() for c in df.columns]
    return spark.createDataFrame(rows, "edition string, column string")


def check_dictionary(spark: SparkSession, dictionary: DataFrame,
                     editions: Mapping[object, DataFrame],
                     edition_columns: Mapping[object, str],
                     field_col: str = FIELD_COL) -> DataFrame:
    """Dictionary entries whose column is missing from that edition:
    ``(edition, field, column)`` via an anti join against the schema catalog."""
    long = dictionary_long(dictionary, edition_columns, field_col)
    catalog = schema_catalog(spark, editions)
    return long.join(catalog, on=["edition", "column"], how="left_anti") \
               .select("edition", "field", "column")


def dictionary_coverage(spark: SparkSession, dictionary: DataFrame,
                        editions: Mapping[object, DataFrame],
                        edition_columns: Mapping[object, str],
                        field_col: str = FIELD_COL) -> DataFrame:
    """Per dictionary entry: does the column exist, and how many rows of the
    edition answer it (non-NULL values; NULL when the column is missing).

    One aggregation pass per edition counts all mapped columns together.
    """
    long = dictionary_long(dictionary, edition_columns, field_col)
    mapped: dict[str, set[str]] = {}
    for r in long.select("edition", "column").distinct().collect():     # metadata: one row per entry
        mapped.setdefault(r["edition"], set()).add(r["column"])
    counts = []
    for ed, df in editions.items():
        present = sorted(c for c in mapped.get(str(ed), ()) if c in df.columns)
        if not present:
            continue
        agg = df.agg(*[F.count(F.col(_quoted(c))).alias(f"n{i}") for i, c in enumerate(present)])
        counts.append(agg.select(F.inline(F.array(*[
            F.struct(F.lit(str(ed)).alias("edition"), F.lit(c).alias("column"), F.col(f"n{i}").alias("n_values"))
            for i, c in enumerate(present)]))))
    report = long.withColumn("present", F.lit(False))
    if counts:
        found = reduce(DataFrame.unionByName, counts)
        report = (long.join(found, on=["edition", "column"], how="left")
                      .withColumn("present", F.col("n_values").isNotNull()))
    else:
        report = report.withColumn("n_values", F.lit(None).cast("long"))
    return report.select("edition", "field", "column", "present", "n_values")


def _quoted(column: str) -> str:
    """A column name as Spark's own parser takes it, whatever it holds."""
    return "`" + column.replace("`", "``") + "`"


def mapping_for(dictionary: DataFrame, dict_col: str,
                field_col: str = FIELD_COL) -> list[tuple[str, str]]:
    """``[(source_column, field)]`` of one edition, in dictionary order."""
    rows = dictionary.select(field_col, dict_col).collect()
    return [(r[dict_col], r[field_col]) for r in rows
            if r[dict_col] is not None and r[dict_col].strip() != ""]


def select_by_dictionary(df: DataFrame, mapping: Sequence[tuple[str, str]],
                         keep: Sequence[str] = (), strict: bool = True) -> DataFrame:
    """Keep ``keep`` columns, then every mapped column renamed to its field;
    unmapped source columns are dropped. A mapped column missing from ``df``
    raises when ``strict``, otherwise becomes a NULL string column."""
    missing = [src for src, _ in mapping if src not in df.columns]
    if missing and strict:
        raise DictionaryError(f"columns not found: {missing}")
    exprs = [F.col(_quoted(c)) for c in keep]
    for src, field in mapping:
        if src in df.columns:
            exprs.append(F.col(_quoted(src)).alias(field))
        else:
            exprs.append(F.lit(None).cast("string").alias(field))
    return df.select(*exprs)


def union_editions(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; a column missing in an edition is NULL there.
    Column order: first edition's columns, then new ones as first seen."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
