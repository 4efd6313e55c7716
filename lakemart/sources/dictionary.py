"""Field dictionary: unified field name -> source column per edition.

Layout (one row per unified field)::

    field, col_<edition_1>, col_<edition_2>, ...

A blank cell means the field does not exist in that edition; the CSV reader
turns it into NULL. The dictionary is metadata (one row per field), so its
rows may be brought to the driver to build select lists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.options(header="true", multiLine="true", escape='"').csv(path)


def dictionary_from_rows(spark: SparkSession, rows: Sequence[Sequence[str | None]],
                         columns: Sequence[str]) -> DataFrame:
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.createDataFrame([tuple(r) for r in rows], schema)
