"""Make marts queryable with SQL (the ad hoc query layer)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Types a column may go on to in another edition; the reader widens old files.
_WIDER = {("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("smallint", "int"),
          ("smallint", "bigint"), ("int", "bigint"), ("float", "double")}


class LayerTypeError(TypeError):
    """Editions of a layer have types for a column that no table can hold."""


def register_marts(spark: SparkSession, marts: Mapping[str, DataFrame | str]) -> list[str]:
    """Register each mart (a DataFrame or a Parquet folder) as a temp view
    named after it; returns the view names."""
    for name, source in marts.items():
        df = spark.read.parquet(source) if isinstance(source, str) else source
        df.createOrReplaceTempView(name)
    return list(marts)


def register_tables(spark: SparkSession, marts: Mapping[str, str], database: str | None = None) -> None:
    """Persistent catalog entries over existing Parquet folders."""
    prefix = f"`{database}`." if database else ""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, path in marts.items():
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}`{name}` USING parquet LOCATION '{place}'")


def _name(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def merged_columns(schemas: Mapping[str, T.StructType]) -> dict[str, str]:
    """Column -> type over several editions' schemas, in order of first coming
    up. Names that differ by case are one column; an integer or float type may
    be wider in some editions; other differences are a :class:`LayerTypeError`."""
    types: dict[str, str] = {}
    spelt: dict[str, tuple[str, str]] = {}         # name in lower case -> its column and edition
    for edition, schema in schemas.items():
        for field in schema:
            kind = field.dataType.simpleString()
            column, first = spelt.setdefault(field.name.lower(), (field.name, edition))
            old = types.setdefault(column, kind)
            if (old, kind) in _WIDER:
                types[column] = kind
            elif old != kind and (kind, old) not in _WIDER:
                raise LayerTypeError(f"{column} is {old} in {first} and {kind} in {edition}")
    return types


def register_layer(spark: SparkSession, name: str, base: str, partition_col: str = "ano",
                   database: str | None = None) -> list[str]:
    """One catalog table over all editions ``<base>/<partition_col>=<edition>``,
    each with its own schema; run again after an edition came, went or was
    written anew. Returns the columns that the table got by this run.

    A column that an edition does not have reads as NULL there. New columns are
    added to an existing table behind its own; a column that became wider, or is
    in no edition any more, makes the entry anew (the files stay). Types are
    checked first: an edition that fits no common type raises
    :class:`LayerTypeError` and the table stays as it was. Filters on
    ``partition_col`` prune folders through the catalog's partitions.
    """
    base = base.rstrip("/")
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(base)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    leaves = sorted(f.getPath().getName() for f in fs.listStatus(folder)
                    if f.isDirectory() and f.getPath().getName().startswith(f"{partition_col}="))
    if not leaves:
        raise ValueError(f"no folder {partition_col}=... in {base}")
    # schemas come from footers, an edition at a time: one has one schema
    columns = merged_columns({leaf: spark.read.parquet(f"{base}/{leaf}").schema for leaf in leaves})
    if partition_col.lower() in map(str.lower, columns):
        raise LayerTypeError(f"{partition_col} is a column of the files too")
    part_type = spark.read.parquet(base).schema[partition_col].dataType.simpleString()
    table = _name(*([database] if database else []), name)
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(database)}")
    old: dict[str, str] = {}
    if spark.catalog.tableExists(table):
        old = {f.name: f.dataType.simpleString() for f in spark.table(table).schema if f.name != partition_col}
        spelt = {c.lower(): c for c in old}
        columns = {spelt.get(c.lower(), c): t for c, t in columns.items()}
        kept_type = spark.table(table).schema[partition_col].dataType.simpleString()
        if kept_type != part_type or any(columns.get(c) != t for c, t in old.items()):
            spark.sql(f"DROP TABLE {table}")       # an entry with a location: files stay
            columns = {c: columns[c] for c in [*filter(columns.__contains__, old), *columns]}
    listed = {c: f"{_name(c)} {t}" for c, t in columns.items()}
    place = base.replace("\\", "\\\\").replace("'", "\\'")
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {table} ({', '.join(listed.values())}, {_name(partition_col)} {part_type}) "
                  f"USING parquet PARTITIONED BY ({_name(partition_col)}) LOCATION '{place}'")
    elif added := [d for c, d in listed.items() if c not in old]:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(added)})")
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)
    return [c for c in columns if c not in old]


def run_sql(spark: SparkSession, sql: str) -> DataFrame:
    return spark.sql(sql)
