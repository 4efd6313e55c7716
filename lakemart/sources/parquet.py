"""Parquet layer scans (filters and projections reach the scan via Catalyst)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_tables(spark: SparkSession, base: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """``{name: <base>/<name>.parquet}``"""
    return {n: spark.read.parquet(f"{base.rstrip('/')}/{n}.parquet") for n in names}


def read_leaf(spark: SparkSession, base: str, partition: str, value) -> DataFrame:
    """One partition directory ``<base>/<partition>=<value>``.

    Reading the leaf gives that edition's own schema and no partition column;
    reading ``base`` instead adds the column and lets the planner prune.
    """
    return spark.read.parquet(f"{base.rstrip('/')}/{partition}={value}")
