"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import delete_path, scratch_path

#: Characters with the Unicode White_Space property, as a regex class body
#: (fixed values; ``\\s`` of Python's ``re`` also holds U+001C..U+001F).
WHITE = "\t-\r \x85\xa0  -     　"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def use_package_on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    A cluster gets the package with ``--py-files`` as any other; this serves
    sessions whose workers start in another folder than the driver."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        env["PYTHONPATH"] = ":".join([root, *paths])


@contextmanager
def shuffles_kept_for_a_job(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a job inside go when it ends, not when the driver's garbage
    collector finds that no frame needs them."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder: computed once,
    read by several jobs, and still there when an executor is lost. ``options``
    are those of the Parquet writer."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    with shuffles_kept_for_a_job(spark):
        df.write.options(**options).parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out.staged_path = path
    return out


def dropped(*tables: DataFrame | None) -> None:
    """Delete tables that :func:`staged` has written and that no frame still
    reads; None stands for none."""
    for df in tables:
        if df is not None:
            delete_path(df.sparkSession, df.staged_path)


def shuffles_freed(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs deleted now. Spark does so when the
    driver's garbage collector finds that no frame needs them, which on a large
    driver comes long after the disks of the executors have filled."""
    spark.sparkContext._jvm.System.gc()


def text_or_empty(col: str):
    """The column as text, null as the empty string."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))
