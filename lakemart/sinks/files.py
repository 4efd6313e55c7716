"""File sinks.

``single_file`` funnels the whole output through one task; it is reserved for
small marts that a person downloads. Large layers (bronze, silver) are
written by all tasks in parallel and partitioned on disk by edition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.names import column_map_frame

def write_layer(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] = (), single_file: bool = False) -> None:
    writer = (df.coalesce(1) if single_file else df).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_partitioned(df: DataFrame, path: str, partition_col: str) -> None:
    """Overwrite only the partitions present in ``df`` (dynamic overwrite). Rows
    are rebalanced by partition first: few even files each, large partitions
    split, instead of a file per task and partition."""
    (df.hint("rebalance", F.col(partition_col)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path))


def write_edition(df: DataFrame, base: str, edition, partition_col: str = "ano") -> str:
    """Overwrite one edition directory ``<base>/<partition_col>=<edition>``.

    Used when editions have different schemas, so they cannot share one
    ``partitionBy`` write; readers then read each leaf with its own schema.
    """
    path = f"{base.rstrip('/')}/{partition_col}={edition}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_column_map(spark: SparkSession, column_map, path: str) -> None:
    """Raw -> sanitised header map as one small CSV with header."""
    (column_map_frame(spark, column_map).select("coluna_bruta", "coluna_saneada")
        .coalesce(1).write.mode("overwrite").option("header", "true").csv(path))


def _quoted(col: Column) -> Column:
    """A CSV field: NULL -> empty and unquoted, otherwise quoted with doubled quotes."""
    text = col.cast("string")
    return F.when(text.isNull(), F.lit("")).otherwise(
        F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"')))


def _records(df: DataFrame) -> Column:
    """A row of ``df`` as one complete CSV record, which the text sink writes verbatim."""
    return F.concat_ws(",", *[_quoted(F.col("`" + c.replace("`", "``") + "`")) for c in df.columns])


def export_csv(df: DataFrame, path: str, single_file: bool = False,
               order_by: Sequence[str | Column] = (), one_header: bool = False) -> None:
    """Mart export in the published CSV format: every value quoted with doubled
    inner quotes, NULL as an empty unquoted field (the empty string is ``""``),
    LF line ends.

    By default all tasks write, each the rows of its partition under a header;
    the first file is a header alone, so a frame without rows has one too. With
    ``one_header`` the first file is the only header and the rows follow, sorted
    by ``order_by`` over all tasks (by range): joined in order of name the files
    are the one file that a single task would write. With ``single_file`` (the
    published form, for small aggregated marts) one task sorts and writes.

    Records and headers are built-in expressions; no row passes a Python worker.
    """
    header = ",".join('"' + c.replace('"', '""') + '"' for c in df.columns)
    first = df.sparkSession.range(0, 1, 1, 1).select(F.lit(header).alias("value"))
    nth = F.monotonically_increasing_id()      # of a partition's rows, in its lower 33 bits
    if single_file:
        df = df.coalesce(1)
        df = df.sortWithinPartitions(*order_by) if order_by else df
        lines = df.select(_records(df).alias("value"), (nth + 1).alias("place"))
        # one task reads both parts, in an order that depends on where they lie
        out = first.withColumn("place", F.lit(0).cast("long")).unionAll(lines).coalesce(1) \
            .sortWithinPartitions("place").select("value")
    elif one_header:
        df = df.orderBy(*order_by) if order_by else df
        out = first.unionAll(df.select(_records(df).alias("value")))
    else:
        if order_by:
            df = df.sortWithinPartitions(*order_by)
        lines = df.select(_records(df).alias("value"), (nth.bitwiseAND(F.lit((1 << 33) - 1)) == 0).alias("leads"))
        headed = F.when(F.col("leads"), F.array(F.lit(header), F.col("value"))).otherwise(F.array("value"))
        out = first.unionAll(lines.select(F.explode(headed).alias("value")))
    out.write.mode("overwrite").option("lineSep", "\n").text(path)
