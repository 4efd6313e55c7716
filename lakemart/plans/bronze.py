"""Bronze job: raw edition CSVs -> typed-as-string Parquet with safe names.

Per edition: scan the CSV, sanitise and de-duplicate the headers, keep the
raw -> clean name map, stamp lineage, write ``<bronze>/ano=<edition>``, then
reconcile the written row count (taken with ``observe`` during the write)
against a read-back count.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.lineage import add_lineage, ingestion_instant
from lakemart.operators.names import sanitize_columns
from lakemart.operators.quality import null_overall
from lakemart.sinks.files import write_column_map, write_edition
from lakemart.sources.csv import corrupt_lines, read_raw_csv
from lakemart.sources.parquet import read_leaf

PARTITION = "ano"


def ingest_edition(spark: SparkSession, edition: int, path: str, ingested_at: str
                   ) -> tuple[DataFrame, list[tuple[str, str]]]:
    raw = read_raw_csv(spark, path)
    clean, column_map = sanitize_columns(raw)
    stamped = add_lineage(clean, edition, os.path.basename(path.rstrip("/")), ingested_at)
    return stamped, column_map


def run_bronze(spark: SparkSession, raw_files: Mapping[int, str], bronze_dir: str,
               dict_dir: str | None = None, ingested_at: str | None = None) -> DataFrame:
    """Returns ``(edition, rows_written, rows_read, columns, corrupt_lines,
    status)``; corrupt lines have more or fewer fields than the header."""
    ingested_at = ingested_at or ingestion_instant()

    def one(item):
        edition, path = item
        df, column_map = ingest_edition(spark, edition, path, ingested_at)
        if dict_dir:
            write_column_map(spark, column_map,
                             f"{dict_dir.rstrip('/')}/bronze_column_mapping_{edition}")
        obs = Observation(f"bronze_{edition}")
        write_edition(df.observe(obs, F.count(F.lit(1)).alias("rows")), bronze_dir, edition,
                      PARTITION)
        written = obs.get["rows"]
        back = read_leaf(spark, bronze_dir, PARTITION, edition)
        read = back.count()
        return (int(edition), written, read, len(back.columns), corrupt_lines(spark, path),
                "OK" if (written, len(df.columns)) == (read, len(back.columns)) else "DIVERGENTE")

    # editions are independent jobs (a multi-line CSV file is one task each):
    # submit them together so they share the executors
    with ThreadPoolExecutor(max_workers=max(1, min(8, len(raw_files)))) as pool:
        report = list(pool.map(one, raw_files.items()))
    return spark.createDataFrame(
        report, "edition int, rows_written long, rows_read long, columns int, corrupt_lines long, "
                "status string")


def bronze_profile(spark: SparkSession, bronze_dir: str, editions) -> DataFrame:
    """Rows, columns and share of NULL cells per edition, one pass per edition:
    ``(edition, n_rows, n_columns, null_cells, pct_null_cells)``."""
    parts = [null_overall(read_leaf(spark, bronze_dir, PARTITION, ed))
             .select(F.lit(int(ed)).alias("edition"), "*") for ed in editions]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
