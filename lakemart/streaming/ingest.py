"""Incremental bronze ingestion of an edition's raw CSV deliveries.

The batch bronze job re-reads a whole edition; when an edition arrives as a
series of files (partial exports, corrections), a file-source stream ingests
only the files not seen before. The stream keeps the batch semantics of the
bronze step (all-string CSV scan, sanitised names, lineage) and adds:

* exactly-once output: the Parquet file sink commits through its metadata log
  and the checkpoint, so a restarted or failed run never duplicates a file;
* fault tolerance: the checkpoint lives under the shared checkpoint folder
  (``spark.checkpoint.dir``) unless a location is given;
* ``availableNow`` trigger: process everything that is there, then stop, so it
  can be scheduled like the batch job.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakemart.operators.lineage import add_lineage, ingestion_instant
from lakemart.operators.names import dedupe_names, sanitize_name
from lakemart.plans.bronze import PARTITION
from lakemart.session import scratch_root
from lakemart.sources.csv import RAW_CSV_OPTIONS, read_raw_csv


def stream_edition_to_bronze(spark: SparkSession, edition: int, raw_dir: str, bronze_dir: str,
                             checkpoint: str | None = None, ingested_at: str | None = None,
                             max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start (and return) the stream; call ``awaitTermination()`` to wait for
    the ``availableNow`` run to finish."""
    # The header of the edition gives the all-string schema (driver metadata).
    schema = read_raw_csv(spark, raw_dir).schema
    clean = dedupe_names(sanitize_name(f.name) for f in schema.fields)
    reader = spark.readStream.schema(schema).options(**RAW_CSV_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.csv(raw_dir)
    renamed = raw.select(*[F.col(f"`{f.name}`").alias(c) for f, c in zip(schema.fields, clean)],
                         F.col("_metadata.file_name").alias("__file"))
    stamped = add_lineage(renamed, edition, F.col("__file"),
                          ingested_at or ingestion_instant()).drop("__file")
    location = checkpoint or f"{scratch_root(spark)}/stream-bronze-{edition}"
    return (stamped.writeStream.format("parquet")
                   .option("path", f"{bronze_dir.rstrip('/')}/{PARTITION}={edition}")
                   .option("checkpointLocation", location)
                   .outputMode("append")
                   .trigger(availableNow=True)
                   .start())
