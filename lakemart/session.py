"""Session construction and scratch-space resolution.

Every job in the package runs on whatever session the caller hands it.
``build_session`` is only a convenience for scripts and tests; it pins the
settings the operators rely on (UTC, ANSI, AQE with skew-join splitting) and
leaves cluster-wide knobs alone when they are already set.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on for correct results.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings that keep plans scalable; applied only where the cluster has not
# chosen its own value.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # AQE may turn a shuffle join into a broadcast join once the built side is
    # measured; the measured size, not an estimate, is what gets checked.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # coalesce small shuffle partitions up to this size, split skewed ones above
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # (on a busy shared cluster also set
    # spark.sql.adaptive.coalescePartitions.parallelismFirst=false so AQE
    # coalesces to this size instead of keeping one small task per core; on a
    # dedicated or local session keeping parallelism first is faster)
}

def build_session(master: str | None = None, app_name: str = "lakemart",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    # checkpoint files of frames that are no longer referenced get deleted
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for key, value in {**SEMANTIC_CONF, **SCALE_CONF}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_semantics(spark)
    return spark


def ensure_semantics(spark: SparkSession) -> None:
    """Pin the result-affecting settings on an existing session."""
    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the one ``spark.checkpoint.dir``
    names, or, where that is unset, a folder in the session's warehouse (which
    every executor of a cluster can reach as well)."""
    folder = (spark.conf.get("spark.checkpoint.dir", None)
              or spark.sparkContext.getConf().get("spark.checkpoint.dir", None))
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the shared scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete a job's own scratch output through the Hadoop
    FileSystem of the path (works for local, HDFS and object stores)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def materialize(df, name: str = "table"):
    """``df`` as a Parquet table in the shared scratch folder: computed once,
    lineage cut, there when an executor is lost, and plans that read it know
    its size."""
    path = scratch_path(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)
