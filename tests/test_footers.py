"""Null profiles from footers against scans."""

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from lakemart.operators.quality import null_profile
from lakemart.sources import footers
from lakemart.sources.footers import footer_of, stored_null_profile


def as_scanned(spark, path, merge=False):
    layer = spark.read.option("mergeSchema", str(merge).lower()).parquet(path)
    told = stored_null_profile(spark, path, merge)
    assert {r.n_rows for r in told.collect()} == {layer.count()}
    same = ["position", "column_name", "n_nulls", "pct_nulls"]
    assert told.select(same).collect() == null_profile(layer).select(same).collect()


def test_footers_tell_what_a_scan_counts(spark, tmp_dir):
    df = spark.range(0, 100, 1, 5).select(
        "id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("odd.name`d"),
        F.lit(None).cast("double").alias("z"),
        F.when(F.col("id") % 7 > 0, F.struct(F.col("id").alias("u"), F.lit(None).cast("int").alias("v"))).alias("st"),
        F.when(F.col("id") % 5 > 0, F.array(F.lit(None).cast("int"))).alias("list"),
        F.when(F.col("id") % 4 > 1, F.col("id") % 4).alias("part"))
    df.write.partitionBy("part").parquet(f"{tmp_dir}/layer")
    as_scanned(spark, f"{tmp_dir}/layer")
    df.where("id < 0").write.parquet(f"{tmp_dir}/empty")
    assert {(r.n_rows, r.n_nulls, r.pct_nulls) for r in stored_null_profile(spark, f"{tmp_dir}/empty").collect()} \
        == {(0, 0, None)}


def test_files_of_other_schemas_and_without_statistics(spark, tmp_dir):
    path = f"{tmp_dir}/mixed"
    spark.range(10).select("id", F.when(F.col("id") > 3, F.lit("x")).alias("b"),
                           F.lit(1).alias("gone")).write.parquet(path)
    spark.range(5).select(F.when(F.col("id") > 1, F.lit("q")).alias("B"), "id").write.mode("append").parquet(path)
    as_scanned(spark, path, merge=True)
    pq.write_table(pa.table({"b": ["u", None, None], "id": [None, 1, 2], "gone": pa.array([None, 1, 2], pa.int32())}),
                   f"{path}/part-plain.parquet", write_statistics=False)
    assert footer_of(f"file:{path}/part-plain.parquet") is None
    as_scanned(spark, path, merge=True)


def test_no_data_is_read_where_footers_tell(spark, tmp_dir):
    """A file whose pages are spoilt still tells its counts."""
    spark.range(1000).select("id", F.when(F.col("id") > 10, F.lit("v")).alias("v")).coalesce(1) \
        .write.parquet(f"{tmp_dir}/spoilt")
    (file,) = (f.removeprefix("file://") for f in spark.read.parquet(f"{tmp_dir}/spoilt").inputFiles())
    raw = open(file, "rb").read()
    footer = int.from_bytes(raw[-8:-4], "little") + 8
    spoilt = f"{tmp_dir}/one.parquet"
    open(spoilt, "wb").write(raw[:4] + b"\0" * (len(raw) - footer - 4) + raw[-footer:])
    told = {r.column_name: (r.n_rows, r.n_nulls) for r in stored_null_profile(spark, spoilt).collect()}
    assert told == {"id": (1000, 0), "v": (1000, 11)}


def test_files_that_cannot_be_opened_are_scanned(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/far"
    spark.range(50).select("id", F.when(F.col("id") > 9, 1).alias("v"), (F.col("id") % 2).alias("p")) \
        .write.partitionBy("p").parquet(path)
    told = footers.footer_counts
    monkeypatch.setattr(footers, "footer_counts", lambda *at: told(*at).withColumn("n_rows", F.lit(None).cast("long")))
    as_scanned(spark, path)
    one = f"{tmp_dir}/plain"                # a single file, which has no folder's columns
    spark.range(9).select("id", F.when(F.col("id") > 4, 1).alias("v")).coalesce(1).write.parquet(one)
    (file,) = spark.read.parquet(one).inputFiles()
    as_scanned(spark, file)
    assert footer_of("nowhere://host/file.parquet") is None
