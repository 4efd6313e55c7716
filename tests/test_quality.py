import pytest
from pyspark.sql import functions as F

from lakemart.operators.quality import (compare_contents, duplicate_key_count, duplicate_keys, invalid_rows,
                                        null_overall, null_profile, top_k, value_counts,
                                        write_and_reconcile, write_and_verify)


def test_null_profile_and_overall(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None), (3, "x", "b")],
                               "id int, s string, t string")
    prof = {r.column_name: (r.n_nulls, round(r.pct_nulls, 4)) for r in null_profile(df).collect()}
    assert prof == {"id": (0, 0.0), "s": (2, 66.6667), "t": (1, 33.3333)}
    o = null_overall(df).first()
    assert (o.n_rows, o.n_columns, o.null_cells) == (3, 3, 3)
    assert abs(o.pct_null_cells - 100 / 3) < 1e-9


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(2023, "t1"), (2023, "t1"), (2024, "t1"), (2023, "t2")],
                               "y int, token string")
    assert [(r.y, r.token, r.n_rows) for r in duplicate_keys(df, ["y", "token"]).collect()] \
        == [(2023, "t1", 2)]
    assert duplicate_key_count(df, ["y", "token"]).first()[0] == 1


def test_value_counts_and_top_k(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("a", "y")], "c string, d string")
    rows = value_counts(df, ["c", "d"]).collect()
    assert [(r.column_name, r.value, r.n_rows) for r in rows] == [
        ("c", "a", 2), ("c", "b", 1), ("d", "x", 2), ("d", "y", 1)]
    top = top_k(value_counts(df, ["c"], sort=False), 1, [F.col("n_rows").desc(), F.col("value")])
    assert top.first().value == "a"


def test_invalid_rows(spark):
    good = spark.createDataFrame([(1,), (2,)], "qtd_respondentes long")
    bad = spark.createDataFrame([(0,), (3,)], "qtd_respondentes long")
    out = {r.mart: (r.invalid_rows, r.mart_rows)
           for r in invalid_rows({"good": good, "bad": bad}).collect()}
    assert out == {"good": (0, 2), "bad": (1, 2)}


def test_write_and_reconcile(spark, tmp_dir):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    r = write_and_reconcile(spark, {"t": df}, tmp_dir).first()
    assert (r.rows_written, r.rows_read, r.columns_written, r.status) == (100, 100, 2, "OK")


def test_reconcile_cleanup(spark, tmp_dir):
    import os
    base = os.path.join(tmp_dir, "scratch")
    r = write_and_reconcile(spark, {"t": spark.range(10)}, base, cleanup=True).first()
    assert r.status == "OK" and not os.path.exists(base)


def divergent(spark, left, right):
    report = compare_contents(spark, {"t": (left, right)}).where("status <> 'OK'")
    return {r.column_name for r in report.collect()}


def test_contents_of_any_order_compare_equal(spark):
    schema = ("a int, b string, c map<string,int>, d array<struct<x:double,y:map<int,string>>>, `odd.name` binary")
    rows = [(i % 3 or None, f"b{i % 5}", {"k": i, "l": 1}, [(i / 2, {1: "x"}), (None, None)], bytes([i]))
            for i in range(40)] + [(None,) * 5] * 2
    left = spark.createDataFrame(rows, schema)
    right = spark.createDataFrame(list(reversed(rows)), schema).repartition(5).select("`odd.name`", "d", "c", "b", "a")
    assert divergent(spark, left, right) == set()
    assert divergent(spark, left, left.where("b is not null")) == {"a", "b", "c", "d", "odd.name", "*"}
    empty = left.where("false")
    assert divergent(spark, empty, empty) == set()
    with pytest.raises(ValueError):
        compare_contents(spark, {"t": (left, left.withColumn("a", F.col("a").cast("long")))})


def test_contents_find_what_counts_do_not(spark):
    def frame(*rows):
        return spark.createDataFrame(rows, "k int, a string, b string, m map<string,int>")

    one, two, three = (1, "x", "y", {"p": 1}), (2, "z", None, {"p": 2}), (3, None, "z", None)
    base = frame(one, two, three)
    assert divergent(spark, base, frame((1, "w", "y", {"p": 1}), two, three)) == {"a", "*"}
    assert divergent(spark, base, frame((1, "z", "y", {"p": 1}), (2, "x", None, {"p": 2}), three)) == {"*"}
    assert divergent(spark, base, frame(one, (2, None, "z", {"p": 2}), three)) == {"a", "b", "*"}
    # a NULL that changes columns within a row, all columns' values being kept by another row
    assert divergent(spark, base, frame(one, (2, None, "z", {"p": 2}), (3, "z", None, None))) == {"*"}
    assert divergent(spark, base, frame(one, one, three)) == {"k", "a", "b", "m", "*"}
    assert divergent(spark, base, frame((1, "x", "y", {"p": 3}), two, three)) == {"m", "*"}


def test_write_and_verify(spark, tmp_dir):
    df = spark.range(1000).select("id", F.when(F.col("id") % 4 > 0, F.md5(F.col("id").cast("string"))).alias("text"))
    report = {r.column_name: r for r in write_and_verify(spark, {"t": df, "none": df.where("false")}, tmp_dir)
              .where("table_name = 't'").collect()}
    assert {c: (r.rows_written, r.rows_read, r.nulls_written, r.nulls_read, r.status) for c, r in report.items()} == {
        "id": (1000, 1000, 0, 0, "OK"), "text": (1000, 1000, 250, 250, "OK"), "*": (1000, 1000, 0, 0, "OK")}
    back = spark.read.parquet(f"{tmp_dir}/t")
    assert divergent(spark, back, df) == set()
