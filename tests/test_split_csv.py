"""Multi-line CSV read by byte ranges equals the one-task scan."""

import os
import random

import pytest

from lakemart.sources.csv import read_raw_csv, read_split_csv

FIELDS = ["plain", "", '"quoted"', '"with ""doubled"" quotes"', '"a\nbreak"', '"\n"', '"two\n\nbreaks, and ""one""\n"',
          '"""starts and ends"""', '"é\r\nü"', '""', 'st"ray', '"x,\ny"', "  spaced ", '"' + "long\n" * 20 + '"']


def write(folder, name, rows, header="a,b,c", end="\n"):
    with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
        f.write(end.join([header, *(",".join(r) for r in rows)]) + end)


@pytest.fixture(params=[48, 400, 1 << 20])
def ranges(spark, request):
    own = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes",
                                          "spark.sql.files.minPartitionNum") if spark.conf.get(k, None)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield request.param
    for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.set(k, own[k]) if k in own else spark.conf.unset(k)


def same(spark, folder):
    want, got = read_raw_csv(spark, folder), read_split_csv(spark, folder)
    assert got.columns == want.columns
    order = lambda df: sorted(([tuple(r) for r in df.collect()]), key=repr)
    assert order(got) == order(want)
    return got


def test_equals_the_one_task_scan(spark, tmp_dir, ranges):
    rng = random.Random(1)
    for k in range(2):
        write(tmp_dir, f"{k}.csv", [[rng.choice(FIELDS) for _ in range(3)] for _ in range(16)])
    write(tmp_dir, "last.csv", [["1", "2", "x"]])
    assert same(spark, tmp_dir).count() == 33
    if ranges == 48:
        assert spark.read.text(tmp_dir).rdd.getNumPartitions() > 15


def test_header_over_several_lines(spark, tmp_dir, ranges):
    write(tmp_dir, "a.csv", [["1", '"x\ny"'], ["2", ""]], header='"first\ncolumn","sec""ond"')
    assert same(spark, tmp_dir).count() == 2


def test_odd_files(spark, tmp_dir):
    write(tmp_dir, "a.csv", [])
    assert same(spark, tmp_dir).count() == 0
    write(tmp_dir, "b.csv", [["1", "2", "3"]], header="a,b,other")
    with pytest.raises(Exception, match="header"):
        read_split_csv(spark, tmp_dir).collect()
