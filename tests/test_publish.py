"""Publications: all marts of a version or none, whatever fails."""

import os

import pytest
from pyspark.sql import functions as F

from lakemart.sinks import publish as sink
from lakemart.sinks.publish import (PublishError, expire, folders, publish, read_published,
                                    register_published, versions)


def mart(spark, n):
    return spark.range(n).select("id", (F.col("id") * n).alias("v"))


def seen(spark, root):
    return {name: df.count() for name, df in read_published(spark, root).items()}


def test_versions_follow_each_other(spark, tmp_dir):
    root = f"{tmp_dir}/gold"
    assert versions(spark, root) == [] and folders(spark, root) == {}
    assert publish(spark, {"a": mart(spark, 3), "b": mart(spark, 4)}, root) == 1
    old = read_published(spark, root)
    assert publish(spark, {"b": mart(spark, 9)}, root) == 2
    assert seen(spark, root) == {"a": 3, "b": 9}
    assert {n: d.count() for n, d in old.items()} == {"a": 3, "b": 4}      # readers keep what they began with
    assert read_published(spark, root, 1)["b"].count() == 4
    assert sorted(register_published(spark, root)) == ["a", "b"]
    assert spark.sql("SELECT count(*) FROM b").first()[0] == 9
    publish(spark, {"a": mart(spark, 0)}, root)                           # an empty mart is a mart
    assert len(expire(spark, root, keep=1)) == 2 and versions(spark, root) == [3]
    assert seen(spark, root) == {"a": 0, "b": 9}
    with pytest.raises(ValueError):
        expire(spark, root, keep=0)


def test_a_failed_run_leaves_the_old_version(spark, tmp_dir, monkeypatch):
    root = f"{tmp_dir}/gold"
    publish(spark, {"a": mart(spark, 3), "b": mart(spark, 3)}, root)
    before = sorted(os.listdir(f"{root}/data"))

    def same():
        return seen(spark, root) == {"a": 3, "b": 3} and sorted(os.listdir(f"{root}/data")) == before

    with pytest.raises(PublishError):       # a check
        publish(spark, {"a": mart(spark, 5), "b": mart(spark, 5)}, root, {"b": lambda df: df.count() > 5})
    assert same()
    with pytest.raises(Exception):          # a job, after another mart was written
        publish(spark, {"a": mart(spark, 5),
                        "b": mart(spark, 5).withColumn("w", F.raise_error(F.lit("no")).cast("int"))}, root)
    assert same()

    def lost(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:        # between the write and the switch
        m.setattr(sink, "_switch", lost)
        with pytest.raises(KeyboardInterrupt):
            publish(spark, {"a": mart(spark, 5)}, root)
    assert same()
    with monkeypatch.context() as m:        # another run was first
        m.setattr(sink, "versions", lambda *_: [])
        with pytest.raises(PublishError):
            publish(spark, {"a": mart(spark, 5)}, root)
    assert same() and versions(spark, root) == [1]
    assert not [f for f in os.listdir(f"{root}/manifests") if f.startswith(".draft")]
