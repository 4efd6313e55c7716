"""Tables in the scratch folder."""

import re
import time

import pytest

from lakemart.llm.common import shuffles_kept_for_a_job, staged

KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark) -> set[str]:
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", manager.getAllFiles().mkString(",")))


def test_shuffle_files_go_with_their_job(spark):
    before = shuffle_files(spark)
    rows = spark.range(100_000).repartition(7, "id")
    staged(rows, "test-staged")
    end = time.time() + 20
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before


def test_the_setting_comes_back(spark):
    was = spark.conf.get(KEY)
    with pytest.raises(ValueError), shuffles_kept_for_a_job(spark):
        assert spark.conf.get(KEY) == "true"
        raise ValueError
    assert spark.conf.get(KEY) == was
