"""One catalog table over editions whose schemas differ."""

import pytest
from pyspark.sql import functions as F

from lakemart.session import delete_path
from lakemart.sinks.catalog import LayerTypeError, register_layer, run_sql
from lakemart.sinks.files import write_edition

DB = "lakemart_layer_db"


def edition(spark, base, name, select):
    write_edition(spark.range(4).selectExpr(*select), base, name)


def rows(spark, sql):
    return [tuple(r) for r in run_sql(spark, sql.replace("FROM T", f"FROM {DB}.t_layer")).collect()]


def test_schema_widens_with_editions(spark, tmp_dir):
    base = f"{tmp_dir}/it's"
    edition(spark, base, 2023, ["cast(id as int) id", "'x' a"])
    assert register_layer(spark, "t_layer", base, database=DB) == ["id", "a"]
    assert rows(spark, "SELECT ano, count(*), sum(id) FROM T GROUP BY ano") == [(2023, 4, 6)]

    edition(spark, base, 2024, ["'y' A", "cast(id as int) id", "id > 1 AS `new.one`"])     # other order and case
    assert register_layer(spark, "t_layer", base, database=DB) == ["new.one"]
    assert register_layer(spark, "t_layer", base, database=DB) == []
    assert rows(spark, "SELECT ano, min(a), count(`new.one`) FROM T GROUP BY ano ORDER BY ano") \
        == [(2023, "x", 0), (2024, "y", 4)]

    edition(spark, base, 2025, ["id + 5000000000 AS id"])                                 # wider, and less columns
    assert register_layer(spark, "t_layer", base, database=DB) == []
    assert rows(spark, "SELECT ano, max(id), count(a) FROM T GROUP BY ano ORDER BY ano") \
        == [(2023, 3, 4), (2024, 3, 4), (2025, 5000000003, 0)]
    assert spark.table(f"{DB}.t_layer").columns == ["id", "a", "new.one", "ano"]

    edition(spark, base, 2026, ["'text' AS id"])
    with pytest.raises(LayerTypeError, match="id is bigint"):
        register_layer(spark, "t_layer", base, database=DB)
    assert rows(spark, "SELECT count(*) FROM T") == [(12,)]                                # the table as it was

    for gone in (2024, 2026):
        delete_path(spark, f"{base}/ano={gone}")
    assert register_layer(spark, "t_layer", base, database=DB) == []
    assert rows(spark, "SELECT DISTINCT ano FROM T ORDER BY 1") == [(2023,), (2025,)]
    assert spark.table(f"{DB}.t_layer").columns == ["id", "a", "ano"]


def test_folders_are_pruned_and_errors(spark, tmp_dir):
    base = f"{tmp_dir}/layer"
    with pytest.raises(Exception):
        register_layer(spark, "none", base, database=DB)
    for y in (2023, 2024):
        edition(spark, base, y, ["id"])
    register_layer(spark, "t_pruned", base, database=DB)
    df = spark.table(f"{DB}.t_pruned").where(F.col("ano") == 2024)
    assert df.count() == 4
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan and all("ano=2024" in f for f in df.inputFiles())
    edition(spark, base, 2025, ["id", "1 AS ano"])
    with pytest.raises(LayerTypeError):
        register_layer(spark, "t_pruned", base, database=DB)
