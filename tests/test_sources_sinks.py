import glob
import os

import pytest
from pyspark.sql import functions as F

from lakemart.sinks.catalog import register_marts, register_tables, run_sql
from lakemart.sinks.files import export_csv, write_layer, write_partitioned
from lakemart.sources.csv import corrupt_lines, read_editions
from lakemart.sources.parquet import read_leaf, read_tables
from lakemart.sources.csv import read_raw_csv


def test_raw_csv_quotes_newlines_and_duplicate_headers(spark, tmp_dir):
    path = os.path.join(tmp_dir, "e.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write('b,b,"c d"\n"multi\nline ""q""",x,\n')
    df = read_raw_csv(spark, path)
    # the reader itself renames duplicate headers by position
    assert df.columns == ["b0", "b1", "c d"]
    row = df.first()
    assert row.b0 == 'multi\nline "q"' and row.b1 == "x" and row["c d"] is None
    assert dict(df.dtypes) == {"b0": "string", "b1": "string", "c d": "string"}


def test_export_csv_format(spark, tmp_dir):
    df = spark.createDataFrame([(2023, "Sudeste", None, 458), (2023, ' sp "x" ', "a", 1)],
                               "ano int, regiao string, nivel string, qtd long")
    out = os.path.join(tmp_dir, "export")
    export_csv(df, out, single_file=True)
    files = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(files) == 1
    text = open(os.path.join(out, files[0]), encoding="utf-8").read()
    assert text.splitlines()[0] == '"ano","regiao","nivel","qtd"'
    assert '"2023","Sudeste",,"458"' in text          # NULL: empty and unquoted
    assert '"2023"," sp ""x"" ","a","1"' in text
    export_csv(df.repartition(4), out + "-many")
    many = [open(os.path.join(out + "-many", f), encoding="utf-8").read().splitlines()
            for f in os.listdir(out + "-many") if f.startswith("part-")]
    assert all(x[0] == text.splitlines()[0] for x in many)
    assert sorted(r for x in many for r in x[1:]) == sorted(text.splitlines()[1:])
    back = read_raw_csv(spark, out).collect()
    assert sorted(r.regiao for r in back) == [' sp "x" ', "Sudeste"]


def test_register_and_query_marts(spark):
    df = spark.createDataFrame([(2023, "a", 3), (2023, "b", 5), (2024, "a", 1)],
                               "ano int, seg string, qtd long")
    register_marts(spark, {"m_test": df})
    top = run_sql(spark, "SELECT ano, max_by(seg, qtd) AS seg FROM m_test GROUP BY ano "
                         "ORDER BY ano").collect()
    assert [(r.ano, r.seg) for r in top] == [(2023, "b"), (2024, "a")]


def test_register_tables_over_parquet(spark, tmp_dir):
    path = os.path.join(tmp_dir, "gold_x")
    spark.createDataFrame([(2023, 5)], "ano int, qtd long").write.parquet(path)
    register_tables(spark, {"gold_x": path}, database="lakemart_test_db")
    assert run_sql(spark, "SELECT qtd FROM lakemart_test_db.gold_x").first().qtd == 5


def test_write_layer_and_readers(spark, tmp_dir):
    df = spark.createDataFrame([(2023, "a"), (2024, "b"), (2024, "c")], "ano int, v string")
    write_layer(df, os.path.join(tmp_dir, "t.parquet"), single_file=True)
    assert len([f for f in os.listdir(os.path.join(tmp_dir, "t.parquet"))
                if f.endswith(".parquet")]) == 1
    tables = read_tables(spark, tmp_dir, ["t"])
    assert tables["t"].count() == 3
    write_layer(df, os.path.join(tmp_dir, "layer"), partition_by=["ano"])
    leaf = read_leaf(spark, os.path.join(tmp_dir, "layer"), "ano", 2024)
    assert leaf.columns == ["v"] and leaf.count() == 2
    for year in (2023, 2024):
        with open(os.path.join(tmp_dir, f"{year}.csv"), "w", encoding="utf-8") as fh:
            fh.write("h_" + str(year) + "\nx\n")
    editions = read_editions(spark, {y: os.path.join(tmp_dir, f"{y}.csv") for y in (2023, 2024)})
    assert {y: e.columns for y, e in editions.items()} == {2023: ["h_2023"], 2024: ["h_2024"]}


def test_null_and_empty_string_stay_apart(spark, tmp_dir):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x")], "id int, v string")
    for single in (True, False):
        out = os.path.join(tmp_dir, f"out-{single}")
        export_csv(df, out, single_file=single)
        back = read_raw_csv(spark, out, nullValue="\ue000").collect()
        assert {int(r.id): r.v for r in back} == {1: None, 2: "", 3: "x"}


def test_single_file_is_in_order_whatever_the_partitions(spark, tmp_dir):
    df = spark.range(500).selectExpr("id", "id * 7919 % 500 AS k").repartition(16)
    out = os.path.join(tmp_dir, "ordered")
    export_csv(df, out, single_file=True, order_by=["k"])
    (part,) = [f for f in os.listdir(out) if f.startswith("part-")]
    lines = open(os.path.join(out, part), encoding="utf-8").read().splitlines()
    assert lines[0] == '"id","k"' and [int(x.split(",")[1].strip('"')) for x in lines[1:]] == list(range(500))


def test_header_drift_is_an_error(spark, tmp_dir):
    for name, text in (("a.csv", "x,y\n1,2\n"), ("b.csv", "y,x\n3,4\n")):
        with open(os.path.join(tmp_dir, name), "w", encoding="utf-8") as fh:
            fh.write(text)
    with pytest.raises(Exception, match="header|schema"):
        read_raw_csv(spark, tmp_dir).collect()


def test_corrupt_lines_are_counted(spark, tmp_dir):
    path = os.path.join(tmp_dir, "c.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write('x,y\n1,2\n1,2,3\n"a\nb",4\n5\n')
    assert corrupt_lines(spark, path) == 2
    assert read_raw_csv(spark, path).count() == 4


def test_table_location_with_a_quote(spark, tmp_dir):
    path = os.path.join(tmp_dir, "it's")
    spark.createDataFrame([(1,)], "v int").write.parquet(path)
    register_tables(spark, {"quoted_place": path}, database="lakemart_test_db")
    assert run_sql(spark, "SELECT v FROM lakemart_test_db.quoted_place").first().v == 1


def test_partitions_with_a_null_and_other_editions_untouched(spark, tmp_dir):
    path = os.path.join(tmp_dir, "p")
    write_partitioned(spark.createDataFrame([(1, 2023), (2, None), (3, 2024)], "id int, ano int"), path, "ano")
    write_partitioned(spark.createDataFrame([(9, 2024)], "id int, ano int"), path, "ano")
    assert sorted((r.id, r.ano) for r in spark.read.parquet(path).collect()) == [(1, 2023), (2, None), (9, 2024)]


def parts(folder):
    return [open(p, newline="", encoding="utf-8").read() for p in sorted(glob.glob(folder + "/part-*"))]


def test_ordered_parts_join_to_the_single_file(spark, tmp_dir):
    df = spark.range(5000).select((F.col("id") * 7919 % 100).alias("k"), "id",
                                  F.when(F.col("id") % 3 > 0, F.concat(F.lit('q"\n,é'), "id")).alias("text")).repartition(6)
    order = ["k", F.col("id").desc()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        export_csv(df, tmp_dir + "/many", order_by=order, one_header=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    export_csv(df, tmp_dir + "/one", order_by=order, single_file=True)
    many, one = parts(tmp_dir + "/many"), parts(tmp_dir + "/one")
    assert len(many) > 4 and len(one) == 1 and many[0] == '"k","id","text"\n'
    assert "".join(many) == one[0]


def test_exports_without_rows_have_a_header(spark, tmp_dir):
    none = spark.range(10).repartition(3).where("id < 0")
    for i, how in enumerate(({}, {"one_header": True}, {"single_file": True}, {"single_file": True, "order_by": ["id"]})):
        export_csv(none, f"{tmp_dir}/{i}", **how)
        assert parts(f"{tmp_dir}/{i}") == ['"id"\n'], how


def test_exports_need_no_python_worker(spark, tmp_dir, monkeypatch):
    from pyspark.sql import DataFrame

    def refuse(*_, **__):
        raise AssertionError("rows go through Python")

    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", refuse)
    monkeypatch.setattr(DataFrame, "mapInArrow", refuse)
    export_csv(spark.range(10).repartition(3), tmp_dir + "/x")
    assert sorted("".join(parts(tmp_dir + "/x")).split("\n"))[1:11] == ['"%d"' % i for i in range(10)]
