import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart.operators.marts import (Dimension, count_mart, count_marts, distinct_mart,
                                      long_format, mart_names, share_mart, split_count_marts)
from lakemart.operators.multiselect import explode_options


def _survey(spark):
    rows = [(2023, "t1", "SP", "SQL, Python"), (2023, "t2", "SP", "Python"),
            (2023, "t3", None, None), (2024, "t1", "RJ", "R, R"), (2024, "t4", "RJ", "")]
    return spark.createDataFrame(rows, "ano int, token string, uf string, ling string")


def test_count_mart_sums_to_rows_and_orders(spark):
    df = _survey(spark)
    mart = count_mart(df, ["ano", "uf"], "qtd")
    assert mart.agg(F.sum("qtd")).first()[0] == df.count()
    assert [(r.ano, r.uf, r.qtd) for r in mart.collect()] == [
        (2023, "SP", 2), (2023, None, 1), (2024, "RJ", 2)]


def test_share_mart(spark):
    df = _survey(spark)
    exploded = explode_options(df.select("ano", "token", "ling"), "ling", "opt")
    mart = share_mart(exploded, df, "ano", ["opt"], "token", "qtd", "pct")
    got = {(r.ano, r.opt): (r.qtd, r.pct) for r in mart.collect()}
    # 2023 has 3 distinct tokens, 2024 has 2; "R, R" counts the token once
    assert got == {(2023, "Python"): (2, 66.7), (2023, "SQL"): (1, 33.3), (2024, "R"): (1, 50.0)}


def test_long_format_equals_union_of_parts(spark):
    df = _survey(spark)
    long = long_format(df, ["ano", "token"], [Dimension("uf", "uf"),
                                               Dimension("ling", "ling", multiselect=True)])
    union = (df.where(F.col("uf").isNotNull())
               .select("ano", "token", F.lit("uf").alias("dimensao"), F.col("uf").alias("valor"))
               .unionByName(explode_options(df.select("ano", "token", "ling"), "ling", "valor")
                            .withColumn("dimensao", F.lit("ling"))))
    assert sorted(long.collect()) == sorted(union.select(*long.columns).collect())
    mart = distinct_mart(long, ["ano", "dimensao", "valor"], "token", "qtd", leading=2)
    assert mart.where("dimensao = 'ling' AND valor = 'R'").first().qtd == 1


def test_long_format_without_dimensions_is_empty(spark):
    df = _survey(spark)
    out = long_format(df, ["ano", "token"], [])
    assert out.columns == ["ano", "token", "dimensao", "valor"] and out.count() == 0


def test_gold_marts_name_missing_questions(spark):
    from lakemart.plans.gold import MissingQuestion, build_marts
    from lakemart.plans.survey import SurveyRecipe
    silver = spark.createDataFrame([(2024, "t1", "Finanças", "Júnior")],
                                   "_ano_pesquisa int, token string, setor string, nivel string")
    recipe = SurveyRecipe(respondent_columns=["_ano_pesquisa", "token", "setor"],
                          panorama_keys=["_ano_pesquisa", "setor"],
                          profile_keys=["_ano_pesquisa", "nivel"],
                          diversity_keys=["_ano_pesquisa", "nivel"],
                          regional_keys=["_ano_pesquisa", "setor"],
                          ai_keys=["setor"], maturity_keys=["setor"])
    with pytest.raises(MissingQuestion, match="cloud_dia_a_dia"):
        build_marts(silver, recipe)
    marts = build_marts(silver, recipe, strict=False)
    assert marts["gold_adocao_tecnologias"].count() == 0
    assert marts["gold_adocao_ia"].count() == 0
    assert marts["gold_panorama_mercado"].first().qtd_respondentes == 1


def test_share_rounding_is_half_up_on_decimal_text(spark):
    """SURVEY H12: 18/4000*100 is 0.44999999999999996 as a double; Spark rounds
    its decimal text HALF_UP to 0.4, and exact halves go up."""
    from lakemart.functions.scalar import share_pct
    df = spark.createDataFrame([(18, 4000), (1, 8), (1, 3)], "n long, t long")
    got = [r[0] for r in df.select(share_pct(F.col("n"), F.col("t"))).collect()]
    assert got == [0.4, 12.5, 33.3]
    df2 = spark.createDataFrame([(5, 400)], "n long, t long")   # 1.25 -> 1.3
    assert df2.select(share_pct(F.col("n"), F.col("t"))).first()[0] == 1.3


def test_count_marts_in_one_pass_equal_separate_marts(spark):
    df = _survey(spark)                     # uf and ling hold NULLs
    marts = {"by_uf": ["ano", "uf"], "by_ling": ["ano", "ling"], "by_year": ["ano"],
             "same_as_uf": ["uf", "ano"]}
    combined = count_marts(df, marts, "qtd")
    split = split_count_marts(combined, marts, "qtd")
    for name, keys in marts.items():
        assert split[name].collect() == count_mart(df, keys, "qtd").collect(), name
    per_mart = (combined.select(F.explode(mart_names(combined, marts)).alias("m"))
                        .groupBy("m").count().collect())
    assert {r.m: r["count"] for r in per_mart} == {
        name: count_mart(df, keys, "qtd").count() for name, keys in marts.items()}


_KEY = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([2023, 2024]), _KEY, _KEY, _KEY), min_size=1,
                max_size=40))
def test_count_marts_property(spark, rows):
    """Property: every mart split from the one-pass aggregate equals the mart
    built on its own, NULL keys included."""
    df = spark.createDataFrame(rows, "ano int, x string, y string, z string")
    marts = {"xy": ["ano", "x", "y"], "z": ["ano", "z"], "yz": ["ano", "y", "z"]}
    split = split_count_marts(count_marts(df, marts, "n"), marts, "n", sort=False)
    for name, keys in marts.items():
        assert sorted(split[name].collect(), key=str) == \
            sorted(count_mart(df, keys, "n", sort=False).collect(), key=str), name


@pytest.fixture()
def order_tables(spark, tmp_dir):
    """40 orders of three lines each, two part types; the last order has no lines."""
    day = "timestamp'2024-05-01' as o_orderdate"
    orders = spark.range(41).selectExpr("id as o_orderkey", "id % 3 as o_custkey", "'O' as o_orderstatus",
                                        "'1-URGENT' as o_orderpriority", day)
    lines = spark.range(120).selectExpr(
        "id % 40 as l_orderkey", "id % 2 as l_partkey", "if(id % 4 < 2, 'A', 'R') as l_returnflag",
        "if(id % 40 < 20, 'F', 'O') as l_linestatus")
    tables = {
        "orders": orders, "lineitem": lines,
        "customer": spark.range(3).selectExpr("id as c_custkey", "'BUILDING' as c_mktsegment", "0L as c_nationkey"),
        "nation": spark.range(1).selectExpr("id as n_nationkey", "'BRAZIL' as n_name"),
        "part": spark.range(2).selectExpr("id as p_partkey", "if(id = 0, 'LARGE, TIN', 'SMALL, TIN') as p_type")}
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{tmp_dir}/{name}.parquet")
    return tmp_dir


@pytest.mark.parametrize(("name", "total"), [("order_flag_adoption", 40 + 40), ("order_adoption_long", 40 + 41 + 41)])
def test_orders_are_dealt_into_as_many_parts_as_they_need(spark, order_tables, name, total, monkeypatch):
    """The distinct orders of a value come from the deal by order: no task holds
    the distinct rows of a whole scan, and parts grow with the rows."""
    from lakemart.operators import marts
    from lakemart.plans.testdata import QUERIES

    for most, parts in ((12, 10), (4, 30)):
        monkeypatch.setattr(marts, "PART_ROWS", most)
        df = QUERIES[name](spark, order_tables)
        assert sum(r["n_orders"] for r in df.collect()) == total
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count(f", {parts}\n") >= 2          # orders, and their lines or cells
        physical = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "o_orderkey" not in "".join(
            x for x in physical.split("\n") if "Exchange hashpartitioning" in x and f", {parts})" not in x
            and "REPARTITION_BY_NUM" not in x)
