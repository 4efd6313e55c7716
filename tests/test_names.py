import csv
import os
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart.functions.text import ascii_fold, slug
from lakemart.operators.names import dedupe_names, sanitize_columns, sanitize_name

# Optional golden: a copy of the published field dictionary (raw and clean headers).
DICTIONARY = os.environ.get("LAKEMART_FIELD_DICTIONARY", "")


@pytest.mark.parametrize("raw, expected", [
    ("", "col"), ("???", "col"), ("1.f.8_Relação", "c_1_f_8_relacao"),
    ("('P1_m ', 'Área de Formação')", "p1_m_area_de_formacao"),
    ("2.a_situação_de_trabalho", "c_2_a_situacao_de_trabalho"),
    ("4.j_usa_chatgpt_ou_copilot_no_trabalho?", "c_4_j_usa_chatgpt_ou_copilot_no_trabalho"),
    ("straße", "strae"), (None, None),
])
def test_sanitize_edge_cases(raw, expected):
    assert sanitize_name(raw) == expected


def test_sanitize_length_cut():
    long = "a" * 40 + "_" + "b" * 100
    assert sanitize_name(long) == "a" * 40
    no_late_underscore = "a" * 20 + "_" + "b" * 100
    assert sanitize_name(no_late_underscore) == no_late_underscore[:110]


# Own headers, each bringing one step of the rule into play.
HEADERS = [
    ("('P1_a ', 'Idade')", "p1_a_idade"), ("Número de funcionários?", "numero_de_funcionarios"),
    ("  __x__  ", "x"), ("???", "col"), ("2º nível", "c_2o_nivel"), ("R$ 1.000/mês", "r_1_000_mes"),
    ("Straße ½ ﬁm…", "strae_12_fim"), ("a" * 120, "a" * 110),
    ("palavra " * 20, "_".join(["palavra"] * 13)),
]


@pytest.mark.parametrize("raw,clean", HEADERS)
def test_header_rule(spark, raw, clean):
    assert sanitize_name(raw) == clean
    df = spark.createDataFrame([(raw,)], "h string")
    assert df.select(slug(F.col("h"))).first()[0] == clean


def published_pairs():
    """The published raw/clean pairs, where a copy of the dictionary is given."""
    if not os.path.isfile(DICTIONARY):
        return []
    with open(DICTIONARY, encoding="utf-8") as fh:
        return [(r[f"coluna_{y}_raw"], r[f"coluna_{y}"]) for r in csv.DictReader(fh)
                for y in (2023, 2024, 2025) if r[f"coluna_{y}_raw"]]


def test_published_header_pairs():
    pairs = published_pairs()
    assert len(pairs) in (0, 231)
    assert [sanitize_name(raw) for raw, _ in pairs] == [clean for _, clean in pairs]


def test_fold_of_long_texts_with_one_expanding_character(spark):
    texts = ["é" + "abc déf " * 300, "…" + "abc déf " * 300, "½ ﬁ 漢 𝐀 ™" * 40]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    fold = lambda t: unicodedata.normalize("NFKD", t.lower()).encode("ascii", "ignore").decode()
    assert [r[0] for r in df.select(ascii_fold(F.lower("t"))).collect()] == [fold(t) for t in texts]


def test_dedupe_is_collision_safe():
    out = dedupe_names(["a", "a", "a_1"])
    assert len(set(out)) == 3 and out[0] == "a" and out[2] == "a_1"
    assert dedupe_names(["x", "x", "x"]) == ["x", "x_1", "x_2"]


def test_sanitize_columns_positional_with_dots(spark):
    df = spark.createDataFrame([("1", "2", "3")], "`a.b` string, `A B` string, `a b` string")
    clean, mapping = sanitize_columns(df)
    assert clean.columns == ["a_b", "a_b_1", "a_b_2"]
    assert mapping[0] == ("a.b", "a_b")
    assert clean.first()["a_b_2"] == "3"


def test_slug_expression_matches_python_rules(spark):
    samples = ["Ｈｅｌｌｏ ½ ﬁne ǆungla", "ß straße", "Ĳssel ™ №5", "İstanbul ℌ", "", "???",
               "1.f.8_Relação", "x" * 120 + "_" + "y" * 5, "a" * 40 + "_" + "b" * 100, None,
               "___9abc", "Água-viva, ÉTÉ; Ñandú"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(slug(F.col("s"))).collect()]
    assert got == [sanitize_name(s) for s in samples]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=20))
def test_slug_property(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(slug(F.col("s"))).collect()]
    assert got == [sanitize_name(t) for t in texts]
