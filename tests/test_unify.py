import pytest

from lakemart.operators.unify import (DictionaryError, check_dictionary, dictionary_coverage,
                                      mapping_for, select_by_dictionary,
                                      union_editions)
from lakemart.sources.dictionary import dictionary_from_rows


def test_union_editions_null_fill_and_order(spark):
    a = spark.createDataFrame([(1, "x")], "id int, only_a string")
    b = spark.createDataFrame([("y", 2)], "only_b string, id int")
    out = union_editions([a, b])
    assert out.columns == ["id", "only_a", "only_b"]
    rows = sorted(out.collect(), key=lambda r: r.id)
    assert (rows[0].only_b, rows[1].only_a) == (None, None)


def test_select_by_dictionary_and_check(spark):
    dictionary = dictionary_from_rows(
        spark, [("idade", "p_idade", "c_idade"), ("uf", None, "c_uf"), ("extra", "p_x", None)],
        ["campo_padronizado", "coluna_2023", "coluna_2024"])
    e23 = spark.createDataFrame([("30", "drop me")], "p_idade string, unused string")
    e24 = spark.createDataFrame([("40", "SP")], "c_idade string, c_uf string")
    missing = check_dictionary(spark, dictionary, {2023: e23, 2024: e24},
                               {2023: "coluna_2023", 2024: "coluna_2024"}).collect()
    assert [(r.edition, r.field, r.column) for r in missing] == [("2023", "extra", "p_x")]
    with pytest.raises(DictionaryError):
        select_by_dictionary(e23, [("p_idade", "idade"), ("p_x", "extra")])
    lenient = select_by_dictionary(e23, [("p_idade", "idade"), ("p_x", "extra")], strict=False)
    assert lenient.columns == ["idade", "extra"] and lenient.first().extra is None


def test_quotes_and_backticks_in_headers(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "`c'x` int, `b``t` string")
    dictionary = spark.createDataFrame([("a", "c'x"), ("b", "b`t"), ("c", "gone'`")],
                                       "campo_padronizado string, col_e string")
    rows = dictionary_coverage(spark, dictionary, {"e'1": df}, {"e'1": "col_e"}).collect()
    assert {(r.edition, r.field, r.present, r.n_values) for r in rows} == {
        ("e'1", "a", True, 2), ("e'1", "b", True, 1), ("e'1", "c", False, None)}
    out = select_by_dictionary(df, mapping_for(dictionary, "col_e"), strict=False)
    assert out.columns == ["a", "b", "c"] and out.where("c is null").count() == 2
