import datetime as dt

from lakemart.operators.standardize import (recode_boolean, recode_values, typed_columns,
                                            unmapped_report)
from lakemart.plans.survey import BOOLEAN_MAP


def test_recode_boolean(spark):
    vals = ["1", "TRUE", "0", "FALSE", "true", "x", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "b string")
    got = [r.b for r in recode_boolean(df, ["b"], BOOLEAN_MAP).collect()]
    assert got == ["Sim", "Sim", "Não", "Não", None, None, None, None]
    report = {(r.value, r.n_rows) for r in unmapped_report(df, ["b"], BOOLEAN_MAP).collect()}
    assert report == {("true", 1), ("x", 1), ("", 1)}


def test_recode_values(spark):
    df = spark.createDataFrame([("de 501 a 100",), ("outro",), (None,)], "n string")
    out = recode_values(df, {"n": {"de 501 a 100": "de 501 a 1.000"}})
    assert [r.n for r in out.collect()] == ["de 501 a 1.000", "outro", None]


def test_typed_columns(spark):
    df = spark.createDataFrame([("31/12/2024 10:00:00", "34"), ("2024-12-31", "x"),
                                (None, "3.7")], "ts string, i string")
    out = typed_columns(df, {"ts": "dd/MM/yyyy HH:mm:ss"}, ["i"]).collect()
    assert out[0].ts == dt.datetime(2024, 12, 31, 10, 0) and out[0].i == 34
    assert out[1].ts is None and out[1].i is None
    # decided: decimal text is not an integer answer -> NULL
    assert out[2].ts is None and out[2].i is None


def test_legacy_integer_mode(spark):
    vals = ["34", " 34 ", "3.7", "-3.7", ".5", "+5", "3.", "x", "1e2", "", "-", "3.7x",
            "99999999999", "\t12\n", None]
    df = spark.createDataFrame([(v,) for v in vals], "i string")
    got = [r.i for r in typed_columns(df, integers=["i"], legacy_integers=True).collect()]
    assert got == [34, 34, 3, -3, 0, 5, 3, None, None, None, None, None, None, 12, None]
    strict = [r.i for r in typed_columns(df, integers=["i"]).collect()]
    assert strict[:4] == [34, 34, None, None]
