import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart.operators.multiselect import (VocabularyError, discover_and_validate,
                                            discover_vocabulary, explode_by_vocabulary,
                                            explode_discovered, explode_options, invalid_cells,
                                            with_discovered_tokens, with_tokens)


def options(vocabulary):
    return [r.option for r in vocabulary.collect()]


def greedy(cell, vocabulary):
    """Tokens by the rule itself, or None: the longest option the rest starts
    with, one separator, and so on; one trailing separator is allowed."""
    out, at = [], 0
    while at < len(cell):
        fits = [o for o in vocabulary if o and cell.startswith(o, at)]
        if not fits:
            return None
        out.append(max(fits, key=len))
        at += len(out[-1])
        if at < len(cell):
            if not cell.startswith(", ", at):
                return None
            at += 2
    return out


def test_explode_options_edge_rows(spark):
    df = spark.createDataFrame([(1, "a, b,c,,  ,d"), (2, "x,x"), (3, ""), (4, None)],
                               "id int, cell string")
    rows = explode_options(df, "cell").orderBy("id").collect()
    assert [(r.id, r.opcao) for r in rows] == [
        (1, "a"), (1, "b"), (1, "c"), (1, "d"), (2, "x"), (2, "x")]
    assert "cell" not in explode_options(df, "cell").columns


def test_explode_options_rejects_same_output(spark):
    df = spark.createDataFrame([("a",)], "c string")
    with pytest.raises(ValueError):
        explode_options(df, "c", "c")


def test_discover_vocabulary(spark):
    df = spark.createDataFrame([("A (x, y).",), ("B.",), ("A (x, y)., B.",), (None,), ("",)],
                               "c string")
    assert options(discover_vocabulary(df, "c")) == ["A (x, y).", "B."]


def test_prefix_clash_takes_longest(spark):
    df = spark.createDataFrame([(1, "A. more., B."), (2, "A."), (3, "A. more."), (4, "B.")],
                               "id int, c string")
    vocab = discover_and_validate(df, "c")
    assert sorted(options(vocab)) == ["A.", "A. more.", "B."]
    rows = explode_by_vocabulary(df, "c", vocab).where("id = 1").collect()
    assert [r.opcao for r in rows] == ["A. more.", "B."]


def test_out_of_vocabulary_raises(spark):
    df = spark.createDataFrame([("lixo., B.",), ("B.",), ("C.",)], "c string")
    with pytest.raises(VocabularyError, match="lixo"):
        explode_by_vocabulary(df, "c", ["C.", "B."])


def test_missing_separator_is_invalid(spark):
    df = spark.createDataFrame([("A.B.",)], "c string")
    assert [r.cell for r in invalid_cells(df, "c", ["A.", "B."]).collect()] == ["A.B."]


def test_empty_vocabulary_gives_no_rows(spark):
    df = spark.createDataFrame([(1, None)], "id int, c string")
    assert explode_by_vocabulary(df, "c", [], validate=False).count() == 0


def test_regex_metacharacters_are_literal(spark):
    opts = ["C++ (a|b).", "[x]* ok.", "R$ 1.000, mais."]
    cell = ", ".join(opts)
    df = spark.createDataFrame([(cell,)] + [(o,) for o in opts], "c string")
    vocab = discover_and_validate(df, "c")
    got = [r.opcao for r in explode_by_vocabulary(df, "c", vocab).collect()]
    assert sorted(got) == sorted(opts * 2)


OPTIONS = ["Uso o X (sim, muito).", "Não uso.", "Uso às vezes, pouco.", "Outro."]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.sampled_from(OPTIONS), min_size=1, max_size=4, unique=True),
                min_size=1, max_size=12))
def test_explode_then_join_is_identity(spark, cells):
    """Property: tokens of a cell joined back give the cell."""
    texts = [", ".join(c) for c in cells]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, c string")
    assert invalid_cells(df, "c", OPTIONS).count() == 0
    exploded = explode_by_vocabulary(df, "c", OPTIONS, validate=False)
    counts = {r.id: r.n for r in exploded.groupBy("id").count().withColumnRenamed("count", "n")
              .collect()}
    assert counts == {i: len(c) for i, c in enumerate(cells)}


SIMPLE = ["SQL", "Python", "R", "Power BI", "C#"]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.sampled_from(SIMPLE), min_size=1, max_size=5),
                min_size=1, max_size=12))
def test_simple_explode_then_join_is_identity(spark, cells):
    """MS-1 property: options without commas survive split + join (duplicates kept)."""
    texts = [", ".join(c) for c in cells]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, c string")
    exploded = explode_options(df, "c")
    counts = {r.id: r.n for r in exploded.groupBy("id").count()
              .withColumnRenamed("count", "n").collect()}
    assert counts == {i: len(c) for i, c in enumerate(cells)}
    values = sorted(r.opcao for r in exploded.collect())
    assert values == sorted(o for c in cells for o in c)


ODD_OPTIONS = ["A.", "A. more.", "B", "B, C", "CD.", "X.,", "Y.", "Y., Z.", "long " * 1000 + "end.", "D, E, F"]


def test_tokens_equal_the_greedy_rule(spark):
    """Options ending in ".,", options that stop inside a piece, options holding
    the marker, prefixes of others, a very long one, trailing separators."""
    rng = random.Random(3)
    cells = ["", "A., ", "B, CD.", "B, C, CD.", "A. mor", "X.,, Y.", ", A.", "A., , B", "Y., Z., Y.", "B, C, D, E, F",
             "lixo", ODD_OPTIONS[8], ODD_OPTIONS[8] + ", A."]
    for _ in range(150):
        cells.append(", ".join(rng.choice([*ODD_OPTIONS[:8], "D, E, F", "C", "D"])
                               for _ in range(rng.randrange(1, 5))) + rng.choice(["", "", ", ", "."]))
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)] + [(-1, None)], "id int, c string")
    got = with_tokens(df, "c", ODD_OPTIONS, "tokens", validate=False).collect()
    assert len(got) == len(cells) + 1
    for r in got:
        assert r.tokens == (None if r.c is None else greedy(r.c, ODD_OPTIONS)), r.c


def test_trailing_separator_is_accepted(spark):
    df = spark.createDataFrame([(1, "A., "), (2, "B., A., ")], "id int, c string")
    vocab = discover_and_validate(df.union(spark.createDataFrame([(3, "B.")], "id int, c string")), "c")
    rows = explode_by_vocabulary(df, "c", vocab).collect()
    assert sorted((r.id, r.opcao) for r in rows) == [(1, "A."), (2, "A."), (2, "B.")]


def test_hot_cell_keeps_every_row(spark):
    df = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 'A., B.', if(id % 3 = 1, 'A.', 'B.')) AS c")
    out = explode_by_vocabulary(df, "c", discover_and_validate(df, "c"))
    assert {r.opcao: r["count"] for r in out.groupBy("opcao").count().collect()} == {"A.": 2000, "B.": 2000}


@pytest.mark.parametrize("longest", [1000])
def test_an_option_of_many_pieces(spark, longest):
    """Cells of 1000 pieces beside an option of 1000: rows, not stretches, are
    what is joined, so this runs in a small heap."""
    rng = random.Random(7)
    short = [f"word {i}" for i in range(30)] + ["word 1, word 2", "word 1, word 2, word 3, wor"]
    long = ", ".join(["word 1"] + [rng.choice(short[:30]) for _ in range(longest - 1)])
    cells = [", ".join(rng.choice(short[:30]) for _ in range(1000)) for _ in range(40)]
    cells += [long, long + ", word 5", "word 5, " + long, long[:-1], ", ".join(["word 1"] * 1000)]
    vocabulary = [*short, long]
    df = spark.createDataFrame([(c,) for c in cells], "cell string")
    got = {r.cell: r.tokens for r in with_tokens(df, "cell", vocabulary, "tokens", validate=False).collect()}
    assert got == {c: greedy(c, vocabulary) for c in cells}
    assert got[long] == [long] and got["word 5, " + long] == ["word 5", long]
    assert any(t is None for t in got.values())


def test_misleading_hashes_are_noticed(spark, monkeypatch):
    """Where all pieces hash alike the walk goes wrong, which its texts show."""
    from lakemart.functions import vocabulary

    own = vocabulary._piece_hashes
    monkeypatch.setattr(vocabulary, "_piece_hashes", lambda parts, k, attempt: own(parts, k, attempt) if attempt
                        else F.transform(parts, lambda p: F.lit(1).cast("long")))
    options = ["a, b.", "a, bc.", "a", "c, d, e", "f"]
    cells = ["a, b.", "a, x.", "c, d, e, f", "c, d, f", "f, a, bc.", "a, f", "c, x, e"]
    df = spark.createDataFrame([(c,) for c in cells], "cell string")
    got = {r.cell: r.tokens for r in with_tokens(df, "cell", options, "tokens", validate=False).collect()}
    assert got == {c: greedy(c, options) for c in cells}


def test_discovered_tokens(spark):
    df = spark.createDataFrame([(1, "a, b., c."), (2, "a, b."), (3, "c."), (4, None), (5, ""), (6, "c., a, b., ")],
                               "id int, cell string")
    got = {r.id: r.tokens for r in with_discovered_tokens(df, "cell", "tokens").collect()}
    assert got == {1: ["a, b.", "c."], 2: ["a, b."], 3: ["c."], 4: None, 5: [], 6: ["c.", "a, b."]}
    assert sorted((r.id, r.opcao) for r in explode_discovered(df, "cell").collect())[:2] == [(1, "a, b."), (1, "c.")]
    with pytest.raises(VocabularyError):
        with_discovered_tokens(spark.createDataFrame([("a., b",), ("a.",)], "cell string"), "cell", "tokens")
