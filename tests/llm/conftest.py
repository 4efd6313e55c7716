import pytest

LONG = "wörd and number 123 " * 4000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, very long and repeated texts, repeated
    rows and ids, special-token strings, and columns with clashing names."""
    base = "the quick brown fox jumps over the lazy dog while seven grey wolves watch from the hill beyond"
    rows = [
        (1, base + " one", "src1"), (2, base.upper() + " ONE", "src1"), (3, None, None), (4, "", "src2"),
        (5, LONG, "src2"), (6, LONG, "src3"), (7, "a<|endoftext|>b <|startoftext|> don't I'LL", "src3"),
        (8, "Ünïcode ß  \t x y\n\nz 😀 ÀÉ", None), (9, "   \n ", "src1"),
        (None, "no id here at all", "src1"), (11, base + " one", "src2"), (11, base + " one", "src2"),
        (12, "x" * 3000, "src4"), (13, base + " two", "src1"), (14, None, "src9"),
    ]
    return spark.createDataFrame(
        [(i, t, s, "row", 1, "k", 0.5, "id", "root") for i, t, s in rows],
        "doc_id long, text string, source string, row string, size int, key string, score double, "
        "id string, root string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
