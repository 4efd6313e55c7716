"""Multi-select answers: one cell holds several options joined by ``", "``.

Two flavours:

* simple options without inner commas -> :func:`explode_options` (split on
  ``,\\s*``);
* options that are sentences with inner commas -> discover the vocabulary
  from the cells that hold one option (:func:`discover_vocabulary`), check that
  every cell is a sequence of those options (:func:`validate_vocabulary`) and
  tokenise greedily, longest option first (:func:`explode_by_vocabulary`).

Everything is distributed: the vocabulary is a table, since free text makes it
as large as the data. Distinct cells are tokenised once and joined back; a cell
that very many rows hold is a skewed join key, which AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.text import MULTISELECT_SPLIT, OPTION_JOINER, split_options
from lakemart.functions.vocabulary import cell_tokens, distinct_cells, tokens_of
from lakemart.session import materialize

DEFAULT_MARKER = "."   # options of the comma-bearing flavour end with this


class VocabularyError(ValueError):
    """A cell cannot be rebuilt from the vocabulary."""


def _check_output(column: str, output: str) -> None:
    if column == output:
        raise ValueError(f"output column {output!r} must differ from the exploded column")


def explode_options(df: DataFrame, column: str, output: str = "opcao",
                    distinct: bool = False) -> DataFrame:
    """One row per option of a simple multi-select cell; the cell column is dropped.

    ``'a, b,c,,  ,d'`` -> a, b, c, d. Duplicates inside a cell stay, case is
    kept, NULL and empty cells give no rows, other columns are carried along.
    ``distinct`` drops pieces that repeat inside a cell before the explode: what
    a mart of distinct tokens counts is the same, from fewer rows.
    """
    _check_output(column, output)
    parts = F.split(F.col(column), MULTISELECT_SPLIT) if distinct else split_options(F.col(column))
    out = df.withColumn(output, F.explode(F.array_distinct(parts) if distinct else parts)).drop(column)
    return out.withColumn(output, F.trim(output)).where(F.col(output) != "") if distinct else out


def discover_vocabulary(df: DataFrame, column: str, marker: str = DEFAULT_MARKER,
                        sort: bool = True) -> DataFrame:
    """Candidate options: distinct non-empty cells that do not contain
    ``marker + ", "`` (i.e. hold a single option; one trailing separator is no
    part of it). Columns ``option, length``, longest first (the order in which
    options are tried) when ``sort``."""
    cell = F.regexp_replace(F.col(column), f"{OPTION_JOINER}$", "")
    out = (df.select(cell.alias("option"))
             .where(F.col("option").isNotNull() & (F.col("option") != "")
                    & ~F.col("option").contains(marker + OPTION_JOINER))
             .distinct()
             .select("option", F.length("option").alias("length")))
    return out.orderBy(F.col("length").desc(), F.col("option")) if sort else out


def vocabulary_table(df: DataFrame, vocabulary: DataFrame | Sequence[str]) -> DataFrame:
    """A vocabulary given as a list becomes a table with a column ``option``."""
    if isinstance(vocabulary, DataFrame):
        return vocabulary
    return df.sparkSession.createDataFrame([(o,) for o in vocabulary], "option string")


def invalid_cells(df: DataFrame, column: str, vocabulary: DataFrame | Sequence[str]) -> DataFrame:
    """Distinct non-NULL cells that are not a ``", "``-joined option sequence."""
    return cell_tokens(df, column, vocabulary_table(df, vocabulary)).where("tokens is null").select("cell")


def _raise_on_invalid(read: DataFrame) -> None:
    bad = read.where("tokens is null").agg(F.count("*").alias("n"), F.min("cell").alias("example")).first()
    if bad["n"]:
        raise VocabularyError(f"{bad['n']} cell(s) cannot be rebuilt from the vocabulary; "
                              f"example: {bad['example']!r}")


def validate_vocabulary(df: DataFrame, column: str, vocabulary: DataFrame | Sequence[str]) -> None:
    """Raise :class:`VocabularyError` with the number of bad cells and one example."""
    _raise_on_invalid(cell_tokens(df, column, vocabulary_table(df, vocabulary)))


def _joined(df: DataFrame, column: str, read: DataFrame, output: str, validate: bool) -> DataFrame:
    if validate:
        _raise_on_invalid(read)
    read = read.select(F.col("cell").alias(f"__{output}_cell"), F.col("tokens").alias(output))
    return df.join(read, df[column] == read[f"__{output}_cell"], "left").drop(f"__{output}_cell")


def with_tokens(df: DataFrame, column: str, vocabulary: DataFrame | Sequence[str], output: str,
                validate: bool = True) -> DataFrame:
    """``df`` with an ``array<string>`` column of the cell's options (NULL for a
    NULL cell). With ``validate`` an out-of-vocabulary cell raises."""
    return _joined(df, column, cell_tokens(df, column, vocabulary_table(df, vocabulary)), output, validate)


def with_discovered_tokens(df: DataFrame, column: str, output: str, marker: str = DEFAULT_MARKER) -> DataFrame:
    """:func:`with_tokens` of the vocabulary that ``column`` itself shows. The
    distinct cells are found and read once: discovery, tokens and validation
    share them."""
    _check_output(column, output)
    cells = distinct_cells(df, column)
    return _joined(df, column, tokens_of(cells, discover_vocabulary(cells, "cell", marker, sort=False)), output, True)


def discover_and_validate(df: DataFrame, column: str, marker: str = DEFAULT_MARKER) -> DataFrame:
    """Vocabulary table ``(option, length)`` of ``column``, validated against
    every distinct cell. The distinct cells are materialised once (one pass over
    ``df``); discovery and validation then each read that table."""
    cells = materialize(df.select(F.col(column)).where(F.col(column).isNotNull()).distinct(), "cells")
    vocabulary = materialize(discover_vocabulary(cells, column, marker, sort=False), "vocabulary")
    validate_vocabulary(cells, column, vocabulary)
    return vocabulary


def explode_by_vocabulary(df: DataFrame, column: str, vocabulary: DataFrame | Sequence[str],
                          output: str = "opcao", validate: bool = True) -> DataFrame:
    """One row per vocabulary option of each cell (greedy, longest first).

    With ``validate`` (default) every distinct cell is first checked and an
    out-of-vocabulary cell raises; without, such cells give no rows. NULL cells
    give no rows; an empty vocabulary gives an empty result.
    """
    _check_output(column, output)
    return (with_tokens(df, column, vocabulary, "__tokens", validate)
            .withColumn(output, F.explode("__tokens")).drop("__tokens", column))


def explode_discovered(df: DataFrame, column: str, output: str = "opcao", marker: str = DEFAULT_MARKER) -> DataFrame:
    """:func:`explode_by_vocabulary` of the vocabulary that ``column`` itself shows."""
    _check_output(column, output)
    return (with_discovered_tokens(df, column, "__tokens", marker)
            .withColumn(output, F.explode("__tokens")).drop("__tokens", column))
