"""Mixing sources to target weights.

Words per source are added up, each source gets a target by water-filling, and
its repetition rate is target / size. A document is taken floor(rate) times and
once more when a hash of its id, read as a number in [0, 1), is below the
rate's fraction: a Bernoulli draw that every rerun repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakemart.llm.common import staged, text_or_empty

#: A run of characters other than space and U+0009..U+000D is a word.
WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code-point order, repeating (null source last).
WEIGHTS = (5.0, 2.0, 1.0)
#: No source is repeated more often than this.
MOST = 3


def word_count(text_col: str) -> Column:
    return F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS,
                   most: int = MOST) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``: shares of the whole by
    weight, no target above ``most`` times its source's size, the excess shared
    again by weight until none is above.

    That is target = min(most * size, level * weight) for the one level at
    which the targets add up to the whole. In order of most * size / weight,
    the sources below the level come first. What the others would get if just
    the first m stopped at their limits grows with m up to the right m and falls
    after it, so the level is the largest of these figures from running sums.
    One row per source goes through these windows, never a document.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(by_name) - 1) % len(weights)
    limit = F.col("source_size") * F.lit(most)
    ranked = sizes.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (nth + 1).cast("int"))) \
        .withColumn("most", limit.cast("double"))
    order = W.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = W.partitionBy()
    levels = ranked.withColumn("level", (
        F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        / F.sum("weight").over(after))
    level = F.max("level").over(whole)
    return levels.select("source", "source_size", "weight",
                         F.least("most", level * F.col("weight")).alias("target"))


def draw(id_col: str | Column) -> Column:
    """A number in [0, 1) from a hash of the id (the same in every run and on
    any cluster); a null id draws as the empty string."""
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def mixed(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", weights: tuple[float, ...] = WEIGHTS,
          most: int = MOST) -> DataFrame:
    """Rows of ``df`` as a struct column ``row``, with ``size``, ``source_size``,
    ``target`` and ``copies``: how often the mix takes the document.

    Null texts have size 0, null sources are one source (last in order), null
    ids draw like each other; repeated rows draw alike. A source without words
    has rate 0. Columns of ``df`` keep their names and cannot clash, since they
    stay inside ``row``. An empty table gives an empty result.

    Sources are few against documents: their table (one row each) is written
    first, so that Spark knows its size before it plans the join and broadcasts
    it where its own limit allows, without a shuffle of texts. A source holding
    most documents adds up in each task first.
    """
    sized = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"),
                      df[source_col].cast("string").alias("source"),
                      word_count(text_col).alias("size"), draw(id_col).alias("draw"))
    sizes = df.select(df[source_col].cast("string").alias("source"), word_count(text_col).alias("size")) \
        .groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = staged(source_targets(sizes, weights, most), "targets")
    rate = F.when(F.col("source_size") > 0,
                  F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    return (sized.join(targets.withColumnRenamed("source", "name"),
                       F.col("source").eqNullSafe(F.col("name")))
            .withColumn("rate", rate)
            .withColumn("copies", (F.floor("rate") + F.when(
                F.col("draw") < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("int"))
            .select("row", "size", "source_size", "target", "copies"))


def mix(df: DataFrame, **options) -> DataFrame:
    """The mixed documents themselves, each as often as the mix takes it, with
    the columns of ``df``."""
    return (mixed(df, **options).filter("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select("row.*"))
