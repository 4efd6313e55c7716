"""Greedy tokenising of multi-select cells whose options contain commas.

A cell is a ``", "``-joined sequence of options, with at most one separator
after the last. Tokenising it means: at the current position take the longest
vocabulary option that the rest starts with, skip one separator, repeat; a cell
that cannot be read to its end this way is invalid.

The vocabulary is a table and stays one, however large. Cells and options are
cut at every separator; a token always is a stretch of whole pieces. An option
can also be a prefix of the rest but end inside a piece. If it is longer than
every option that ends with a piece, the greedy rule takes it and fails.

1. First-piece index: each first piece of options, with the *shapes* of the
   options it begins: how many whole pieces, and how many characters of a further
   piece. Pieces of cells are joined with it; a piece that begins no option
   costs one row.
2. Cells carry running hashes of their pieces, so the hash of any stretch is a
   subtraction: a stretch of a shape is looked up by its number of pieces and its
   hash (and the further characters), never written out.
3. What the walk over a cell takes is compared with the vocabulary by its text.
   Should hashes have misled it, the cells are read again with other hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.text import OPTION_JOINER
from lakemart.session import materialize

#: Moduli of the two running hashes: primes below 2**31, so products fit 64 bits.
MODULI = (2147483647, 2147483629)
#: Their bases; attempt ``k`` uses those that are ``k`` larger.
BASES = (1000003, 998244353)


def pieces(cell: Column) -> Column:
    """The cell cut at separators, without one trailing separator."""
    joiner = F.lit(OPTION_JOINER)
    whole = F.when(F.endswith(cell, joiner), F.substring(
        cell, F.lit(1), F.length(cell) - len(OPTION_JOINER))).otherwise(cell)
    return F.split(whole, OPTION_JOINER)


def _piece_hashes(parts: Column, k: int, attempt: int) -> Column:
    return F.transform(parts, lambda p: F.pmod(F.xxhash64(p, F.lit(attempt * 2 + k)), F.lit(MODULI[k])))


def _running(hashes: Column, k: int, attempt: int) -> Column:
    """array<bigint>: the running hash before the first piece (0) and after each."""
    base = F.lit(BASES[k] + attempt)
    return F.aggregate(hashes, F.array(F.lit(0).cast("long")), lambda s, h: F.concat(
        s, F.array((F.element_at(s, -1) * base + h) % F.lit(MODULI[k]))))


def _power(parts: Column, k: int, attempt: int) -> Column:
    """base ** number of parts, modulo."""
    base = F.lit(BASES[k] + attempt)
    return F.aggregate(parts, F.lit(1).cast("long"), lambda s, _: s * base % F.lit(MODULI[k]))


def _hash(before: Column, after: Column, power: Column, k: int) -> Column:
    return F.pmod(after - before * power, F.lit(MODULI[k]))


def _keys(options: DataFrame, attempt: int) -> DataFrame:
    """(option, first, len, x, y, p0, p1, more, rest): each option by its whole
    pieces, and options of several pieces once more by all but the last, the rest."""
    run = options.select("option", "parts", "m", *[
        _running(_piece_hashes(F.col("parts"), k, attempt), k, attempt).alias(f"run{k}") for k in (0, 1)])
    def key(n: Column, rest: Column) -> Column:
        return F.struct(n.alias("len"), *[F.get(f"run{k}", n).alias("xy"[k]) for k in (0, 1)],
                        *[_power(F.slice("parts", F.lit(1), n), k, attempt).alias(f"p{k}") for k in (0, 1)],
                        rest.isNotNull().alias("more"), F.coalesce(rest, F.lit("")).alias("rest"))

    return run.select("option", F.get("parts", F.lit(0)).alias("first"), F.inline(F.array(
        key(F.col("m"), F.lit(None).cast("string")), key(F.col("m") - 1, F.element_at("parts", -1))))).where("len > 0")


def _walk(steps: Column) -> Column:
    """The walk over a cell's steps (start, step, inside), in order of start:
    struct(next, over, spans, inside). A step says how many pieces the token
    takes; a step of 0 is an option that ends inside a piece, which ends the walk
    (``inside``), as does a piece at which no step starts."""
    begin = F.struct(F.lit(1).alias("next"), F.lit(False).alias("over"),
                     F.array().cast("array<struct<start:int,len:int>>").alias("spans"),
                     F.lit(None).cast("string").alias("inside"))

    def step(s: Column, x: Column) -> Column:
        taken = F.struct(
            (x["start"] + x["step"]).alias("next"), F.lit(False).alias("over"),
            F.concat(s["spans"], F.array(F.struct(x["start"].alias("start"), x["step"].alias("len")))).alias("spans"),
            F.lit(None).cast("string").alias("inside"))
        ended = F.struct(s["next"].alias("next"), F.lit(True).alias("over"), s["spans"].alias("spans"),
                         F.when(x["start"] == s["next"], x["inside"]).alias("inside"))
        return F.when(s["over"] | (x["start"] < s["next"]), s).when(
            (x["start"] == s["next"]) & (x["step"] > 0), taken).otherwise(ended)

    return F.aggregate(steps, begin, step)


def _read(full: DataFrame, keys: DataFrame, attempt: int) -> DataFrame:
    """(cell, taken, whole, inside, rest) of cells with pieces: the tokens as far
    as the walk got, whether it got to the end, and the option that stopped it
    inside a piece with what it should begin."""
    full = full.repartition("id").withColumns({
        f"run{k}": _running(_piece_hashes(F.col("parts"), k, attempt), k, attempt) for k in (0, 1)})
    shapes = keys.groupBy("first").agg(
        F.collect_set(F.struct("len", "p0", "p1", "more", F.length("rest").alias("over"))).alias("shapes"))
    # small rows: a cell's text and arrays stay where they are
    starts = (full.select("id", F.posexplode("parts").alias("start", "first"))
              .join(shapes, "first").groupBy("id").agg(F.collect_list(F.struct("start", "shapes")).alias("starts")))
    end = F.col("start") + F.col("len")
    asked = (full.join(starts, "id").select("id", "n", "parts", "run0", "run1", F.explode("starts").alias("s"))
             .select("id", "n", "parts", "run0", "run1", "s.start", F.inline("s.shapes"))
             .where(end + F.col("more").cast("int") <= F.col("n"))
             .select("id", "start", "len", "more", *[
                 _hash(F.get(f"run{k}", F.col("start")), F.get(f"run{k}", end), F.col(f"p{k}"), k).alias("xy"[k])
                 for k in (0, 1)],
                 F.when(F.col("more"), F.left(F.get("parts", end), F.col("over"))).otherwise("").alias("rest")))
    # by cell once, for both groupings (and the join) below
    found = (asked.join(keys.drop("first", "p0", "p1"), ["len", "x", "y", "more", "rest"])
             .select("id", "start", "len", "more", "option").repartition("id"))
    whole, inside = F.max(F.when(~F.col("more"), F.col("len"))), F.max(F.when(
        F.col("more"), F.struct((F.col("len") + 1).alias("len"), "option")))
    stopped = F.coalesce(F.col("inside.len"), F.lit(0)) > F.col("whole")
    steps = (found.groupBy("id", "start").agg(F.coalesce(whole, F.lit(0)).alias("whole"), inside.alias("inside"))
             .groupBy("id").agg(F.array_sort(F.collect_list(F.struct(
                 (F.col("start") + 1).alias("start"), F.when(stopped, 0).otherwise(F.col("whole")).alias("step"),
                 F.when(stopped, F.col("inside.option")).alias("inside")))).alias("steps")))
    walked = full.join(steps, "id", "left").withColumn("walk", _walk(F.coalesce(
        "steps", F.array().cast("array<struct<start:int,step:int,inside:string>>"))))
    text = lambda start, n: F.array_join(F.slice("parts", start, n), OPTION_JOINER)
    return walked.select(
        "cell", F.transform("walk.spans", lambda s: text(s["start"], s["len"])).alias("taken"),
        (F.col("walk.next") == F.col("n") + 1).alias("whole"), F.col("walk.inside").alias("inside"),
        F.when(F.col("walk.inside").isNotNull(), text(F.col("walk.next"), F.col("n"))).alias("rest"))


def _misled(read: DataFrame, options: DataFrame) -> bool:
    """Whether a walk took, or was stopped by, what is no option."""
    stopped = read.where(F.col("inside").isNotNull() & ~F.startswith("rest", F.col("inside"))).select("inside")
    taken = read.select(F.explode(F.array_distinct("taken")).alias("option")).distinct()
    return not stopped.unionAll(taken.join(options, "option", "left_anti")).isEmpty()


def distinct_cells(df: DataFrame, column: str) -> DataFrame:
    """The distinct non-NULL cells of ``column`` as a table (id, cell, parts, n):
    numbered once, the number stands for the cell in all joins."""
    return materialize(
        df.select(F.col(f"`{column}`").alias("cell")).where("cell is not null").distinct()
        .withColumn("parts", F.when(F.col("cell") == "", F.array().cast("array<string>"))
                    .otherwise(pieces(F.col("cell"))))
        .withColumn("n", F.size("parts")).withColumn("id", F.monotonically_increasing_id()), "cells")


def tokens_of(cells: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(cell, tokens)`` for each of :func:`distinct_cells`: its options in
    order, NULL when the cell is invalid. ``vocabulary`` has a column ``option``.
    The empty cell holds no option and is valid. The tokens are a table in the
    scratch folder when this returns."""
    options = (vocabulary.select("option").where("option is not null and option <> ''").distinct()
               .withColumn("parts", F.split("option", OPTION_JOINER)).withColumn("m", F.size("parts")))
    empty = cells.where("n = 0").select("cell", F.array().cast("array<string>").alias("tokens"))
    attempt = 0
    while True:
        keys = materialize(_keys(options, attempt), "options")
        read = materialize(_read(cells.where("n > 0"), keys, attempt), "tokens")
        if not _misled(read, keys.select("option")):
            return empty.unionByName(read.select("cell", F.when(F.col("whole"), F.col("taken")).alias("tokens")))
        attempt += 1


def cell_tokens(df: DataFrame, column: str, vocabulary: DataFrame) -> DataFrame:
    """:func:`tokens_of` the distinct cells of ``column``."""
    return tokens_of(distinct_cells(df, column), vocabulary)
