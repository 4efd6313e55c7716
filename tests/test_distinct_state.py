"""Bitmaps of numbered tokens against count(DISTINCT)."""

import random

import pytest
from pyspark.sql import functions as F

from lakemart.operators.distinct_state import (BITS, RUN, DistinctStore, distinct_state, merge_states,
                                               number_tokens, roll_up, state_counts, state_shares)
from lakemart.operators.marts import distinct_mart, share_mart

KEYS = ["edition", "dimension", "value"]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def answers(spark, seed, editions, tokens):
    rng = random.Random(seed)
    rows = [(rng.choice(editions), rng.choice("ab"), rng.choice(["x", "y", "", None]), rng.choice(tokens))
            for _ in range(600)]
    return spark.createDataFrame(rows, "edition int, dimension string, value string, token string")


def test_counts_of_all_key_subsets_over_batches(spark, tmp_dir):
    first = answers(spark, 1, [2023, None], [*map(str, range(80)), None])
    second = answers(spark, 2, [2024, 2025], [*map(str, range(40, 140)), ""])
    only_null = spark.createDataFrame([(2026, "a", "z", None)] * 2, first.schema)
    store = DistinctStore(spark, f"{tmp_dir}/state")
    for name, batch in (("1", first), ("2", second), ("3", only_null), ("4", first.where("false"))):
        store.add(name, batch, KEYS, "token")
    whole = first.unionByName(second).unionByName(only_null)
    state = store.state()
    for keys in (KEYS, ["edition", "value"], ["dimension"], ["value", "edition"]):
        assert rows_of(state_counts(state, keys)) == rows_of(distinct_mart(whole, keys, "token")), keys
    assert rows_of(state_counts(merge_states([state, state]), KEYS)) == rows_of(distinct_mart(whole, KEYS, "token"))
    numbers = [r[0] for r in spark.read.parquet(f"{tmp_dir}/state/numbers").select("__number").collect()]
    assert sorted(numbers) == list(range(1, len(numbers) + 1))


def test_a_batch_given_again_replaces_its_state(spark, tmp_dir):
    store = DistinctStore(spark, f"{tmp_dir}/state")
    first, other = answers(spark, 3, [1], list("abcdef")), answers(spark, 4, [1, 2], list("defxyz"))
    store.add("1", first, KEYS, "token")
    store.add("2", other, KEYS, "token")
    store.add("1", first.where("token <> 'a'"), KEYS, "token")
    whole = first.where("token <> 'a'").unionByName(other)
    assert rows_of(state_counts(store.state(), KEYS)) == rows_of(distinct_mart(whole, KEYS, "token"))
    assert rows_of(state_counts(store.state(), ["edition"])) == rows_of(distinct_mart(whole, ["edition"], "token"))


def test_shares_equal_share_mart(spark, tmp_dir):
    chosen = answers(spark, 5, [2023, 2024], list(map(str, range(50))))
    base = chosen.select("edition", "token").unionByName(
        spark.createDataFrame([(2024, "silent"), (2025, "silent")], "edition int, token string"))
    numbers = number_tokens(base, "token").cache()
    everyone = distinct_state(base, ["edition"], "token", numbers)
    state = distinct_state(chosen, KEYS, "token", numbers)
    assert rows_of(state_shares(state, everyone, "edition", ["dimension", "value"])) == \
        rows_of(share_mart(chosen, base, "edition", ["dimension", "value"], "token"))


def test_a_hot_key_over_several_runs(spark):
    rows = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"),
        (F.col("id") % 70_000).alias("token"))
    state = distinct_state(rows, ["k"], "token", number_tokens(rows, "token"))
    assert rows_of(state_counts(state, ["k"])) == rows_of(distinct_mart(rows, ["k"], "token"))
    whole = roll_up(state, []).agg(F.sum(F.bitmap_count(BITS))).first()[0]
    assert whole == 70_000 and state.select(RUN).distinct().count() == 3


def test_no_batch(spark, tmp_dir):
    with pytest.raises(ValueError):
        DistinctStore(spark, f"{tmp_dir}/none").state()
