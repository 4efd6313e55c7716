"""A key holding a third of all rows: results stay exact and every shuffle
is preceded by a map-side partial aggregate."""

import io
import re
from collections import Counter, defaultdict
from contextlib import redirect_stdout

import pytest

from lakemart.operators.marts import count_mart, distinct_mart, share_mart
from lakemart.operators.multiselect import explode_options

N = 3000


@pytest.fixture(scope="module")
def skewed(spark):
    rows = []
    for i in range(N):
        hot = i % 3 == 0                      # a third of all rows in one group
        rows.append((2024 if hot else 2020 + i % 4, f"t{i % 700}", "hot" if hot else f"k{i % 50}",
                     "A, B" if hot else ("B, C" if i % 2 else "C")))
    return rows, spark.createDataFrame(rows, "ano int, token string, k string, cell string") \
        .repartition(12)


def _plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_count_and_distinct_marts_exact_under_skew(skewed):
    rows, df = skewed
    got = {(r.ano, r.k): r.n for r in count_mart(df, ["ano", "k"], "n", sort=False).collect()}
    assert got == dict(Counter((a, k) for a, _, k, _ in rows))
    tokens = defaultdict(set)
    for a, t, k, _ in rows:
        tokens[(a, k)].add(t)
    got = {(r.ano, r.k): r.n for r in distinct_mart(df, ["ano", "k"], "token", "n",
                                                     sort=False).collect()}
    assert got == {key: len(v) for key, v in tokens.items()}


def test_share_mart_exact_under_skew(skewed):
    rows, df = skewed
    exploded = explode_options(df.select("ano", "token", "cell"), "cell", "opt")
    mart = share_mart(exploded, df, "ano", ["opt"], "token", "n", "pct", sort=False)
    totals, per = defaultdict(set), defaultdict(set)
    for a, t, _, cell in rows:
        totals[a].add(t)
        for o in cell.split(", "):
            per[(a, o)].add(t)
    got = {(r.ano, r.opt): (r.n, r.pct) for r in mart.collect()}
    assert {k: v[0] for k, v in got.items()} == {k: len(v) for k, v in per.items()}
    for (a, o), (n, pct) in got.items():
        assert abs(pct - n / len(totals[a]) * 100) <= 0.05 + 1e-9


def test_aggregates_combine_map_side(skewed):
    _, df = skewed
    assert "partial_count" in _plan(count_mart(df, ["ano", "k"], "n", sort=False))
    plan = _plan(distinct_mart(df, ["ano", "k"], "token", "n", sort=False))
    assert "partial_count(distinct" in plan
    # the dedupe shuffle is keyed on the token too, so the hot key is spread
    keys = [set(re.sub(r"#\d+", "", k).split(", ")[:-1])
            for k in re.findall(r"hashpartitioning\(([^)]*)\)", plan)]
    assert {"ano", "k", "token"} in keys and {"ano", "k"} in keys


def test_session_has_skew_join_and_aqe(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_no_query_changes_the_session(spark):
    """Partition counts come from the session; queries run in any order."""
    from lakemart.plans.testdata import QUERIES
    before = dict(spark.conf.getAll)
    for name in ("order_adoption_long", "bronze_round_trip", "technology_adoption"):
        QUERIES[name](spark, "/root/testdata/sf0.001").count()
    assert dict(spark.conf.getAll) == before
