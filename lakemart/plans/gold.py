"""Gold job: the eight marts of the survey, from one silver table.

Each mart reads only the columns it needs from the silver Parquet (column
pruning at the scan), so no cache of the 83-column table is needed. The two
long-format marts read silver once each thanks to ``long_format``.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.distinct_state import DistinctStore, state_counts, state_shares
from lakemart.operators.lineage import EDITION_COL
from lakemart.operators.marts import (Dimension, base_projection, count_mart, count_marts,
                                      distinct_mart, long_format, share_mart,
                                      split_count_marts)
from lakemart.operators.multiselect import with_discovered_tokens
from lakemart.operators.quality import duplicate_key_count, invalid_rows
from lakemart.plans.survey import MART_NAMES as MART_ORDER
from lakemart.plans.survey import SurveyRecipe
from lakemart.session import materialize
from lakemart.sinks.catalog import register_marts
from lakemart.sinks.publish import publish


class MissingQuestion(ValueError):
    """A question of the recipe is not a column of the silver table."""


def missing_questions(silver: DataFrame, recipe: SurveyRecipe) -> list[str]:
    """Columns that the long-format marts ask for and silver does not have."""
    asked = [c for c, _ in recipe.technology_fields] + [c for _, c in recipe.ai_dimensions] \
        + [c for _, c, _ in recipe.maturity_dimensions]
    return [c for c in dict.fromkeys(asked) if c not in silver.columns]


def technology_mart(silver: DataFrame, recipe: SurveyRecipe) -> DataFrame:
    dims = [Dimension(category, column, multiselect=True)
            for column, category in recipe.technology_fields if column in silver.columns]
    long = long_format(silver, [EDITION_COL, recipe.token], dims,
                       dimension_col="categoria", value_col="tecnologia", distinct=True)
    return share_mart(long, silver, EDITION_COL, ["categoria", "tecnologia"], recipe.token,
                      recipe.measure, recipe.share)


def ai_mart(silver: DataFrame, recipe: SurveyRecipe) -> DataFrame:
    field, options = recipe.ai_vocabulary_field, "__ai_options"
    df = silver
    if field in silver.columns:
        df = with_discovered_tokens(silver, field, options)
    dims = [Dimension(name, options, tokens=True) if column == field else Dimension(name, column)
            for name, column in recipe.ai_dimensions if column in silver.columns]
    long = long_format(df, [EDITION_COL, recipe.token, *recipe.ai_keys], dims)
    return distinct_mart(long, [EDITION_COL, "dimensao", *recipe.ai_keys, "valor"],
                         recipe.token, recipe.measure, leading=2)


def maturity_mart(silver: DataFrame, recipe: SurveyRecipe) -> DataFrame:
    dims = [Dimension(name, column, multiselect=multi)
            for name, column, multi in recipe.maturity_dimensions if column in silver.columns]
    long = long_format(silver, [EDITION_COL, recipe.token, *recipe.maturity_keys], dims, distinct=True)
    return distinct_mart(long, [EDITION_COL, "dimensao", *recipe.maturity_keys, "valor"],
                         recipe.token, recipe.measure, leading=2)


#: Tags of the marts in the state of distinct respondents; "everyone" counts all.
TECHNOLOGY, AI, MATURITY, EVERYONE = "technology", "ai", "maturity", "everyone"


def _state_rows(silver: DataFrame, r: SurveyRecipe) -> tuple[DataFrame, list[str]]:
    """One long table of the three distinct-respondent marts, from one scan of
    silver, and its keys. A mart's rows carry that mart's keys only, others are
    NULL, so that the state is no finer than its marts."""
    field, options = r.ai_vocabulary_field, "__ai_options"
    df = silver.withColumn("__everyone", F.lit(""))
    if field in silver.columns:
        df = with_discovered_tokens(df, field, options)
    dims = [Dimension(f"{TECHNOLOGY}/{category}", column, multiselect=True)
            for column, category in r.technology_fields if column in silver.columns]
    dims += [Dimension(f"{AI}/{name}", options, tokens=True) if column == field
             else Dimension(f"{AI}/{name}", column) for name, column in r.ai_dimensions if column in silver.columns]
    dims += [Dimension(f"{MATURITY}/{name}", column, multiselect=multi)
             for name, column, multi in r.maturity_dimensions if column in silver.columns]
    dims.append(Dimension(f"{EVERYONE}/", "__everyone"))
    carried = list(dict.fromkeys([*r.ai_keys, *r.maturity_keys]))
    long = long_format(df, [EDITION_COL, r.token, *carried], dims, distinct=True)
    tag = F.split("dimensao", "/", 2)
    long = long.withColumns({"mart": tag[0], "dimensao": tag[1]})
    own = {k: [m for m, keys in ((AI, r.ai_keys), (MATURITY, r.maturity_keys)) if k in keys] for k in carried}
    long = long.withColumns({k: F.when(F.col("mart").isin(marts), F.col(k)) for k, marts in own.items()})
    return long, ["mart", EDITION_COL, "dimensao", *carried, "valor"]


def add_to_state(spark: SparkSession, silver: DataFrame, state_dir: str, batch: str,
                 recipe: SurveyRecipe | None = None) -> DistinctStore:
    """Add the respondents of ``silver`` (an edition, a delivery) to the state of
    distinct respondents in ``state_dir``; a batch given again is replaced. The
    comma-bearing options are those that the batch's own cells show."""
    r = recipe or SurveyRecipe()
    rows, keys = _state_rows(silver, r)
    store = DistinctStore(spark, state_dir)
    store.add(batch, rows, keys, r.token)
    return store


def state_marts(store: DistinctStore, recipe: SurveyRecipe | None = None) -> dict[str, DataFrame]:
    """The marts of distinct respondents over all batches of a state, equal to
    those that :func:`build_marts` counts from the silver rows."""
    r, state = recipe or SurveyRecipe(), store.state()

    def of(mart: str) -> DataFrame:
        return state.where(F.col("mart") == mart)

    technology = of(TECHNOLOGY).withColumnsRenamed({"dimensao": "categoria", "valor": "tecnologia"})
    return {
        "gold_adocao_tecnologias": state_shares(technology, of(EVERYONE), EDITION_COL, ["categoria", "tecnologia"],
                                                r.measure, r.share),
        "gold_adocao_ia": state_counts(of(AI), [EDITION_COL, "dimensao", *r.ai_keys, "valor"], r.measure, leading=2),
        "gold_maturidade_e_desafios": state_counts(
            of(MATURITY), [EDITION_COL, "dimensao", *r.maturity_keys, "valor"], r.measure, leading=2),
    }


def build_marts(silver: DataFrame, recipe: SurveyRecipe | None = None,
                one_pass_counts: bool = False, strict: bool = True) -> dict[str, DataFrame]:
    """The eight marts. A question of the recipe that silver does not have raises
    :class:`MissingQuestion`, or with ``strict=False`` is left out. With ``one_pass_counts`` the four ``count(*)`` marts come
    from one GROUPING SETS aggregation over silver, materialised once (a
    checkpoint) and split, instead of four scans."""
    r = recipe or SurveyRecipe()
    missing = missing_questions(silver, r)
    if strict and missing:
        raise MissingQuestion(f"questions not in the silver table: {missing}")
    count_keys = {
        "gold_panorama_mercado": r.panorama_keys,
        "gold_perfis_profissionais": r.profile_keys,
        "gold_diversidade": r.diversity_keys,
        "gold_perfil_regional": r.regional_keys,
    }
    if one_pass_counts:
        combined = materialize(count_marts(silver, count_keys, r.measure), "count-marts")
        counts = split_count_marts(combined, count_keys, r.measure)
    else:
        counts = {name: count_mart(silver, keys, r.measure) for name, keys in count_keys.items()}
    return {
        "gold_respondentes": base_projection(silver, r.respondent_columns),
        "gold_panorama_mercado": counts["gold_panorama_mercado"],
        "gold_perfis_profissionais": counts["gold_perfis_profissionais"],
        "gold_diversidade": counts["gold_diversidade"],
        "gold_adocao_tecnologias": technology_mart(silver, r),
        "gold_adocao_ia": ai_mart(silver, r),
        "gold_perfil_regional": counts["gold_perfil_regional"],
        "gold_maturidade_e_desafios": maturity_mart(silver, r),
    }


ROW_LEVEL = {"gold_respondentes"}
#: Marts whose keys hold free text grow with the data; like row-level tables
#: they are never funnelled through one task.
OPEN_KEYS = {"gold_adocao_tecnologias", "gold_adocao_ia", "gold_maturidade_e_desafios"}


def run_gold(spark: SparkSession, silver_path: str, gold_dir: str,
             recipe: SurveyRecipe | None = None, single_file: bool = False,
             strict: bool = True) -> DataFrame:
    """Write every mart in its order, register them as views and return
    ``(mart, rows_written, rows_read, columns, status)``; the status compares
    rows and columns. ``single_file`` writes the marts of closed keys as one
    file each. Marts are range-sorted, so their files in name order are in mart
    order."""
    silver = spark.read.parquet(silver_path)
    marts = build_marts(silver, recipe, one_pass_counts=True, strict=strict)
    paths = {name: f"{gold_dir.rstrip('/')}/{name}" for name in marts}

    def one(item):
        name, mart = item
        obs = Observation(name)
        out = mart.observe(obs, F.count(F.lit(1)).alias("rows"))
        if single_file and name not in ROW_LEVEL | OPEN_KEYS:
            out = out.coalesce(1)
        out.write.mode("overwrite").parquet(paths[name])
        back = spark.read.parquet(paths[name])
        written, read = obs.get["rows"], back.count()
        return (name, written, read, len(back.columns),
                "OK" if (written, mart.columns) == (read, back.columns) else "DIVERGENTE")

    # the marts are independent jobs: submit them together to share the executors
    with ThreadPoolExecutor(max_workers=max(1, min(8, len(marts)))) as pool:
        report = list(pool.map(one, marts.items()))
    register_marts(spark, paths)
    return spark.createDataFrame(
        report, "mart string, rows_written long, rows_read long, columns int, status string")


def gold_checks(spark: SparkSession, gold_dir: str, recipe: SurveyRecipe | None = None
                ) -> dict[str, DataFrame]:
    """Checks on the written marts: repeated ``(edition, token)`` in the
    respondent table, and aggregated rows with a non-positive count."""
    r = recipe or SurveyRecipe()
    base = gold_dir.rstrip("/")
    respondents = spark.read.parquet(f"{base}/gold_respondentes")
    aggregated = {n: spark.read.parquet(f"{base}/{n}") for n in MART_ORDER if n not in ROW_LEVEL}
    return {
        "duplicate_tokens": duplicate_key_count(respondents, [EDITION_COL, r.token]),
        "invalid_rows": invalid_rows(aggregated, r.measure),
    }


def publish_gold(spark: SparkSession, silver_path: str, root: str, recipe: SurveyRecipe | None = None,
                 strict: bool = True) -> int:
    """The eight marts as the next version of the published folder ``root``
    (:func:`lakemart.sinks.publish.publish`): all of them or, where one has a
    measure that is not positive or was not read back as written, none."""
    r = recipe or SurveyRecipe()
    marts = build_marts(spark.read.parquet(silver_path), r, one_pass_counts=True, strict=strict)
    checks = {name: lambda df: df.where(F.col(r.measure) <= 0).isEmpty()
              for name, df in marts.items() if r.measure in df.columns}
    return publish(spark, marts, root, checks)
