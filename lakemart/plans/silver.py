"""Silver job: unify the bronze editions through the field dictionary.

select-and-rename per edition -> UNION BY NAME (missing fields NULL) ->
typed columns -> boolean and value recodes. The result is written by all
tasks in parallel (no single-file funnel); checks are returned as reports.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from lakemart.operators.lineage import EDITION_COL, LINEAGE_COLS
from pyspark.sql import functions as F

from lakemart.operators.quality import duplicate_key_count, null_profile, rows_per_group, top_k
from lakemart.operators.standardize import (recode_boolean, recode_values, typed_columns,
                                            unmapped_report)
from lakemart.operators.unify import (DictionaryError, check_dictionary, mapping_for, select_by_dictionary,
                                      union_editions)
from lakemart.plans.bronze import PARTITION
from lakemart.plans.survey import SurveyRecipe
from lakemart.sources.dictionary import read_dictionary
from lakemart.sources.parquet import read_leaf


def build_silver(bronze: Mapping[int, DataFrame], dictionary: DataFrame,
                 edition_columns: Mapping[int, str], recipe: SurveyRecipe | None = None,
                 strict: bool = True) -> DataFrame:
    recipe = recipe or SurveyRecipe()
    frames = [select_by_dictionary(bronze[ed], mapping_for(dictionary, dict_col),
                                   keep=LINEAGE_COLS, strict=strict)
              for ed, dict_col in edition_columns.items()]
    silver = union_editions(frames)
    cols = set(silver.columns)
    silver = typed_columns(
        silver,
        timestamps={c: f for c, f in recipe.timestamp_fields.items() if c in cols},
        integers=[c for c in recipe.integer_fields if c in cols],
        legacy_integers=recipe.legacy_integers)
    silver = recode_boolean(silver, [c for c in recipe.boolean_fields if c in cols],
                            recipe.boolean_map)
    return recode_values(silver, {c: m for c, m in recipe.value_recodes.items() if c in cols})


def run_silver(spark: SparkSession, bronze_dir: str, dictionary_path: str,
               edition_columns: Mapping[int, str], silver_path: str,
               recipe: SurveyRecipe | None = None, strict: bool = True
               ) -> dict[str, DataFrame]:
    """Write silver; return the reports ``missing_columns``, ``rows_per_edition``
    and ``duplicate_tokens`` (computed from the written table). With ``strict`` a
    dictionary entry without its column raises, naming every such entry;
    otherwise the field is NULL there and the entry is in ``missing_columns``."""
    recipe = recipe or SurveyRecipe()
    bronze = {ed: read_leaf(spark, bronze_dir, PARTITION, ed) for ed in edition_columns}
    dictionary = read_dictionary(spark, dictionary_path)
    missing = check_dictionary(spark, dictionary, bronze, edition_columns)
    if strict and (absent := missing.collect()):        # dictionary metadata: one row per field
        raise DictionaryError("dictionary entries without a column: " + "; ".join(
            f"{r['edition']}: {r['field']} <- {r['column']}" for r in absent))
    unified = union_editions([select_by_dictionary(bronze[ed], mapping_for(dictionary, col),
                                                   keep=LINEAGE_COLS, strict=strict)
                              for ed, col in edition_columns.items()])
    silver = build_silver(bronze, dictionary, edition_columns, recipe, strict)
    silver.write.mode("overwrite").parquet(silver_path)
    written = spark.read.parquet(silver_path)
    return {
        "missing_columns": missing,
        "rows_per_edition": rows_per_group(written, EDITION_COL),
        "duplicate_tokens": duplicate_key_count(written, [EDITION_COL, recipe.token]),
        "top_null_fields": top_k(null_profile(written), 15,
                                 [F.col("pct_nulls").desc(), F.col("position").asc()]),
        # answers the boolean recode turns into NULL (other spellings)
        "unmapped_booleans": unmapped_report(
            unified, [c for c in recipe.boolean_fields if c in unified.columns],
            recipe.boolean_map),
    }
