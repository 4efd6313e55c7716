"""Command line for the survey pipeline.

    python -m lakemart bronze --raw 2023=raw/2023.csv --raw 2024=raw/2024.csv --lake lake
    python -m lakemart silver --dictionary dictionary/fields.csv --editions 2023 2024 --lake lake
    python -m lakemart gold   --lake lake
    python -m lakemart all    --raw ... --dictionary ... --lake lake

Layers go to ``<lake>/bronze``, ``<lake>/silver/pesquisa_unificada``,
``<lake>/gold/<mart>`` and the name maps to ``<lake>/dictionary``. Each step
prints its report. Dictionary columns are ``coluna_<edition>``.
"""

from __future__ import annotations

import argparse
import sys

from lakemart.plans.bronze import bronze_profile, run_bronze
from lakemart.plans.gold import gold_checks, run_gold
from lakemart.plans.silver import run_silver
from lakemart.plans.survey import SurveyRecipe
from lakemart.session import build_session


def _paths(lake: str) -> dict[str, str]:
    base = lake.rstrip("/")
    return {"bronze": f"{base}/bronze", "dictionary": f"{base}/dictionary",
            "silver": f"{base}/silver/pesquisa_unificada", "gold": f"{base}/gold"}


def _raw_files(items: list[str]) -> dict[int, str]:
    out = {}
    for item in items:
        edition, _, path = item.partition("=")
        if not path:
            raise SystemExit(f"--raw expects EDITION=PATH, got {item!r}")
        out[int(edition)] = path
    return out


def main(argv: list[str] | None = None, spark=None) -> int:
    parser = argparse.ArgumentParser(prog="python -m lakemart", description=__doc__,
                                     formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("step", choices=["bronze", "silver", "gold", "all"])
    parser.add_argument("--lake", required=True, help="root folder of the layers")
    parser.add_argument("--raw", action="append", default=[], help="EDITION=PATH (repeat)")
    parser.add_argument("--dictionary", help="field dictionary CSV")
    parser.add_argument("--editions", nargs="*", type=int, help="editions to unify")
    parser.add_argument("--legacy-integers", action="store_true",
                        help="truncate decimal text in integer answers ('3.7' -> 3)")
    parser.add_argument("--lenient", action="store_true",
                        help="go on without dictionary entries and questions that are missing")
    parser.add_argument("--master", help="Spark master (default: from the environment)")
    args = parser.parse_args(argv)

    spark = spark or build_session(args.master)
    paths = _paths(args.lake)
    recipe = SurveyRecipe(legacy_integers=args.legacy_integers)
    raw = _raw_files(args.raw)
    editions = args.editions or sorted(raw)

    if args.step in ("bronze", "all"):
        if not raw:
            parser.error("bronze needs --raw EDITION=PATH")
        run_bronze(spark, raw, paths["bronze"], paths["dictionary"]).show(truncate=False)
        bronze_profile(spark, paths["bronze"], sorted(raw)).show(truncate=False)
    if args.step in ("silver", "all"):
        if not args.dictionary or not editions:
            parser.error("silver needs --dictionary and --editions (or --raw)")
        reports = run_silver(spark, paths["bronze"], args.dictionary,
                             {e: f"coluna_{e}" for e in editions}, paths["silver"], recipe,
                             strict=not args.lenient)
        for name, report in reports.items():
            print(f"-- {name}")
            report.show(truncate=False)
    if args.step in ("gold", "all"):
        run_gold(spark, paths["silver"], paths["gold"], recipe, strict=not args.lenient).show(truncate=False)
        for name, report in gold_checks(spark, paths["gold"], recipe).items():
            print(f"-- {name}")
            report.show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
