"""End to end: three hand-made survey editions -> bronze -> silver -> gold,
checked against a plain-Python brute force over the same records."""

import csv
import os
import random
from collections import defaultdict

import pytest

from lakemart.operators.names import sanitize_name
from lakemart.plans.bronze import bronze_profile, run_bronze
from lakemart.plans.gold import add_to_state, gold_checks, run_gold, state_marts
from lakemart.plans.silver import run_silver
from lakemart.plans.survey import BOOLEAN_MAP, SurveyRecipe

EDITIONS = (2023, 2024, 2025)

SIMPLE = {
    "faixa_idade": ["17-21", "22-24", "25-29"], "genero": ["Feminino", "Masculino", "Prefiro não informar"],
    "cor_raca_etnia": ["Branca", "Parda", "Preta"], "pcd": ["Sim", "Não"],
    "regiao_onde_mora": ["Sudeste", "Sul", "Nordeste", None], "uf_onde_mora": ["SP", "RJ", "PE"],
    "nivel_de_ensino": ["Graduação", "Mestrado"], "area_de_formacao": ["Computação", "Economia"],
    "situacao_de_trabalho": ["CLT", "PJ"], "setor": ["Finanças", "Varejo", "Tecnologia"],
    "numero_de_funcionarios": ["de 501 a 100", "de 501 a 1.000", "Acima de 3.000"],
    "cargo_atual": ["Analista de Dados",
                    "Engenheiro de Dados/Arquiteto de Dados/Data Engineer/Data Architect",
                    "Engenheiro de Dados/Data Engineer/Data Architect"],
    "nivel": ["Júnior", "Pleno", "Sênior", None],
    "faixa_salarial": ["de R$ 101/mês a R$ 2.000/mês", "de R$ 1.001/mês a R$ 2.000/mês",
                       "de R$ 8.001/mês a R$ 12.000/mês"],
    "tempo_de_experiencia_em_dados": ["de 1 a 2 anos", "de 4 a 6 anos", "de 5 a 6 anos"],
    "tempo_de_experiencia_em_ti": ["Menos de 1 ano", "Mais de 10 anos"],
    "modelo_de_trabalho_atual": ["Modelo 100% remoto", "Modelo híbrido", None],
    "modelo_de_trabalho_ideal": ["Modelo 100% remoto", "Modelo híbrido"],
    "planos_de_mudar_de_emprego_6m": ["Sim", "Não", ""],
    "participou_de_entrevistas_ultimos_6m": ["Sim", "Não"],
    "ai_generativa_e_llm_e_uma_prioridade": ["Sim", "Não sei", "Mais ou menos... É uma das "
        "várias iniciativas que estamos impulsionando, mas não é uma prioridade (iniciativas "
        "isoladas e pouco foco)."],
    "empresa_esta_conseguindo_ter_bons_resultados_com_llms": ["Sim", "Não", None],
}
BOOLEANS = ["atua_como_gestor", "possui_data_lake", "possui_data_warehouse",
            "satisfeito_atualmente", "vive_no_brasil", "vive_no_estado_de_formacao"]
MULTI = {
    "banco_de_dados_dia_a_dia": ["PostgreSQL", "SQL SERVER", "MySQL", "Oracle"],
    "cloud_dia_a_dia": ["AWS", "Azure", "GCP"],
    "linguagem_de_programacao_dia_a_dia": ["Python", "SQL", "R"],
    "ferramenta_de_bi_dia_a_dia": ["Power BI", "Tableau", "Looker"],
    "desafios_como_gestor": ["Contratar talentos", "Reter talentos", "Orçamento"],
    "motivos_para_nao_usar_ai_generativa_e_llm": ["Custo", "Segurança", "Falta de uso"],
}
AI_OPTIONS = ["Uso soluções pagas (exemplo: Github Copilot, ChatGPT Plus).",
              "Uso soluções gratuitas.", "Não uso, mas a empresa incentiva, às vezes."]
ABSENT = {2023: {"data_hora_envio", "empresa_esta_conseguindo_ter_bons_resultados_com_llms"},
          2024: set(), 2025: {"linguagem_de_programacao_dia_a_dia"}}
FIELDS = (["token", "idade", "data_hora_envio", "usa_chatgpt_ou_copilot_no_trabalho"]
          + list(SIMPLE) + BOOLEANS + list(MULTI))


def _raw_header(edition, i, field):
    human = field.replace("_", " ").replace("numero", "número").replace("regiao", "região")
    if edition == 2023:
        return f"('P{i}_x ', '{human.capitalize()}?')"
    return f"{i}.a_{human.replace(' ', '_')}?"


def _value(rng, field, edition, row):
    if field == "token":
        return f"t{edition}_{row % 17}"            # repeats inside an edition on purpose
    if field == "idade":
        return rng.choice(["25", "31", "x", "", "40"])
    if field == "data_hora_envio":
        return rng.choice(["31/12/2024 10:00:00", "01/02/2025 08:30:15", "2024-12-31"])
    if field == "usa_chatgpt_ou_copilot_no_trabalho":
        k = rng.randint(0, 3)
        return ", ".join(rng.sample(AI_OPTIONS, k)) if k else None
    if field in BOOLEANS:
        return rng.choice(["1", "0", "TRUE", "FALSE", "true", None])
    if field in MULTI:
        k = rng.randint(0, 3)
        return ", ".join(rng.sample(MULTI[field], k)) if k else rng.choice([None, ""])
    return rng.choice(SIMPLE[field])


@pytest.fixture(scope="module")
def survey(tmp_path_factory):
    base = tmp_path_factory.mktemp("survey")
    rng = random.Random(7)
    records, dictionary = [], defaultdict(dict)
    for edition in EDITIONS:
        fields = [f for f in FIELDS if f not in ABSENT[edition]]
        rng.shuffle(fields)                          # column order drifts too
        headers = [_raw_header(edition, i, f) for i, f in enumerate(fields)]
        rows = []
        for r in range(30 + edition % 7):
            rec = {f: _value(rng, f, edition, r) for f in fields}
            rec["_ano_pesquisa"] = edition
            records.append(rec)
            rows.append(["" if rec[f] is None else rec[f] for f in fields])
        rows[0][fields.index("faixa_idade")] = 'multi\nline "quoted"'
        records[-len(rows)]["faixa_idade"] = 'multi\nline "quoted"'
        with open(base / f"{edition}.csv", "w", newline="", encoding="utf-8") as fh:
            w = csv.writer(fh, quoting=csv.QUOTE_MINIMAL)
            w.writerow(headers)
            w.writerows(rows)
        for h, f in zip(headers, fields):
            dictionary[f][edition] = sanitize_name(h)
    with open(base / "mapa.csv", "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh)
        w.writerow(["campo_padronizado", "coluna_2023", "coluna_2024", "coluna_2025"])
        for f in FIELDS:
            w.writerow([f] + [dictionary[f].get(e, "") for e in EDITIONS])
    # empty CSV cells read as NULL, like a missing answer
    for rec in records:
        for k, v in rec.items():
            if v == "":
                rec[k] = None
    return base, records


@pytest.fixture(scope="module")
def gold(spark, survey):
    base, _ = survey
    raw = {e: str(base / f"{e}.csv") for e in EDITIONS}
    bronze_report = run_bronze(spark, raw, str(base / "bronze"), str(base / "dictionary"),
                               ingested_at="2025-01-01T00:00:00+00:00").collect()
    reports = run_silver(spark, str(base / "bronze"), str(base / "mapa.csv"),
                         {e: f"coluna_{e}" for e in EDITIONS}, str(base / "silver"))
    gold_report = run_gold(spark, str(base / "silver"), str(base / "gold")).collect()
    return bronze_report, reports, gold_report, base


def _std(rec):
    out = dict(rec)
    recipe = SurveyRecipe()
    for c in recipe.boolean_fields:
        if c in out:
            out[c] = BOOLEAN_MAP.get(out[c])
    for c, m in recipe.value_recodes.items():
        if c in out and out[c] in m:
            out[c] = m[out[c]]
    return out


def test_bronze_and_silver_reports(gold, survey):
    bronze_report, reports, gold_report, base = gold
    _, records = survey
    assert all(r.status == "OK" for r in bronze_report)
    assert sum(r.rows_written for r in bronze_report) == len(records)
    assert reports["missing_columns"].count() == 0
    per_year = {r._ano_pesquisa: r.n_rows for r in reports["rows_per_edition"].collect()}
    assert per_year == {e: sum(1 for r in records if r["_ano_pesquisa"] == e) for e in EDITIONS}
    assert reports["duplicate_tokens"].first()[0] > 0
    assert all(r.status == "OK" for r in gold_report) and len(gold_report) == 8
    assert os.path.isdir(base / "dictionary" / "bronze_column_mapping_2023")


def test_silver_types_and_recodes(spark, gold):
    *_, base = gold
    silver = spark.read.parquet(str(base / "silver"))
    types = dict(silver.dtypes)
    assert types["idade"] == "int" and types["data_hora_envio"] == "timestamp"
    assert silver.columns[:3] == ["_ano_pesquisa", "_arquivo_origem", "_data_ingestao"]
    assert {r[0] for r in silver.select("possui_data_lake").distinct().collect()} <= {"Sim", "Não", None}
    assert silver.where("numero_de_funcionarios = 'de 501 a 100'").count() == 0
    assert silver.where("_ano_pesquisa = 2023").where("data_hora_envio IS NOT NULL").count() == 0
    assert silver.where("faixa_idade LIKE 'multi%'").first().faixa_idade == 'multi\nline "quoted"'


def test_panorama_mart_matches_brute_force(spark, survey, gold):
    _, records = survey
    keys = ["_ano_pesquisa", "situacao_de_trabalho", "setor", "numero_de_funcionarios",
            "modelo_de_trabalho_atual"]
    expected = defaultdict(int)
    for rec in map(_std, records):
        expected[tuple(rec.get(k) for k in keys)] += 1
    got = spark.sql("SELECT * FROM gold_panorama_mercado").collect()
    assert {tuple(r[k] for k in keys): r.qtd_respondentes for r in got} == dict(expected)


def test_technology_mart_matches_brute_force(spark, survey, gold):
    _, records = survey
    totals = defaultdict(set)
    tokens = defaultdict(set)
    categories = {"banco_de_dados_dia_a_dia": "Banco de Dados", "cloud_dia_a_dia": "Cloud",
                  "linguagem_de_programacao_dia_a_dia": "Linguagem de Programação",
                  "ferramenta_de_bi_dia_a_dia": "Ferramenta de BI"}
    for rec in records:
        totals[rec["_ano_pesquisa"]].add(rec["token"])
        for field, cat in categories.items():
            for opt in (rec.get(field) or "").split(", "):
                if opt.strip():
                    tokens[(rec["_ano_pesquisa"], cat, opt.strip())].add(rec["token"])
    got = spark.sql("SELECT * FROM gold_adocao_tecnologias").collect()
    assert {(r._ano_pesquisa, r.categoria, r.tecnologia): r.qtd_respondentes for r in got} == \
        {k: len(v) for k, v in tokens.items()}
    for r in got:
        exact = r.qtd_respondentes / len(totals[r._ano_pesquisa]) * 100
        assert abs(r.pct_respondentes_ano - exact) <= 0.05 + 1e-9
    assert not [r for r in got if r._ano_pesquisa == 2025 and r.categoria.startswith("Linguagem")]


def test_ai_mart_uses_vocabulary(spark, survey, gold):
    _, records = survey
    expected = defaultdict(set)
    for rec in map(_std, records):
        y = rec["_ano_pesquisa"]
        for opt in AI_OPTIONS:
            cell = rec.get("usa_chatgpt_ou_copilot_no_trabalho") or ""
            if opt in cell:
                expected[(y, "uso_individual_ia", rec["cargo_atual"], rec["setor"], opt)].add(rec["token"])
        for dim, field in [("prioridade_empresa_ia", "ai_generativa_e_llm_e_uma_prioridade"),
                           ("resultado_llms_empresa",
                            "empresa_esta_conseguindo_ter_bons_resultados_com_llms")]:
            if rec.get(field) is not None:
                expected[(y, dim, rec["cargo_atual"], rec["setor"], rec[field])].add(rec["token"])
    got = spark.sql("SELECT * FROM gold_adocao_ia").collect()
    assert {(r._ano_pesquisa, r.dimensao, r.cargo_atual, r.setor, r.valor): r.qtd_respondentes
            for r in got} == {k: len(v) for k, v in expected.items()}


def test_maturity_mart_and_order(spark, survey, gold):
    _, records = survey
    dims = [("possui_data_lake", "possui_data_lake", False),
            ("possui_data_warehouse", "possui_data_warehouse", False),
            ("desafio_gestor", "desafios_como_gestor", True),
            ("motivo_nao_uso_ia", "motivos_para_nao_usar_ai_generativa_e_llm", True),
            ("risco_turnover", "planos_de_mudar_de_emprego_6m", False)]
    expected = defaultdict(set)
    for rec in map(_std, records):
        for name, field, multi in dims:
            v = rec.get(field)
            if v is None:
                continue
            values = [o.strip() for o in v.split(", ") if o.strip()] if multi else [v]
            for o in values:
                expected[(rec["_ano_pesquisa"], name, rec["setor"],
                          rec["numero_de_funcionarios"], o)].add(rec["token"])
    *_, base = gold
    got = spark.read.parquet(str(base / "gold" / "gold_maturidade_e_desafios")).collect()
    assert {(r._ano_pesquisa, r.dimensao, r.setor, r.numero_de_funcionarios, r.valor):
            r.qtd_respondentes for r in got} == {k: len(v) for k, v in expected.items()}
    order = [(r._ano_pesquisa, r.dimensao, -r.qtd_respondentes) for r in got]
    assert order == sorted(order)      # single ordered file per mart


def test_marts_from_a_state_added_to_by_edition(spark, gold):
    *_, base = gold
    silver = spark.read.parquet(str(base / "silver"))
    editions = [r[0] for r in silver.select("_ano_pesquisa").distinct().collect()]
    for edition in sorted(editions):
        store = add_to_state(spark, silver.where(f"_ano_pesquisa = {edition}"), str(base / "state"), str(edition))
    for name, mart in state_marts(store).items():
        whole = spark.read.parquet(str(base / "gold" / name))
        assert mart.columns == whole.columns
        assert sorted(map(tuple, mart.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr), name


def test_profiles_and_checks(spark, survey, gold):
    _, records = survey
    *_, base = gold
    prof = {r.edition: r for r in bronze_profile(spark, str(base / "bronze"), EDITIONS).collect()}
    assert sum(p.n_rows for p in prof.values()) == len(records)
    assert all(0 < p.pct_null_cells < 100 for p in prof.values())
    checks = gold_checks(spark, str(base / "gold"))
    assert checks["duplicate_tokens"].first()[0] > 0          # tokens repeat on purpose
    rows = checks["invalid_rows"].collect()
    assert len(rows) == 7 and all(r.invalid_rows == 0 and r.mart_rows > 0 for r in rows)


def test_unmapped_booleans_reported(spark, gold):
    _, reports, *_ = gold
    rows = reports["unmapped_booleans"].collect()
    assert rows and all(r.value == "true" for r in rows)     # the only odd spelling used


def test_top_null_fields(spark, gold):
    _, reports, *_ = gold
    top = reports["top_null_fields"].collect()
    assert len(top) == 15
    pcts = [r.pct_nulls for r in top]
    assert pcts == sorted(pcts, reverse=True)


def test_command_line_runs_all_steps(spark, survey, tmp_path, capsys):
    from lakemart.__main__ import main
    base, records = survey
    lake = tmp_path / "lake"
    argv = ["all", "--lake", str(lake), "--dictionary", str(base / "mapa.csv")]
    for e in EDITIONS:
        argv += ["--raw", f"{e}={base / f'{e}.csv'}"]
    assert main(argv, spark=spark) == 0
    out = capsys.readouterr().out
    assert "DIVERGENTE" not in out and "duplicate_tokens" in out
    regional = spark.read.parquet(str(lake / "gold" / "gold_perfil_regional"))
    assert regional.agg({"qtd_respondentes": "sum"}).first()[0] == len(records)


def test_gold_is_published_whole(spark, gold):
    from lakemart.plans.gold import publish_gold
    from lakemart.plans.survey import MART_NAMES
    from lakemart.sinks.publish import read_published

    base = gold[-1]
    assert publish_gold(spark, str(base / "silver"), str(base / "published")) == 1
    marts = read_published(spark, str(base / "published"))
    assert sorted(marts) == sorted(MART_NAMES)
    for name, df in marts.items():
        written = spark.read.parquet(str(base / "gold" / name))
        assert sorted(map(str, df.collect())) == sorted(map(str, written.collect()))
