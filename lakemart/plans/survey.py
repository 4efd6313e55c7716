"""Configuration of the yearly survey pipeline (data, not code).

The jobs in ``bronze``/``silver``/``gold`` are generic; this module only says
which fields, recodes and marts the survey uses.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from lakemart.operators.lineage import EDITION_COL

TOKEN_COL = "token"   # respondent id inside an edition

# ---- Fixed values: must equal the published pipeline for identical marts ----

BOOLEAN_FIELDS = [
    "atua_como_gestor", "possui_data_lake", "possui_data_warehouse",
    "satisfeito_atualmente", "vive_no_brasil", "vive_no_estado_de_formacao",
]
BOOLEAN_MAP = {"1": "Sim", "TRUE": "Sim", "0": "Não", "FALSE": "Não"}

VALUE_RECODES = {
    "cargo_atual": {
        "Engenheiro de Dados/Arquiteto de Dados/Data Engineer/Data Architect":
            "Engenheiro de Dados/Data Engineer/Data Architect",
    },
    "ai_generativa_e_llm_e_uma_prioridade": {
        "Mais ou menos... É uma das várias iniciativas que estamos impulsionando, mas não é "
        "uma prioridade (iniciativas isoladas e pouco foco).":
            "Mais ou menos... É uma das várias iniciativas que estamos impulsionando, mas não é "
            "uma prioridade (tratam-se de iniciativas isoladas e com pouco foco).",
    },
    "numero_de_funcionarios": {
        "de 501 a 100": "de 501 a 1.000",
    },
    "faixa_salarial": {
        "de R$ 101/mês a R$ 2.000/mês": "de R$ 1.001/mês a R$ 2.000/mês",
        "de R$ 25.001/mês a R$ 3000/mês": "de R$ 25.001/mês a R$ 30.000/mês",
    },
}

TIMESTAMP_FIELDS = {"data_hora_envio": "dd/MM/yyyy HH:mm:ss"}
INTEGER_FIELDS = ["idade", EDITION_COL]

RESPONDENT_COLUMNS = [
    EDITION_COL, TOKEN_COL,
    "faixa_idade", "genero", "cor_raca_etnia", "pcd", "regiao_onde_mora", "uf_onde_mora",
    "nivel_de_ensino", "area_de_formacao",
    "situacao_de_trabalho", "setor", "numero_de_funcionarios",
    "cargo_atual", "nivel", "faixa_salarial",
    "tempo_de_experiencia_em_dados", "tempo_de_experiencia_em_ti",
    "atua_como_gestor", "modelo_de_trabalho_atual", "modelo_de_trabalho_ideal",
    "satisfeito_atualmente", "planos_de_mudar_de_emprego_6m",
    "participou_de_entrevistas_ultimos_6m",
    "ai_generativa_e_llm_e_uma_prioridade", "usa_chatgpt_ou_copilot_no_trabalho",
    "empresa_esta_conseguindo_ter_bons_resultados_com_llms",
    "possui_data_lake", "possui_data_warehouse",
]

PANORAMA_KEYS = [EDITION_COL, "situacao_de_trabalho", "setor", "numero_de_funcionarios",
                 "modelo_de_trabalho_atual"]
PROFILE_KEYS = [EDITION_COL, "cargo_atual", "nivel", "faixa_salarial"]
DIVERSITY_KEYS = [EDITION_COL, "cargo_atual", "nivel", "genero", "cor_raca_etnia", "pcd"]
REGIONAL_KEYS = [EDITION_COL, "regiao_onde_mora", "nivel", "modelo_de_trabalho_atual"]

TECHNOLOGY_FIELDS = [
    ("banco_de_dados_dia_a_dia", "Banco de Dados"),
    ("cloud_dia_a_dia", "Cloud"),
    ("linguagem_de_programacao_dia_a_dia", "Linguagem de Programação"),
    ("ferramenta_de_bi_dia_a_dia", "Ferramenta de BI"),
]

AI_USAGE_FIELD = "usa_chatgpt_ou_copilot_no_trabalho"     # vocabulary multi-select
AI_DIMENSIONS = [
    ("uso_individual_ia", AI_USAGE_FIELD),
    ("prioridade_empresa_ia", "ai_generativa_e_llm_e_uma_prioridade"),
    ("resultado_llms_empresa", "empresa_esta_conseguindo_ter_bons_resultados_com_llms"),
]
AI_KEYS = ["cargo_atual", "setor"]

MATURITY_DIMENSIONS = [   # (dimension name, field, simple multi-select?)
    ("possui_data_lake", "possui_data_lake", False),
    ("possui_data_warehouse", "possui_data_warehouse", False),
    ("desafio_gestor", "desafios_como_gestor", True),
    ("motivo_nao_uso_ia", "motivos_para_nao_usar_ai_generativa_e_llm", True),
    ("risco_turnover", "planos_de_mudar_de_emprego_6m", False),
]
MATURITY_KEYS = ["setor", "numero_de_funcionarios"]

MEASURE = "qtd_respondentes"
SHARE = "pct_respondentes_ano"

MART_NAMES = [
    "gold_respondentes", "gold_panorama_mercado", "gold_perfis_profissionais",
    "gold_diversidade", "gold_adocao_tecnologias", "gold_adocao_ia",
    "gold_perfil_regional", "gold_maturidade_e_desafios",
]


@dataclass
class SurveyRecipe:
    """Everything the jobs need to know about one survey; defaults are the
    published configuration, any field can be overridden."""
    token: str = TOKEN_COL
    boolean_fields: list[str] = field(default_factory=lambda: list(BOOLEAN_FIELDS))
    boolean_map: dict[str, str] = field(default_factory=lambda: dict(BOOLEAN_MAP))
    value_recodes: dict[str, dict[str, str]] = field(
        default_factory=lambda: {k: dict(v) for k, v in VALUE_RECODES.items()})
    timestamp_fields: dict[str, str] = field(default_factory=lambda: dict(TIMESTAMP_FIELDS))
    integer_fields: list[str] = field(default_factory=lambda: list(INTEGER_FIELDS))
    legacy_integers: bool = False   # True: '3.7' -> 3 as older runtimes did; False: NULL
    respondent_columns: list[str] = field(default_factory=lambda: list(RESPONDENT_COLUMNS))
    panorama_keys: list[str] = field(default_factory=lambda: list(PANORAMA_KEYS))
    profile_keys: list[str] = field(default_factory=lambda: list(PROFILE_KEYS))
    diversity_keys: list[str] = field(default_factory=lambda: list(DIVERSITY_KEYS))
    regional_keys: list[str] = field(default_factory=lambda: list(REGIONAL_KEYS))
    technology_fields: list[tuple[str, str]] = field(
        default_factory=lambda: list(TECHNOLOGY_FIELDS))
    ai_dimensions: list[tuple[str, str]] = field(default_factory=lambda: list(AI_DIMENSIONS))
    ai_vocabulary_field: str = AI_USAGE_FIELD
    ai_keys: list[str] = field(default_factory=lambda: list(AI_KEYS))
    maturity_dimensions: list[tuple[str, str, bool]] = field(
        default_factory=lambda: list(MATURITY_DIMENSIONS))
    maturity_keys: list[str] = field(default_factory=lambda: list(MATURITY_KEYS))
    measure: str = MEASURE
    share: str = SHARE
