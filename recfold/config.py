"""Fixed data values and the few settings that steer a run."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values -----------------------------------------------------------
# Values below are part of the data contract: they occur in the inputs or must
# appear unchanged in the outputs.

SEJUSP = "SEJUSP"
DER = "DER"
WAZE = "WAZE"
OFFICIAL_SOURCES = [SEJUSP, DER]

STRONG = "FORTE"
POSSIBLE = "POSSIVEL"

MISSING_ID = "NaN"

ROLE_REPRESENTATIVE = "representante"
ROLE_EVIDENCE = "evidencia_associada"
ROLE_ISOLATED = "isolado"
ROLE_CANDIDATE = "representante_candidato"

RULE_WAZE = "isolado_waze_ausencia_chave"
RULE_STRONG = "cluster_forte"
RULE_POSSIBLE = "isolado_possivel_cenario_conservador"
RULE_SOURCE_ID = "id_original_fonte"
RULE_NO_KEY = "isolado_sem_chave"

ORIGIN_SEJUSP = "SEJUSP_ID_ORIGINAL"
ORIGIN_DER = "DER_ID_ORIGINAL"
ORIGIN_WAZE = "SEM_CHAVE_OFICIAL_WAZE"
ORIGIN_OTHER = "SEM_CHAVE_OFICIAL_OUTRO"

STATUS_WAZE = "INEXISTENTE_WAZE"
STATUS_ACTIVE = "CHAVE_FISICA_ATIVA"
STATUS_ABSENT = "INEXISTENTE"
STATUS_OTHER = "REGISTRO_NAO_ELEGIVEL_DER"

DEDUP_ORIGIN = "DEDUPLICACAO_CONSERVADORA_V2"
RESOLVED = "resolvido"
RESOLVED_POSSIBLE = "isolado_cenario_conservador"
RESOLVED_WAZE = "isolado_por_ausencia_de_chave_forte"
SOURCE_LIMIT = "limitação_fonte_fase1"

# Suffix of a physical occurrence key. \z and not $: Java's $ also matches
# before a trailing newline.
SUFFIX_PATTERN = r"-[0-9]{3}\z"

FATAL_MARKS = ["FATAL"]
INJURED_MARKS = ["COM LESOES", "GRAVE", "LEVE"]
UNHURT_MARKS = ["SEM LESOES", "ILESO"]

# Whole-field texts that a delimited file uses for "no value".
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

REJECT_REASON = "Linhas com numero incorreto de delimitadores"
REJECT_IMPACT = "Possivel perda minima de algumas metricas associadas a poucos acidentes."

COVERAGE_NOTE = (
    "Cobertura de registros na tabela Acidente_Envolvidos; ausencia nao implica falha de join DER"
)

EXPECTED_INPUT_ROWS = 3567394
PREVIOUS_TOTAL = 3546719
SENSITIVITY_MERGED = 180126

# --- end of fixed values ----------------------------------------------------

BASE_COLUMNS = [
    "id_acidente_unico", "fonte_original", "id_original_fonte", "arquivo_origem", "flag_duplicidade",
    "id_cluster_duplicidade", "data_acidente", "municipio", "uf", "latitude", "longitude", "tipo_acidente",
]

GOLDEN_COLUMNS = [
    "id_acidente_final", "fonte_representante", "fontes_associadas", "id_cluster_duplicidade",
    "id_original_representante", "numero_ocorrencia_final", "numero_ocorrencia_associado_final",
    "origem_chave_ocorrencia_final", "status_chave_ocorrencia_final", "data_acidente", "municipio", "uf",
    "latitude", "longitude", "tipo_acidente", "flag_origem_deduplicacao", "regra_deduplicacao_final",
    "status_resolucao_possivel", "status_resolucao_waze", "rodovia", "severidade",
    "status_rodovia_severidade", "qtde_veiculos_envolvidos", "tipos_veiculos_envolvidos",
    "qtde_envolvidos_total", "qtde_vitimas_total", "qtde_vitimas_fatais", "qtde_vitimas_feridas",
    "qtde_ilesos", "condicoes_acidente", "condicoes_via", "indicador_embriaguez",
]

CROSSWALK_COLUMNS = [
    "id_acidente_unico", "id_acidente_final", "fonte_original", "arquivo_origem", "id_original_fonte",
    "flag_duplicidade", "regra_deduplicacao_final", "papel_no_grupo", "fonte_representante",
]

# Child tables and the columns the job reads from each. The first three must be present.
CHILD_TABLES = {
    "der_ocorrencia": ["numero_ocorrencia", "numero_ocorrencia_associado"],
    "der_veiculos": ["numero_ocorrencia", "numero_ocorrencia_associado", "tipo_veiculo_descricao_longa"],
    "der_envolvidos": ["numero_ocorrencia", "numero_ocorrencia_associado", "condicao_fisica_descricao"],
    "der_cond_acidente": ["numero_ocorrencia", "luminosidade_descricao", "condicao_sinalizacao_descricao"],
    "der_cond_via": ["numero_ocorrencia", "BURACOS", "MATERIAL NA PISTA"],
    "der_embriaguez": ["numero_ocorrencia", "sintoma_embriaguez_descricao"],
}
MANDATORY_TABLES = ["der_ocorrencia", "der_veiculos", "der_envolvidos"]


@dataclass(frozen=True)
class Skew:
    """When a join key counts as hot, and how finely its rows are spread.

    A key is hot once it holds more than ``rows_per_task`` rows.
    """

    rows_per_task: int = 1_000_000


@dataclass(frozen=True)
class Expectations:
    """Totals of a particular delivery. They are inputs to the report, never computed."""

    input_rows: int = EXPECTED_INPUT_ROWS
    previous_total: int = PREVIOUS_TOTAL
    sensitivity_merged: int = SENSITIVITY_MERGED
