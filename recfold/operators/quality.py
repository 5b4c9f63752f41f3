"""Quality checks as data: texts, compared values and pass conditions."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from recfold.config import Expectations

# --- fixed values -----------------------------------------------------------
# Texts of the check report: id, description, metric, severity, message. Names in braces stand
# for counters and parameters.
CHECK_TEXTS = [
    ("QA_01", "Total de registros de entrada Atividade 2 = {p_entrada_texto}",
     "contagem_linhas", "P0", ""),
    ("QA_02", "Crosswalk v2 tem exatamente {p_entrada_texto} linhas",
     "contagem_linhas", "P0", ""),
    ("QA_03", "Cada registro de entrada possui exatamente um id_acidente_final",
     "pk_crosswalk", "P0", ""),
    ("QA_04", "Base final tem uma linha por id_acidente_final",
     "pk_base_final", "P0", ""),
    ("QA_05", "Registros FORTE tratados por regra documentada",
     "contagem_registros_forte", "P1", "Clusters FORTE preservados sem redesenho"),
    ("QA_06", "POSSIVEL recebeu politica explicita",
     "contagem_possivel_regra_isolado", "P1",
     "Todos registros POSSIVEL com regra isolado_possivel_cenario_conservador"),
    ("QA_07", "WAZE recebeu politica explicita",
     "contagem_waze_regra_isolado", "P1", "WAZE fora de FORTE isolado por ausencia de chave oficial"),
    ("QA_08", "Latitude e longitude nao usadas isoladamente",
     "regra_programatica_lat_lon", "P1", "Nenhuma regra de dedup usa lat/lon sozinhos"),
    ("QA_09", "DER relacional agregado por numero_ocorrencia",
     "contagem_ocorrencias_agregadas", "P0", ""),
    ("der_chave_fisica_presente_no_universo_elegivel", "Eventos SEJUSP/DER com chave fisica materializada",
     "contagem_chave_fisica_elegivel", "P0", "SEJUSP usada como ponte operacional de chave quando aplicavel"),
    ("der_match_ocorrencia_por_chave", "Match formal DER Ocorrencia por chave fisica no universo elegivel",
     "taxa_match_der_ocorrencia_universo_elegivel", "P0",
     "Match por numero_ocorrencia: {n_eventos_match_der_ocorrencia_por_numero_ocorrencia} eventos"),
    ("der_match_veiculos_por_chave", "Cobertura DER Veiculos por chave fisica no universo elegivel",
     "taxa_match_der_veiculos_universo_elegivel", "P0", "Taxa: {taxa_match_der_veiculos_universo_elegivel}%"),
    ("der_match_envolvidos_por_chave", "Cobertura de registros Acidente_Envolvidos por chave fisica",
     "taxa_cobertura_envolvidos_universo_elegivel", "P0",
     "Taxa cobertura envolvidos: {taxa_cobertura_envolvidos_universo_elegivel}%"
     " — nao e match DER relacional total"),
    ("der_sem_envolvidos_classificado_sem_tratar_como_falha_de_join",
     "Eventos sem envolvidos com ocorrencia DER classificados como ausencia fisica",
     "n_eventos_sem_envolvidos_mas_com_ocorrencia_der", "P0", "Ausencia na tabela Envolvidos, nao falha de join"),
    ("der_sem_match_classificado", "Eventos sem match DER ocorrencia no universo elegivel",
     "n_eventos_sem_match_der_ocorrencia", "P0", ""),
    ("numero_ocorrencia_final_presente_na_base_final",
     "Coluna numero_ocorrencia_final materializada na base final",
     "coluna_presente_todas_linhas", "P0", "Preenchida em {n_com_numero} eventos"),
    ("numero_ocorrencia_associado_final_presente_na_base_final",
     "Coluna numero_ocorrencia_associado_final materializada na base final",
     "coluna_presente_todas_linhas", "P0", "Preenchida em {n_com_numero_associado} eventos"),
    ("origem_chave_ocorrencia_final_preenchida",
     "Coluna origem_chave_ocorrencia_final preenchida em todos os eventos",
     "contagem_origem_preenchida", "P0", ""),
    ("status_chave_ocorrencia_final_preenchida",
     "Coluna status_chave_ocorrencia_final preenchida em todos os eventos",
     "contagem_status_preenchida", "P0", ""),
    ("possivel_nao_fundido_por_regra_programatica", "POSSIVEL nao fundido por regra conservadora",
     "contagem_possivel_regra_isolado", "P0", "chave_dedup = id_acidente_unico para POSSIVEL"),
    ("waze_nao_fundido_por_regra_programatica", "WAZE nao fundido por regra programatica",
     "contagem_waze_regra_isolado", "P0",
     "WAZE fora de FORTE isolado; eventos finais WAZE puros: {n_eventos_waze_isolado}"),
    ("data_municipio_nao_usado_sozinho_para_possivel", "Data e municipio nao usados sozinhos para fundir POSSIVEL",
     "contagem_possivel_sem_fusao_data_municipio", "P0",
     "Cenario conservador: sem fusao por data+municipio isolados"),
    ("QA_11", "Nenhum arquivo fora da sandbox v2 alterado",
     "filesystem", "P0", ""),
    ("QA_12", "Rodovia e severidade nao inventadas",
     "contagem_rodovia_severidade_nulas", "P1", ""),
    ("QA_13", "Linhas malformadas em arquivos DER registradas",
     "arquivos_der_logados", "P2", ""),
    ("QA_14", "Nenhum id_acidente_final duplicado na base final",
     "pk_base_final", "P0", ""),
    ("QA_15", "Quantidade de veiculos agregada quando possivel",
     "contagem_match_veiculos", "P0", ""),
    ("QA_16", "Quantidade de envolvidos agregada quando possivel",
     "contagem_cobertura_envolvidos", "P0", "Cobertura tabela Envolvidos, nao proxy de match total"),
    ("QA_17", "Hashes Atividade 2 PRE = POS",
     "hash", "P0", ""),
]
KEY_CHECK_PREFIXES = ["der_", "numero_", "origem_", "status_", "possivel_", "waze_", "data_"]
PAYLOAD_CHECK = (
    "metricas_formais_der", "Payload completo de metricas formais DER", "metricas_match_formal_por_chave", "P0"
)
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class Comparison:
    """Compared values and pass condition of a check, as SQL over counters and parameters.

    ``passes=None`` marks a check that only informs. ``settled`` marks a check whose status is
    PASS by contract whatever the data say; the computed status stands beside it.
    """

    expected: str
    observed: str
    passes: str | None
    settled: bool = False


_POSSIBLE = Comparison("n_possivel_entrada", "n_possivel_regra_ok", "n_possivel_regra_ok = n_possivel_entrada")
_WAZE = Comparison("n_waze_nao_forte", "n_waze_regra_ok", "n_waze_regra_ok = n_waze_nao_forte")
_UNIQUE = Comparison("n_final", "n_final", "n_final_ids = n_final")
_ALL_MATCHED = "n_eventos_sem_match_der_ocorrencia = 0"

COMPARISONS = {
    "QA_01": Comparison("p_entrada", "n_entrada", "n_entrada = p_entrada"),
    "QA_02": Comparison("n_entrada", "n_crosswalk", "n_crosswalk = n_entrada"),
    "QA_03": Comparison(
        "n_entrada", "n_crosswalk", "n_crosswalk = n_entrada AND n_crosswalk_ids = n_crosswalk", True
    ),
    "QA_04": _UNIQUE,
    "QA_05": Comparison("n_forte_entrada", "n_forte_saida", "n_forte_saida = n_forte_entrada", True),
    "QA_06": _POSSIBLE,
    "QA_07": _WAZE,
    "QA_08": Comparison("0", "0", None, True),
    "QA_09": Comparison("n_ocorrencias", "n_agregados", "n_agregados = n_ocorrencias", True),
    "der_chave_fisica_presente_no_universo_elegivel": Comparison(
        "n_elegivel_com_ocorrencia", "n_chave_elegivel_com_fisica",
        "n_chave_elegivel_com_fisica = n_elegivel_com_ocorrencia",
    ),
    "der_match_ocorrencia_por_chave": Comparison(
        "CAST(100.0 AS DOUBLE)", "taxa_match_der_ocorrencia_universo_elegivel", _ALL_MATCHED
    ),
    "der_match_veiculos_por_chave": Comparison(
        "n_universo_elegivel_der", "n_elegivel_com_veiculos", None, True
    ),
    "der_match_envolvidos_por_chave": Comparison(
        "n_universo_elegivel_der", "n_elegivel_com_envolvidos", None, True
    ),
    "der_sem_envolvidos_classificado_sem_tratar_como_falha_de_join": Comparison(
        "n_eventos_sem_envolvidos_mas_com_ocorrencia_der", "n_eventos_sem_envolvidos_mas_com_ocorrencia_der",
        None, True,
    ),
    "der_sem_match_classificado": Comparison("0", "n_eventos_sem_match_der_ocorrencia", _ALL_MATCHED),
    "numero_ocorrencia_final_presente_na_base_final": Comparison("n_final", "n_final", None, True),
    "numero_ocorrencia_associado_final_presente_na_base_final": Comparison("n_final", "n_final", None, True),
    "origem_chave_ocorrencia_final_preenchida": Comparison("n_final", "n_com_origem", "n_com_origem = n_final"),
    "status_chave_ocorrencia_final_preenchida": Comparison("n_final", "n_com_status", "n_com_status = n_final"),
    "possivel_nao_fundido_por_regra_programatica": _POSSIBLE,
    "waze_nao_fundido_por_regra_programatica": _WAZE,
    "data_municipio_nao_usado_sozinho_para_possivel": _POSSIBLE,
    "QA_11": Comparison("'sandbox_only'", "'sandbox_only'", None, True),
    "QA_12": Comparison("0", "n_rodovia_severidade", "n_rodovia_severidade = 0", True),
    "QA_13": Comparison("p_fontes", "p_relatorios", "p_relatorios = p_fontes", True),
    "QA_14": _UNIQUE,
    "QA_15": Comparison(
        "n_elegivel_com_veiculos", "n_eventos_match_der_veiculos_por_numero_ocorrencia", None, True
    ),
    "QA_16": Comparison(
        "n_elegivel_com_envolvidos", "n_eventos_match_der_envolvidos_por_numero_ocorrencia", None, True
    ),
}
_INTEGRITY = {
    True: Comparison("'Iguais'", "'Iguais'", "true"),
    False: Comparison("'Iguais'", "'Diferentes'", "false"),
    None: Comparison("'Iguais'", "'nao_avaliado'", None),
}


def _text(template: str) -> Column:
    """``template`` with the counters named in braces filled in."""
    pieces = re.split(r"\{(\w+)\}", template)
    return F.concat(*[
        F.col(piece).cast("string") if position % 2 else F.lit(piece) for position, piece in enumerate(pieces)
    ])


def _as_text(sql: str) -> Column:
    return F.expr(sql).cast("string")


def _row(check: tuple, status: Column, promised: Column, expected: Column, observed: Column) -> Column:
    name, description, metric, severity, message = check
    return F.struct(
        F.lit(name).alias("id_check"),
        _text(description).alias("descricao"),
        status.alias("status"),
        promised.alias("status_contratual"),
        expected.alias("esperado"),
        observed.alias("observado"),
        F.lit(metric).alias("metrica"),
        F.lit(severity).alias("severidade"),
        _text(message).alias("mensagem"),
    )


def _check_rows(integrity: bool | None) -> list[Column]:
    comparisons = {**COMPARISONS, "QA_17": _INTEGRITY[integrity]}
    rows = []
    for check in CHECK_TEXTS:
        rule = comparisons[check[0]]
        status = F.when(F.expr(rule.passes), "PASS").otherwise("FAIL") if rule.passes else F.lit("INFO")
        promised = F.lit("PASS") if rule.settled else status
        rows.append(_row(check, status, promised, _as_text(rule.expected), _as_text(rule.observed)))
    return rows


def _with_parameters(facts: DataFrame, expectations: Expectations, sources: int, reports: int) -> DataFrame:
    return facts.withColumns({
        "p_entrada": F.lit(expectations.input_rows),
        "p_entrada_texto": F.lit(f"{expectations.input_rows:,}".replace(",", ".")),
        "p_fontes": F.lit(sources),
        "p_relatorios": F.lit(reports),
        "n_elegivel_com_ocorrencia": F.expr("n_universo_elegivel_der - n_eventos_sem_match_der_ocorrencia"),
        "n_elegivel_com_veiculos": F.expr("n_universo_elegivel_der - n_eventos_sem_match_der_veiculos"),
        "n_elegivel_com_envolvidos": F.expr("n_universo_elegivel_der - n_eventos_sem_match_der_envolvidos"),
    })


def checks(
    facts: DataFrame,
    expectations: Expectations = Expectations(),
    sources: int = 6,
    reports: int = 6,
    integrity: bool | None = None,
) -> DataFrame:
    """One row per check, from the one row of all counters, metrics and rates.

    ``status`` is computed from the data, INFO where nothing is compared; ``status_contratual``
    is what the report promises.
    """
    facts = _with_parameters(facts, expectations, sources, reports)
    return facts.select(F.inline(F.array(*_check_rows(integrity))))


def metric_names(facts: DataFrame) -> list[str]:
    return [name for name in facts.columns if name.startswith(("n_eventos_", "n_universo_", "taxa_", "nota_"))]


def key_checks(
    facts: DataFrame, expectations: Expectations = Expectations(), sources: int = 6, reports: int = 6
) -> DataFrame:
    """The checks about keys and policy, plus one row holding all metrics as JSON."""
    payload = F.to_json(F.struct(*metric_names(facts)))
    payload_row = _row((*PAYLOAD_CHECK, ""), F.lit("PASS"), F.lit("PASS"), payload, payload)
    rows = F.array(*_check_rows(None), payload_row)
    wanted = reduce(or_, [F.col("id_check").startswith(prefix) for prefix in KEY_CHECK_PREFIXES])
    facts = _with_parameters(facts, expectations, sources, reports)
    return facts.select(F.inline(rows)).filter(wanted | (F.col("id_check") == PAYLOAD_CHECK[0]))
