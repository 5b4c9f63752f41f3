"""Each computed check passes on clean data and fails on data that break it."""

import json

import fixtures
import pytest
from pyspark.sql import functions as F

from recfold.config import Expectations
from recfold.operators import audit, quality, reports
from recfold.plans.job import decide

CLEAN = [row for row in fixtures.RECORDS if row[0] in {"R01", "R02", "R03", "R10", "R11", "R12", "R18", "R07"}]


def facts_of(spark, rows, occurrences):
    children = fixtures.children(spark, occurrences)
    decision = decide(fixtures.records(spark, rows), children)
    return audit.facts(
        decision.records, decision.crosswalk, decision.golden, decision.aggregates, children
    ).cache()


@pytest.fixture(scope="module")
def clean(spark):
    return facts_of(spark, CLEAN, ["001-001", "007-001", "008-001"])


@pytest.fixture(scope="module")
def broken(spark):
    return facts_of(spark, fixtures.RECORDS, fixtures.OCCURRENCES)


def status(facts, **options):
    return {row.id_check: row for row in quality.checks(facts, **options).collect()}


def test_clean_data_pass(clean):
    found = status(clean, expectations=Expectations(input_rows=len(CLEAN)), integrity=True)
    assert len(found) == 29
    assert {row.status for row in found.values()} == {"PASS", "INFO"}
    assert {row.status_contratual for row in found.values()} == {"PASS"}


@pytest.mark.parametrize("check", [
    "QA_01", "QA_02", "QA_03", "QA_04", "QA_05", "QA_06", "QA_14", "der_match_ocorrencia_por_chave",
    "der_sem_match_classificado", "der_chave_fisica_presente_no_universo_elegivel", "QA_13", "QA_17",
    "possivel_nao_fundido_por_regra_programatica", "data_municipio_nao_usado_sozinho_para_possivel",
])
def test_broken_data_fail(broken, check):
    assert status(broken, integrity=False, reports=5)[check].status == "FAIL"


@pytest.mark.parametrize("check, change", [
    ("QA_07", {"n_waze_regra_ok": 0, "n_waze_nao_forte": 1}),
    ("waze_nao_fundido_por_regra_programatica", {"n_waze_regra_ok": 0, "n_waze_nao_forte": 1}),
    ("QA_09", {"n_agregados": 0}),
    ("QA_12", {"n_rodovia_severidade": 1}),
    ("origem_chave_ocorrencia_final_preenchida", {"n_com_origem": 0}),
    ("status_chave_ocorrencia_final_preenchida", {"n_com_status": 0}),
])
def test_changed_counters_fail(clean, check, change):
    facts = clean.withColumns({name: F.lit(value).cast("long") for name, value in change.items()})
    assert status(clean)[check].status == "PASS"
    assert status(facts)[check].status == "FAIL"


def test_texts(broken):
    found = status(broken)
    assert found["QA_01"].descricao == "Total de registros de entrada Atividade 2 = 3.567.394"
    assert found["QA_01"].esperado == "3567394" and found["QA_01"].observado == "23"
    assert found["QA_02"].observado == "21"
    assert found["QA_06"].esperado == "2" and found["QA_06"].observado == "1"
    assert found["QA_17"].status == "INFO"


def test_key_checks(broken):
    rows = {row.id_check: row for row in quality.key_checks(broken).collect()}
    assert len(rows) == 14 and not any(name.startswith("QA_") for name in rows)
    payload = json.loads(rows["metricas_formais_der"].observado)
    assert payload["n_eventos_finais_total"] == 20
    assert payload["taxa_cobertura_envolvidos_universo_elegivel"] == payload["taxa_match_der_envolvidos_universo_elegivel"]


def test_reports(spark, broken):
    assert {row.metrica: row.valor for row in reports.summary_counts(broken).collect()} == {
        "Total de Registros Entrada": 23, "Total Acidentes Unicos Final": 20, "Qtd Veiculos Agregados": 7,
        "Qtd Envolvidos Agregados": 9,
    }
    rows = spark.range(5)
    assert reports.version_compare(rows, Expectations(previous_total=7)).first()[1:] == (7, 5)
    totals = [row.total_final for row in reports.scenario_compare(rows, Expectations(sensitivity_merged=2)).collect()]
    assert totals == ["5", "Estimado conservadoramente: 3"]
    inventory = reports.schema_inventory(fixtures.children(spark)["der_cond_via"]).collect()
    assert [tuple(row) for row in inventory] == [
        (1, "numero_ocorrencia", "VARCHAR", 2), (2, "BURACOS", "VARCHAR", 2), (3, "MATERIAL NA PISTA", "VARCHAR", 2),
    ]
    keys = {row.fonte_original: (row.qtd, row.com_id) for row in
            reports.source_key_inventory(fixtures.records(spark)).collect()}
    assert keys["WAZE"] == (4, 0) and keys[None] == (1, 1)
