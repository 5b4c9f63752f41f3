"""The policy on the edge-case records, row by row."""

import fixtures
import pytest
from pyspark.sql import functions as F

from recfold import config as c
from recfold.operators import audit, crosswalk as cw, golden as gold, relational
from recfold.plans.job import decide


@pytest.fixture(scope="module")
def decision(spark):
    return decide(fixtures.records(spark), fixtures.children(spark))


@pytest.fixture(scope="module")
def golden(decision):
    return decision.golden.cache()


def test_crosswalk(decision):
    rows = decision.annotated.select(
        "id_acidente_unico", "chave_dedup", "id_acidente_final", "regra_deduplicacao_final", "papel_no_grupo",
        "fonte_representante", "id_original_representante", "target_der_final",
    ).collect()
    assert {row[0]: tuple(row)[1:] for row in rows} == fixtures.CROSSWALK
    assert len(rows) == len(fixtures.CROSSWALK)


def test_crosswalk_columns(decision):
    assert decision.crosswalk.columns == [
        "id_acidente_unico", "id_acidente_final", "fonte_original", "arquivo_origem", "id_original_fonte",
        "target_der_id", "flag_duplicidade", "regra_deduplicacao_final", "papel_no_grupo",
        "fonte_representante", "id_original_representante", "target_der_final",
    ]


def test_representatives(decision):
    expected = {
        (final, source, source_id)
        for _, final, _, role, source, source_id, _ in fixtures.CROSSWALK.values()
        if role == "representante"
    }
    rows = cw.representatives(decision.groups).collect()
    assert {tuple(row)[:3] for row in rows} == expected
    assert len(rows) == len(expected)


def test_canonical_keys(decision):
    rows = gold.canonical_keys(decision.groups).drop("origem_chave_ocorrencia_final").collect()
    assert {tuple(row) for row in rows} == fixtures.KEYS
    assert len(rows) == len(fixtures.KEYS)


def test_key_origin(decision):
    rows = gold.canonical_keys(decision.groups).collect()
    origin = {(row.id_acidente_final, row.fonte_representante): row.origem_chave_ocorrencia_final for row in rows}
    assert origin[("R01", "SEJUSP")] == "SEJUSP_ID_ORIGINAL"
    assert origin[("R04", "DER")] == "DER_ID_ORIGINAL"
    assert origin[("R08", "WAZE")] == "SEM_CHAVE_OFICIAL_WAZE"
    assert origin[("R13", "DER")] == origin[("R21", "OUTRO")] == "SEM_CHAVE_OFICIAL_OUTRO"


def test_suffix_is_only_stripped_at_the_very_end(spark):
    from recfold.functions.keys import associated_number

    texts = ["2020-1-001", "2020-1-001\n", "2020-1-0012", "2020-001-x", "-123"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(associated_number(F.col("t"))).collect()
    assert [row[0] for row in rows] == ["2020-1", "2020-1-001\n", "2020-1-0012", "2020-001-x", ""]


def test_occurrence_aggregates(spark):
    rows = relational.occurrence_aggregates(fixtures.children(spark)).select(
        "numero_ocorrencia", "qtde_veiculos_envolvidos", "tipos_veiculos_envolvidos", "qtde_envolvidos_total",
        "qtde_vitimas_fatais", "qtde_vitimas_feridas", "qtde_ilesos",
    ).collect()
    assert sorted((tuple(row) for row in rows), key=str) == fixtures.AGGREGATES


def test_conditions_equal_the_unreduced_join(spark):
    tables = fixtures.children(spark)
    names = ["der_ocorrencia", "der_cond_acidente", "der_cond_via", "der_embriaguez"]
    raw = tables[names[0]]
    for name in names[1:]:
        raw = raw.join(tables[name], "numero_ocorrencia", "left")
    raw = raw.groupBy("numero_ocorrencia").agg(
        F.max(F.concat("luminosidade_descricao", F.lit(" / "), "condicao_sinalizacao_descricao")),
        F.max(F.concat("BURACOS", F.lit(" / "), F.col("`MATERIAL NA PISTA`"))),
        F.max("sintoma_embriaguez_descricao"),
    )
    reduced = relational.condition_aggregates(*[tables[name] for name in names])
    assert sorted(map(tuple, reduced.collect())) == sorted(map(tuple, raw.collect()))
    values = {row[0]: tuple(row)[1:] for row in reduced.collect()}
    assert values["2020-000000001-001"] == ("DIA / BOA", "SIM / OLEO", None)


def test_golden_fans_out_as_documented(golden):
    assert golden.columns == c.GOLDEN_COLUMNS
    counts = {row[0]: row[1] for row in golden.groupBy("id_acidente_final").count().collect()}
    assert sum(counts.values()) == 20 and len(counts) == 15
    assert counts["R08"] == 4 and counts["R10"] == counts["R12"] == 2


def test_golden_joins_raw_keys_and_audit_trimmed_ones(spark, golden):
    row = audit.audit(golden, fixtures.children(spark)).filter("id_acidente_final = 'R18'").first()
    assert row.qtde_veiculos_envolvidos == 0
    assert row.match_vei_exato == row.match_oco_exato == 1


def test_associated_match_differs_from_exact(spark, golden):
    row = audit.audit(golden, fixtures.children(spark)).filter("id_acidente_final = 'R04'").first()
    assert (row.match_oco_exato, row.match_oco_assoc) == (0, 1)


def test_golden_types(golden):
    types = dict(golden.dtypes)
    assert types["rodovia"] == types["severidade"] == "string"
    assert types["qtde_veiculos_envolvidos"] == "int"


def test_full_records_fan_out_and_keep_all_columns(decision):
    full = decision.full_records
    assert full.columns[: len(decision.records.columns)] == decision.records.columns
    counts = {row[0]: row[1] for row in full.groupBy("id_acidente_unico").count().collect()}
    assert set(counts) == set(fixtures.CROSSWALK)
    assert counts["R08"] == counts["R09"] == 2 and sum(counts.values()) == 23


def test_metrics_agree_on_rows_and_on_counted_combinations(spark, golden):
    children = fixtures.children(spark)
    by_row = audit.metrics(audit.audit(golden, children)).first()
    counted = audit.metrics(audit.audit(audit.event_profile(golden), children), "eventos").first()
    assert by_row == counted
    assert by_row.n_eventos_finais_total == 20


def test_metrics_of_nothing_are_zero(spark, golden):
    rated = audit.rates(audit.metrics(audit.audit(golden.filter("false"), fixtures.children(spark)))).first()
    assert rated.n_eventos_finais_total == 0
    assert rated.taxa_match_der_veiculos_universo_elegivel == 0.0
