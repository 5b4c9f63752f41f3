"""Canonical event keys, the golden table and the full record table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recfold import config as c
from recfold.functions import keys
from recfold.operators.skew import HotKeys, spread_join

KEY_COLUMNS = [
    "numero_ocorrencia_final", "numero_ocorrencia_associado_final",
    "origem_chave_ocorrencia_final", "status_chave_ocorrencia_final",
]


def _key_columns(key: Column) -> list[Column]:
    source, number = key.getField("fonte"), key.getField("numero")
    return [
        number.alias("numero_ocorrencia_final"),
        keys.associated_number(number).alias("numero_ocorrencia_associado_final"),
        F.when(key.isNotNull(), keys.key_origin(source, number)).alias("origem_chave_ocorrencia_final"),
        F.when(key.isNotNull(), keys.key_status(source, number)).alias("status_chave_ocorrencia_final"),
    ]


def canonical_keys(groups: DataFrame) -> DataFrame:
    """Distinct event keys. Already distinct inside each group, and groups share no final id."""
    exploded = groups.select("id_acidente_final", F.explode("chaves").alias("chave"))
    return exploded.select(
        "id_acidente_final", F.col("chave.fonte").alias("fonte_representante"), *_key_columns(F.col("chave"))
    )


def golden(
    annotated: DataFrame,
    aggregates: DataFrame,
    hot: HotKeys | None = None,
    written: bool = False,
) -> DataFrame:
    """Representatives and isolated records, once per event key of their group.

    The target of such a row is its own, so the records' hot targets are this join's hot keys.
    With ``written``, ``annotated`` is a stored table, cheap to scan twice: rows without a target
    then go around the join instead of through its shuffle.
    A group with a representative beside isolated WAZE records has two event keys, and each of
    its rows appears under both; ``pk_uniqueness`` and the checks report it.
    """
    unique = annotated.filter(F.col("papel_no_grupo").isin(c.ROLE_REPRESENTATIVE, c.ROLE_ISOLATED))
    target = F.col("target_der_final")
    joined = spread_join(
        unique.filter(target.isNotNull()) if written else unique, aggregates, "target_der_final",
        "numero_ocorrencia", [F.col("id_acidente_unico")], "left", (hot or {}).get("target_der_id"),
    )
    if written:
        joined = joined.unionByName(unique.filter(target.isNull()), allowMissingColumns=True)
    keyed = joined.withColumn("chave", F.explode("chaves"))

    def count(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0)).alias(column)

    return keyed.select(
        "id_acidente_final",
        "fonte_representante",
        "fontes_associadas",
        F.when(F.col("flag_duplicidade") == c.STRONG, F.col("id_cluster_duplicidade")).alias("id_cluster_duplicidade"),
        "id_original_representante",
        *_key_columns(F.col("chave")),
        "data_acidente", "municipio", "uf", "latitude", "longitude", "tipo_acidente",
        F.lit(c.DEDUP_ORIGIN).alias("flag_origem_deduplicacao"),
        "regra_deduplicacao_final",
        F.when(F.col("flag_duplicidade") == c.POSSIBLE, c.RESOLVED_POSSIBLE).otherwise(c.RESOLVED)
        .alias("status_resolucao_possivel"),
        F.when(F.col("fonte_original") == c.WAZE, c.RESOLVED_WAZE).otherwise(c.RESOLVED)
        .alias("status_resolucao_waze"),
        F.lit(None).cast("string").alias("rodovia"),
        F.lit(None).cast("string").alias("severidade"),
        F.lit(c.SOURCE_LIMIT).alias("status_rodovia_severidade"),
        count("qtde_veiculos_envolvidos"),
        "tipos_veiculos_envolvidos",
        count("qtde_envolvidos_total"),
        count("qtde_vitimas_total"),
        count("qtde_vitimas_fatais"),
        count("qtde_vitimas_feridas"),
        count("qtde_ilesos"),
        "condicoes_acidente", "condicoes_via", "indicador_embriaguez",
    )


def full_records(annotated: DataFrame, record_columns: list[str]) -> DataFrame:
    """Every crosswalked record with its own columns plus the decision and the event keys."""
    exploded = annotated.withColumn("chave", F.explode_outer("chaves"))
    return exploded.select(
        *record_columns, "target_der_id", "chave_dedup",
        "id_acidente_final", "regra_deduplicacao_final", "papel_no_grupo", "fonte_representante",
        *_key_columns(F.col("chave")),
    )
