"""Inventories, summaries and comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recfold.config import Expectations

# --- fixed values -----------------------------------------------------------
SUMMARY_LABELS = {
    "n_entrada": "Total de Registros Entrada",
    "n_final": "Total Acidentes Unicos Final",
    "n_veiculos": "Qtd Veiculos Agregados",
    "n_envolvidos": "Qtd Envolvidos Agregados",
}
VERSION_LABEL = "Total Linhas"
MAIN_SCENARIO = ("Cenário Principal (Conservador)", "POSSÍVEL isolado. WAZE isolado.")
SENSITIVITY_SCENARIO = (
    "Cenário de Sensibilidade (POSSÍVEL)",
    "POSSÍVEL funde via regras rigorosas de mesma data, municipio, raio espacial e tipo de acidente combinados.",
)
SENSITIVITY_TEXT = "Estimado conservadoramente: "
SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE"}
# --- end of fixed values ----------------------------------------------------


def source_key_inventory(records: DataFrame) -> DataFrame:
    return records.groupBy("fonte_original").agg(
        F.count("*").cast("int").alias("qtd"),
        F.count("id_original_fonte").cast("int").alias("com_id"),
    )


def schema_inventory(df: DataFrame) -> DataFrame:
    """Name, SQL type and number of filled rows of each column, in order; one pass."""
    counted = df.agg(*[F.count(F.col(f"`{field.name}`")).alias(str(i)) for i, field in enumerate(df.schema)])

    def row(position: int, name: str, kind: str) -> Column:
        return F.struct(
            F.lit(position + 1).alias("posicao"),
            F.lit(name).alias("column_name"),
            F.lit(SQL_TYPES.get(kind, kind.upper())).alias("column_type"),
            F.col(f"`{position}`").alias("preenchidas"),
        )

    return counted.select(F.inline(F.array(*[
        row(i, field.name, field.dataType.simpleString()) for i, field in enumerate(df.schema)
    ])))


def summary_counts(counters: DataFrame) -> DataFrame:
    """Four totals as rows, from the one-row counters."""
    return counters.select(F.inline(F.array(*[
        F.struct(F.lit(label).alias("metrica"), F.col(name).alias("valor"))
        for name, label in SUMMARY_LABELS.items()
    ])))


def version_compare(golden: DataFrame, expectations: Expectations = Expectations()) -> DataFrame:
    """An earlier delivery's total, given as a parameter, beside the current one."""
    return golden.agg(
        F.lit(VERSION_LABEL).alias("metrica"),
        F.lit(expectations.previous_total).cast("long").alias("v1"),
        F.count("*").alias("v2"),
    )


def scenario_compare(golden: DataFrame, expectations: Expectations = Expectations()) -> DataFrame:
    """The main scenario's total. The sensitivity row subtracts a given estimate from it; that
    scenario is not computed."""

    def row(texts: tuple[str, str], total: Column) -> Column:
        return F.struct(
            F.lit(texts[0]).alias("cenario"), F.lit(texts[1]).alias("regra"), total.alias("total_final")
        )

    total = F.col("total")
    estimate = (total - F.lit(expectations.sensitivity_merged)).cast("string")
    return golden.agg(F.count("*").alias("total")).select(F.inline(F.array(
        row(MAIN_SCENARIO, total.cast("string")),
        row(SENSITIVITY_SCENARIO, F.concat(F.lit(SENSITIVITY_TEXT), estimate)),
    )))
