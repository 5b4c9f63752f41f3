"""Shape the test tables into the job's inputs.

The SQL is portable: Spark and the oracle run the same text with their own table names filled
in. Every adapter covers its whole tables. Where a child row shall have no occurrence, its key
is NULL or blank, as in real deliveries, so that the operators meet large groups of such keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["orders", "lineitem", "part"]


def _occurrence(key: str) -> str:
    return (
        f"CONCAT('2020-', LPAD(CAST(CAST(FLOOR({key} / 10) AS BIGINT) * 5 + {key} % 5 AS STRING), 9, '0'))"
    )


def _child_keys(present: str, absent: str) -> str:
    """Both key columns of a child row; ``absent`` stands where the row has no occurrence."""
    number = _occurrence("l_orderkey")
    return f"""CASE WHEN {present} THEN CONCAT({number}, '-001') ELSE {absent} END AS numero_ocorrencia,
       CASE WHEN {present} THEN {number} ELSE {absent} END AS numero_ocorrencia_associado"""


BASE = f"""
SELECT LPAD(CAST(o_orderkey AS STRING), 9, '0') AS id_acidente_unico,
       CASE WHEN o_orderkey % 5 IN (0, 1) THEN 'SEJUSP' WHEN o_orderkey % 5 IN (2, 3) THEN 'DER' ELSE 'WAZE' END
         AS fonte_original,
       CASE WHEN o_orderkey % 5 = 4 OR o_orderkey % 11 = 0 THEN NULL
            WHEN o_orderkey % 11 = 1 THEN 'NaN'
            WHEN o_orderkey % 23 = 2 THEN '  '
            ELSE CONCAT({_occurrence('o_orderkey')}, '-001') END AS id_original_fonte,
       CASE WHEN o_orderkey % 17 = 3 THEN '' WHEN o_orderkey % 19 = 4 THEN CONCAT('a, "b"', CHR(13), CHR(10), CHR(10), '"')
            ELSE o_orderpriority END AS arquivo_origem,
       CASE CAST(FLOOR(o_orderkey / 6) AS BIGINT) % 4
            WHEN 0 THEN CASE WHEN o_orderkey % 5 = 4 AND CAST(FLOOR(o_orderkey / 6) AS BIGINT) % 3 <> 0
                             THEN 'UNICO' ELSE 'FORTE' END
            WHEN 1 THEN 'POSSIVEL' WHEN 2 THEN 'UNICO' ELSE NULL END AS flag_duplicidade,
       CASE WHEN CAST(FLOOR(o_orderkey / 6) AS BIGINT) % 4 = 0
            THEN CONCAT('C', CAST(CAST(FLOOR(o_orderkey / 6) AS BIGINT) AS STRING)) END AS id_cluster_duplicidade,
       CAST(o_orderdate AS DATE) AS data_acidente, o_orderstatus AS municipio, 'UF' AS uf,
       CAST(o_custkey % 90 AS DOUBLE) AS latitude, CAST(o_custkey % 180 AS DOUBLE) AS longitude,
       o_orderpriority AS tipo_acidente
FROM {{orders}}"""

# About one block of keys in 13 becomes one occurrence without a key.
DER_OCORRENCIA = f"""
SELECT DISTINCT CASE WHEN listed THEN CONCAT(numero, '-001') END AS numero_ocorrencia,
       CASE WHEN listed THEN numero END AS numero_ocorrencia_associado
FROM (SELECT {_occurrence('o_orderkey')} AS numero,
             o_orderkey % 5 <> 4 AND CAST(FLOOR(o_orderkey / 10) AS BIGINT) % 13 <> 0 AS listed
      FROM {{orders}}) k"""

DER_VEICULOS = f"""
SELECT {_child_keys("l_orderkey % 5 <> 4 AND l_linenumber <= 3", "''")},
       p_type AS tipo_veiculo_descricao_longa
FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey"""

DER_ENVOLVIDOS = f"""
SELECT {_child_keys("l_orderkey % 5 <> 4 AND l_linenumber >= 5", "NULL")},
       CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'VITIMA FATAL'
            WHEN l_returnflag = 'A' THEN 'COM LESOES GRAVES'
            WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'LEVE'
            WHEN l_returnflag = 'N' THEN 'SEM LESOES'
            WHEN l_linestatus = 'F' THEN 'ILESO' END AS condicao_fisica_descricao
FROM {{lineitem}}"""


def _condition_table(line: int, columns: str) -> str:
    return f"""
SELECT CASE WHEN l_orderkey % 5 <> 4 AND l_linenumber = {line}
            THEN CONCAT({_occurrence('l_orderkey')}, '-001') END AS numero_ocorrencia,
       {columns}
FROM {{lineitem}}"""


_VALUE_A = "CASE WHEN l_returnflag = 'A' THEN 'DIA' WHEN l_returnflag = 'N' THEN 'NOITE' END"
_VALUE_B = "CASE WHEN l_linestatus = 'F' THEN 'BOA' ELSE 'RUIM' END"

DER_COND_ACIDENTE = _condition_table(
    1, f"{_VALUE_A} AS luminosidade_descricao, {_VALUE_B} AS condicao_sinalizacao_descricao"
)
DER_COND_VIA = _condition_table(2, f"{_VALUE_A} AS BURACOS, {_VALUE_B} AS {{quote}}MATERIAL NA PISTA{{quote}}")
DER_EMBRIAGUEZ = _condition_table(4, f"{_VALUE_A} AS sintoma_embriaguez_descricao")

# Raw lines of a delimited file with three columns: over-long lines with and without a value in
# the extra field, short lines, separators inside quotes, texts that mean NULL, accents.
DELIMITED_HEADER = ["numero_ocorrencia", "numero_ocorrencia_associado", "condicao_fisica_descricao"]
_LINE_START = f"CONCAT({_occurrence('l_orderkey')}, '-001;', {_occurrence('l_orderkey')}"
DELIMITED_LINES = f'''
SELECT CASE l_linenumber
         WHEN 1 THEN {_LINE_START}, ';', CASE l_returnflag WHEN 'A' THEN 'NA' WHEN 'N' THEN '' ELSE 'LESÕES' END)
         WHEN 2 THEN {_LINE_START}, ';NaN')
         WHEN 3 THEN {_LINE_START}, ';SEM "ASPAS" LESOES')
         WHEN 4 THEN {_LINE_START}, ';"COM; LESOES ""GRAVES"""')
         WHEN 5 THEN {_LINE_START})
         WHEN 6 THEN {_LINE_START}, ';LEVE;')
         ELSE {_LINE_START}, ';ILESO;A MAIS') END AS linha
FROM {{lineitem}}'''

# Lines of files that break within quoted fields, hold long fields and blank lines in them, and
# have their columns in two orders, by file.
BROKEN_HEADERS = ("numero_ocorrencia;numero_ocorrencia_associado;condicao_fisica_descricao",
                  "condicao_fisica_descricao;numero_ocorrencia;numero_ocorrencia_associado")
BROKEN_FILE = "CAST(FLOOR(l_orderkey / 20000) AS BIGINT)"
_BROKEN_NUMBERS = f"CONCAT({_occurrence('l_orderkey')}, '-001;', {_occurrence('l_orderkey')}, ' á')"
_BROKEN_STATE = '''CASE l_linenumber
             WHEN 1 THEN CONCAT('"COM', CHR(10), 'LESÕES; ""GRAVES"""')
             WHEN 2 THEN CONCAT('"a;', CHR(10), CHR(10), '""b"')
             WHEN 3 THEN REPEAT('x', 3000)
             WHEN 5 THEN CONCAT('"x', CHR(10), 'y"')
             WHEN 6 THEN 'NaN' ELSE 'ILESO' END'''
BROKEN_LINES = f"""
SELECT arquivo,
       CASE WHEN l_linenumber = 4 THEN CASE WHEN arquivo % 2 = 0 THEN numeros ELSE CONCAT(estado, ';', numero) END
            ELSE CONCAT(CASE WHEN arquivo % 2 = 0 THEN CONCAT(numeros, ';', estado) ELSE CONCAT(estado, ';', numeros) END,
                        CASE WHEN l_linenumber = 5 THEN ';A MAIS' ELSE '' END) END AS linha
FROM (SELECT {BROKEN_FILE} AS arquivo, l_linenumber, {_BROKEN_NUMBERS} AS numeros,
             CONCAT({_occurrence('l_orderkey')}, '-001') AS numero, {_BROKEN_STATE} AS estado
      FROM {{lineitem}}) k"""

INPUTS = {
    "delimited_lines": DELIMITED_LINES,
    "broken_lines": BROKEN_LINES,
    "base": BASE,
    "der_ocorrencia": DER_OCORRENCIA,
    "der_veiculos": DER_VEICULOS,
    "der_envolvidos": DER_ENVOLVIDOS,
    "der_cond_acidente": DER_COND_ACIDENTE,
    "der_cond_via": DER_COND_VIA,
    "der_embriaguez": DER_EMBRIAGUEZ,
}


def spark_inputs(spark: SparkSession, sf_dir: str, names: list[str]) -> dict[str, DataFrame]:
    """The named inputs; each test table is opened once."""
    texts = {name: INPUTS[name].replace("{quote}", "`") for name in names}
    tables = {
        table: spark.read.parquet(f"{sf_dir}/{table}.parquet")
        for table in TABLES
        if any(f"{{{table}}}" in text for text in texts.values())
    }
    return {
        name: spark.sql(text, **{table: df for table, df in tables.items() if f"{{{table}}}" in text})
        for name, text in texts.items()
    }


def spark_input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark_inputs(spark, sf_dir, [name])[name]


def oracle_input(name: str) -> str:
    """The adapter as the body of a common table expression of the oracle."""
    return INPUTS[name].format(quote='"', **{table: table for table in TABLES})
