"""Match coverage between golden rows and child tables, and the counters behind the checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from recfold import config as c
from recfold.config import Skew
from recfold.functions import keys
from recfold.functions.keys import filled
from recfold.operators.skew import HotKeys, hot_keys, spread_join

EXACT, ASSOCIATED = "numero_ocorrencia", "numero_ocorrencia_associado"
LOOKED_UP = "numero_ocorrencia_associado_final"
# What the metrics look at.
PROFILED = (
    "fonte_representante", "fontes_associadas", "status_resolucao_possivel", "numero_ocorrencia_final", LOOKED_UP,
)
# Child table and the short name its match flags carry.
AUDITED = {"der_ocorrencia": "oco", "der_veiculos": "vei", "der_envolvidos": "env"}


def distinct_keys(children: dict[str, DataFrame]) -> DataFrame:
    """Distinct trimmed non-blank keys per audited table and kind of key, one scan per table."""
    parts = [
        children[table].select(
            F.lit(table).alias("tabela"),
            F.inline(F.array(*[
                F.struct(F.lit(kind).alias("tipo_chave"), F.trim(F.col(kind)).alias("chave"))
                for kind in (EXACT, ASSOCIATED)
            ])),
        )
        for table in AUDITED
    ]
    return reduce(DataFrame.unionByName, parts).filter(F.col("chave") != "").distinct()


def key_presence(children: dict[str, DataFrame]) -> DataFrame:
    """One row per associated number: the tables it occurs in as such, and those of each full number of its events.

    A number leads to its associated one by losing its suffix, so both kinds of lookup need the
    rows of one associated number only, and a golden row finds them with one key. Tables are bits.
    Rows are first reduced per number, in tasks; a suffix has three digits, so the lists stay short.
    """
    number, associated = F.trim(F.col(EXACT)), F.trim(F.col(ASSOCIATED))
    parts = [
        children[table].select(
            F.lit(1 << bit).alias("tabelas"),
            F.inline(F.array(
                F.struct(associated.alias("chave"), F.lit(False).alias("exata")),
                F.struct(number.alias("chave"), F.lit(True).alias("exata")),
            )),
        )
        for bit, table in enumerate(AUDITED)
    ]
    entries = reduce(DataFrame.unionByName, parts).filter(F.col("chave") != "")
    seen = entries.groupBy("chave", "exata").agg(F.bit_or("tabelas").alias("tabelas"))
    exact = F.col("exata")
    return seen.select(
        F.when(exact, keys.associated_number(F.col("chave"))).otherwise(F.col("chave")).alias("associado"),
        F.when(~exact, F.col("tabelas")).alias("tabelas_assoc"),
        F.when(exact, F.struct(F.col("chave").alias("numero"), "tabelas")).alias("exato"),
    ).groupBy("associado").agg(
        F.max("tabelas_assoc").alias("tabelas_assoc"), F.collect_list("exato").alias("exatos")
    )


def golden_hot_keys(golden: DataFrame, skew: Skew = Skew()) -> HotKeys:
    """Hot keys of golden rows; run it on a written golden table."""
    return hot_keys(golden, {LOOKED_UP: F.col(LOOKED_UP)}, skew)


def audit(
    golden: DataFrame, children: dict[str, DataFrame], hot: HotKeys | None = None, presence: DataFrame | None = None
) -> DataFrame:
    """``golden`` (or its ``event_profile``) plus the eligibility flag and six match flags, all 0/1.

    ``presence`` is ``key_presence(children)`` where that has been written already. Keys are compared trimmed here, while the golden table joined them raw. Golden rows are sent
    once, to where all that is known of their associated number is; those without a number are
    placed by their id.
    """
    number = F.col("numero_ocorrencia_final")
    row = ["id_acidente_final"] if "id_acidente_final" in golden.columns else PROFILED
    found = spread_join(
        golden, key_presence(children) if presence is None else presence, LOOKED_UP, "associado", [F.col(name) for name in row], "left",
        (hot or {}).get(LOOKED_UP),
    )
    eligible = F.col("fonte_representante").isin(c.OFFICIAL_SOURCES) & number.isNotNull()
    mine = F.get(F.filter("exatos", lambda entry: entry["numero"] == number), F.lit(0))["tabelas"]
    found = found.withColumn("tabelas_exato", mine)
    flags = [
        F.coalesce(F.getbit(F.col(f"tabelas_{kind}"), F.lit(bit)).cast("int"), F.lit(0)).alias(f"match_{short}_{kind}")
        for bit, short in enumerate(AUDITED.values()) for kind in ("exato", "assoc")
    ]
    return found.select(*golden.columns, F.when(eligible, 1).otherwise(0).alias("is_elegivel_der"), *flags)


def event_profile(golden: DataFrame) -> DataFrame:
    """Golden rows counted per combination of what the metrics look at.

    Leaves a handful of rows per key, and one for all rows without a key, so that the lookups
    of ``audit`` meet no hot key.
    """
    alone = F.when(F.col("fontes_associadas") == c.WAZE, c.WAZE).alias("fontes_associadas")
    return golden.select(*(alone if name == "fontes_associadas" else F.col(name) for name in PROFILED)).groupBy(
        *PROFILED
    ).agg(F.count("*").alias("eventos"))


def profile_metrics(golden: DataFrame, children: dict[str, DataFrame]) -> DataFrame:
    """``metrics`` of all golden rows, looked up once per combination of what counts."""
    return metrics(audit(event_profile(golden), children), "eventos")


def metrics(audited: DataFrame, weight: str | None = None) -> DataFrame:
    """Formal match metrics in one pass; ``weight`` is the events a row stands for."""
    amount = F.col(weight) if weight else F.lit(1)
    eligible = F.col("is_elegivel_der") == 1

    def matched(short: str) -> Column:
        return (F.col(f"match_{short}_exato") == 1) | (F.col(f"match_{short}_assoc") == 1)

    conditions = {
        "finais_total": F.lit(True),
        "waze_isolado": (F.col("fonte_representante") == c.WAZE) & (F.col("fontes_associadas") == c.WAZE),
        "possivel_isolado": F.col("status_resolucao_possivel") == c.RESOLVED_POSSIBLE,
        "oficiais_der_sejusp": F.col("fonte_representante").isin(c.OFFICIAL_SOURCES),
        "com_numero_ocorrencia_final": F.col("numero_ocorrencia_final").isNotNull(),
        "com_numero_ocorrencia_associado_final": F.col("numero_ocorrencia_associado_final").isNotNull(),
    }
    tables = {"oco": "ocorrencia", "vei": "veiculos", "env": "envolvidos"}
    for short, table in tables.items():
        conditions[f"match_der_{table}_por_numero_ocorrencia"] = F.col(f"match_{short}_exato") == 1
        conditions[f"match_der_{table}_por_numero_ocorrencia_associado"] = F.col(f"match_{short}_assoc") == 1
    for short, table in tables.items():
        conditions[f"sem_match_der_{table}"] = eligible & ~matched(short)
    for short, table in (("oco", "ocorrencia"), ("vei", "veiculos")):
        conditions[f"sem_envolvidos_mas_com_{table}_der"] = eligible & matched(short) & ~matched("env")
    totals = {f"n_eventos_{name}": condition for name, condition in conditions.items()}
    totals["n_universo_elegivel_der"] = eligible
    return audited.agg(*[
        F.coalesce(F.sum(F.when(condition, amount).otherwise(0)), F.lit(0)).cast("long").alias(name)
        for name, condition in totals.items()
    ])


def rates(metric_row: DataFrame) -> DataFrame:
    """``metric_row`` plus coverage rates over the eligible events, in percent."""
    universe = F.col("n_universo_elegivel_der").cast("double")

    def rate(table: str) -> Column:
        found = universe - F.col(f"n_eventos_sem_match_der_{table}")
        return F.when(universe > 0, F.round(F.lit(100.0) * found / universe, 4)).otherwise(F.lit(0.0))

    return metric_row.withColumns({
        "taxa_match_der_ocorrencia_universo_elegivel": rate("ocorrencia"),
        "taxa_match_der_veiculos_universo_elegivel": rate("veiculos"),
        "taxa_match_der_envolvidos_universo_elegivel": rate("envolvidos"),
        "taxa_cobertura_envolvidos_universo_elegivel": rate("envolvidos"),
        "nota_metrica_envolvidos": F.lit(c.COVERAGE_NOTE),
    })


def merge_totals(parts: list[DataFrame]) -> DataFrame:
    """One-row frames of counts side by side in one row."""
    stacked = reduce(lambda above, below: above.unionByName(below, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def record_counters(records: DataFrame) -> DataFrame:
    flag = F.col("flag_duplicidade")
    return records.agg(
        F.count("*").alias("n_entrada"),
        F.count_if(flag == c.STRONG).alias("n_forte_entrada"),
        F.count_if(flag == c.POSSIBLE).alias("n_possivel_entrada"),
    )


def distinct_count(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct values of a column, as a row: of the table only this column is read and sent, each value once."""
    return df.select(column).distinct().agg(F.count(column).alias(name))


def crosswalk_counters(crosswalk: DataFrame) -> DataFrame:
    flag, rule = F.col("flag_duplicidade"), F.col("regra_deduplicacao_final")
    waze = (F.col("fonte_original") == c.WAZE) & (flag != c.STRONG)
    return crosswalk.agg(
        F.count("*").alias("n_crosswalk"),
        F.count_if(flag == c.STRONG).alias("n_forte_saida"),
        F.count_if((flag == c.POSSIBLE) & (rule == c.RULE_POSSIBLE)).alias("n_possivel_regra_ok"),
        F.count_if(waze).alias("n_waze_nao_forte"),
        F.count_if(waze & (rule == c.RULE_WAZE)).alias("n_waze_regra_ok"),
    )


def golden_counters(golden: DataFrame) -> DataFrame:
    official = F.col("fonte_representante").isin(c.OFFICIAL_SOURCES)
    return golden.agg(
        F.count("*").alias("n_final"),
        F.count_if(official & F.col("numero_ocorrencia_final").isNotNull()).alias("n_chave_elegivel_com_fisica"),
        F.count_if(official).alias("n_chave_elegivel_total"),
        F.count("numero_ocorrencia_final").alias("n_com_numero"),
        F.count("numero_ocorrencia_associado_final").alias("n_com_numero_associado"),
        F.count_if(filled(F.col("origem_chave_ocorrencia_final"))).alias("n_com_origem"),
        F.count_if(filled(F.col("status_chave_ocorrencia_final"))).alias("n_com_status"),
        F.count_if(F.col("rodovia").isNotNull() | F.col("severidade").isNotNull()).alias("n_rodovia_severidade"),
        F.coalesce(F.sum("qtde_veiculos_envolvidos"), F.lit(0)).alias("n_veiculos"),
        F.coalesce(F.sum("qtde_envolvidos_total"), F.lit(0)).alias("n_envolvidos"),
    )


def counters(records: DataFrame, crosswalk: DataFrame, golden: DataFrame) -> DataFrame:
    """Policy and uniqueness counters; run it on written tables, of which each part reads its own columns."""
    return merge_totals(_counter_parts(records, crosswalk, golden))


def _counter_parts(records: DataFrame, crosswalk: DataFrame, golden: DataFrame) -> list[DataFrame]:
    return [
        record_counters(records),
        crosswalk_counters(crosswalk),
        distinct_count(crosswalk, "id_acidente_unico", "n_crosswalk_ids"),
        golden_counters(golden),
        distinct_count(golden, "id_acidente_final", "n_final_ids"),
    ]


def facts(
    records: DataFrame, crosswalk: DataFrame, golden: DataFrame, aggregates: DataFrame, children: dict[str, DataFrame]
) -> DataFrame:
    """All counters, metrics and rates in one row, as the checks need them."""
    return rates(merge_totals([
        *_counter_parts(records, crosswalk, golden),
        children["der_ocorrencia"].agg(F.count("*").alias("n_ocorrencias")),
        aggregates.agg(F.count("*").alias("n_agregados")),
        profile_metrics(golden, children),
    ]))


def pk_uniqueness(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and exact distinct keys per table; ``unica`` is 1 where they agree."""
    parts = [
        df.agg(
            F.lit(name).alias("tabela"), F.count("*").alias("n_linhas"), F.countDistinct(key).alias("n_chaves")
        )
        for name, (df, key) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts).withColumn(
        "unica", F.when(F.col("n_linhas") == F.col("n_chaves"), 1).otherwise(0)
    )
