"""Child tables aggregated per occurrence.

Every aggregate is reduced on the map side before its single shuffle, so a key that holds a
large share of a child table costs one partial row per task.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from recfold import config as c
from recfold.config import Skew
from recfold.operators.skew import hot_keys

KEY = "numero_ocorrencia"


def distinct_list(column: Column) -> Column:
    """Sorted distinct values joined by a comma; NULL when the group has none."""
    values = F.collect_set(column)
    return F.when(F.size(values) > 0, F.array_join(F.sort_array(values), ", "))


def contains_any(column: Column, marks: list[str]) -> Column:
    return reduce(or_, [column.contains(mark) for mark in marks])


def _count_where(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def vehicle_aggregates(vehicles: DataFrame) -> DataFrame:
    return vehicles.groupBy(KEY).agg(
        F.count("*").alias("qtde_veiculos_envolvidos"),
        distinct_list(F.col("tipo_veiculo_descricao_longa")).alias("tipos_veiculos_envolvidos"),
    )


def involved_aggregates(involved: DataFrame) -> DataFrame:
    """The categories overlap: one row may count as fatal and as injured."""
    state = F.col("condicao_fisica_descricao")
    return involved.groupBy(KEY).agg(
        F.count("*").alias("qtde_envolvidos_total"),
        _count_where(contains_any(state, c.FATAL_MARKS)).alias("qtde_vitimas_fatais"),
        _count_where(contains_any(state, c.INJURED_MARKS)).alias("qtde_vitimas_feridas"),
        _count_where(contains_any(state, c.UNHURT_MARKS)).alias("qtde_ilesos"),
    )


def _condition_parts(accident: DataFrame, road: DataFrame, sobriety: DataFrame) -> list[DataFrame]:
    """Each condition table reduced to one row per key, before any join multiplies rows."""
    lighting = F.concat("luminosidade_descricao", F.lit(" / "), "condicao_sinalizacao_descricao")
    surface = F.concat("BURACOS", F.lit(" / "), F.col("`MATERIAL NA PISTA`"))
    return [
        accident.groupBy(KEY).agg(F.max(lighting).alias("condicoes_acidente")),
        road.groupBy(KEY).agg(F.max(surface).alias("condicoes_via")),
        sobriety.groupBy(KEY).agg(F.max("sintoma_embriaguez_descricao").alias("indicador_embriaguez")),
    ]


def _join_all(left: DataFrame, parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda joined, part: joined.join(part, KEY, "left"), parts, left)


def condition_aggregates(
    occurrences: DataFrame, accident: DataFrame, road: DataFrame, sobriety: DataFrame
) -> DataFrame:
    """One row per distinct occurrence key."""
    return _join_all(occurrences.select(KEY).distinct(), _condition_parts(accident, road, sobriety))


def repeats_heavily(occurrences: DataFrame, skew: Skew = Skew()) -> bool:
    """Whether some key, NULL included, has more occurrence rows than one task should emit."""
    return hot_keys(occurrences, {KEY: F.coalesce(F.col(KEY), F.lit("\0"))}, skew)[KEY] is not None


def occurrence_aggregates(
    children: dict[str, DataFrame], heavy: bool = False, skew: Skew = Skew()
) -> DataFrame:
    """One row per occurrence **row**, with the aggregates of all child tables.

    The output depends on the key alone, so equal occurrence rows are counted first, joined
    once per key and repeated afterwards. All joins share the partitioning by key: six inputs,
    six shuffles, no further one, and no join ever sees a key twice. ``heavy`` spreads the
    repeated rows of a key over tasks (see ``repeats_heavily``).
    """
    keyed = children["der_ocorrencia"].groupBy(KEY).agg(F.count("*").alias("__copies"))
    joined = _join_all(
        keyed,
        [
            vehicle_aggregates(children["der_veiculos"]),
            involved_aggregates(children["der_envolvidos"]),
            *_condition_parts(
                children["der_cond_acidente"], children["der_cond_via"], children["der_embriaguez"]
            ),
        ],
    )

    def count(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0))

    result = joined.select(
        KEY,
        count("qtde_veiculos_envolvidos").cast("int").alias("qtde_veiculos_envolvidos"),
        "tipos_veiculos_envolvidos",
        count("qtde_envolvidos_total").cast("int").alias("qtde_envolvidos_total"),
        (count("qtde_vitimas_fatais") + count("qtde_vitimas_feridas")).cast("int").alias("qtde_vitimas_total"),
        count("qtde_vitimas_fatais").cast("int").alias("qtde_vitimas_fatais"),
        count("qtde_vitimas_feridas").cast("int").alias("qtde_vitimas_feridas"),
        count("qtde_ilesos").cast("int").alias("qtde_ilesos"),
        "condicoes_acidente",
        "condicoes_via",
        "indicador_embriaguez",
        "__copies",
    )
    return _repeat_rows(result, heavy, skew.rows_per_task)


def _repeat_rows(df: DataFrame, heavy: bool, rows_per_task: int) -> DataFrame:
    """Each row ``__copies`` times, at most ``rows_per_task`` of them from one row of a task."""
    copies = F.col("__copies")
    if heavy:
        last = F.expr(f"(__copies - 1) div {rows_per_task}")
        df = (
            df.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
            .repartition(KEY, "__chunk")
            .withColumn("__copies", F.least(copies - F.col("__chunk") * rows_per_task, F.lit(rows_per_task)))
            .drop("__chunk")
        )
    return df.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), copies))).drop("__copy", "__copies")
