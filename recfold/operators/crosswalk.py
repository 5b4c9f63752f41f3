"""Groups of records, their representative, and the record to event crosswalk.

One aggregation per dedup key yields everything a group shares: final id, source list,
representative and event keys. One join brings it back to the records. The representative is
the minimum of a struct ordered by (source rank, record id), which reduces on the map side;
ranking rows inside the group would put a hot group into a single task.

A record whose dedup key is its own id is a group of one, unless that id is also the text of a
cluster or source key. Once ``profile_records`` has shown that no such text exists, these
records, often the majority, are decided where they are read and reach no shuffle.

``id_acidente_unico`` must be unique (``operators.audit.pk_uniqueness`` reports it).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from recfold import config as c
from recfold.config import Skew
from recfold.functions import keys, policy
from recfold.operators.relational import distinct_list
from recfold.operators.skew import HotKeys, hot_keys, spread_join
from recfold.sources.storage import side_by_side


def with_dedup_key(records: DataFrame) -> DataFrame:
    return records.withColumns({
        "target_der_id": policy.relational_target(F.col("fonte_original"), F.col("id_original_fonte")),
        "chave_dedup": policy.dedup_key(),
    })


def _present(source: str) -> Column:
    return F.max(F.when(F.col("fonte_original") == source, 1).otherwise(0))


def group_stats(keyed: DataFrame) -> DataFrame:
    """Final id, presence flags and size per dedup key. The NULL key forms a row as well."""
    return keyed.groupBy("chave_dedup").agg(
        F.min("id_acidente_unico").alias("id_acidente_final"),
        _present(c.SEJUSP).alias("tem_sejusp"),
        _present(c.DER).alias("tem_der"),
        _present(c.WAZE).alias("tem_waze"),
        F.count("*").alias("qtd_registros"),
    )


@dataclass(frozen=True)
class RecordProfile:
    """What one look at the records tells about executing the policy; never about its result."""

    hot: HotKeys
    own_keys_apart: bool


def profile_records(records: DataFrame, skew: Skew = Skew()) -> RecordProfile:
    """Hot dedup keys and relational targets, and whether own-id keys meet no other key."""
    keyed = with_dedup_key(records)
    columns = {name: F.col(name) for name in ("chave_dedup", "target_der_id")}
    return RecordProfile(*side_by_side(lambda: hot_keys(keyed, columns, skew), lambda: _own_keys_apart(keyed)))


def _own_keys_apart(keyed: DataFrame) -> bool:
    """Whether own keys are unique and no other record has them.

    The bare keys are counted; value ranges settle the rest in most cases, else a join of them.
    """
    own, key = policy.keeps_own_key(), F.col("chave_dedup")
    repeated = keyed.filter(own).groupBy("chave_dedup").count().filter("count > 1")
    bounds = keyed.agg(
        F.min(F.when(own, key)).alias("own_low"),
        F.max(F.when(own, key)).alias("own_high"),
        F.min(F.when(~own, key)).alias("shared_low"),
        F.max(F.when(~own, key)).alias("shared_high"),
    ).select(
        F.coalesce(
            (F.col("own_high") < F.col("shared_low")) | (F.col("shared_high") < F.col("own_low")), F.lit(True)
        )
    )
    unique, apart = side_by_side(repeated.isEmpty, lambda: bounds.first()[0])
    if not unique:
        return False
    if apart:
        return True
    shared = keyed.filter(~own).select("chave_dedup").distinct()
    return keyed.filter(own).select("chave_dedup").join(shared, "chave_dedup", "left_semi").isEmpty()


def _grouped_records(records: DataFrame) -> DataFrame:
    """Records that belong to an event, with the traits their treatment depends on."""
    return with_dedup_key(records).filter(F.col("chave_dedup").isNotNull()).withColumns({
        "__own": policy.keeps_own_key(),
        "__isolated": policy.is_isolated(),
        "__yields": policy.yields_to_sejusp(),
    })


def _as_member() -> Column:
    return F.struct(
        policy.source_rank().alias("rank"),
        F.col("id_acidente_unico").alias("id"),
        F.col("fonte_original").alias("fonte"),
        F.col("id_original_fonte").alias("id_original"),
    )


def _event_key(source: Column, source_id: Column) -> Column:
    return F.struct(source.alias("fonte"), keys.occurrence_number(source, source_id).alias("numero"))


_GROUP_COLUMNS = ["id_acidente_final", "tem_sejusp", "fontes_associadas", "rep", "chaves"]


def _groups(keyed: DataFrame) -> DataFrame:
    isolated, yields = F.col("__isolated"), F.col("__yields")
    source, source_id = F.col("fonte_original"), F.col("id_original_fonte")
    groups = keyed.groupBy("chave_dedup").agg(
        F.min("id_acidente_unico").alias("id_acidente_final"),
        _present(c.SEJUSP).alias("tem_sejusp"),
        distinct_list(source).alias("fontes_associadas"),
        F.min(F.when(~isolated, _as_member())).alias("first_any"),
        F.min(F.when(~(isolated | yields), _as_member())).alias("first_ruled"),
        F.collect_set(F.when(isolated, _event_key(source, source_id))).alias("isolated_keys"),
    )
    rep = F.when(F.col("tem_sejusp") == 1, F.col("first_ruled")).otherwise(F.col("first_any"))
    rep_key = _event_key(F.col("rep.fonte"), F.col("rep.id_original"))
    with_rep = groups.withColumn("rep", rep)
    return with_rep.withColumn(
        "chaves",
        F.when(F.col("rep").isNull(), F.col("isolated_keys"))
        .otherwise(F.array_union("isolated_keys", F.array(rep_key))),
    ).select("chave_dedup", *_GROUP_COLUMNS)


def _as_own_group(alone: DataFrame) -> DataFrame:
    """Records that are groups of one, with the columns ``_groups`` would give them."""
    source = F.col("fonte_original")
    return alone.withColumns({
        "id_acidente_final": F.col("id_acidente_unico"),
        "tem_sejusp": F.when(source == c.SEJUSP, 1).otherwise(0),
        "fontes_associadas": source,
        "rep": F.when(~F.col("__isolated"), _as_member()),
        "chaves": F.array(_event_key(source, F.col("id_original_fonte"))),
    })


def event_groups(records: DataFrame, profile: RecordProfile | None = None) -> DataFrame:
    """One row per dedup key with all that its records share.

    ``rep`` is the representative: the group's best record by (source rank, id) among those
    that are not isolated and, beside a SEJUSP record, not mere evidence; NULL if there is none.
    ``chaves`` holds the distinct (source, occurrence number) of the rows that reach the golden
    table: the representative and the isolated records of the group. It stays short, because
    isolated records sharing a group are keyless WAZE records and so all alike.
    """
    keyed = _grouped_records(records)
    if not (profile and profile.own_keys_apart):
        return _groups(keyed)
    alone = _as_own_group(keyed.filter("__own")).select("chave_dedup", *_GROUP_COLUMNS)
    return _groups(keyed.filter("NOT __own")).unionByName(alone)


def annotate(records: DataFrame, profile: RecordProfile | None = None) -> DataFrame:
    """Every record that has a dedup key, with all its columns and what its group decided.

    Columns nobody asks for later are pruned before the shuffle.
    """
    keyed = _grouped_records(records)
    apart = bool(profile and profile.own_keys_apart)
    shared = keyed.filter("NOT __own") if apart else keyed
    members = spread_join(
        shared, _groups(shared), "chave_dedup", "chave_dedup", [F.col("id_acidente_unico")], "inner",
        profile.hot["chave_dedup"] if profile else None,
    )
    if apart:
        members = members.unionByName(_as_own_group(keyed.filter("__own")))
    isolated = F.col("__isolated")

    def inherited(own: str, from_representative: Column) -> Column:
        return F.when(isolated, F.col(own)).otherwise(from_representative)

    return members.withColumns({
        "regra_deduplicacao_final": policy.rule_label(),
        "papel_no_grupo_tmp": policy.provisional_role(isolated, F.col("__yields"), F.col("tem_sejusp") == 1),
        "papel_no_grupo": F.when(isolated, c.ROLE_ISOLATED)
        .when(F.col("id_acidente_unico") == F.col("rep.id"), c.ROLE_REPRESENTATIVE)
        .otherwise(c.ROLE_EVIDENCE),
        "fonte_representante": inherited("fonte_original", F.col("rep.fonte")),
        "id_original_representante": inherited("id_original_fonte", F.col("rep.id_original")),
        "target_der_final": inherited(
            "target_der_id", policy.relational_target(F.col("rep.fonte"), F.col("rep.id_original"))
        ),
    }).drop("tem_sejusp", "rep", "__own", "__isolated", "__yields")


def crosswalk(annotated: DataFrame) -> DataFrame:
    """One row per record: final id, rule, role and the attributes of its representative."""
    return annotated.select(
        "id_acidente_unico", "id_acidente_final", "fonte_original", "arquivo_origem", "id_original_fonte",
        "target_der_id", "flag_duplicidade", "regra_deduplicacao_final", "papel_no_grupo",
        "fonte_representante", "id_original_representante", "target_der_final",
    )


def provisional_crosswalk(annotated: DataFrame) -> DataFrame:
    """The crosswalk before candidates compete inside their group."""
    return annotated.select(
        "id_acidente_unico", "id_acidente_final", "fonte_original", "arquivo_origem", "id_original_fonte",
        "flag_duplicidade", "target_der_id", "regra_deduplicacao_final", "papel_no_grupo_tmp",
    )


def representatives(groups: DataFrame) -> DataFrame:
    """One row per group that has a representative; needs no join back to the records."""
    return groups.filter(F.col("rep").isNotNull()).select(
        "id_acidente_final",
        F.col("rep.fonte").alias("fonte_representante"),
        F.col("rep.id_original").alias("id_original_representante"),
        policy.relational_target(F.col("rep.fonte"), F.col("rep.id_original")).alias("target_der_id"),
    )


def associated_sources(groups: DataFrame) -> DataFrame:
    return groups.select("id_acidente_final", "fontes_associadas")


def attach_crosswalk(records: DataFrame, exported: DataFrame) -> DataFrame:
    """Join records to a crosswalk that was written earlier; both are unique by record id."""
    decided = exported.select(
        "id_acidente_unico", "id_acidente_final", "regra_deduplicacao_final", "papel_no_grupo", "fonte_representante"
    )
    return records.join(decided, "id_acidente_unico")
