"""Survivorship policy as column expressions over one source record."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from recfold import config as c


def has_source_id() -> Column:
    """The looser of two notions of "has a key": blank text counts, NULL and ``NaN`` do not."""
    source_id = F.col("id_original_fonte")
    return source_id.isNotNull() & (source_id != c.MISSING_ID)


def relational_target(source: Column, source_id: Column) -> Column:
    """Key under which the child tables know the record."""
    return F.when(source.isin(c.OFFICIAL_SOURCES), source_id)


def keeps_own_key() -> Column:
    """True or false: the record's dedup key is its own id."""
    return F.coalesce(
        (F.col("fonte_original") == c.WAZE) | (F.col("flag_duplicidade") == c.POSSIBLE) | ~has_source_id(),
        F.lit(False),
    ) & ~F.col("flag_duplicidade").eqNullSafe(c.STRONG)


def dedup_key() -> Column:
    """Key whose equal values make records one event.

    A NULL result (strong record without a cluster, or an id without a source) means the
    record belongs to no event.
    """
    return (
        F.when(F.col("flag_duplicidade") == c.STRONG, F.col("id_cluster_duplicidade"))
        .when(keeps_own_key(), F.col("id_acidente_unico"))
        .otherwise(F.concat("fonte_original", F.lit("_"), "id_original_fonte"))
    )


def rule_label() -> Column:
    """Name of the rule that decided the record. WAZE is looked at before the strong flag,
    unlike in ``dedup_key``."""
    return (
        F.when(F.col("fonte_original") == c.WAZE, c.RULE_WAZE)
        .when(F.col("flag_duplicidade") == c.STRONG, c.RULE_STRONG)
        .when(F.col("flag_duplicidade") == c.POSSIBLE, c.RULE_POSSIBLE)
        .when(has_source_id(), c.RULE_SOURCE_ID)
        .otherwise(c.RULE_NO_KEY)
    )


def is_isolated() -> Column:
    """True or false, never NULL. A keyless record with a NULL flag is not isolated."""
    return F.coalesce(
        (F.col("fonte_original") == c.WAZE)
        | (F.col("flag_duplicidade") == c.POSSIBLE)
        | ((F.col("flag_duplicidade") != c.STRONG) & ~has_source_id()),
        F.lit(False),
    )


def yields_to_sejusp() -> Column:
    """True for a strong record that is only evidence once its group holds a SEJUSP record."""
    return F.coalesce(
        (F.col("flag_duplicidade") == c.STRONG) & (F.col("fonte_original") != c.SEJUSP), F.lit(False)
    )


def provisional_role(isolated: Column, yields: Column, group_has_sejusp: Column) -> Column:
    return (
        F.when(isolated, c.ROLE_ISOLATED)
        .when(yields & group_has_sejusp, c.ROLE_EVIDENCE)
        .otherwise(c.ROLE_CANDIDATE)
    )


def source_rank() -> Column:
    return F.when(F.col("fonte_original") == c.SEJUSP, 1).otherwise(2)
