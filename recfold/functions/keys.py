"""Canonical occurrence keys as column expressions over (source, source id)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from recfold import config as c


def occurrence_number(source: Column, source_id: Column) -> Column:
    """Trimmed id of an official source; NULL when it is missing, blank or the text ``NaN``.

    ``NaN`` is compared before trimming, blank after it.
    """
    usable = source.isin(c.OFFICIAL_SOURCES) & (F.trim(source_id) != "") & (source_id != c.MISSING_ID)
    return F.when(usable, F.trim(source_id))


def associated_number(number: Column) -> Column:
    """The number without its ``-NNN`` suffix; unchanged when it has none."""
    return F.regexp_replace(number, c.SUFFIX_PATTERN, "")


def key_origin(source: Column, number: Column) -> Column:
    return (
        F.when(source == c.WAZE, c.ORIGIN_WAZE)
        .when(number.isNull(), c.ORIGIN_OTHER)
        .when(source == c.SEJUSP, c.ORIGIN_SEJUSP)
        .otherwise(c.ORIGIN_DER)
    )


def key_status(source: Column, number: Column) -> Column:
    return (
        F.when(source == c.WAZE, c.STATUS_WAZE)
        .when(number.isNotNull(), c.STATUS_ACTIVE)
        .when(source.isin(c.OFFICIAL_SOURCES), c.STATUS_ABSENT)
        .otherwise(c.STATUS_OTHER)
    )


def filled(column: Column) -> Column:
    """Neither NULL nor blank. NULL-safe: always true or false."""
    return F.coalesce(F.trim(column) != "", F.lit(False))
