"""Parquet inputs and the availability of sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from recfold import config as c


class SourceUnavailable(Exception):
    """A source the job cannot do without is missing or lacks a column."""


class UnreadableSource(Exception):
    """A source whose rows cannot all be told apart; ``profile`` has its files and lines."""

    def __init__(self, message: str, profile: DataFrame):
        super().__init__(message)
        self.profile = profile


def require_columns(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    missing = [column for column in columns if column not in df.columns]
    if missing:
        raise SourceUnavailable(f"FAIL_BLOQUEADO: {name} lacks columns {missing}")
    return df


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All columns of the record table; further columns are kept."""
    return require_columns(spark.read.parquet(path), path, c.BASE_COLUMNS)


def empty_table(spark: SparkSession, columns: list[str]) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"`{column}` string" for column in columns))


def probe(df: DataFrame) -> DataFrame:
    """``df`` after every one of its files was opened, in tasks, so that one that can't be shows here.

    The rows are counted without a column: of a Parquet file that reads the end alone.
    """
    df.agg(F.count("*")).collect()
    return df


def load_child(spark: SparkSession, name: str, read: Callable[[], DataFrame]) -> tuple[DataFrame, bool]:
    """The child table and whether it could be read.

    Any failure to read counts: a missing path, another format, a damaged file, a column that is
    not there. Such an optional table becomes an empty one, so that its attributes come out NULL;
    such a mandatory one stops the job.
    """
    columns = c.CHILD_TABLES[name]
    try:
        return probe(require_columns(read(), name, columns)), True
    except Exception as error:
        if name in c.MANDATORY_TABLES:
            raise SourceUnavailable(f"FAIL_BLOQUEADO: {name} could not be loaded: {error}") from error
        return empty_table(spark, columns), False
