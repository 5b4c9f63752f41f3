"""Output files. Every writer leaves a folder of part files, one per task."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    df.write.mode("overwrite").parquet(path, partitionBy=partition_by)


def write_csv(df: DataFrame, path: str) -> None:
    """Comma, header in every part file; NULL is empty, the empty text is quoted, and blanks at
    either end of a value stay. ``sources.delimited.read_exact_csv`` reads all of it back."""
    df.write.mode("overwrite").options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, lineSep="\n"
    ).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One object per line; NULL fields are kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
