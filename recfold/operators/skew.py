"""Joins that stay balanced when one key, or NULL, holds a large share of the rows."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

from recfold.config import Skew
from recfold.sources.storage import materialise, scratch_dir

_MERGE_GROUPS = 256
# What a summary can track in Spark, and the keys it then tells apart for certain. Beyond
# 250,000 hot keys the limit rises with the rows, to a share of 1 / 250,000.
_LEAST_TRACKED, _MOST_TRACKED, _MOST_KEYS = 4_096, 1_000_000, 250_000
# Per key column: a written table of keys (``chave``), their estimated rows (``linhas``) and the
# number of salts they are split into (``sais``), or None where no key is hot.
HotKeys = dict[str, DataFrame | None]


def hot_keys(df: DataFrame, columns: dict[str, Column], skew: Skew) -> HotKeys:
    """Keys holding more than ``skew.rows_per_task`` rows, with the salts to split them into.

    A frequency summary per column and no shuffle of the keys. Its size follows from the number
    of rows: at most ``rows / rows_per_task`` keys can be above the limit, the summary tracks
    several times as many, and all that it finds are listed. Each task's summaries merge in a
    first layer of groups and those in one row, so that no task receives the summaries of all.

    The list is a table, however long; the driver sees how many keys each column has. It only
    decides how rows are spread: a key that is missed or listed needlessly changes no join result.
    """
    rows = df.count()
    if not rows:
        return dict.fromkeys(columns)
    limit = max(skew.rows_per_task, ceil(rows / _MOST_KEYS))
    most = rows // limit + 1
    tracked = min(_MOST_TRACKED, max(_LEAST_TRACKED, 4 * most))
    keys = df.select(*[column.cast("string").alias(name) for name, column in columns.items()])
    layer = keys.groupBy(F.pmod(F.spark_partition_id(), F.lit(_MERGE_GROUPS)).alias("__layer")).agg(*[
        F.expr(f"approx_top_k_accumulate(`{name}`, {tracked})").alias(name) for name in columns
    ])
    # In one partition: Spark can't combine summaries in a task that has none.
    summary = layer.repartition(1).agg(*[
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(`{name}`, {tracked}), {most})").alias(name)
        for name in columns
    ])

    def entries(name: str) -> Column:
        listed = F.transform(name, lambda entry: F.struct(
            F.lit(name).alias("coluna"), entry["item"].alias("chave"), entry["count"].alias("linhas")
        ))
        return F.coalesce(F.filter(listed, lambda e: e["chave"].isNotNull() & (e["linhas"] > limit)), F.array().cast(
            "array<struct<coluna:string,chave:string,linhas:bigint>>"
        ))

    # Salts to a power of two, at least two: each key by its own count.
    salts = F.greatest(F.lit(2), F.pow(F.lit(2), F.ceil(F.log2(F.ceil(F.col("linhas") / skew.rows_per_task))))).cast("int")
    found = summary.select(F.inline(F.flatten(F.array(*map(entries, columns))))).withColumn("sais", salts)
    found = materialise(found, f"{scratch_dir(df.sparkSession)}/hot_keys")
    some = {row[0] for row in found.select("coluna").distinct().collect()}
    return {name: found.filter(F.col("coluna") == name).drop("coluna") if name in some else None for name in columns}


def spread_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread: list[Column],
    how: str = "left",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join on ``left_key = right_key``, keeping every column of both sides but ``right_key``.

    ``spread`` are left columns that tell apart rows of equal key. NULL keys match nothing, so
    in a left join such a row is hashed by ``spread`` instead of by its key, and the second
    join condition keeps the stand-in from matching. Rows of a hot key are split into salts
    and the matching right rows are repeated once per salt; both sides learn the salts by a join
    with the list of hot keys, which Spark broadcasts if its size allows.
    """
    key, other = F.col(left_key), F.col("__right_key")
    right = right.withColumnRenamed(right_key, "__right_key")
    stand_in = F.xxhash64(*spread)
    if how == "inner":
        condition = key == other
    else:
        condition = (F.coalesce(key, stand_in.cast("string")) == other) & key.isNotNull()
    if hot is not None:
        def salted(df: DataFrame, name: str) -> DataFrame:
            listed = hot.select(F.col("chave").alias("__hot"), F.col("sais").alias("__salts"))
            return df.join(listed, F.col(name) == F.col("__hot"), "left").drop("__hot").withColumn(
                "__salts", F.coalesce("__salts", F.lit(1))
            )

        left = salted(left, left_key).withColumn("__salt", F.pmod(stand_in, F.col("__salts")).cast("int")).drop("__salts")
        right = salted(right, "__right_key").withColumn(
            "__right_salt", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1))
        ).drop("__salts")
        condition = condition & (F.col("__salt") == F.col("__right_salt"))
    return left.join(right, condition, how).drop("__right_key", "__salt", "__right_salt")
