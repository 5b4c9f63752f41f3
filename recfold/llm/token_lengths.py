"""Exact histogram of encoded lengths, and what its suffix sums answer for every context limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from recfold.llm.bpe import lengths
from recfold.llm.rows import stored

_BLOCK = 4096


def histogram(docs: DataFrame, path: str) -> DataFrame:
    """``n_tokens``, ``n_docs``: how many rows of ``docs`` encode to each length (NULL and empty: 0)."""
    rows = lengths(docs.select(F.col("text").cast("string").alias("text")), path).select("n_tokens")
    return rows.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(counts: DataFrame) -> DataFrame:
    """A row per length as a limit: what is at least as long, what cutting there leaves, and the quantile.

    ``docs_from``, ``tokens_from``: documents of at least ``n_tokens`` and their tokens;
    ``truncated_tokens``: all tokens left if every document is cut to ``n_tokens``;
    ``quantile``: the share of documents of at most that length. For a limit between two lengths,
    take the next longer row: its documents and their tokens are the same. Blocks of lengths are
    summed first, then the lengths in each block, so no task holds all lengths. An empty table
    gives no rows.
    """
    counts = stored(counts.withColumn("block", F.floor(F.col("n_tokens") / _BLOCK)), "histogram")
    tokens = (F.col("n_docs") * F.col("n_tokens")).alias("tokens")
    blocks = counts.select("block", "n_docs", tokens).groupBy("block").agg(
        F.sum("n_docs").alias("docs"), F.sum("tokens").alias("tokens")
    )
    # One row per 4,096 lengths.
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    all_blocks = Window.partitionBy()
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("docs").over(all_blocks).alias("all_docs"),
        F.sum("tokens").over(all_blocks).alias("all_tokens"),
    )
    within = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    sums = counts.select(
        "block", "n_tokens", "n_docs", F.sum("n_docs").over(within).alias("docs"),
        F.sum(F.col("n_docs") * F.col("n_tokens")).over(within).alias("tokens"),
    ).join(blocks, "block")
    docs_from, tokens_from = F.col("docs") + F.col("later_docs"), F.col("tokens") + F.col("later_tokens")
    return sums.select(
        "n_tokens", "n_docs", docs_from.alias("docs_from"), tokens_from.alias("tokens_from"),
        (F.col("all_tokens") - tokens_from + docs_from * F.col("n_tokens")).alias("truncated_tokens"),
        ((F.col("all_docs") - docs_from + F.col("n_docs")) / F.col("all_docs")).alias("quantile"),
    )


def at_limits(sums: DataFrame, limits: DataFrame) -> DataFrame:
    """``limit``, ``docs_cut``, ``total_tokens`` for each context limit in ``limits`` (``limit``), once each.

    ``docs_cut`` counts documents longer than the limit, ``total_tokens`` what all documents give
    when cut to it. Both follow from the suffix sums of the next longer length: its documents are
    those that are cut, all other tokens stay. That length is looked for in the limit's block of
    lengths, else it is the first one of the next block that has any. A limit below zero counts as
    zero; a NULL limit is left out. Without documents both are 0.
    """
    wanted = limits.select(F.col("limit").cast("long").alias("limit")).filter("limit is not null").distinct()
    wanted = wanted.select("limit", F.greatest("limit", F.lit(0)).alias("cut"))
    wanted = wanted.withColumn("block", F.floor(F.col("cut") / _BLOCK))
    rows = sums.select(
        F.floor(F.col("n_tokens") / _BLOCK).alias("block"), F.struct("n_tokens", "docs_from", "tokens_from").alias("row")
    )
    first = rows.groupBy("block").agg(F.min("row").alias("row"))
    # One row per limit and per 4,096 lengths; the limits of a block come before its own row.
    later = Window.orderBy(F.desc("block"), F.col("row").isNotNull()).rowsBetween(Window.unboundedPreceding, -1)
    lined = wanted.select("block", "limit", F.lit(None).cast(first.schema["row"].dataType).alias("row")).unionByName(
        first.select("block", F.lit(None).cast("long").alias("limit"), "row")
    )
    beyond = lined.withColumn("beyond", F.last("row", ignorenulls=True).over(later)).filter("limit is not null").select(
        "limit", "beyond"
    )
    within = wanted.join(rows, "block").filter(F.col("row.n_tokens") > F.col("cut")).groupBy("limit").agg(
        F.min("row").alias("within")
    )
    all_tokens = sums.agg(F.max("tokens_from")).first()[0] or 0
    found = wanted.join(within, "limit", "left").join(beyond, "limit", "left").withColumn("row", F.coalesce("within", "beyond"))
    docs, tokens = (F.coalesce(F.col(f"row.{name}"), F.lit(0)) for name in ("docs_from", "tokens_from"))
    return found.select(
        "limit", docs.alias("docs_cut"), (F.lit(all_tokens) - tokens + docs * F.col("cut")).alias("total_tokens")
    )


def at_quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """``share``, ``n_tokens``: the smallest length that at least such a share of documents don't exceed.

    A share above one, or any share without documents, has no row; each share is answered once.
    """
    every = F.explode(F.array_distinct(F.array(*map(F.lit, shares)))).alias("share")
    return sums.select("n_tokens", "quantile", every).filter("quantile >= share").groupBy("share").agg(
        F.min("n_tokens").alias("n_tokens")
    )
