"""Connected components of a table of links, by contraction in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recfold.llm.rows import stored


def connected_components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of ``links`` (two integer columns ``a``, ``b``).

    Each round maps every node to the neighbour, or itself, that comes first in an order drawn
    anew for the round, and links the images; no links left means one image per component. A
    drawn order shortens long chains by a constant share, so the rounds grow with the logarithm
    of the longest one. Every round's tables are written to the shared folder. Nodes, links and
    maps stay distributed; a node with very many links reduces on the map side first, and its
    join is one that Spark can split.
    """
    links = stored(links.filter("a != b").select("a", "b").distinct(), "links")
    if links.isEmpty():
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    maps = []
    while not links.isEmpty():
        order = F.lit(len(maps))
        ends = links.union(links.select("b", "a"))
        nearest = F.min(F.struct(F.xxhash64("b", order).alias("drawn"), F.col("b").alias("to")))
        own = F.struct(F.xxhash64("a", order).alias("drawn"), F.col("a").alias("to"))
        step = ends.groupBy("a").agg(nearest.alias("nearest")).select(
            F.col("a").alias("node"), F.least("nearest", own)["to"].alias("root")
        )
        step = stored(step, "step")
        maps.append(step)
        moved = (
            links.join(step.select(F.col("node").alias("a"), F.col("root").alias("low_a")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("root").alias("low_b")), "b")
            .filter("low_a != low_b")
            .select(F.least("low_a", "low_b").alias("a"), F.greatest("low_a", "low_b").alias("b"))
            .distinct()
        )
        links = stored(moved, "links")
    roots = maps.pop()
    while maps:
        later = roots.select(F.col("node").alias("root"), F.col("root").alias("last"))
        roots = stored(
            maps.pop().join(later, "root", "left").select("node", F.coalesce("last", "root").alias("root")), "roots"
        )
    return roots
