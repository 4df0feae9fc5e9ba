"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.session import settle

# Links of a file, if there are more than a file for every core holds: starting a file costs a process.
FILE_LINKS = 1 << 20


def stars(links: DataFrame, large: bool) -> DataFrame:
    """One contraction step: each node's neighbours move to the smallest among them.

    The large step moves the neighbours above the node, the small step those below
    it and the node itself. Components stay what they are.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    above = F.col("b") > F.col("a")
    moved = both.where(above if large else ~above).join(lowest, "a").select(
        F.col("low").alias("a"), "b"
    )
    if not large:
        own = lowest.select(F.col("low").alias("a"), F.col("a").alias("b"))
        moved = moved.union(own)
    return moved.where("a < b").distinct()


def component_roots(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches, from links (a, b).

    Alternating large and small star steps need about log2 of the longest path;
    each round is written to shared storage and compared by count and hash sum. From the second
    round on the count tells in how many files.
    Self links, repeated links and both directions are fine; nodes without a link do not appear.
    """
    state = settle(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a < b")
        .distinct(),
        "links",
    )
    mark = None
    while True:
        moved = stars(stars(state, large=True), large=False)
        if mark is not None:
            cores = links.sparkSession.sparkContext.defaultParallelism
            moved = moved.coalesce(max(cores, mark[0] // FILE_LINKS))
        state = settle(moved, "links")
        digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        now = tuple(state.agg(F.count(F.lit(1)), digest).first())
        if now == mark:
            return state.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
                state.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
        mark = now
