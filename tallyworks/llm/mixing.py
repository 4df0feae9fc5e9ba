"""Mixing sources to target weights by repeating documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import SPACED_WORD, fresh, hash_fraction

WEIGHTS = (3, 1, 2)
SHARE = 1.5
LIMIT = 2


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    limit: int = LIMIT,
) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources in code point order, null last, take ``weights`` in turn and divide
    ``share`` times the total. No target exceeds ``limit`` times its source; the
    excess goes to the others by weight. In the order of limit over weight, the
    level that each further capped source leaves rises until the caps stop, then
    falls: its maximum is the common level. One row a source is all that the
    ordered windows see.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(weight) for weight in weights])
    weighted = sources.withColumn(
        "weight", F.element_at(cycle, (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    )
    by_cap = (
        Window.orderBy(
            (F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last()
        ).rowsBetween(Window.unboundedPreceding, -1)
    )
    everything = Window.partitionBy()
    earlier_caps = limit * F.coalesce(F.sum("source_size").over(by_cap), F.lit(0))
    earlier_weights = F.coalesce(F.sum("weight").over(by_cap), F.lit(0))
    level = (share * F.sum("source_size").over(everything) - earlier_caps) / (
        F.sum("weight").over(everything) - earlier_weights
    )
    return (
        weighted.withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .select(
            "source",
            "source_size",
            F.least(
                F.col("weight") * F.col("level"), (limit * F.col("source_size")).cast("double")
            ).alias("target"),
        )
    )


def with_copies(
    documents: DataFrame,
    seed: str = "mix",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    limit: int = LIMIT,
    names: Sequence[str] = ("size", "source_size", "target", "copies"),
) -> DataFrame:
    """Every row of ``documents`` with its size, source_size, target and copies.

    ``copies`` is the floor of the source's rate (target over size) plus one
    more with the probability of its fraction, decided by the hash of seed and
    doc_id, so reruns and repeated rows agree. Where doc_id is null, source and text stand
    for it. A null or blank text has size 0;
    a null source is a source of its own; a source without words gets target 0
    and no copies. Columns that have one of the four ``names`` are replaced. The
    targets are one row a source: Spark broadcasts them if they are below its own
    threshold and otherwise joins by key, splitting a source of too many rows.
    """
    size, source_size, target, copies = names
    rows = documents.drop(*names).withColumn(
        size, F.coalesce(F.regexp_count("text", F.lit(SPACED_WORD)), F.lit(0)).cast("long")
    )
    origin, rate, draw = fresh(rows, "origin", "rate", "draw")
    # drawn before the join, which then moves texts only if the caller wants them
    unnamed = F.concat(
        F.lit(":"), F.coalesce("source", F.lit("")), F.lit(":"), F.coalesce("text", F.lit(""))
    )
    name = F.coalesce(F.col("doc_id").cast("string"), unnamed)
    rows = rows.withColumn(draw, hash_fraction(F.concat(F.lit(f"{seed}:"), name)))
    targets = source_targets(
        rows.select("source", F.col(size).alias("size")), weights, share, limit
    ).select(
        F.col("source").alias(origin),
        F.col("source_size").alias(source_size),
        F.col("target").alias(target),
    )
    rated = F.when(F.col(source_size) > 0, F.col(target) / F.col(source_size)).otherwise(0.0)
    whole = F.floor(rate)
    return (
        rows.join(targets, rows["source"].eqNullSafe(targets[origin]), "left")
        .withColumn(rate, rated)
        .withColumn(copies, (whole + (F.col(draw) < F.col(rate) - whole).cast("int")).cast("int"))
        .drop(origin, rate, draw)
    )


def mix(documents: DataFrame, seed: str = "mix", **settings) -> DataFrame:
    """The mixture itself: each row of ``documents`` as often as it is to be taken."""
    names = fresh(documents, "size", "source_size", "target", "copies", "copy")
    counted = with_copies(documents, seed, names=names[:4], **settings)
    taken = counted.withColumn(names[4], F.explode(F.array_repeat(F.lit(1), F.col(names[3]))))
    return taken.select(*documents.columns)


def mixing_report(documents: DataFrame, seed: str = "mix") -> DataFrame:
    """doc_id, size, source_size, target and the words that the mix takes of it."""
    return with_copies(documents.select("doc_id", "text", "source"), seed).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )
