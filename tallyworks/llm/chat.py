"""Chat formatting: collapse of cumulative snapshots, then rendering."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.session import settle

# Turns that are rendered in one piece.
BLOCK = 256
# Code points of a text that decide to which part a turn goes; the rest orders turns inside it.
OPENING = 32
TURN = ("<|im_start|>", "\n", "<|im_end|>\n")


def fewer_copies(turns: DataFrame) -> DataFrame:
    """One of equal rows of a batch, so that a row repeated without end is not shuffled whole."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            yield from rows.group_by(rows.column_names).aggregate([]).to_batches()

    return turns.mapInArrow(combine, turns.schema)


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, part, at, role, text, hash_1, hash_2): distinct turns of all conversations in order.

    ``conv`` wraps the conv_id, so that a missing one is a key like any other. Turns are
    dealt to parts by ranges of (conv_id, turn, role, opening of the text) and numbered by
    ``at`` in that order, so a conversation of any length spreads over parts, and a part
    shares at most two conversations with others.
    """
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # Only openings are sampled for the ranges, so no whole text meets the driver.
    dealt = fewer_copies(rows).withColumn("opening", F.substring("text", 1, OPENING))
    sorted_rows = (
        dealt.repartitionByRange("conv_id", "turn", "role", "opening")
        .distinct()
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .withColumn("at", F.monotonically_increasing_id())
    )
    return sorted_rows.select(
        F.struct("conv_id").alias("conv"),
        F.shiftright("at", 33).alias("part"),
        "at",
        "role",
        "text",
        *(F.xxhash64(F.lit(salt), "role", "text").alias(f"hash_{salt}") for salt in (1, 2)),
    )


def carried(turns: DataFrame, values: dict[str, Column]) -> DataFrame:
    """(conv, part, before_x, all_x): sums of earlier parts and of all, where there are several.

    At most two rows a part: only the conversations at its two ends reach beyond it.
    """
    sums = turns.groupBy("conv", "part").agg(*(F.sum(value).alias(name) for name, value in values.items()))
    whole = Window.partitionBy("conv")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = [
        total
        for name in values
        for total in (
            F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"before_{name}"),
            F.sum(name).over(whole).alias(f"all_{name}"),
        )
    ]
    parts = F.count(F.lit(1)).over(whole).alias("parts")
    return sums.select("conv", "part", *totals, parts).where("parts > 1").drop("parts")


def with_prefix_hashes(turns: DataFrame) -> DataFrame:
    """Turns without texts: place (from 1), turns (in all), two rolling hashes of the prefix they end.

    A turn's hash holds its place, role and text, and a prefix's hash is the sum
    of its turns', twice with different salts: equal prefixes have equal sums,
    and others differ but for a chance of about 2^-128. Sums run inside a part and start where
    the earlier parts of a conversation end; those starts, two a part at most, are broadcast.
    """
    here = Window.partitionBy("conv", "part")
    so_far = here.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = turns.select("conv", "part", "at", "hash_1", "hash_2")
    starts = F.broadcast(carried(rows, {"turn": F.lit(1)}))
    placed = rows.withColumn("seen", F.row_number().over(here.orderBy("at")).cast("long")).withColumn(
        "here", F.count(F.lit(1)).over(here)
    )
    placed = placed.join(starts, ["conv", "part"], "left").select(
        "conv",
        "part",
        "at",
        (F.col("seen") + F.coalesce("before_turn", F.lit(0))).alias("place"),
        F.coalesce("all_turn", "here").alias("turns"),
        F.col("all_turn").isNotNull().alias("split"),
        "hash_1",
        "hash_2",
    )
    # Wide numbers, so that sums of 64-bit hashes stay exact.
    hashes = {
        f"prefix_{salt}": F.xxhash64(F.lit(salt), "place", f"hash_{salt}").cast("decimal(38,0)")
        for salt in (1, 2)
    }
    summed = placed.select("*", *(F.sum(value).over(so_far).alias(name) for name, value in hashes.items()))
    starts = F.broadcast(carried(placed, hashes))
    return summed.join(starts, ["conv", "part"], "left").select(
        "conv",
        "part",
        "at",
        "place",
        "turns",
        "split",
        *((F.col(name) + F.coalesce(f"before_{name}", F.lit(0))).alias(name) for name in hashes),
    )


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """(conv) of the conversations that are no proper prefix of another.

    Of equal conversations the smallest conv_id stays. Prefixes collapse before they
    are shuffled, so a first turn that many conversations share is one row.
    """
    key = ["place", "prefix_1", "prefix_2"]
    whole = F.col("place") == F.col("turns")
    finals = prefixes.where(whole).groupBy(*key).agg(F.min("conv.conv_id").alias("conv_id"))
    inner = prefixes.where(~whole).select(*key).distinct()
    return finals.join(inner, key, "left_anti").select(F.struct("conv_id").alias("conv"))


def render(turns: DataFrame, prefixes: DataFrame, kept: DataFrame) -> DataFrame:
    """(conv_id, part, n_turns, rendered): each kept conversation in parts of BLOCK turns.

    The parts of a conversation, joined in order, are its text; a conversation of
    any length fits because none is gathered whole. Texts move once; only pieces of conversations
    that lie in several parts move again.
    """
    opening, middle, closing = (F.lit(mark) for mark in TURN)
    line = F.concat(opening, "role", middle, "text", closing)
    stretches = prefixes.groupBy("conv", "part").agg(
        F.min("at").alias("first_at"),
        F.min("place").alias("first_place"),
        F.first("turns").alias("n_turns"),
        F.first("split").alias("split"),
    )
    place = F.col("at") - F.col("first_at") + F.col("first_place")
    pieces = (
        turns.select("conv", "part", "at", line.alias("line"))
        .join(stretches.join(kept, "conv"), ["conv", "part"])
        .select("conv", "part", "n_turns", "split", place.alias("place"), "line")
        .groupBy("conv", "part", F.floor((F.col("place") - 1) / BLOCK).cast("long").alias("block"))
        .agg(
            F.first("n_turns").alias("n_turns"),
            F.first("split").alias("split"),
            F.sort_array(F.collect_list(F.struct("place", "line"))).alias("lines"),
        )
    )
    joined = (
        pieces.where("split")
        .groupBy("conv", "block")
        .agg(
            F.first("n_turns").alias("n_turns"),
            F.sort_array(F.flatten(F.collect_list("lines"))).alias("lines"),
        )
    )
    shape = ["conv", "block", "n_turns", "lines"]
    return (
        pieces.where("NOT split")
        .select(*shape)
        .unionByName(joined.select(*shape))
        .select(
            "conv.conv_id",
            F.col("block").alias("part"),
            F.col("n_turns").cast("long").alias("n_turns"),
            F.array_join("lines.line", "").alias("rendered"),
        )
    )


def format_chats(conversations: DataFrame) -> DataFrame:
    """Renders the conversations that are not logged again as the start of a longer one.

    Turns follow each other by turn number (null first), then role and text;
    repeated rows count once; null roles and texts count as empty; rows without
    a conv_id are one conversation without a name. Texts of any length are rendered whole; an
    empty table has no rows. Columns beside conv_id, turn, role and text are not read.
    """
    turns = settle(ordered_turns(conversations), "turns")
    prefixes = settle(with_prefix_hashes(turns), "prefixes")
    return render(turns, prefixes, maximal_conversations(prefixes))
