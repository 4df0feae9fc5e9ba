"""Phrase collocations: shards mined at lowered support, their frequent phrases counted exactly."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.session import settle

SUPPORT = 10
LONGEST = 3
# A longer phrase with this share of a phrase's occurrences, in per cent, replaces it.
COVERING = 50
TOP = 2_000
SHARDS = 4
# Words whose phrases a task adds up before it hands the counts on, and rows of a batch.
HELD = 1 << 21
BATCH = 1 << 16
# Bits of the filter of frequent phrases: 8 MB, whatever the corpus.
FILTER_BITS = 1 << 26
# A-Z count as a-z; these bytes end a piece; a tab is a space.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
PIECE_END = b"."
PIECE_BYTES = bytes(
    byte + 32 if 65 <= byte <= 90 else PIECE_END[0] if byte in PIECE_ENDS else 32 if byte == 9 else byte
    for byte in range(256)
)


def tokens_of(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text, with PIECE_END between pieces."""
    return (text or b"").translate(PIECE_BYTES).replace(PIECE_END, b" " + PIECE_END + b" ").split()


class Numbers(dict):
    """Numbers of words in the order in which they come; PIECE_END is 0."""

    def __init__(self):
        self[PIECE_END] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def phrase_places(words: list[np.ndarray], lang: str) -> np.ndarray:
    """Filter places of phrases, from the hashes of their first words, second words, ..."""
    place = np.full(len(words[0]), xxhash.xxh64_intdigest(lang), dtype=np.uint64)
    for hashes in words:
        place = (place ^ hashes) * np.uint64(0x9E3779B97F4A7C15)
        place ^= place >> np.uint64(32)
    return (place % np.uint64(FILTER_BITS)).astype(np.int64)


class PhraseFilter:
    """Which phrases may be frequent: never wrong about one that is, and of one size for any corpus."""

    def __init__(self, slices: list[tuple[int, bytes]]):
        self.bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
        for number, content in slices:
            start = number * len(content)
            self.bits[start : start + len(content)] = np.frombuffer(content, np.uint8)

    def has(self, places: np.ndarray) -> np.ndarray:
        return (self.bits[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)


class Tally:
    """Words of one language as numbers, and the phrases in them."""

    def __init__(self, lang: str):
        self.lang, self.numbers, self.ids = lang, Numbers(), array("q")

    def add(self, text: bytes | None) -> int:
        """Takes the words of a text and returns their number."""
        before = len(self.ids)
        self.ids.extend(map(self.numbers.__getitem__, tokens_of(text)))
        self.ids.append(0)
        return len(self.ids) - before

    def phrases(self, sizes: tuple[int, ...], frequent: PhraseFilter | None) -> Iterator[tuple]:
        """(size, first words, second words, ..., counts) of every size, words as their numbers."""
        ids = np.frombuffer(self.ids, dtype=np.int64)
        count = np.bincount(ids, minlength=len(self.numbers))
        if 0 in sizes:
            yield 0, [], np.array([count[1:].sum()])
        if 1 in sizes:
            yield 1, [np.arange(1, len(count))], count[1:]
        if frequent is not None:
            hashed = np.fromiter(map(xxhash.xxh64_intdigest, self.numbers), np.uint64, len(self.numbers))
        # the phrase of each place, as its rank; below zero where there is none
        ranks, words = np.where(ids > 0, ids, -1), [np.arange(len(count))]
        for size in range(2, max(sizes) + 1):
            live = (ranks[:-1] >= 0) & (ids[size - 1 :] > 0)
            if size in sizes and frequent is not None:
                maybe = frequent.has(phrase_places([hashed[column] for column in words], self.lang))
                kept = np.append(maybe, False)[ranks]  # rank -1: no phrase
                live &= kept[:-1] & kept[1:]
            codes = ranks[:-1][live] * len(count) + ids[size - 1 :][live]
            if size == max(sizes):
                unique, n = np.unique(codes, return_counts=True)
            else:
                unique, inverse, n = np.unique(codes, return_inverse=True, return_counts=True)
                ranks = np.full(len(live), -1)
                ranks[live] = inverse
            before, last = np.divmod(unique, len(count))
            words = [*(column[before] for column in words), last]
            if size in sizes:
                yield size, words, n


def count_phrases(
    documents: DataFrame, sizes: tuple[int, ...], frequent: Broadcast | None = None
) -> DataFrame:
    """(lang, size, phrase, in_0, in_1, ...): occurrences in each shard.

    A shard is every SHARDS-th split of the input. Size 0 counts all words under the
    empty phrase. With ``frequent``, a phrase is counted only if both phrases
    one word shorter that it holds may be frequent. Tasks add up the phrases of HELD words before
    they are dealt out, so a phrase has few rows however common it is.
    """

    def rows(tally: Tally, known: PhraseFilter | None) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(list(tally.numbers), pa.binary())
        for size, words, counts in tally.phrases(sizes, known):
            for start in range(0, len(counts), BATCH):
                n = counts[start : start + BATCH]
                parts = [vocabulary.take(pa.array(column[start : start + BATCH])) for column in words]
                if len(parts) > 1:
                    phrases = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()))
                else:
                    phrases = parts[0] if parts else pa.array([b""] * len(n), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([tally.lang] * len(n), pa.string()),
                        pa.array(np.full(len(n), size, np.int32)),
                        phrases.view(pa.string()),
                        pa.array(n.astype(np.int64)),
                    ],
                    ["lang", "size", "phrase", "n"],
                )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frequent.value if frequent is not None else None
        held: dict[str, Tally] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if lang not in held:
                    held[lang] = Tally(lang)
                size += held[lang].add(text)
                if size >= HELD:
                    for tally in held.values():
                        yield from rows(tally, known)
                    held, size = {}, 0
        for tally in held.values():
            yield from rows(tally, known)

    counted = documents.select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text")
    ).mapInArrow(compute, "lang string, size int, phrase string, n long")
    dealt = counted.withColumn("shard", F.pmod(F.spark_partition_id(), F.lit(SHARDS)).cast("int"))
    # the tasks have added up what they could, so the phrases are dealt first and added up once
    return (
        dealt.repartition("lang", "size", "phrase")
        .groupBy("lang", "size", "phrase")
        .agg(
            *[
                F.sum(F.when(F.col("shard") == i, F.col("n")).otherwise(F.lit(0))).alias(f"in_{i}")
                for i in range(SHARDS)
            ]
        )
    )


def everywhere() -> Column:
    return sum((F.col(f"in_{i}") for i in range(1, SHARDS)), F.col("in_0"))


def frequent_somewhere(counted: DataFrame, words: DataFrame, support: int) -> DataFrame:
    """Phrases with their share of ``support`` in at least one shard.

    A shard's share is its part of the language's words. The shares sum up to ``support``, so
    a phrase below its share in all shards is below ``support`` everywhere.
    """
    reaches = F.lit(False)
    for i in range(SHARDS):
        part = F.col(f"in_{i}").cast("decimal(38,0)") * F.col("all_words")
        reaches |= (F.col(f"in_{i}") > 0) & (part >= F.col(f"words_{i}").cast("decimal(38,0)") * support)
    return counted.join(words, "lang").where(reaches).select(counted.columns)


def filter_of(phrases: DataFrame) -> list[tuple[int, bytes]]:
    """The bits of ``phrases`` (lang, phrase): at most FILTER_BITS / 32768 slices of 4 kB."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list[list[int]]] = {}
            for lang, phrase in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                rows.setdefault(lang, []).append([xxhash.xxh64_intdigest(w) for w in phrase.split(b" ")])
            for lang, hashes in rows.items():
                places = phrase_places(list(np.array(hashes, dtype=np.uint64).T), lang)
                yield pa.RecordBatch.from_arrays([pa.array(places)], ["place"])

    places = phrases.select("lang", F.col("phrase").cast("binary")).mapInArrow(place, "place long")
    slices = places.groupBy((F.col("place") / F.lit(32_768)).cast("long").alias("number")).agg(
        F.expr("bitmap_construct_agg(place % 32768)").alias("bits")
    )
    return [(row.number, bytes(row.bits)) for row in slices.collect()]


def mine_phrases(documents: DataFrame, support: int = SUPPORT, longest: int = LONGEST) -> DataFrame:
    """(lang, size, phrase, f): all phrases up to ``longest`` words with f >= ``support`` occurrences.

    Size 1 has all words and size 0 the number of words, whatever their count. Every shard is
    mined completely for the phrases that reach its share of the support, and each
    phrase frequent in any shard is then counted over all of them. Phrases of three
    words or more are only looked for where the phrases one word shorter are
    frequent in a shard; a filter of fixed size tells, and may let others pass.
    """
    counted = settle(count_phrases(documents, (0, 1, 2)), "phrases")
    shares = [F.col(f"in_{i}").alias(f"words_{i}") for i in range(SHARDS)]
    words = settle(
        counted.where("size = 0").select("lang", everywhere().alias("all_words"), *shares), "words"
    )
    found = [counted.where("size < 2")]
    level = settle(frequent_somewhere(counted.where("size = 2"), words, support), "frequent")
    found.append(level)
    for size in range(3, longest + 1):
        known = documents.sparkSession.sparkContext.broadcast(PhraseFilter(filter_of(level)))
        longer = count_phrases(documents, (size,), known)
        level = settle(frequent_somewhere(longer, words, support), "frequent")
        found.append(level)
    total = everywhere()
    exact = [part.select("lang", "size", "phrase", total.alias("f")) for part in found]
    result = exact[0]
    for part in exact[1:]:
        result = result.unionByName(part.where(F.col("f") >= support))
    return result


def part_of(start: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), start, size), " ")


def scored_phrases(phrases: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, size, phrase, a, l, r, score) by the cut of lowest score, ties to the first."""
    candidates = phrases.where("size >= 2").withColumnRenamed("f", "a")
    scored = None
    for size in range(2, longest + 1):
        rows = candidates.where(F.col("size") == size)
        for cut in range(1, size):
            for side, start, width in (("l", 1, cut), ("r", cut + 1, size - cut)):
                counts = phrases.where(F.col("size") == width).select(
                    "lang", F.col("phrase").alias("part"), F.col("f").alias(f"{side}_{cut}")
                )
                rows = (
                    rows.withColumn("part", part_of(start, width))
                    .join(counts, ["lang", "part"])
                    .drop("part")
                )
        a = F.col("a").cast("decimal(15,0)")
        cuts = []
        for cut in range(1, size):
            below = F.col(f"l_{cut}").cast("decimal(15,0)") * F.col(f"r_{cut}").cast("decimal(15,0)")
            above = (a * a).cast("decimal(30,0)") * F.lit(1_000_000).cast("decimal(7,0)")
            score = F.call_function("div", above, below)
            cuts.append(
                F.struct(
                    score.alias("score"),
                    F.lit(cut).alias("cut"),
                    F.col(f"l_{cut}").alias("l"),
                    F.col(f"r_{cut}").alias("r"),
                )
            )
        best = F.array_min(F.array(*cuts))
        rows = rows.withColumn("best", best).select(
            "lang", "size", "phrase", "a", "best.l", "best.r", "best.score"
        )
        scored = rows if scored is None else scored.unionByName(rows)
    return scored


def without_covered(scored: DataFrame, longest: int = LONGEST, covering: int = COVERING) -> DataFrame:
    """Candidates that no longer candidate around them has ``covering`` per cent of."""
    places = [
        F.struct(F.lit(width).alias("size"), part_of(start, width).alias("phrase"), F.lit(longer).alias("longer"))
        for longer in range(3, longest + 1)
        for width in range(2, longer)
        for start in range(1, longer - width + 2)
    ]
    if not places:
        return scored
    inside = (
        scored.where("size > 2")
        .select("lang", "a", F.col("size").alias("own_size"), F.explode(F.array(*places)).alias("inner"))
        .where("inner.longer = own_size")
        .groupBy("lang", F.col("inner.size").alias("size"), F.col("inner.phrase").alias("phrase"))
        .agg(F.max("a").alias("around"))
    )
    covered = F.coalesce(F.col("around") * 100 >= F.col("a") * covering, F.lit(False))
    return scored.join(inside, ["lang", "size", "phrase"], "left").where(~covered).drop("around")


def collocation_report(
    documents: DataFrame, support: int = SUPPORT, longest: int = LONGEST, top: int = TOP
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of every language.

    Null texts are empty, a null language is ``und``. Phrases stay within a piece; repeated rows
    count as often as they occur. Ties in score go to the more frequent phrase, then to the
    smaller by UTF-8 bytes. An empty table, or one without frequent phrases, has
    no rows. A long text is read whole, piece by piece. Other columns are not
    read, so their names may clash.
    """
    phrases = settle(mine_phrases(documents, support, longest), "counted")
    words = settle(phrases.where("size = 0").select("lang", F.col("f").alias("n")), "words")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        without_covered(scored_phrases(phrases, longest), longest)
        .withColumn("rank", F.row_number().over(order).cast("long"))
        .where(F.col("rank") <= top)
        .join(words, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
