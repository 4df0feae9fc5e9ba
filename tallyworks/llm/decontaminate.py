"""Benchmark decontamination: test phrases searched in an FM-index of every training shard."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyworks.llm.common import fresh
from tallyworks.llm.fmindex import FMIndex
from tallyworks.session import settle

WINDOW = 10
# Indexed words of a shard; phrases and owners searched in one pass over the documents.
SHARD_WORDS = 1 << 20
BLOCK_PHRASES = 1_000_000
WINDOWS_AT_ONCE = 10_000
# Which bytes belong to a word. A-Z count as a-z; all others separate words.
WORD_BYTES = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if 48 <= byte <= 57 or 97 <= byte <= 122 or byte >= 128 else 32
    for byte in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


class Phrases:
    """The phrases of one block, as rows of word numbers, and the items that each occurs in."""

    def __init__(self, phrases: list[tuple[bytes, list[str]]], window: int):
        self.numbers: dict[bytes, int] = {}
        ids = [
            [self.numbers.setdefault(word, len(self.numbers) + 1) for word in phrase.split()]
            for phrase, _ in phrases
        ]
        self.owners = [owners for _, owners in phrases]
        self.lengths = np.array([len(row) for row in ids], dtype=np.int64)
        self.rows = np.zeros((len(ids), window), dtype=np.int64)
        for row, own in enumerate(ids):
            self.rows[row, window - len(own) :] = own
        self.shortest = int(self.lengths.min()) if ids else 0


def phrase_runs(ids: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """[start, end) of the runs of benchmark words that could hold a phrase."""
    inside = np.concatenate(([False], ids > 0, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= shortest
    return starts[long], ends[long]


class Shard:
    """Runs of benchmark words of many documents, indexed together once there are enough."""

    def __init__(self, phrases: Phrases):
        self.phrases = phrases
        self.separator = len(phrases.numbers) + 1
        self.pieces: list[np.ndarray] = []
        self.origins: list[tuple[int, int, int]] = []
        self.size = 0

    def add(self, document: int, ids: np.ndarray) -> None:
        """A run longer than a shard goes in pieces that overlap by a window less one word."""
        overlap = self.phrases.rows.shape[1] - 1
        for start, end in zip(*phrase_runs(ids, self.phrases.shortest), strict=True):
            for first in range(int(start), int(end), SHARD_WORDS):
                piece = ids[first : min(int(end), first + SHARD_WORDS + overlap)]
                self.origins.append((self.size, document, first))
                self.pieces += [piece, np.array([self.separator])]
                self.size += len(piece) + 1

    def occurrences(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, first word, phrase) of all phrase occurrences."""
        if not self.pieces:
            empty = np.zeros(0, dtype=np.int64)
            return empty, empty, empty
        index = FMIndex(np.concatenate(self.pieces), self.separator)
        start, end = index.search(self.phrases.rows, self.phrases.lengths)
        counts = end - start
        phrase = np.repeat(np.arange(len(counts)), counts)
        offset = np.arange(len(phrase)) - np.repeat(np.cumsum(counts) - counts, counts)
        position = index.locate(np.repeat(start, counts) + offset)
        origins = np.array(self.origins, dtype=np.int64)
        origin = origins[np.searchsorted(origins[:, 0], position, side="right") - 1]
        return origin[:, 1], origin[:, 2] + position - origin[:, 0], phrase


def merged(starts: np.ndarray, ends: np.ndarray) -> list[dict[str, int]]:
    """Overlapping and adjoining spans joined, in order."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate(([True], starts[1:] > reach[:-1]))
    last = np.concatenate((first[1:], [True]))
    return [
        {"start": int(a), "end": int(b)} for a, b in zip(starts[first], reach[last], strict=True)
    ]


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def search_block(
    documents: DataFrame,
    phrases: list[tuple[bytes, list[str]]],
    window: int,
    names: Sequence[str],
    wanted: Sequence[str],
) -> DataFrame:
    """The columns ``wanted`` of ``documents``, one block's occurrences added to those of ``names``."""
    n_words, spans, found = names
    block = documents.sparkSession.sparkContext.broadcast(Phrases(phrases, window))

    def finish(batches: list[pa.RecordBatch], counts: list[int], shard: Shard):
        document, first, phrase = shard.occurrences()
        order = np.argsort(document, kind="stable")
        document, first, phrase = document[order], first[order], phrase[order]
        last = first + shard.phrases.lengths[phrase]
        bounds = np.searchsorted(document, np.arange(len(counts) + 1))
        done = 0
        for batch in batches:
            all_spans, all_items = [], []
            known = zip(batch.column(spans).to_pylist(), batch.column(found).to_pylist(), strict=True)
            for place, (earlier, names) in enumerate(known, done):
                low, high = bounds[place], bounds[place + 1]
                old = np.array([[x["start"], x["end"]] for x in earlier], dtype=np.int64).reshape(-1, 2)
                all_spans.append(
                    merged(np.append(old[:, 0], first[low:high]), np.append(old[:, 1], last[low:high]))
                )
                owners = {x for p in np.unique(phrase[low:high]) for x in shard.phrases.owners[p]}
                all_items.append(sorted(owners.union(names)))
            size = batch.num_rows
            new = {
                n_words: pa.array(counts[done : done + size], pa.int64()),
                spans: pa.array(all_spans, SPANS),
                found: pa.array(all_items, pa.list_(pa.string())),
            }
            done += size
            columns = [new[name] if name in new else batch.column(name) for name in wanted]
            yield pa.RecordBatch.from_arrays(columns, list(wanted))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases: Phrases = block.value
        number = phrases.numbers.get
        waiting, counts, shard = [], [], Shard(phrases)
        for batch in batches:
            for value in batch.column("text"):
                words = words_of(value.as_buffer().to_pybytes() if value.is_valid else None)
                ids = np.fromiter((number(word, 0) for word in words), np.int64, len(words))
                shard.add(len(counts), ids)
                counts.append(len(words))
            waiting.append(batch)
            if shard.size >= SHARD_WORDS or len(counts) >= SHARD_WORDS // 32:
                yield from finish(waiting, counts, shard)
                waiting, counts, shard = [], [], Shard(phrases)
        yield from finish(waiting, counts, shard)

    schema = StructType([documents.schema[name] for name in wanted])
    return documents.mapInArrow(compute, schema)


def benchmark_phrases(benchmark: DataFrame, window: int) -> DataFrame:
    """(phrase, owners): distinct windows of the items' words, space-joined, and the items that hold each.

    A null item id counts as an item without a name; null texts have no words.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text"), strict=True):
                words = words_of(text.as_buffer().to_pybytes())
                starts = range(max(1, len(words) - window + 1) if words else 0)
                for first in range(0, len(starts), WINDOWS_AT_ONCE):
                    phrases = {
                        b" ".join(words[start : start + window])
                        for start in starts[first : first + WINDOWS_AT_ONCE]
                    }
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(phrases), pa.binary()), pa.array([item] * len(phrases))],
                        ["phrase", "item"],
                    )

    items = benchmark.where("text IS NOT NULL").select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.col("text").cast("binary").alias("text"),
    )
    return (
        items.mapInArrow(cut, "phrase binary, item string")
        .groupBy("phrase")
        .agg(F.sort_array(F.collect_set("item")).alias("owners"))
    )


def benchmark_blocks(benchmark: DataFrame, window: int) -> Iterator[list[tuple[bytes, list[str]]]]:
    """The benchmark's phrases in blocks of about BLOCK_PHRASES phrases and owners, by hash.

    Spark finds the phrases; one block at a time meets the driver.
    """
    phrases = settle(benchmark_phrases(benchmark, window), "phrases")
    [total] = phrases.agg(F.coalesce(F.sum(F.size("owners") + 1), F.lit(0))).first()
    blocks = max(1, math.ceil(total / BLOCK_PHRASES))
    block = F.pmod(F.xxhash64("phrase"), F.lit(blocks))
    for number in range(blocks):
        rows = phrases.where(block == number).collect()
        yield sorted((bytes(row.phrase), list(row.owners)) for row in rows)


NAMES = ("n_words", "spans", "items")


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    names: Sequence[str] = NAMES,
    wanted: Sequence[str] | None = None,
) -> DataFrame:
    """``documents`` with n_words, the removal ``spans`` (word positions) and ``items``.

    A phrase is ``window`` consecutive words of an item, or the whole of a shorter
    one. Every task indexes its documents in shards of about SHARD_WORDS words and
    searches all phrases of a block of the benchmark; further blocks add to
    the result in further passes. Words that the benchmark does not have can be
    in no occurrence, so a shard keeps only runs of its words that are long
    enough for the shortest phrase. Null and empty texts have no words. Columns
    that have one of the three ``names`` are replaced. ``wanted`` selects columns
    of the result; all by default.
    """
    empty = [
        F.lit(0).cast("long"),
        F.expr("CAST(array() AS array<struct<start:bigint,end:bigint>>)"),
        F.expr("CAST(array() AS array<string>)"),
    ]
    rows = documents.drop(*names)
    rows = rows.select("*", *[column.alias(name) for column, name in zip(empty, names, strict=True)])
    wanted = wanted or rows.columns
    blocks = benchmark_blocks(benchmark, window)
    block = next(blocks)
    for following in blocks:
        rows = settle(search_block(rows, block, window, names, rows.columns), "searched")
        block = following
    return search_block(rows, block, window, names, wanted)


def clean_documents(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``documents`` in which no phrase of the benchmark occurs."""
    names = fresh(documents, *NAMES)
    found = find_contamination(documents, benchmark, window, names)
    return found.where(F.size(names[1]) == 0).select(*documents.columns)


def contamination_report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Words, hit words and items of every document.

    Repeated rows are searched each; with an empty benchmark nothing is hit; an empty table has no
    rows. Other columns are not read, so their names may clash.
    """
    found = find_contamination(
        documents.select("doc_id", "text"), benchmark, wanted=["doc_id", *NAMES]
    )
    n_hit = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"]
    )
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
