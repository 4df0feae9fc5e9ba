"""Suffix-array dedup: bytes of strings that start in two places, found in sorted shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import fresh
from tallyworks.llm.suffixes import permuted_prefixes, predecessors, suffix_array
from tallyworks.session import settle

LENGTH = 200
# Bytes of the grams whose smallest hash a string is dealt by.
GRAM = 32
# Bytes of text that are hashed together, and that one suffix array covers at least.
BLOCK = 1 << 20
SHARD = 1 << 20
# A gram with more different stretches than this is not searched in one shard.
CROWD = 8_192


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ values >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ values >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ values >> np.uint64(33)


BYTE_HASHES = mixed(np.arange(1, 257, dtype=np.uint64))


def smallest_hashes(content: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For every string of ``length`` bytes, the smallest hash of the grams inside it.

    Also whether the first gram has it, so that the next string no longer holds this one.
    """
    hashes = BYTE_HASHES[content]
    step = 1
    while step < GRAM:
        hashes = hashes[:-step] * np.uint64(0x9E3779B97F4A7C15 + 2 * step) + hashes[step:]
        step *= 2
    hashes = first = mixed(hashes)
    width, covered = length - GRAM + 1, 1
    while covered < width:
        step = min(covered, width - covered)
        hashes = np.minimum(hashes[:-step], hashes[step:])
        covered += step
    return hashes, first[: len(hashes)] == hashes


def blocks(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(row, first byte, content) of about BLOCK bytes; long texts in pieces that share length - 1 bytes."""
    held, size = [], 0
    for row, text in enumerate(texts):
        for first in range(0, max(1, len(text) - length + 1), BLOCK):
            content = text[first : first + BLOCK + length - 1]
            if len(content) < length:
                continue
            held.append((row, first, content))
            size += len(content)
            if size >= BLOCK:
                yield held
                held, size = [], 0
    if held:
        yield held


def stretches(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, start, count, grams, gram, stretch) of runs of strings with the same smallest hash.

    The strings of a run start at ``start`` and the next count - 1 places; ``stretch``
    is a hash of all their bytes. Equal strings have equal grams wherever they are. In
    periodic text a run may hold its gram several times: ``grams`` of them come first in
    a string. A run of more than ``length`` strings is cut.
    """
    for block in blocks(texts, length):
        content = b"".join(piece for _, _, piece in block)
        smallest, opens = smallest_hashes(np.frombuffer(content, np.uint8), length)
        passed = np.concatenate(([0], np.cumsum(opens)))
        ends = np.cumsum([len(piece) for _, _, piece in block])
        begins = np.concatenate(([0], ends[:-1]))
        inside = np.ones(len(smallest), dtype=bool)
        for end in ends[:-1].tolist():
            inside[end - length + 1 : end] = False
        edge = np.concatenate(([True], (smallest[1:] != smallest[:-1]) | (inside[1:] != inside[:-1])))
        starts = np.flatnonzero(edge)
        counts = np.diff(np.append(starts, len(smallest)))
        counts, starts = counts[inside[starts]], starts[inside[starts]]
        cuts = -(-counts // length)
        nth = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        starts = np.repeat(starts, cuts) + nth * length
        counts = np.minimum(np.repeat(counts, cuts) - nth * length, length)
        piece = np.searchsorted(ends, starts, side="right")
        rows = np.array([row for row, _, _ in block])[piece]
        firsts = np.array([first for _, first, _ in block])[piece]
        digest = xxhash.xxh3_64_intdigest
        bounds = zip(starts.tolist(), (starts + counts + length - 1).tolist(), strict=True)
        hashes = np.fromiter((digest(content[a:b]) for a, b in bounds), np.uint64, len(starts))
        grams = 1 + passed[starts + counts - 1] - passed[starts]
        yield rows, starts - begins[piece] + firsts, counts, grams, smallest[starts].view(np.int64), hashes.view(np.int64)


def anchored(texts: DataFrame, length: int) -> DataFrame:
    """(key, start, count, grams, gram, stretch) of all strings of ``length`` bytes of ``texts`` (key, text)."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key")
            for rows, start, count, grams, gram, stretch in stretches(batch.column("text").to_pylist(), length):
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(rows)),
                        pa.array(start.astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                        pa.array(grams.astype(np.int32)),
                        pa.array(gram),
                        pa.array(stretch),
                    ],
                    ["key", "start", "count", "grams", "gram", "stretch"],
                )

    return texts.mapInArrow(
        compute, "key binary, start int, count int, grams int, gram long, stretch long"
    )


def repeated_starts(bodies: list[bytes], length: int) -> list[np.ndarray]:
    """For each body the starts of its strings of ``length`` bytes that start elsewhere in ``bodies`` too."""
    ends = np.cumsum([len(body) + 1 for body in bodies])
    text = np.frombuffer(b"\0".join(bodies) + b"\0\0", np.uint8).astype(np.uint16) + 2
    text[ends - 1], text[-1] = 1, 0
    before = predecessors(suffix_array(text, 258))
    repeated = np.flatnonzero(permuted_prefixes(text, before) >= length)
    repeated = np.unique(np.concatenate((repeated, before[repeated])))
    body = np.searchsorted(ends, repeated, side="right")
    whole = repeated + length < ends[np.minimum(body, len(ends) - 1)]
    repeated, body = repeated[whole], body[whole]
    bounds = np.searchsorted(body, np.arange(len(bodies) + 1))
    begins = np.concatenate(([0], ends[:-1]))
    return [repeated[a:b] - begins[i] for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))]


def runs(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """[first, last) of the runs of consecutive numbers."""
    if len(starts):
        cuts = np.flatnonzero(np.diff(starts) != 1) + 1
        for run in np.split(starts, cuts):
            yield int(run[0]), int(run[-1]) + 1


FOUND = "gram long, stretch long, first int, last int"


def search_shards(bodies: DataFrame, length: int) -> DataFrame:
    """(gram, stretch, first, last): runs of repeated strings in ``bodies`` (gram, stretch, body).

    All stretches of a gram lie in one shard, which ends with the gram that fills it.
    """

    def finish(shard: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        found = repeated_starts([body for _, _, body in shard], length) if shard else []
        rows = [
            (gram, stretch, first, last)
            for (gram, stretch, _), starts in zip(shard, found, strict=True)
            for first, last in runs(starts)
        ]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        columns = zip(*rows) if rows else ([], [], [], [])
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)],
            ["gram", "stretch", "first", "last"],
        )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if size >= SHARD and row[0] != last:
                    yield finish(shard)
                    shard, size = [], 0
                shard.append(row)
                size += len(row[2])
                last = row[0]
        yield finish(shard)

    dealt = bodies.select("gram", "stretch", "body").repartition("gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(compute, FOUND)


def search_crowds(bodies: DataFrame, length: int) -> DataFrame:
    """The same for grams with too many stretches for a shard: strings meet by their own digest."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gram, stretch, body in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                n = len(body) - length + 1
                digests = [xxhash.xxh3_128_digest(body[i : i + length]) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, gram)),
                        pa.array(np.full(n, stretch)),
                        pa.array(np.arange(n, dtype=np.int32)),
                        pa.array(digests, pa.binary()),
                    ],
                    ["gram", "stretch", "first", "digest"],
                )

    strings = settle(
        bodies.select("gram", "stretch", "body").mapInArrow(
            compute, "gram long, stretch long, first int, digest binary"
        ),
        "strings",
    )
    repeated = settle(
        strings.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"),
        "repeated-strings",
    )
    return strings.join(repeated, "digest").select(
        "gram", "stretch", "first", (F.col("first") + 1).alias("last")
    )


def bodies_of(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(gram, stretch, body): the bytes of each stretch of ``wanted``, cut from the text that has it."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("text").to_pylist(), batch.column("cuts").to_pylist(), strict=True)
            for text, cuts in rows:
                bodies = [text[c["start"] : c["start"] + c["count"] + length - 1] for c in cuts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([c["gram"] for c in cuts], pa.int64()),
                        pa.array([c["stretch"] for c in cuts], pa.int64()),
                        pa.array(bodies, pa.binary()),
                    ],
                    ["gram", "stretch", "body"],
                )

    cuts = wanted.groupBy("key").agg(
        F.collect_list(F.struct("start", "count", "gram", "stretch")).alias("cuts")
    )
    return texts.join(cuts, "key").select("text", "cuts").mapInArrow(
        compute, "gram long, stretch long, body binary"
    )


def merged(runs_of_starts: list[dict[str, int]], length: int) -> list[tuple[int, int]]:
    """[start, end) of the bytes that strings of ``length`` bytes starting in the runs cover."""
    spans: list[tuple[int, int]] = []
    for run in sorted(runs_of_starts, key=lambda r: r["first"]):
        first, end = run["first"], run["last"] - 1 + length
        if spans and first <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((first, end))
    return spans


def keyed_texts(documents: DataFrame, *columns: str) -> DataFrame:
    """``columns`` with the text's bytes (null: none) and their MD5 as ``key``."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return documents.select(*columns, text.alias("text"), F.unhex(F.md5(text)).alias("key"))


def repeated_runs(documents: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(key, text) of the distinct texts, and (key, first, last): runs of starts of repeated strings.

    Every string is dealt by the smallest hash of the grams inside it, so equal strings meet
    however the texts are split. A gram met only once has no repeated string.
    Where all stretches of a gram are equal, and several, all their strings repeat. The
    others are cut from one text each and searched: a suffix array of each shard by induced sorting
    and permuted common prefixes give the strings that start in two places.
    """
    rows = keyed_texts(documents).select("key", "text")
    strings = anchored(rows, length)
    grams = (
        strings.groupBy("gram")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("grams").alias("grams"),
            F.min("stretch").alias("low"),
            F.max("stretch").alias("high"),
        )
        .where("grams > 1")
        .select("gram", ((F.col("low") == F.col("high")) & (F.col("n") > 1)).alias("alike"))
    )
    marks = settle(
        strings.join(settle(grams, "grams"), "gram")
        .groupBy("key", "start")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.first(name).alias(name) for name in ("count", "gram", "stretch", "alike")],
        ),
        "marks",
    )
    unlike = marks.where("NOT alike")
    kinds = settle(
        unlike.groupBy("gram", "stretch").agg(
            F.sum("n").alias("n"), F.min(F.struct("key", "start", "count")).alias("place")
        ),
        "stretches",
    )
    crowded = settle(
        kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > CROWD), "crowded"
    )
    texts = rows.groupBy("key").agg(F.first("text").alias("text"))
    bodies = settle(bodies_of(texts, kinds.select("gram", "stretch", "place.*"), length), "bodies")
    found = search_shards(bodies.join(crowded, "gram", "left_anti"), length).unionByName(
        search_crowds(bodies.join(crowded, "gram", "left_semi"), length)
    )
    copied = kinds.where("n > 1").select(
        "gram", "stretch", F.lit(0).alias("first"), F.col("place.count").alias("last")
    )
    spread = unlike.select("key", "start", "gram", "stretch").join(
        found.unionByName(copied), ["gram", "stretch"]
    )
    start = F.col("start")
    repeated = (
        marks.where("alike")
        .select("key", start.alias("first"), (start + F.col("count")).alias("last"))
        .unionByName(spread.select("key", (start + F.col("first")).alias("first"), (start + F.col("last")).alias("last")))
    )
    return texts, repeated


def kept_texts(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, n_bytes, spans, kept): what is removed from each distinct text and the bytes that stay.

    ``spans`` are the maximal removed runs of bytes, [start, end).
    """
    texts, repeated = repeated_runs(documents, length)
    runs_of = repeated.groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("runs"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept, sizes = [], [], []
            rows = zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True)
            for text, found in rows:
                mine = merged(found or [], length)
                bounds = [0, *(place for span in mine for place in span), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True)))
                spans.append([{"start": a, "end": b} for a, b in mine])
                sizes.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(sizes, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    pa.array(kept, pa.binary()),
                ],
                ["key", "n_bytes", "spans", "kept"],
            )

    return texts.join(runs_of, "key", "left").mapInArrow(
        compute, "key binary, n_bytes long, spans array<struct<start:int,end:int>>, kept binary"
    )


def without_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """``documents`` with ``text`` less its repeated bytes; null texts stay null.

    A cut inside a character leaves bytes that are no valid UTF-8; they are kept as they are.
    """
    key, kept = fresh(documents, "key", "kept")
    cut = kept_texts(documents, length).select(F.col("key").alias(key), F.col("kept").alias(kept))
    text = F.col("text").cast("binary")
    shorter = F.when(F.col("text").isNotNull(), F.col(kept).cast("string")).alias("text")
    return (
        documents.withColumn(key, F.unhex(F.md5(F.coalesce(text, F.lit(b"")))))
        .join(cut, key)
        .select(*[shorter if name == "text" else name for name in documents.columns])
    )


def repeat_report(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document.

    A byte goes if a string of ``length`` bytes covers it that starts anywhere else too, in this
    document or another; the strings are judged on the input, and of equal ones none stays.
    So repeated rows of at least ``length`` bytes lose all their text. Null texts count as
    empty, and texts under ``length`` bytes lose nothing. Texts of any length are read
    whole. An empty table has no rows; null and repeated ids are kept as they
    are. Other columns are not read, so their names may clash.
    """
    size = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"]
    )
    cut = kept_texts(documents, length).select(
        "key",
        "n_bytes",
        size.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
    return keyed_texts(documents, "doc_id").select("doc_id", "key").join(cut, "key").drop("key")
