"""SimHash near-duplicates, found through deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import fresh
from tallyworks.llm.components import component_roots
from tallyworks.session import settle

BITS = 64
SEED = 42
SHINGLE = 4
DISTANCE = 4
# A signature shared by more fingerprints than this is cut again instead of compared.
CROWD = 2_048
# Cuts: after three, what fingerprints of one signature may differ in is 20 bits.
LEVELS = 3
CHUNK = 65_536


def simhash(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of a UTF-8 text: bit set where over half of the shingle hashes have it."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(0, len(words) - shingle)
    starts, ends = starts[: last + 1].tolist(), ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[start:end], SEED) for start, end in zip(starts, ends, strict=True)),
        dtype=np.uint64,
        count=last + 1,
    )
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), CHUNK):
        octets = hashes[start : start + CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = counts * 2 > len(hashes)
    return int(np.packbits(majority, bitorder="little").view(np.int64)[0])


def fingerprints(
    documents: DataFrame, shingle: int = SHINGLE, carried: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """(*carried, fingerprint long); a text without words, or none at all, has fingerprint zero."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [simhash(text.as_py(), shingle) for text in batch.column("text")]
            columns = [*(batch.column(name) for name in carried), pa.array(values, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*carried, "fingerprint"])

    kinds = [f"`{name}` {documents.schema[name].dataType.simpleString()}" for name in carried]
    return documents.select(*carried, F.col("text").cast("binary").alias("text")).mapInArrow(
        compute, ", ".join([*kinds, "fingerprint long"])
    )


@lru_cache(maxsize=None)
def segments(taken: int, distance: int) -> list[list[int]]:
    """The bits outside the mask ``taken``, in as few runs as leave one with at most one change."""
    free = [bit for bit in range(BITS) if not taken >> bit & 1]
    pieces = distance // 2 + 1
    return [piece.tolist() for piece in np.array_split(free, pieces)]


@lru_cache(maxsize=None)
def kept_bits(path: int, distance: int) -> tuple[int, int]:
    """(bits a signature keeps, bits its segments span) for the wildcards of ``path``.

    A path has one wildcard bit a cut, as digits base 65 of bit + 1, the first
    cut in the lowest digit.
    """
    kept = spanned = 0
    while path:
        bit = path % 65 - 1
        segment = next(run for run in segments(spanned, distance) if bit in run)
        span = sum(1 << each for each in segment)
        kept |= span & ~(1 << bit)
        spanned |= span
        path //= 65
    return kept, spanned


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def variants(crowds: DataFrame, level: int, distance: int) -> DataFrame:
    """(path, signature, fingerprint) of the next cut for every (path, fingerprint).

    The free bits are cut into distance // 2 + 1 segments. Of two fingerprints at
    most ``distance`` bits apart, one segment differs in one bit at most, so they
    agree in it once that bit is a wildcard: one variant for each wildcard bit.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_numpy(zero_copy_only=False)
            prints = batch.column("fingerprint").to_numpy(zero_copy_only=False)
            for path in np.unique(paths).tolist():
                mine = prints[paths == path]
                for run in segments(kept_bits(path, distance)[1], distance):
                    for bit in run:
                        longer = path + (bit + 1) * 65**level
                        kept = np.int64(signed(kept_bits(longer, distance)[0]))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(mine), longer)),
                                pa.array(mine & kept),
                                pa.array(mine),
                            ],
                            ["path", "signature", "fingerprint"],
                        )

    return crowds.select("path", "fingerprint").mapInArrow(
        compute, "path long, signature long, fingerprint long"
    )


def differing_bits(left: np.ndarray, right: np.ndarray | np.int64) -> np.ndarray:
    """Numpy counts the bits of absolute values, so signed numbers are first read as unsigned."""
    return np.bitwise_count(np.bitwise_xor(left, right).view(np.uint64))


def tree_links(prints: np.ndarray, distance: int) -> tuple[list[int], list[int]]:
    """Links of at most ``distance`` bits that join all of ``prints`` that such links connect."""
    rest, left, right = prints, [], []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            node = queue.pop()
            near = differing_bits(rest, node) <= distance
            found = rest[near]
            rest = rest[~near]
            left += [int(node)] * len(found)
            right += found.tolist()
            queue.extend(found)
    return left, right


def compare(table: DataFrame, distance: int, crowd: int | None) -> DataFrame:
    """Links among fingerprints of one signature: (a, b, null), a tree for each set they join.

    Where more than ``crowd`` fingerprints share a signature, they are passed on
    as (fingerprint, null, path) to be cut again. Rows come sorted by signature,
    and no more than one signature's, or ``crowd``, are held at a time.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a: list, b: list, path: list) -> pa.RecordBatch:
            kinds = [pa.int64()] * 3
            columns = [pa.array(x, kind) for x, kind in zip((a, b, path), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, ["a", "b", "path"])

        held: list[np.ndarray] = []
        held_key: tuple[int, int] | None = None
        count, passing = 0, False

        def close() -> pa.RecordBatch | None:
            if passing or count < 2:
                return None
            left, right = tree_links(np.concatenate(held), distance)
            return out(left, right, [None] * len(left)) if left else None

        for batch in batches:
            if not batch.num_rows:
                continue
            path, signature, prints = (
                batch.column(place).to_numpy(zero_copy_only=False) for place in range(3)
            )
            change = np.flatnonzero((np.diff(path) != 0) | (np.diff(signature) != 0)) + 1
            starts = np.concatenate(([0], change))
            ends = np.concatenate((change, [len(prints)]))
            inner = ends - starts
            # Runs of two inside the batch, the most common ones, at once.
            pairs = starts[(inner == 2) & (starts > 0) & (ends < len(prints))]
            near = pairs[differing_bits(prints[pairs], prints[pairs + 1]) <= distance]
            if len(near):
                yield out(prints[near], prints[near + 1], [None] * len(near))
            others = (inner > 2) | (starts == 0) | (ends == len(prints))
            for start, end in zip(starts[others].tolist(), ends[others].tolist(), strict=True):
                key = (int(path[start]), int(signature[start]))
                if key != held_key:
                    done = close()
                    if done:
                        yield done
                    held, held_key, count, passing = [], key, 0, False
                piece = prints[start:end]
                count += len(piece)
                if crowd and count > crowd:
                    piece = np.concatenate([*held, piece])
                    held, passing = [], True
                    yield out(piece, [None] * len(piece), [key[0]] * len(piece))
                else:
                    held.append(piece)
        done = close()
        if done:
            yield done

    return table.mapInArrow(compute, "a long, b long, path long")


def fingerprint_links(
    prints: DataFrame, distance: int = DISTANCE, crowd: int = CROWD, levels: int = LEVELS
) -> DataFrame:
    """(a, b) that connect exactly the distinct fingerprints that links of ``distance`` connect.

    Signatures are dealt over all tasks and compared inside each. Crowded ones
    are cut again in the bits they leave free, where the same argument holds, so
    that no task compares all pairs of a large group of near copies.
    """
    crowds = prints.select(F.lit(0).cast("long").alias("path"), "fingerprint")
    links = None
    for level in range(levels):
        dealt = (
            variants(crowds, level, distance)
            .repartition("path", "signature")
            .sortWithinPartitions("path", "signature", "fingerprint")
        )
        limit = crowd if level + 1 < levels else None
        found = settle(compare(dealt, distance, limit), f"links-{level}")
        direct = found.where(F.col("path").isNull()).select("a", "b")
        links = direct if links is None else links.union(direct)
        crowds = found.where(F.col("path").isNotNull()).select(
            "path", F.col("a").alias("fingerprint")
        )
        if not crowds.take(1):
            break
    return links.distinct()


def rooted_fingerprints(prints: DataFrame, first: Column, distance: int) -> DataFrame:
    """(fingerprint, first, root): the smallest ``first`` of each fingerprint, and its component's root."""
    nodes = settle(prints.groupBy("fingerprint").agg(F.min(first).alias("first")), "simhash-nodes")
    roots = settle(
        component_roots(fingerprint_links(nodes.select("fingerprint"), distance)), "simhash-roots"
    )
    return nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )


def near_duplicates(
    documents: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """(doc_id, fingerprint long, component_id) of every row of ``documents``.

    Documents are linked when their fingerprints differ in at most ``distance``
    bits; ``component_id`` is the smallest doc_id that a document reaches. Copies
    share a fingerprint and are compared once. Texts without words have fingerprint zero
    and are linked like any other; texts of any length are read whole. A null doc_id is
    returned with its component, whose id is null only if no member has one. An empty table
    has no rows. Other columns are not read.
    """
    prints = settle(fingerprints(documents, shingle), "simhash")
    joined = rooted_fingerprints(prints, F.col("doc_id"), distance)
    smallest = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = joined.join(smallest, "root").select("fingerprint", "component_id")
    return prints.join(classes, "fingerprint").select("doc_id", "fingerprint", "component_id")


def one_of_each(
    documents: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """One row of ``documents``, with all its columns, for each component of near duplicates.

    The row of the smallest doc_id stays, one without an id only if no member has one; of
    several texts with that id, or without any, the one of smallest hash. So an id with
    two texts keeps a row in each of their components, and reruns agree. Of rows with the same id
    and text any one stays.
    """
    key = fresh(documents, "key")[0]
    text = F.md5(F.coalesce(F.col("text").cast("binary"), F.lit(b"")))
    known = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    keyed = documents.withColumn(key, F.concat(text, F.lit(":"), known))
    prints = settle(fingerprints(keyed, shingle, ("doc_id", key)), "simhash")
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", key)
    joined = rooted_fingerprints(prints, first, distance)
    chosen = joined.groupBy("root").agg(F.min("first").alias("one")).select(f"one.{key}")
    return keyed.join(chosen, key, "left_semi").dropDuplicates([key]).drop(key)


def near_duplicate_report(documents: DataFrame) -> DataFrame:
    """The fingerprint as 16 hexadecimal digits."""
    return near_duplicates(documents).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
