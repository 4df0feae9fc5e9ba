from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tallyworks.llm import components, simhash
from tallyworks.llm.components import component_roots
from tallyworks.session import settle

PARTITIONS = "spark.sql.shuffle.partitions"
MERGED = "spark.sql.adaptive.coalescePartitions.enabled"


def print_by_hand(text: str | None) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def roots_by_hand(prints: list[int], distance: int = 4) -> dict[int, int]:
    nodes = sorted(set(prints))
    root = {node: node for node in nodes}

    def find(node):
        while root[node] != node:
            node = root[node]
        return node

    for place, a in enumerate(nodes):
        for b in nodes[place + 1 :]:
            if ((a ^ b) % 2**64).bit_count() <= distance:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {node: find(node) for node in nodes}


@pytest.mark.parametrize("table", ["odd", "empty", "documents", "clashing"])
def test_components_equal_brute_force(request, table):
    documents = request.getfixturevalue(table)
    texts = [(r.doc_id, print_by_hand(r.text)) for r in documents.select("doc_id", "text").collect()]
    roots = roots_by_hand([p for _, p in texts])
    smallest = {}
    for doc_id, value in texts:
        root, old = roots[value], smallest.get(roots[value])
        smallest[root] = min((x for x in (doc_id, old) if x is not None), default=None)
    expected = sorted(str((d, f"{p:016x}", smallest[roots[p]])) for d, p in texts)
    found = simhash.near_duplicate_report(documents).collect()
    assert sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in found) == expected


@pytest.mark.parametrize("crowd", [2, 5, 1_000])
def test_crowded_signatures_are_cut_again_without_losing_links(spark, crowd):
    chance = random.Random(7)
    prints = set()
    for _ in range(3):
        centre = chance.getrandbits(64)
        for _ in range(60):
            prints.add(centre ^ sum(1 << chance.randrange(64) for _ in range(chance.randrange(4))) % 2**64)
    prints |= {chance.getrandbits(64) for _ in range(100)}
    signed = [simhash.signed(p % 2**64) for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    links = simhash.fingerprint_links(frame, crowd=crowd)
    assert all(((r.a ^ r.b) % 2**64).bit_count() <= 4 for r in links.collect())
    found = {r.node: r.root for r in component_roots(links).collect()}
    expected = roots_by_hand(signed)
    assert {p: found.get(p, p) for p in signed} == expected


def test_links_stay_few_in_a_large_group(spark):
    centre = 0x0123456789ABCDEF
    near = sorted({centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)})
    frame = spark.createDataFrame([(simhash.signed(p),) for p in near], "fingerprint long")
    links = simhash.fingerprint_links(frame)
    assert links.count() < 64 * len(near)
    assert component_roots(links).select("root").distinct().count() == 1


def test_every_pair_within_distance_shares_a_signature():
    chance = random.Random(3)
    for distance in (1, 2, 3, 4, 6):
        for _ in range(200):
            a = chance.getrandbits(64)
            b = a
            for bit in chance.sample(range(64), distance):
                b ^= 1 << bit
            shared = [
                bit
                for run in simhash.segments(0, distance)
                for bit in run
                if not (a ^ b) & simhash.kept_bits(bit + 1, distance)[0]
            ]
            assert shared


def test_bit_counts_of_negative_numbers():
    left, right = np.array([-1, 5]), np.array([0, 4])
    assert simhash.differing_bits(left, right).tolist() == [64, 1]


def test_one_document_of_each_group_stays(odd, clashing, empty):
    kept = simhash.one_of_each(odd)
    ids = [r.doc_id for r in kept.collect()]
    assert len([i for i in ids if i is not None]) == len({i for i in ids if i is not None})
    classes = simhash.near_duplicates(odd).where("component_id IS NOT NULL")
    assert set(ids) - {None} == {r.component_id for r in classes.select("component_id").collect()}
    assert simhash.one_of_each(clashing).columns == clashing.columns
    assert simhash.one_of_each(empty).count() == 0


def test_components_of_a_long_path(spark):
    path = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = component_roots(path.union(spark.createDataFrame([(900, 901), (901, 900)], "a long, b long")))
    assert {r.root for r in found.where("node < 500").collect()} == {0}
    assert {r.root for r in found.where("node >= 500").collect()} == {900}
    assert found.count() == 303
    assert component_roots(path.limit(0)).count() == 0


def test_every_component_keeps_one_row_whatever_its_ids(spark):
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    other = "aa bb cc dd ee ff gg hh ii jj kk ll mm nn oo pp qq rr ss tt"
    third = "red orange yellow green blue indigo violet white black grey brown pink teal"
    rows = [
        (7, base, "x"), (7, other, "y"), (3, base, "z"), (None, other, "n"), (7, other, "y"),
        (None, third, "m"), (None, third, "m"), (None, third + " gold", "o"), (9, None, "p"), (8, "", "q"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, key string")
    roots = roots_by_hand([print_by_hand(text) for _, text, _ in rows])
    results = [
        sorted(map(str, simhash.one_of_each(frame.repartition(n)).collect())) for n in (1, 4, 9)
    ]
    assert results[0] == results[1] == results[2]
    kept = simhash.one_of_each(frame).collect()
    assert kept and simhash.one_of_each(frame).columns == frame.columns
    groups = [roots[print_by_hand(r.text)] for r in kept]
    assert sorted(groups) == sorted(set(roots.values()))
    assert {(r.doc_id, r.text) for r in kept} >= {(3, base), (7, other), (8, "")}
    assert {r.doc_id for r in kept if r.text and r.text.startswith(third)} == {None}


def test_rounds_of_few_links_write_few_files(spark, monkeypatch):
    """Every file starts a process on a local disk, so files follow the links, not the partitions."""
    files = []

    def settled(frame, name):
        copy = settle(frame, name)
        files.append(len(copy.inputFiles()))
        return copy

    monkeypatch.setattr(components, "settle", settled)
    links = spark.createDataFrame([(n, n + 1) for n in range(300)], "a long, b long")
    kept = {key: spark.conf.get(key) for key in (PARTITIONS, MERGED)}
    try:
        spark.conf.set(PARTITIONS, "64")
        spark.conf.set(MERGED, "false")
        roots = components.component_roots(links)
        assert {tuple(row) for row in roots.collect()} == {(n, 0) for n in range(301)}
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
    assert len(files) > 3 and max(files[2:]) <= spark.sparkContext.defaultParallelism
