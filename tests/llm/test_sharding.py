from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tallyworks.llm import mixing, sharding
from tallyworks.session import splits


def jump_by_hand(key: int, shards: int) -> int:
    found, jump = -1, 0
    while jump < shards:
        found = jump
        key = (key * 2862933555777941757 + 1) % 2**64
        jump = int((found + 1) * (2**31 / ((key >> 33) + 1)))
    return found


def test_jump_hash_equals_the_published_loop():
    keys = [0, 1, 2, 10, 2**63, 2**64 - 1, *range(1000, 1100)]
    for shards in (1, 2, 40, 41, 1000):
        found = sharding.jump_hash(np.array(keys, dtype=np.uint64), shards)
        assert found.tolist() == [jump_by_hand(key, shards) for key in keys]


def test_another_shard_takes_its_part_and_moves_nothing_else():
    keys = np.arange(200_000, dtype=np.uint64)
    before, after = sharding.jump_hash(keys, 40), sharding.jump_hash(keys, 41)
    moved = before != after
    assert (after[moved] == 40).all()
    assert 0.9 < moved.mean() * 41 < 1.1
    counts = np.bincount(before)
    assert counts.max() / counts.min() < 1.2


@pytest.mark.parametrize("table", ["odd", "empty", "documents"])
def test_report(request, table):
    documents = request.getfixturevalue(table)
    rows = sharding.shard_report(documents, 40).collect()
    texts = documents.select("doc_id", "text").collect()
    expected = Counter(
        (
            doc_id,
            16 + len((text or "").encode()),
            None if text is None else zlib.crc32(text.encode()),
            jump_by_hand((doc_id or 0) % 2**64, 40),
            jump_by_hand((doc_id or 0) % 2**64, 41),
        )
        for doc_id, text in texts
    )
    assert expected == Counter(
        (r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in rows
    )
    slots = defaultdict(list)
    for row in rows:
        assert row.law == "key"
        slots[row.shard].append(row.slot)
    assert all(sorted(each) == list(range(len(each))) for each in slots.values())


def test_sharding_keeps_all_rows_and_columns(clashing):
    sharded = sharding.shard_documents(clashing, 4)
    assert sorted(sharded.columns) == sorted(clashing.columns)
    assert sharded.count() == clashing.count()
    assert sharded.where("slot IS NULL OR shard IS NULL").count() == 0


def test_a_task_hashes_its_keys_once(documents):
    """A second hash in a task takes a second Python worker for every core."""
    for sharded in (sharding.shard_documents(documents, 40), sharding.shard_report(documents, 40)):
        plan = sharded._jdf.queryExecution().optimizedPlan().toString()
        # the rows, and the counts of the buckets
        assert plan.count("ArrowEvalPython [assign") == 2


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("shards", [40, 2_000])
def test_slots_have_no_gaps_whether_starts_are_broadcast_or_not(documents, shards):
    report = sharding.shard_report(documents, shards)
    assert ("strategy=broadcast" in plan_of(report)) == (shards == 40)
    slots = defaultdict(list)
    for row in report.collect():
        slots[row.shard].append(row.slot)
    assert sum(map(len, slots.values())) == documents.count()
    assert all(sorted(each) == list(range(len(each))) for each in slots.values())


def test_rows_and_counts_share_one_hash_of_the_texts(documents):
    report = sharding.shard_report(documents, 40)
    report.collect()
    final = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("crc32(") == 1
    # for the rows one hash of the content and one of the order, the same for the counts, none to filter
    assert plan_of(sharding.shard_documents(documents, 40)).count("xxhash64(") == 4


def test_report_has_a_part_for_each_split_at_most(spark, documents):
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        parts = sharding.shard_report(documents, 40).rdd.getNumPartitions()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert parts <= splits(documents) < 64


def water_level(sizes: dict, share: float = 1.5, limit: int = 2) -> dict:
    """Targets by the rule as told: cap, share the excess out by weight, again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {source: (3, 1, 2)[place % 3] for place, source in enumerate(order)}
    target, free = dict.fromkeys(order, 0.0), list(order)
    rest = share * sum(sizes.values())
    while free:
        unit = rest / sum(weight[s] for s in free)
        capped = [s for s in free if weight[s] * unit > limit * sizes[s]]
        if not capped:
            target.update({s: weight[s] * unit for s in free})
            break
        for s in capped:
            target[s] = float(limit * sizes[s])
            rest -= target[s]
            free.remove(s)
    return target


@pytest.mark.parametrize("table", ["odd", "empty", "documents", "clashing"])
def test_mixing_targets_and_copies(request, table):
    documents = request.getfixturevalue(table)
    rows = mixing.with_copies(documents).select(
        "source", "size", "source_size", "target", "copies"
    ).collect()
    sizes = defaultdict(int)
    for row in rows:
        sizes[row.source] += row.size
    expected = water_level(sizes)
    for row in rows:
        assert row.source_size == sizes[row.source]
        assert row.target == pytest.approx(expected[row.source])
        rate = row.target / row.source_size if row.source_size else 0
        assert row.copies in (int(rate), int(rate) + 1) and row.copies <= 2
    mixed = mixing.mix(documents)
    assert mixed.columns == documents.columns
    assert mixed.count() == sum(row.copies for row in rows)
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix(documents).collect()))


def test_mixed_words_come_near_the_targets(spark):
    rows = [(n, "w " * (1 + n % 50), f"s{n % 4}") for n in range(8_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    totals = defaultdict(lambda: [0, 0.0])
    sources = {n: source for n, _, source in rows}
    for row in mixing.mixing_report(table).collect():
        totals[sources[row.doc_id]][0] += row.taken
        totals[sources[row.doc_id]][1] = row.target
    assert all(abs(taken / target - 1) < 0.05 for taken, target in totals.values())


def test_sources_come_near_their_targets_without_ids(spark):
    """Half the documents have no id; their texts draw for them, each its own."""
    rows = [
        (None if n % 2 else n, " ".join(f"w{n}x{k}" for k in range(5 + n % 7)), f"s{n % 3}") for n in range(9_000)
    ]
    rows += [(None, None, None), (None, "", "s0"), (None, "lonely words", None)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, target = Counter(), {}
    assert all(row.taken <= 2 * row.size for row in mixing.mixing_report(documents).collect())
    for row in mixing.with_copies(documents).collect():
        taken[row.source] += row.size * row.copies
        target[row.source] = row.target
    for source in ("s0", "s1", "s2"):
        assert taken[source] == pytest.approx(target[source], rel=0.05)
