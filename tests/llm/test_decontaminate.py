from __future__ import annotations

import random

import numpy as np
import pytest
from tallyworks.llm import decontaminate
from tallyworks.llm.fmindex import FMIndex, WaveletTree, suffix_order


def test_suffix_order_and_ranks():
    chance = np.random.default_rng(2)
    for size, top in ((1, 1), (50, 2), (300, 9), (200, 200)):
        symbols = chance.integers(0, top + 1, size)
        text = [*symbols.tolist(), -1]
        expected = sorted(range(len(text)), key=lambda at: text[at:])
        assert suffix_order(np.array(text)).tolist() == expected
        tree = WaveletTree(symbols, max(1, int(top).bit_length()))
        places = chance.integers(0, size + 1, 40)
        wanted = chance.integers(0, top + 1, 40)
        ranks = [int((symbols[:p] == s).sum()) for p, s in zip(places, wanted, strict=True)]
        assert tree.rank(wanted, places).tolist() == ranks
        assert tree.at(np.arange(size)).tolist() == symbols.tolist()


@pytest.mark.parametrize("sample", [1, 3, 8])
def test_backward_search_equals_scanning(sample):
    chance = random.Random(4)
    for _ in range(20):
        text = [chance.randint(1, 3) for _ in range(chance.randint(1, 120))] + [4]
        index = FMIndex(np.array(text), 4, sample)
        phrases = np.zeros((12, 5), dtype=np.int64)
        lengths = np.array([chance.randint(1, 5) for _ in range(12)])
        for row, size in enumerate(lengths):
            phrases[row, 5 - size :] = [chance.randint(1, 3) for _ in range(size)]
        starts, ends = index.search(phrases, lengths)
        for row, size in enumerate(lengths):
            phrase = phrases[row, 5 - size :].tolist()
            scan = [at for at in range(len(text)) if text[at : at + size] == phrase]
            assert sorted(index.locate(np.arange(starts[row], ends[row])).tolist()) == scan


def test_spans_merge():
    spans = decontaminate.merged(np.array([5, 1, 3, 20]), np.array([9, 4, 6, 22]))
    assert spans == [{"start": 1, "end": 9}, {"start": 20, "end": 22}]
    assert decontaminate.merged(np.array([]), np.array([])) == []


def test_small_shards_and_several_blocks_change_nothing(spark, documents, folder, monkeypatch):
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    whole = sorted(decontaminate.contamination_report(documents, benchmark).collect())
    assert any(r.contaminated for r in whole)
    monkeypatch.setattr(decontaminate, "BLOCK_PHRASES", 150)
    assert sorted(decontaminate.contamination_report(documents, benchmark).collect()) == whole
    phrases = decontaminate.Phrases([(b"x y z w v u t s r q", ["a"]), (b"y z w v u t s r q p", ["a"])], 10)
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 7)
    shard = decontaminate.Shard(phrases)
    words = decontaminate.words_of(b"x y z w v u t s r q p " * 5)
    shard.add(3, np.array([phrases.numbers[word] for word in words]))
    document, first, phrase = shard.occurrences()
    found = sorted(zip(first.tolist(), phrase.tolist(), strict=True))
    assert set(document) == {3}
    assert sorted(set(found)) == sorted((11 * n + shift, shift) for n in range(5) for shift in (0, 1))


def test_clean_documents_keep_their_columns(spark, odd, clashing, empty):
    benchmark = spark.createDataFrame([(1, "Jumps over one lazy dog and runs through a green")], "item_id int, text string")
    for frame in (odd, clashing, empty):
        kept = decontaminate.clean_documents(frame, benchmark)
        assert kept.columns == frame.columns
        expected = [r for r in frame.collect() if "jumps over one lazy dog" not in (r.text or "")]
        assert sorted(map(str, kept.collect())) == sorted(map(str, expected))
        assert decontaminate.clean_documents(frame, benchmark.limit(0)).count() == frame.count()


def test_phrases_of_the_benchmark_and_their_items(spark):
    rows = [("b", "One two, THREE four"), ("a", "two three four five"), (None, "one two three four"),
            ("c", "One"), ("d", ""), ("e", None), ("b", "one two")]
    table = decontaminate.benchmark_phrases(spark.createDataFrame(rows, "item_id string, text string"), 3)
    assert {bytes(r.phrase): r.owners for r in table.collect()} == {
        b"one two three": ["", "b"], b"two three four": ["", "a", "b"], b"three four five": ["a"],
        b"one": ["c"], b"one two": ["b"],
    }
