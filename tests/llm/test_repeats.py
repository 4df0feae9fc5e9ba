from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from tallyworks.llm import repeats, sql
from tallyworks.llm import suffixes as s

from test_llm_sql import assert_same, connection_with


def by_hand(texts, length):
    """(n_bytes, n_removed, n_spans, sha256 of what stays) of every text."""
    strings = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    results = []
    for text in texts:
        gone = np.zeros(len(text) + 1, dtype=bool)
        for i in range(len(text) - length + 1):
            if strings[text[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, out in zip(text, gone) if not out)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        results.append((len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return results


@pytest.mark.parametrize("table", ["odd", "clashing", "empty", "documents"])
def test_report_equals_brute_force(request, table):
    documents = request.getfixturevalue(table)
    rows = documents.select("doc_id", "text").collect()
    texts = [(r.text or "").encode() for r in rows]
    expected = Counter((r.doc_id, *x) for r, x in zip(rows, by_hand(texts, 200), strict=True))
    found = repeats.repeat_report(documents)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert Counter(tuple(r) for r in found.collect()) == expected


def tangled(count: int) -> list[str]:
    """Texts that share passages, tails and periodic stretches, some exactly as long as the limit."""
    chance = random.Random(11)
    passages = ["".join(chance.choice("abcdé ") for _ in range(size)) for size in (39, 40, 41, 90, 300)]
    texts = []
    for n in range(count):
        parts = [chance.choice([*passages, "ab" * 60, "z" * 150, f"own {n} {chance.random()}"]) for _ in range(4)]
        texts.append(" ".join(parts)[chance.randrange(30) :])
    return [*texts, "", "short", "q" * 39, "q" * 41, texts[0], texts[0]]


@pytest.mark.parametrize("crowd", [3, 10_000])
def test_tangled_texts_equal_brute_force(spark, monkeypatch, crowd):
    """Crowded grams, small shards and blocks cut inside texts change no byte."""
    monkeypatch.setattr(repeats, "CROWD", crowd)
    monkeypatch.setattr(repeats, "SHARD", 500)
    monkeypatch.setattr(repeats, "BLOCK", 64)
    texts = tangled(60)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: tuple(r)[1:] for r in repeats.repeat_report(frame, 40).collect()}
    assert [found[n] for n in range(len(texts))] == by_hand([t.encode() for t in texts], 40)


def test_odd_tables_equal_sql(odd, empty, tmp_path):
    for name, documents in (("odd", odd), ("empty", empty)):
        (tmp_path / name).mkdir()
        connection = connection_with(tmp_path / name, documents=documents)
        assert_same(repeats.repeat_report(documents, 60), connection, sql.suffix_array_dedup(60))


def test_equal_strings_have_equal_grams_wherever_they_are():
    texts = [t.encode() for t in tangled(40)]
    gram_of, covered = {}, Counter()
    for rows, starts, counts, _, grams, _ in repeats.stretches(texts, 40):
        for row, start, count, gram in zip(rows, starts, counts, grams, strict=True):
            for at in range(start, start + count):
                assert gram_of.setdefault(texts[row][at : at + 40], gram) == gram
                covered[int(row), int(at)] += 1
    wanted = {(n, i) for n, text in enumerate(texts) for i in range(len(text) - 39)}
    assert set(covered) == wanted and set(covered.values()) <= {1}


def test_texts_without_repeats_keep_their_columns(odd, clashing):
    for documents in (odd, clashing):
        kept = repeats.without_repeats(documents)
        assert kept.columns == documents.columns and kept.count() == documents.count()
        texts = {r.text for r in kept.where("doc_id = 7").collect()}
        assert "the quick brown fox jumps over one lazy dog and runs through a green field toward home again once more" in texts
        assert kept.where("text IS NULL").count() == documents.where("text IS NULL").count()


@pytest.mark.parametrize("bucketed", [0, 4, 1_024])
def test_suffix_order_and_prefixes_equal_sorting(monkeypatch, bucketed):
    monkeypatch.setattr(s, "BUCKETED", bucketed)
    chance = np.random.default_rng(bucketed)
    for _ in range(150):
        text = np.append(chance.integers(1, chance.integers(2, 6), chance.integers(0, 70)), 0)
        symbols = text.tolist()
        order = s.suffix_array(text, int(text.max()) + 1)
        assert order.tolist() == sorted(range(len(symbols)), key=lambda at: symbols[at:])
        before = s.predecessors(order)
        shared = s.permuted_prefixes(text.astype(np.uint16), before)
        for at, other in enumerate(before.tolist()):
            same = 0
            while other >= 0 and symbols[at + same] == symbols[other + same]:
                same += 1
            assert shared[at] == same


def test_smaller_types_by_definition():
    chance = np.random.default_rng(5)
    for _ in range(50):
        text = np.append(chance.integers(1, 4, 30), 0).tolist()
        expected = [text[i:] < text[i + 1 :] for i in range(30)] + [True]
        assert s.smaller_types(np.array(text)).tolist() == expected
