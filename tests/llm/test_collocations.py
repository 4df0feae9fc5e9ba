from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tallyworks.llm import collocations, sql

from test_divergence import lowered
from test_llm_sql import assert_same, connection_with


def counts_by_hand(rows, longest=3):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            counts[lang or "und"][()] += len(words)
            for size in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    return counts


def by_hand(rows, support, longest, top):
    found = set()
    for lang, f in counts_by_hand(rows, longest).items():
        candidates = {p: n for p, n in f.items() if len(p) >= 2 and n >= support}
        ranked = []
        for phrase, a in candidates.items():
            inside = any(
                len(other) > len(phrase)
                and any(other[i : i + len(phrase)] == phrase for i in range(len(other)))
                and 100 * n >= 50 * a
                for other, n in candidates.items()
            )
            if not inside:
                cuts = [
                    (10**6 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k, f[phrase[:k]], f[phrase[k:]])
                    for k in range(1, len(phrase))
                ]
                score, _, left, right = min(cuts)
                ranked.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            found.add((lang, rank, phrase.decode(), -a, left, right, f[()], -score))
    return found


def report(documents, **limits):
    frame = collocations.collocation_report(documents, **limits)
    return {tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


@pytest.mark.parametrize("table", ["odd", "clashing", "empty", "documents"])
@pytest.mark.parametrize("longest", [2, 3, 4])
def test_report_equals_counting_by_hand(request, table, longest):
    documents = request.getfixturevalue(table)
    rows = [(r.lang, r.text) for r in documents.select("lang", "text").collect()]
    limits = {"support": 5 if table == "documents" else 2, "longest": longest, "top": 200}
    assert report(documents, **limits) == by_hand(rows, **limits)


def test_odd_tables_equal_sql(odd, empty, tmp_path):
    for name, documents in (("odd", odd), ("empty", empty)):
        (tmp_path / name).mkdir()
        connection = connection_with(tmp_path / name, documents=documents)
        assert_same(collocations.collocation_report(documents, support=2), connection, sql.phrase_collocations(2))


def test_shards_of_any_share_lose_no_phrase(spark, monkeypatch):
    """A phrase split over all shards, none of which has many of it, is still found exactly."""
    rows = [("xx", f"rare pair here {n}, common thing") for n in range(12)] + [("xx", "filler of words " * 50)] * 40
    documents = spark.createDataFrame(rows, "lang string, text string")
    limits = {"support": 10, "longest": 3, "top": 100}
    expected = by_hand(rows, **limits)
    assert any(phrase == "rare pair here" for _, _, phrase, *_ in expected)
    for splits in (1, 3, 52):
        assert report(documents.repartition(splits), **limits) == expected
    # a filter that lets nearly everything pass changes nothing, nor do small batches
    monkeypatch.setattr(collocations, "HELD", 10)
    assert report(documents.repartition(7), **limits) == expected


def test_only_shares_of_the_support_count_as_frequent(spark):
    rows = [("xx", "a b", 0, 0, 3, 0), ("xx", "c d", 2, 2, 2, 2), ("xx", "e f", 0, 1, 0, 0)]
    counted = spark.createDataFrame(
        [(lang, 2, phrase, *shards) for lang, phrase, *shards in rows],
        "lang string, size int, phrase string, in_0 long, in_1 long, in_2 long, in_3 long",
    )
    words = spark.createDataFrame(
        [("xx", 100, 25, 25, 25, 25)],
        "lang string, all_words long, words_0 long, words_1 long, words_2 long, words_3 long",
    )
    kept = collocations.frequent_somewhere(counted, words, 10).collect()
    assert {r.phrase for r in kept} == {"a b"}


def test_filter_has_all_frequent_phrases_and_a_fixed_size(spark):
    phrases = spark.range(5_000).select(
        F.lit("xx").alias("lang"), F.concat(F.lit("word é "), F.col("id").cast("string")).alias("phrase")
    )
    found = collocations.PhraseFilter(collocations.filter_of(phrases))
    assert len(found.bits) * 8 == collocations.FILTER_BITS

    def places(texts):
        hashes = [[xxhash.xxh64_intdigest(w) for w in text.encode().split()] for text in texts]
        return collocations.phrase_places(list(np.array(hashes, dtype=np.uint64).T), "xx")

    assert found.has(places(r.phrase for r in phrases.collect())).all()
    assert found.has(places(f"other é {n}" for n in range(5_000))).sum() < 50


def test_scores_beyond_64_bits(spark):
    rows = [("xx", 1, "a", 4 * 10**12), ("xx", 1, "b", 5 * 10**12), ("xx", 2, "a b", 3 * 10**12)]
    phrases = spark.createDataFrame(rows, "lang string, size int, phrase string, f long")
    [row] = collocations.scored_phrases(phrases, 2).collect()
    assert row.score == 10**6 * 9 * 10**24 // (20 * 10**24)
