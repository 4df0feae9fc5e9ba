from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from tallyworks.llm import divergence, sql

from test_llm_sql import assert_same, connection_with

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def by_hand(rows, min_documents, top):
    """The contract read literally: dense over all kept terms."""
    counts, present = defaultdict(Counter), defaultdict(Counter)
    groups = defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = TERM.findall(lowered(text))
        counts[lang, source].update(terms)
        present[lang].update(set(terms))
    found = set()
    for lang, sources in groups.items():
        kept = [t for t, n in present[lang].items() if n >= min_documents]

        def share(count, total):
            return 1 + 10**9 * (count + 5) // (total + 5 * len(kept))

        totals = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: share(counts[lang, s][t], totals[s]) for t in kept} for s in sources}
        overall = {t: sum(counts[lang, s][t] for s in sources) for t in kept}
        q = {t: share(overall[t], sum(overall.values())) for t in kept}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, ranked in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                found |= {(lang, s, part, item, -v, r) for r, (v, _, item) in enumerate(ranked, 1)}
    return found


def report(documents, **limits):
    return {
        (r.lang, r.source, r.part, r.item, r.value, r.rank)
        for r in divergence.divergence_report(documents, **limits).collect()
    }


@pytest.mark.parametrize("table", ["odd", "clashing", "empty", "documents"])
@pytest.mark.parametrize("limits", [{"min_documents": 2, "top": 3}, {"min_documents": 10_000, "top": 50}])
def test_report_equals_dense_arithmetic(request, table, limits):
    documents = request.getfixturevalue(table)
    rows = [(r.lang, r.source, r.text) for r in documents.select("lang", "source", "text").collect()]
    assert report(documents, **limits) == by_hand(rows, **limits)


def test_one_hot_source_among_many_equals_dense_arithmetic(spark):
    rows = [("xx", "hot", f"alpha beta gamma{'x' * (n % 7)}") for n in range(300)]
    rows += [("xx", f"s{n % 9}", f"alpha Delta {'é' * (n % 5 + 1)} beta") for n in range(90)]
    rows += [("xx", "silent", "12 34 -- "), ("xx", None, None), (None, "alone", "word"), ("yy", "a", ""), ("yy", "b", None)]
    documents = spark.createDataFrame(rows, "lang string, source string, text string")
    limits = {"min_documents": 30, "top": 50}
    found = report(documents, **limits)
    assert found == by_hand(rows, **limits)
    assert ("yy", "a", "pair", "b", 0, 1) in found
    assert {r[1] for r in found if r[0] == "xx"} >= {"silent", ""}


def test_odd_tables_equal_sql(odd, empty, tmp_path):
    for name, documents in (("odd", odd), ("empty", empty)):
        (tmp_path / name).mkdir()
        connection = connection_with(tmp_path / name, documents=documents)
        assert_same(divergence.divergence_report(documents, min_documents=2), connection, sql.source_divergence(2))


def test_counts_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(10**14, 3 * 10**15, 7)], "count long, total long, terms long")
    [row] = frame.select(divergence.probability(F.col("count"), F.col("total"), F.col("terms")).alias("p")).collect()
    assert row.p == 1 + 10**9 * (10**14 + 5) // (3 * 10**15 + 35)


def test_vectors_count_whole_texts(spark):
    text = "Ab ab " * 100_000 + "ÜBER über"
    documents = spark.createDataFrame([(text, "x", "y")], "text string, lang string, source string")
    [row] = divergence.document_vectors(documents).collect()
    assert {(e["term"], e["count"]) for e in row.vector} == {("ab", 200_000), ("Über", 1), ("über", 1)}
