"""The pipeline's stages against plain versions of what each decides."""

from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from tallyworks.llm import mixing, quality, simhash


def rows_of(frame):
    return Counter(map(str, frame.collect()))


def test_stages_decide_as_their_operators(spark, folder, documents):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs, seen = documents, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder).checkpoint()
        assert kept.columns == documents.columns
        seen.append((docs, kept))
        docs = kept
    (start, good), (_, single), (_, clean), (_, mixed) = seen
    judged = {r.doc_id for r in quality.quality_report(start).collect() if r.kept}
    assert {r.doc_id for r in good.collect()} == judged
    classes = simhash.near_duplicates(good).collect()
    assert sorted(r.doc_id for r in single.collect()) == sorted({r.component_id for r in classes})
    assert rows_of(clean) <= rows_of(single) and clean.count() < single.count()
    copies = {r.doc_id: r.copies for r in mixing.with_copies(clean).collect() if r.copies}
    assert Counter(r.doc_id for r in mixed.collect()) == copies
    final = corpus_pipeline.run(spark, folder)
    assert Counter(r.doc_id for r in final.collect()) == copies
    slots = defaultdict(list)
    for row in final.collect():
        slots[row.shard].append(row.slot)
    assert all(sorted(each) == list(range(len(each))) for each in slots.values())


def plain(row, columns) -> str:
    return str([row[c] for c in columns])


@pytest.mark.parametrize("table", ["odd", "empty", "clashing"])
def test_stages_take_odd_documents(request, spark, folder, table):
    """Each stage returns rows of its input: which ones, and how often, follows from plain rules."""
    frame = request.getfixturevalue(table)
    own = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = Counter(plain(r, own) for r in frame.collect())
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, frame, folder)
        assert result.columns[: len(frame.columns)] == frame.columns or name == "sharding"
        results[name] = result.collect()
        mine = Counter(plain(r, own) for r in results[name])
        assert set(mine) <= set(rows)
        if name in ("quality classifier", "benchmark decontamination"):
            # equal texts share their fate, so repeated rows stay or go together
            assert all(mine[row] in (0, n) for row, n in rows.items())
    single = results["SimHash near-dedup"]
    classes = simhash.near_duplicates(frame).collect()
    assert len(single) == len({(r.component_id, r.fingerprint if r.component_id is None else 0) for r in classes})
    copies = Counter()
    for r in mixing.with_copies(frame.select("doc_id", "text", "source")).collect():
        copies[str((r.doc_id, r.text, r.source))] += r.copies
    found = Counter(str((r.doc_id, r.text, r.source)) for r in results["mixing sources to target weights"])
    assert found == +copies
    assert len(results["sharding"]) == frame.count()
    if table == "empty":
        assert not any(results.values())
    else:
        assert {r.doc_id for r in results["quality classifier"]} >= {1, 2}
