"""Source divergence audit: sparse term vectors, group sums, and the pairs of sources they set apart."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.session import settle

MIN_DOCUMENTS = 30
# Added to every count of a kept term, and the parts into which a probability is divided.
PRIOR = 5
UNIT = 1_000_000_000
TOP_TERMS = 50
# A-Z count as a-z; letters and all bytes from 128 on belong to a term.
TERM_BYTES = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if 97 <= byte <= 122 or byte >= 128 else 32
    for byte in range(256)
)
# Documents whose vectors go to Spark in one batch hold about so many entries.
BATCH_ENTRIES = 1 << 18
VECTOR = pa.list_(pa.struct([("term", pa.string()), ("count", pa.int64())]))


def term_counts(text: bytes | None) -> Counter[bytes]:
    """The exact sparse vector of a UTF-8 text: its terms and how often each occurs."""
    return Counter((text or b"").translate(TERM_BYTES).split())


def document_vectors(documents: DataFrame) -> DataFrame:
    """(lang, source, vector array<struct<term, count>>) of every document; nulls read as ''."""

    def pack(langs: list, sources: list, vectors: list[Counter[bytes]]) -> pa.RecordBatch:
        ends = [0]
        for vector in vectors:
            ends.append(ends[-1] + len(vector))
        terms = pa.array([term for vector in vectors for term in vector], pa.binary())
        counts = pa.array([n for vector in vectors for n in vector.values()], pa.int64())
        entries = pa.StructArray.from_arrays(
            [terms.view(pa.string()), counts], fields=list(VECTOR.value_type)
        )
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(sources, pa.string()), lists],
            ["lang", "source", "vector"],
        )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, sources, vectors, held = [], [], [], 0
            for lang, source, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                vector = term_counts(text)
                langs.append(lang)
                sources.append(source)
                vectors.append(vector)
                held += len(vector)
                if held >= BATCH_ENTRIES:
                    yield pack(langs, sources, vectors)
                    langs, sources, vectors, held = [], [], [], 0
            yield pack(langs, sources, vectors)

    rows = documents.select(
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.col("text").cast("binary").alias("text"),
    )
    return rows.mapInArrow(
        compute, "lang string, source string, vector array<struct<term:string,count:bigint>>"
    )


def group_sums(vectors: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(lang, source, term, count, lang_count) of the terms that enough documents of a language have.

    The vectors of a group add up within each task first. The vocabulary has no
    other limit than ``min_documents``; it stays a table and never meets the driver.
    """
    summed = (
        vectors.select("lang", "source", F.explode("vector").alias("entry"))
        .groupBy("lang", "source", F.col("entry.term").alias("term"))
        .agg(F.sum("entry.count").alias("count"), F.count(F.lit(1)).alias("documents"))
    )
    term = Window.partitionBy("lang", "term")
    return (
        summed.withColumns(
            {
                "lang_count": F.sum("count").over(term),
                "documents": F.sum("documents").over(term),
                "opens": F.row_number().over(term.orderBy("source")) == 1,
            }
        )
        .where(F.col("documents") >= min_documents)
        .drop("documents")
    )


def probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + PRIOR) / (total + PRIOR * terms)), without overflow."""
    above = (count + F.lit(PRIOR)).cast("decimal(19,0)") * F.lit(UNIT).cast("decimal(10,0)")
    below = (total + F.lit(PRIOR) * terms).cast("decimal(19,0)")
    return F.lit(1) + F.call_function("div", above, below)


def group_levels(documents: DataFrame, sums: DataFrame) -> DataFrame:
    """(lang, source, total, terms, lang_total, floor) of every group that occurs.

    ``floor`` is the probability of a kept term that the group lacks; null
    where its language keeps no term.
    """
    groups = documents.select(
        F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")
    ).distinct()
    totals = sums.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    langs = sums.groupBy("lang").agg(
        F.count_if("opens").alias("terms"), F.sum("count").alias("lang_total")
    )
    return (
        groups.join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .na.fill(0, ["total", "terms", "lang_total"])
        .withColumn(
            "floor",
            F.when(F.col("terms") > 0, probability(F.lit(0).cast("long"), F.col("total"), F.col("terms"))),
        )
    )


def telling_terms(probable: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, item, value, rank): the terms a group has more often than its language."""
    expected = probability(F.col("lang_count"), F.col("lang_total"), F.col("terms"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        probable.select("lang", "source", F.col("term").alias("item"), (F.col("p") - expected).alias("value"))
        .where("value > 0")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
    )


def source_pairs(levels: DataFrame, probable: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): the distance of every two sources of a language.

    Over all kept terms it is the distance of the two floors, once a term, plus what
    the terms of either source change. What one source alone changes depends on the
    term's count only, so terms of equal count are taken together; what
    both change is summed over the terms they share.
    """
    one = levels.select("lang", "source", "floor", "terms")
    other = levels.select("lang", F.col("source").alias("item"), F.col("floor").alias("other_floor"))
    pairs = one.join(other, "lang").where("source <> item")
    floors = F.abs(F.col("floor") - F.col("other_floor"))

    counted = probable.groupBy("lang", "source", "floor", "p").agg(F.count(F.lit(1)).alias("alike"))
    alone = (
        counted.join(other, "lang")
        .where("source <> item")
        .groupBy("lang", "source", "item")
        .agg(F.sum(F.col("alike") * (F.abs(F.col("p") - F.col("other_floor")) - floors)).alias("change"))
    )
    theirs = probable.select(
        "lang", "term", F.col("source").alias("item"), F.col("floor").alias("other_floor"), F.col("p").alias("q")
    )
    joint = (
        F.abs(F.col("p") - F.col("q"))
        - F.abs(F.col("p") - F.col("other_floor"))
        - F.abs(F.col("floor") - F.col("q"))
        + floors
    )
    shared = (
        probable.join(theirs, ["lang", "term"])
        .where("source < item")
        .groupBy("lang", "source", "item")
        .agg(F.sum(joint).alias("change"))
    )
    turned = ["lang", F.col("item").alias("source"), F.col("source").alias("item"), "change"]
    changes = (
        alone.unionByName(alone.select(*turned))
        .unionByName(shared)
        .unionByName(shared.select(*turned))
        .groupBy("lang", "source", "item")
        .agg(F.sum("change").alias("change"))
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    value = F.coalesce(F.col("terms") * floors, F.lit(0)) + F.coalesce("change", F.lit(0))
    return (
        pairs.join(changes, ["lang", "source", "item"], "left")
        .select("lang", "source", "item", value.cast("long").alias("value"))
        .withColumn("rank", F.row_number().over(order))
    )


def divergence_report(
    documents: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS
) -> DataFrame:
    """(lang, source, part, item, value, rank): how the sources of each language differ.

    Null text, lang and source read as ''. Part ``pair`` ranks the other sources of
    the language by distance, part ``term`` the terms that the source has more often than
    its language. A group of documents without kept terms is a source like
    any other; where a language keeps no term, all distances are zero. Ties
    go by the item's UTF-8 bytes. Repeated rows count as often as they occur;
    an empty table has no rows. A long text is one vector of its distinct terms.
    Other columns are not read, so their names may clash.
    """
    sums = settle(group_sums(document_vectors(documents), min_documents), "group-sums")
    levels = settle(group_levels(documents, sums), "group-levels")
    probable = sums.join(levels, ["lang", "source"]).withColumn(
        "p", probability(F.col("count"), F.col("total"), F.col("terms"))
    )
    wanted = ["lang", "source", "part", "item", "value", "rank"]
    return (
        source_pairs(levels, probable)
        .withColumn("part", F.lit("pair"))
        .select(wanted)
        .unionByName(telling_terms(probable, top).withColumn("part", F.lit("term")).select(wanted))
    )
