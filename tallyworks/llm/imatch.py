"""Document fingerprints after I-Match, with several randomised lexicon subsets."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import ALNUM_WORD
from tallyworks.session import settle

# The band: terms that between e^-IDF_HIGH and e^-IDF_LOW of all documents have.
IDF_LOW = 3.0
IDF_HIGH = 6.5
# Bits of a term's hash that must be zero for it to be in a subset: each subset
# keeps a random 2^-bits of the lexicon and reads bits of its own, 60 in all.
SUBSET_BITS = (2, 2, 2, 2, 2, 4, 4, 4, 4, 4, 6, 6, 6, 6, 6)
EMPTY = "--------"
# A lexicon of more terms is joined by key instead of being broadcast.
BROADCAST_TERMS = 1_000_000
# In the lexicon, so that a text without any term in the band keeps one row.
NO_TERM = ""


def text_terms(text: Column) -> Column:
    """Distinct lower-case words of a text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(ALNUM_WORD), F.lit(0)))


def term_code(term: Column) -> Column:
    """60 bits of the term's MD5: orders the terms and decides their subsets."""
    return F.conv(F.substring(F.md5(term), 1, 15), 16, 10).cast("bigint")


def lexicon(documents: DataFrame, low: float = IDF_LOW, high: float = IDF_HIGH) -> DataFrame:
    """(term, code) of the terms whose inverse document frequency lies in [low, high].

    Counted over all documents. A term has at least e^-high of all documents, so
    there are at most e^high times as many terms as a document has distinct
    terms on average, however many documents there are.
    """
    total = documents.count()
    counts = (
        documents.select(F.explode(text_terms(F.col("text"))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("documents_with"))
    )
    idf = F.log(F.lit(float(total)) / F.col("documents_with"))
    return (
        counts.where(idf.between(low, high))
        .select("term", term_code(F.col("term")).alias("code"))
    )


def range_buckets(documents: DataFrame, rows_each: int = 2_000, cells: int = 128) -> Column:
    """A bucket number that never falls as doc_id falls; null ids come last.

    The ids' quantiles cut them into ``cells`` and equal widths cut each cell
    again, so that a bucket holds about ``rows_each`` rows. Any such numbering
    gives the same result; only the balance depends on it.
    """
    steps = [step / cells for step in range(1, cells)]
    rows, lowest, highest, cuts = documents.agg(
        F.count("doc_id"),
        F.min("doc_id"),
        F.max("doc_id"),
        F.percentile_approx("doc_id", steps, 10_000),
    ).first()
    if not rows:
        return F.lit(0)
    edges = sorted({int(lowest), *(int(cut) for cut in cuts)})
    parts = max(1, math.ceil(rows / cells / rows_each))
    last = len(edges)
    ends = [*edges[1:], int(highest) + 1]
    doc_id = F.col("doc_id")
    cell = F.size(F.filter(F.array(*[F.lit(edge) for edge in edges]), lambda edge: edge <= doc_id))
    start = F.element_at(F.array(*[F.lit(edge) for edge in edges]), cell)
    width = F.element_at(
        F.array(*[F.lit(max(1, end - edge)) for edge, end in zip(edges, ends, strict=True)]), cell
    )
    part = F.floor((doc_id - start) / width * parts)
    return F.when(doc_id.isNull(), F.lit(last * parts)).otherwise(
        (last - cell) * parts + (parts - 1 - F.least(part, F.lit(parts - 1)))
    )


def with_next_text(documents: DataFrame) -> DataFrame:
    """(bucket, place, doc_id, text, next_text, over_edge) in descending doc_id.

    ``next_text`` is the following document's text, after the last the first's;
    rows of equal doc_id follow each other by text. The rows move once, to their
    bucket; only the first text of each bucket moves again, to the bucket before.
    ``over_edge`` marks rows whose next one lies in another bucket.
    """
    rows = documents.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        range_buckets(documents).cast("long").alias("bucket"),
    )
    inside = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    placed = rows.select(
        "*",
        F.row_number().over(inside).alias("place"),
        F.lead("text").over(inside).alias("next_inside"),
    )
    heads = placed.where(F.col("place") == 1).select("bucket", F.col("text").alias("head"))
    order = Window.orderBy("bucket")
    everything = Window.partitionBy()
    followed = rows.select("bucket").distinct().select(
        "bucket",
        F.coalesce(F.lead("bucket").over(order), F.min("bucket").over(everything)).alias("following"),
    )
    next_heads = followed.join(
        heads.withColumnRenamed("bucket", "following"), "following"
    ).select("bucket", "head")
    return placed.join(next_heads, "bucket").select(
        "bucket",
        "place",
        "doc_id",
        "text",
        F.coalesce("next_inside", "head").alias("next_text"),
        F.col("next_inside").isNull().alias("over_edge"),
    )


def signatures(codes: Column, spare: Column) -> Column:
    """One signature of the whole lexicon and one of every subset.

    A subset in which the text has no term gives a blank. A text that has no term in
    the band gives ``spare`` everywhere.
    """

    def signed(kept: Column) -> Column:
        joined = F.md5(F.array_join(kept.cast("array<string>"), ","))
        return F.when(F.size(kept) > 0, F.substring(joined, 1, 8)).otherwise(EMPTY)

    def subset(offset: int, bits: int) -> Column:
        return F.filter(
            codes, lambda code: F.pmod(F.shiftright(code, offset), F.lit(2**bits)) == 0
        )

    offsets = [sum(SUBSET_BITS[:place]) for place in range(len(SUBSET_BITS))]
    subsets = [signed(subset(*cut)) for cut in zip(offsets, SUBSET_BITS, strict=True)]
    return F.when(F.size(codes) > 0, F.array(signed(codes), *subsets)).otherwise(
        F.array_repeat(spare, 1 + len(SUBSET_BITS))
    )


def likeness(left: Column, right: Column) -> Column:
    """Share of equal signatures among those where either text has terms."""
    pairs = F.filter(
        F.arrays_zip(left.alias("l"), right.alias("r")),
        lambda pair: (pair["l"] != EMPTY) | (pair["r"] != EMPTY),
    )
    equal = F.filter(pairs, lambda pair: pair["l"] == pair["r"])
    return F.size(equal) / F.size(pairs)


def spare_signature(terms: Column) -> Column:
    return F.substring(F.md5(F.array_join(F.sort_array(terms), " ")), 1, 8)


def fingerprint_report(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text takes the place of the last half of the code points by as
    many from the start of the next document in descending doc_id. Null texts
    count as empty; repeated rows are documents of their own, the next in order of their texts;
    an empty table has no rows. Other columns are not read, so their names may clash. Texts
    move between machines once; their terms meet the lexicon, and are gathered again, where
    the text lies.
    """
    terms = settle(
        lexicon(documents).union(
            documents.sparkSession.sql(f"SELECT '{NO_TERM}' AS term, CAST(NULL AS bigint) AS code")
        ),
        "lexicon",
    )
    if terms.count() <= BROADCAST_TERMS:
        terms = F.broadcast(terms)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    pairs = (
        with_next_text(documents)
        .withColumn("n_chars", F.char_length("text").cast("long"))
        .withColumn(
            "edited",
            F.concat(
                F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
                F.substring("next_text", F.lit(1), half),
            ),
        )
    )
    kinds = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), text_terms(F.col(column)).alias("terms"))
            for kind, column in enumerate(["text", "edited"])
        ],
        F.when(
            F.col("over_edge"),
            F.struct(F.lit(2).alias("kind"), text_terms(F.col("next_text")).alias("terms")),
        ),
    )
    identity = ["bucket", "place", "doc_id", "n_chars", "edited_sha256", "over_edge"]
    # The columns beside the exploded terms stay small: each is repeated for every term.
    words = (
        pairs.select(
            "*",
            F.sha2("edited", 256).alias("edited_sha256"),
            F.explode(F.filter(kinds, lambda kind: kind.isNotNull())).alias("version"),
        )
        .select(*identity, "version.kind", "version.terms")
        .withColumn("spare", spare_signature(F.col("terms")))
        .select(
            *identity,
            "kind",
            "spare",
            F.explode(F.concat(F.array(F.lit(NO_TERM)), F.col("terms"))).alias("term"),
        )
        .join(terms, "term")
    )

    def gathered(kind: int) -> list[Column]:
        mine = F.col("kind") == kind
        return [
            F.sort_array(F.collect_set(F.when(mine, F.col("code")))).alias(f"codes_{kind}"),
            F.max(F.when(mine, F.col("spare"))).alias(f"spare_{kind}"),
        ]

    marks = (
        words.groupBy(*identity)
        .agg(*[column for kind in range(3) for column in gathered(kind)])
        .select(
            "*",
            *[
                signatures(F.col(f"codes_{kind}"), F.col(f"spare_{kind}")).alias(f"marks_{kind}")
                for kind in range(3)
            ],
        )
    )
    inside = Window.partitionBy("bucket").orderBy("place")
    following = F.when(F.col("over_edge"), F.col("marks_2")).otherwise(
        F.lead("marks_0").over(inside)
    )
    return marks.withColumn("marks_next", following).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.array_join("marks_0", "").alias("fingerprint"),
        F.array_join("marks_1", "").alias("edited_fingerprint"),
        likeness(F.col("marks_0"), F.col("marks_1")).alias("near_edited"),
        likeness(F.col("marks_0"), F.col("marks_next")).alias("near_next"),
    )
