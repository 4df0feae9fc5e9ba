from __future__ import annotations

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
# Extra columns that clash with names the operators use inside or return.
CLASHING = (
    "size long, source_size long, target double, copies int, copy int, shard int, slot long, bucket int, "
    "first long, rank int, kept boolean, fingerprint string, component_id long, n_words long, "
    "spans string, items string, weak_bad double, score double, lang_pred string, term string, "
    "base_spans string, secret_spans string, path string, rate double, origin string, place int"
)
PROSE = "the quick brown fox jumps over one lazy dog and runs through a green field toward home again"


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and blank texts, repeated rows, ties and a very long text."""
    long = " ".join(f"{PROSE} {n}" for n in range(3_000))
    return [
        (1, PROSE, "en", "a", 10),
        (1, PROSE, "en", "a", 10),
        (2, PROSE, "en", "a", 10),
        (3, None, "en", "b", 10),
        (4, "", "en", "b", 0),
        (5, " \n\t ", None, None, 4),
        (6, "Ünïcode ß ñ 字 😀 words", "de", None, None),
        (None, "a text without a name", "en", "a", 3),
        (None, None, None, None, None),
        (7, long, "en", "c", len(long)),
        (7, PROSE + " once more", "en", "c", 5),
        (-8, "%%% ### !!! | | |", "en", "c", 17),
        (2**62, "one", "en", "z", 3),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCUMENT)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture(scope="session")
def clashing(spark):
    width = len(CLASHING.split(","))
    return spark.createDataFrame(
        [(*row, *[None] * width) for row in odd_rows()], f"{DOCUMENT}, {CLASHING}"
    )


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
