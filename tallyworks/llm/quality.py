"""Quality classifier: weak labellers, their accuracies by expectation-maximisation, a linear scorer."""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import fresh, sampled

ABSTAIN, GOOD, BAD = 0, 1, 2
# Distinct texts that train the scorer; all documents train the label model.
SAMPLE = 4_000
BUCKETS = 1 << 15
ROUNDS = 60
REJECT_FROM = 0.5
# Fewer words than this say nothing about repetition.
FEW = 20
# Bytes of words: digits, letters and all of other scripts.
LETTERS = bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])
MARKS = b"#$%&*+/<=>@\\^_`{|}~"


class Facts:
    """Counts that the labellers share; shares are of words unless said otherwise."""

    def __init__(self, text: bytes):
        self.words = text.split()
        self.count = len(self.words)
        some = max(1, self.count)
        self.letters = (len(text) - len(text.translate(None, LETTERS))) / max(1, len(text))
        self.marks = (len(text) - len(text.translate(None, MARKS))) / some
        self.exclamations = text.count(b"!") / some
        seen = Counter(self.words)
        self.distinct = len(seen) / some
        self.commonest = max(seen.values(), default=0) / some
        self.lone = sum(n for word, n in seen.items() if not word.strip(MARKS)) / some
        self.shouted = sum(n for word, n in seen.items() if len(word) > 1 and word.isupper()) / some
        self.echoed = sum(map(operator.eq, self.words, self.words[1:])) / some
        lines = [line for line in text.split(b"\n") if line.strip()]
        self.repeated_lines = 1 - len(set(lines)) / max(1, len(lines))
        self.length = sum(map(len, self.words)) / some


def beyond(value: float, good: float, bad: float) -> int:
    """A vote: bad from ``bad`` on, good up to ``good``, silent between; either may be larger."""
    if good < bad:
        return BAD if value >= bad else GOOD if value <= good else ABSTAIN
    return BAD if value <= bad else GOOD if value >= good else ABSTAIN


LABELLERS: list[Callable[[Facts], int]] = [
    lambda f: beyond(f.letters, good=0.74, bad=0.62),
    lambda f: beyond(f.marks, good=0.05, bad=0.4),
    lambda f: beyond(f.exclamations, good=0.1, bad=0.5),
    lambda f: beyond(f.lone, good=0.02, bad=0.15),
    lambda f: beyond(f.shouted, good=0.1, bad=0.4),
    lambda f: beyond(f.echoed, good=0.1, bad=0.3),
    lambda f: beyond(f.distinct, good=0.4, bad=0.2) if f.count >= FEW else ABSTAIN,
    lambda f: beyond(f.commonest, good=0.2, bad=0.4) if f.count >= FEW else ABSTAIN,
    lambda f: beyond(f.repeated_lines, good=0.35, bad=0.6),
    lambda f: GOOD if 3 <= f.length <= 12 else BAD if f.count and f.length > 25 else ABSTAIN,
]


def votes_code(text: bytes) -> int:
    """The labellers' votes as the digits of a number of base 3."""
    facts = Facts(text)
    return sum(labeller(facts) * 3**place for place, labeller in enumerate(LABELLERS))


def vote_digits(codes: np.ndarray) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


class LabelModel:
    """P(vote | class, not silent) of each labeller and the classes' shares, without true labels.

    Starts from "bad if any labeller says so", then alternates posteriors and
    shares over the counts of all vote patterns.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        votes = vote_digits(codes)
        posterior = np.where((votes == BAD).any(axis=1), 0.9, 0.1)
        for _ in range(ROUNDS):
            self.share = float((posterior * counts).sum() + 1) / float(counts.sum() + 2)
            self.votes = np.ones((2, len(LABELLERS), 3))
            for label, weight in enumerate(((1 - posterior) * counts, posterior * counts)):
                for vote in (GOOD, BAD):
                    self.votes[label, :, vote] = ((votes == vote) * weight[:, None]).sum(axis=0) + 1
            # A silent labeller says nothing about the class.
            self.votes[:, :, GOOD:] /= self.votes[:, :, GOOD:].sum(axis=2, keepdims=True)
            self.votes[:, :, ABSTAIN] = 1
            posterior = self.posterior(codes)

    def posterior(self, codes: np.ndarray) -> np.ndarray:
        """P(bad) for each vote pattern."""
        votes = vote_digits(np.asarray(codes, dtype=np.int64))
        each = np.arange(len(LABELLERS))
        good, bad = (np.log(self.votes[label, each, votes]).sum(axis=1) for label in (0, 1))
        odds = np.log(self.share) - np.log1p(-self.share) + bad - good
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def bucket(feature: bytes) -> int:
    return zlib.crc32(feature) % BUCKETS


def shape(word: bytes) -> bytes:
    """Character classes with repeats removed: ``Of%%%`` gives ``Xx%``."""
    classes = bytes(
        88 if 65 <= byte <= 90 else 120 if 97 <= byte <= 122 or byte >= 128 else 48 if 48 <= byte <= 57 else byte
        for byte in word[:64]
    )
    return bytes(b for b, before in zip(classes, b"\0" + classes, strict=False) if b != before)


def word_features(word: bytes) -> tuple[int, int]:
    return bucket(b"w" + word.lower()), bucket(b"s" + shape(word))


ECHO = bucket(b"echo")


def document_features(text: bytes) -> tuple[list[int], list[float]]:
    """Buckets and values: each feature's occurrences per word."""
    words = text.split()
    found: Counter[int] = Counter()
    for word, count in Counter(words).items():
        for feature in word_features(word):
            found[feature] += count
    found[ECHO] += sum(map(operator.eq, words, words[1:]))
    some = max(1, len(words))
    buckets = sorted(found)
    return buckets, [found[b] / some for b in buckets]


class Scorer:
    """Logistic regression over hashed features, on soft labels."""

    def __init__(self, rows: list[tuple[list[int], list[float], float]], steps: int = 300):
        self.weights = np.zeros(BUCKETS)
        self.bias = 0.0
        if not rows:
            return
        lengths = [len(buckets) for buckets, _, _ in rows]
        row = np.repeat(np.arange(len(rows)), lengths)
        column = np.concatenate([np.array(buckets, dtype=np.int64) for buckets, _, _ in rows])
        value = np.concatenate([np.array(values) for _, values, _ in rows])
        target = np.array([label for _, _, label in rows])
        total = np.zeros(BUCKETS)
        total_bias = 1e-8
        for _ in range(steps):  # AdaGrad on the whole sample
            odds = self.bias + np.bincount(row, value * self.weights[column], len(rows))
            error = 1 / (1 + np.exp(-np.clip(odds, -50, 50))) - target
            slope = np.bincount(column, value * error[row], BUCKETS) / len(rows)
            slope += 1e-4 * self.weights
            total += slope**2
            total_bias += error.mean() ** 2
            self.weights -= 2.0 * slope / np.sqrt(total + 1e-12)
            self.bias -= 0.5 * error.mean() / np.sqrt(total_bias)

    def scores(self, texts: Iterator[bytes]) -> Iterator[float]:
        """P(bad) of each text; a word's weight is looked up once a batch."""
        known: dict[bytes, float] = {}
        echo = float(self.weights[ECHO])
        for text in texts:
            words = text.split()
            odds = 0.0
            for word, count in Counter(words).items():
                weight = known.get(word)
                if weight is None:
                    weight = known[word] = float(self.weights[list(word_features(word))].sum())
                odds += weight * count
            odds += echo * sum(map(operator.eq, words, words[1:]))
            odds = self.bias + odds / max(1, len(words))
            yield 1 / (1 + float(np.exp(-np.clip(odds, -500, 500))))


def text_bytes(batch: pa.RecordBatch) -> Iterator[bytes]:
    for value in batch.column("text"):
        yield value.as_buffer().to_pybytes() if value.is_valid else b""


def fit_labels(documents: DataFrame) -> LabelModel:
    """Fits the label model to the votes on all documents; at most 3^10 patterns are counted."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = Counter(map(votes_code, text_bytes(batch)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())],
                ["code", "seen"],
            )

    counts = (
        documents.select("text").mapInArrow(vote, "code long, seen long")
        .groupBy("code").agg(F.sum("seen").alias("seen")).orderBy("code").collect()
    )
    codes, seen = (np.array([row[place] for row in counts], dtype=np.int64) for place in (0, 1))
    return LabelModel(codes, seen)


def fit_scorer(documents: DataFrame, labels: LabelModel, sample: int = SAMPLE) -> Scorer:
    """Trains on the ``sample`` distinct texts of smallest hash; on all if there are no more.

    Without any document there is nothing to train on, and nothing to score.
    """
    picked = sampled(documents, "text", sample)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = list(text_bytes(batch))
            rows = [document_features(text) for text in texts]
            label = labels.posterior(np.array([votes_code(text) for text in texts], dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([buckets for buckets, _ in rows], pa.list_(pa.int32())),
                    pa.array([values for _, values in rows], pa.list_(pa.float64())),
                    pa.array(label, pa.float64()),
                ],
                ["buckets", "shares", "label"],
            )

    # One of each set of copies: a text that holds a third of all rows would overfill the sample.
    rows = (
        documents.where(picked).select("text").distinct()
        .mapInArrow(featurise, "buckets array<int>, shares array<double>, label double")
        .collect()
    )
    return Scorer(sorted((list(r.buckets), list(r.shares), r.label) for r in rows))


def score_documents(
    documents: DataFrame, posterior: str = "weak_bad", score: str = "score"
) -> DataFrame:
    """``documents`` with P(bad) by the label model and by the scorer.

    Both models are fitted to the same documents. Null and empty texts have no
    words; most labellers are silent about them. Columns that have the new
    names are replaced.
    """
    rows = documents.drop(posterior, score)
    labels = fit_labels(rows)
    scorer = fit_scorer(rows, labels)
    context = documents.sparkSession.sparkContext.broadcast((labels, scorer))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label_model, linear = context.value
        for batch in batches:
            # the texts are read twice: no copy of a whole batch of them is held
            codes = np.array([votes_code(text) for text in text_bytes(batch)], dtype=np.int64)
            columns = [
                *batch.columns,
                pa.array(label_model.posterior(codes), pa.float64()),
                pa.array(list(linear.scores(text_bytes(batch))), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, posterior, score])

    empty = rows.withColumn(posterior, F.lit(0.0)).withColumn(score, F.lit(0.0))
    return rows.mapInArrow(apply, empty.schema)


def good_documents(documents: DataFrame, reject_from: float = REJECT_FROM) -> DataFrame:
    """The rows of ``documents`` that the scorer does not find bad."""
    names = fresh(documents, "weak_bad", "score")
    scored = score_documents(documents, *names)
    return scored.where(F.col(names[1]) < reject_from).select(*documents.columns)


def quality_report(documents: DataFrame) -> DataFrame:
    """doc_id, the label model's posterior, the scorer's score, and whether the document is kept.

    A score of exactly one half rejects. Repeated rows are judged alike; an empty table has no
    rows. Other columns are not read, so their names may clash.
    """
    return (
        score_documents(documents.select("doc_id", "text"))
        .select("doc_id", "weak_bad", "score", (F.col("score") < REJECT_FROM).alias("kept"))
    )
