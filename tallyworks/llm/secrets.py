"""Secret scan: fixed patterns, and a linear-chain conditional random field for the rest."""

from __future__ import annotations

import math
import re
import warnings
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import sampled
from tallyworks.session import settle

# The base patterns, in the order in which kinds are listed, and their shortest
# lengths (of group 2 where there is one, else of the match).
BASE = (
    (
        "assign",
        re.compile(
            r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
            r"([A-Za-z0-9+/_.=-]+)"
        ),
        8,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 16),
    ("hex", re.compile(r"[0-9a-f]+"), 32),
)
LEARNED = "crf"
KINDS = [*(kind for kind, _, _ in BASE), LEARNED]
OUTSIDE, BEGIN, INSIDE = range(3)
TOKEN = re.compile(r"[A-Za-z0-9+/_.-]+|[^\sA-Za-z0-9+/_.-]")
FEATURES = 1 << 14
# Distinct texts in the training sample; windows a document gives, and tokens on each side.
SAMPLE = 20_000
WINDOWS = 4
REACH = 8
STEPS = 80
SHORTEST = 8
KNOWN_TOKENS = 100_000
# Rows that a task turns into Python objects at a time.
SLICE = 256

Span = tuple[str, int, int]
PARTS = ("kind", "start", "end")


# Every match of a kind needs one of these in the lower-case text.
NEEDED = {"assign": ("passw", "secret", "token", "api"), "access": ("akia",)}
DIGIT = re.compile(r"[0-9]")


def base_spans(text: str) -> list[Span]:
    """All base matches, code points, end exclusive, by start and then kind."""
    found = []
    lower = text.lower()
    for place, (kind, pattern, shortest) in enumerate(BASE):
        if kind in NEEDED and not any(part in lower for part in NEEDED[kind]):
            continue
        if kind == "hex" and max(map(len, text.split()), default=0) < shortest:
            continue
        for match in pattern.finditer(text):
            low, high = match.span(pattern.groups)
            if high - low >= shortest:
                found.append((match.start(), place, match.end(), kind))
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def feature(name: str) -> int:
    return zlib.crc32(name.encode()) % FEATURES


ROLES = ("own word", "before", "two before", "after")
# The checksum runs on from a role's name over the word.
ROLE_SEEDS = [zlib.crc32(f"{role} ".encode()) for role in ROLES]


def word_ids(word: str) -> list[int]:
    """Features of a word for itself, the next token, the one after, and the one before."""
    name = word.encode()
    return [zlib.crc32(name, seed) % FEATURES for seed in ROLE_SEEDS]


def token_shape(token: str) -> list[str]:
    """What a token looks like, apart from which word it is."""
    size = len(token)
    digits = sum(map(str.isdigit, token))
    kinds = [
        "digit" * bool(digits),
        "upper" * any("A" <= c <= "Z" for c in token),
        "lower" * any("a" <= c <= "z" for c in token),
        "sign" * any(c in "+/_.-" for c in token),
    ]
    classes = "".join(kinds)
    names = [f"class {classes}", f"size {min(size, 16) if size < 16 else 16 + min(size, 64) // 8}"]
    names.append(f"class and size {classes} {size >= 8} {size >= 16} {size >= 24}")
    if size >= 8 and digits:
        counts = Counter(token)
        entropy = -sum(n / size * math.log2(n / size) for n in counts.values())
        names.append(f"entropy {round(entropy * 2)}")
        names.append(f"digits {digits * 8 // size}")
        changes = sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:], strict=False))
        names.append(f"changes {changes * 8 // size}")
        if token.lower().strip("0123456789abcdef") == "":
            names.append(f"hexadecimal {size >= 24}")
        names += [f"sign {sign} {min(token.count(sign), 4)}" for sign in "+/_.-" if sign in token]
    return names


def token_word(token: str) -> str:
    """The token itself if it could be a word; others are alike for their neighbours."""
    if len(token) <= 16 and DIGIT.search(token) is None:
        return token.lower()
    return "#"


@lru_cache(maxsize=10_000)
def token_features(token: str) -> list[list[int]]:
    """All features that a token gives itself, the next token, the one after, and the one before."""
    own, *others = word_ids(token_word(token))
    shape = [feature(f"own {name}") for name in token_shape(token)]
    return [[*shape, own], *[[other] for other in others]]


def file_features(text: str, tokens: int) -> list[int]:
    """Of the whole document, shared by all of its tokens."""
    some = max(1, tokens)
    return [
        feature(f"file assignments {min(3, text.count('=') + text.count(':'))}"),
        feature(f"file lines {min(4, text.count('\n') * 50 // some)}"),
        feature(f"file upper {text.isupper()}"),
        feature(f"file braces {'{' in text}"),
    ]


class Field:
    """Weights of the chain: one row a feature, one column a tag, and tag to tag steps."""

    def __init__(self) -> None:
        self.emit = np.zeros((FEATURES, 3))
        self.step = np.zeros((3, 3))

    def fit(self, features: np.ndarray, tags: np.ndarray, steps: int = STEPS) -> Field:
        """Maximum likelihood by AdaGrad over all windows.

        ``features`` is (windows, tokens, slots), padded by the extra row FEATURES;
        ``tags`` is (windows, tokens). Windows are as long as each other.
        """
        windows, size, _ = features.shape
        if not windows:
            return self
        emit_total, step_total = np.full((FEATURES + 1, 3), 1e-8), np.full((3, 3), 1e-8)
        emit = np.vstack([self.emit, np.zeros((1, 3))])
        truth = np.eye(3)[tags]
        steps_seen = np.einsum("wta,wtb->ab", truth[:, :-1], truth[:, 1:])
        flat = features.reshape(windows * size, -1)
        for _ in range(steps):
            scores = emit[flat].sum(axis=1).reshape(windows, size, 3)
            forward, backward = np.zeros_like(scores), np.zeros_like(scores)
            forward[:, 0] = scores[:, 0] + self.step[OUTSIDE]
            for at in range(1, size):
                reach = forward[:, at - 1, :, None] + self.step
                forward[:, at] = scores[:, at] + np.logaddexp.reduce(reach, axis=1)
            for at in range(size - 2, -1, -1):
                reach = self.step + (scores[:, at + 1] + backward[:, at + 1])[:, None, :]
                backward[:, at] = np.logaddexp.reduce(reach, axis=2)
            whole = np.logaddexp.reduce(forward[:, -1], axis=1)
            single = np.exp(forward + backward - whole[:, None, None])
            double = np.exp(
                forward[:, :-1, :, None]
                + self.step
                + (scores + backward)[:, 1:, None, :]
                - whole[:, None, None, None]
            ).sum(axis=(0, 1))
            error = (single - truth).reshape(windows * size, 3)
            slope = np.stack(
                [
                    np.bincount(
                        flat.ravel(), np.repeat(error[:, tag], flat.shape[1]), FEATURES + 1
                    )
                    for tag in range(3)
                ],
                axis=1,
            ) / windows + 1e-4 * emit
            slope[FEATURES] = 0
            step_slope = (double - steps_seen) / windows + 1e-4 * self.step
            emit_total += slope**2
            step_total += step_slope**2
            emit -= 0.3 * slope / np.sqrt(emit_total)
            self.step -= 0.3 * step_slope / np.sqrt(step_total)
        self.emit = emit[:FEATURES]
        return self

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """The best tags of one sequence of (tokens, 3) scores, by Viterbi.

        Where outside leads by more than two steps can give back, the best path
        is outside for certain. Such tokens cut the sequence into short runs with
        outside on both ends, and all runs are decoded side by side.
        """
        tags = np.zeros(len(scores), dtype=np.int64)
        swing = 2 * float(self.step.max() - self.step.min())
        open_ = scores[:, OUTSIDE] - scores[:, 1:].max(axis=1) <= swing
        edges = np.flatnonzero(np.diff(np.concatenate(([0], open_, [0]))))
        starts, ends = edges[::2], edges[1::2]
        if not len(starts):
            return tags
        order = np.argsort(starts - ends, kind="stable")
        starts, sizes = starts[order], (ends - starts)[order]
        best = scores[starts] + self.step[OUTSIDE]
        back = []
        for at in range(1, int(sizes[0])):
            live = int(np.searchsorted(-sizes, -at, side="left"))
            reach = best[:live, :, None] + self.step
            back.append(reach.argmax(axis=1))
            best[:live] = reach.max(axis=1) + scores[starts[:live] + at]
        last = ends[order] < len(scores)
        tag = (best + np.where(last[:, None], self.step[:, OUTSIDE], 0.0)).argmax(axis=1)
        tags[starts + sizes - 1] = tag
        for at in range(int(sizes[0]) - 1, 0, -1):
            live = len(back[at - 1])
            tag[:live] = back[at - 1][np.arange(live), tag[:live]]
            tags[starts[:live] + at - 1] = tag[:live]
        return tags


def true_tags(tokens: list[re.Match], spans: Iterable[Span]) -> np.ndarray:
    """Tags by the base spans: the first token that touches one begins it."""
    tags = np.zeros(len(tokens), dtype=np.int64)
    starts = np.array([token.start() for token in tokens])
    ends = np.array([token.end() for token in tokens])
    for kind, start, end in spans:
        touched = np.flatnonzero((starts < end) & (ends > start))
        if kind == "assign":  # the value alone, which ends the match, perhaps with padding
            words = [place for place in touched if tokens[place].group() != "="]
            touched = touched[touched >= words[-1]]
        tags[touched] = INSIDE
        if len(touched):
            tags[touched[0]] = BEGIN
    return tags


def looks_random(token: str) -> bool:
    """Letters and digits that alternate often: perhaps a secret that no base pattern knows."""
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:], strict=False))
    return len(token) >= 12 and changes >= 4 and any(map(str.isalpha, token))


ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def disguises(token: str) -> list[list[str]]:
    """Tokens of a secret of other kinds, fixed by the token.

    Itself, upper case, letters of either case, the same with signs and padding, in dashed
    groups, behind a name, and broken over punctuation.
    """
    noise = zlib.crc32(token.encode())

    def letters(count: int, alphabet: str = ALPHABET) -> str:
        nonlocal noise
        picked = []
        for place in range(count):
            noise = zlib.crc32(f"{noise} {place}".encode())
            picked.append(alphabet[noise % len(alphabet)])
        return "".join(picked)

    mark = ":~|,"[noise % 4]
    size = 16 + noise % 25
    secrets = [
        token,
        token.upper(),
        letters(size),
        letters(size, ALPHABET + "+/") + "=" * (1 + noise % 2),
        "-".join(letters(4 + size % 9) for _ in range(3 + size % 3)),
        "_".join([letters(2 + size % 3, ALPHABET[36:]), letters(4, ALPHABET[36:]), letters(size)]),
        mark.join(letters(8 + size % 9) for _ in range(2 + size % 3)),
    ]
    return [TOKEN.findall(secret) for secret in secrets]


def window_features(
    tokens: list[str], shared: list[int], start: int, size: int, alone: bool
) -> list[list[int]]:
    """Features of ``size`` tokens from ``start`` on; none outside the text, no neighbours' if ``alone``."""
    rows = []
    for place in range(start, start + size):
        row: list[int] = []
        if 0 <= place < len(tokens):
            row = [*shared, *token_features(tokens[place])[0]]
            for shift, role in () if alone else ((-1, 1), (-2, 2), (1, 3)):
                if 0 <= place + shift < len(tokens):
                    row += token_features(tokens[place + shift])[role]
        rows.append(row)
    return rows


def training_windows(text: str) -> Iterator[tuple[list[list[int]], list[int]]]:
    """Windows around base spans, and around tokens that look most like them but are none.

    Each window around a base span comes with its secret in other disguises, and with
    and without what neighbours say, so that neither alone decides. Tokens that look
    random but match no base pattern are of unknown kind: their windows are left out.
    """
    matches = list(TOKEN.finditer(text))
    tokens = [match.group() for match in matches]
    if not tokens:
        return
    tags = true_tags(matches, base_spans(text))
    shared = file_features(text, len(tokens))
    size = 2 * REACH + 1

    def labels(start: int, tags: list[int]) -> list[int]:
        return [
            tags[place] if 0 <= place < len(tags) else OUTSIDE for place in range(start, start + size)
        ]

    known = tags.tolist()
    for centre in np.flatnonzero(tags == BEGIN)[:WINDOWS].tolist():
        start = centre - REACH
        for parts in disguises(tokens[centre]):
            other = [*tokens[:centre], *parts, *tokens[centre + 1 :]]
            tagged = [*known[: centre + 1], *[INSIDE] * (len(parts) - 1), *known[centre + 1 :]]
            for alone in (False, True):
                yield window_features(other, shared, start, size, alone), labels(start, tagged)
    hard = [
        place
        for place, token in enumerate(tokens)
        if tags[place] == OUTSIDE and (len(token) >= 12 or any(map(str.isdigit, token)))
    ]
    unknown = {place for place in hard if looks_random(tokens[place])}
    clear = [
        place
        for place in [*hard, len(tokens) // 2]
        if unknown.isdisjoint(range(place - REACH, place + REACH + 1))
    ]
    for place, centre in enumerate([*clear[:WINDOWS], *clear[WINDOWS:][-1:]]):
        start = centre - REACH
        yield window_features(tokens, shared, start, size, bool(place % 2)), labels(start, known)


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


def fit_field(documents: DataFrame, sample: int = SAMPLE) -> Field:
    """Trains on windows of the ``sample`` distinct texts of smallest hash, labelled by the base patterns.

    Without a secret in them the field learns nothing and adds no span; a warning says so.
    """
    texts = documents.where(F.col("text").isNotNull())
    picked = sampled(texts, "text", sample)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [
                window for text in batch.column("text").to_pylist() for window in training_windows(text)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rows for rows, _ in found], pa.list_(pa.list_(pa.int32()))),
                    pa.array([tags for _, tags in found], pa.list_(pa.int32())),
                    pa.array([BEGIN in tags for _, tags in found], pa.bool_()),
                ],
                ["rows", "tags", "secret"],
            )

    windows = settle(
        texts.where(picked).select("text").distinct()
        .mapInArrow(cut, "rows array<array<int>>, tags array<int>, secret boolean"),
        "windows",
    )
    # At most 3,000 windows: the first 1,500 by hash that hold a secret, and so many others.
    order = F.xxhash64("rows", "tags")
    chosen = [
        row
        for secret in (True, False)
        for row in windows.where(F.col("secret") == secret).orderBy(order).limit(1_500).collect()
    ]
    if not any(window.secret for window in chosen):
        warnings.warn("no base secret in the training sample: the field adds no span", stacklevel=2)
    slots = max((len(row) for window in chosen for row in window.rows), default=1)
    features = np.full((len(chosen), 2 * REACH + 1, slots), FEATURES, dtype=np.int64)
    tags = np.zeros((len(chosen), 2 * REACH + 1), dtype=np.int64)
    for place, window in enumerate(chosen):
        tags[place] = window.tags
        for at, row in enumerate(window.rows):
            features[place, at, : len(row)] = row
    return Field().fit(features, tags)


class Words(dict):
    """Token numbers of each word between spaces, found when the word is first looked up."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}
        self.new: list[str] = []

    def __missing__(self, word: str) -> tuple[int, ...]:
        numbers, tokens = self.numbers, TOKEN.findall(word)
        for token in tokens:
            if token not in numbers:
                numbers[token] = len(numbers)
                self.new.append(token)
        found = self[word] = tuple(map(numbers.__getitem__, tokens))
        return found


class Scanner:
    """Scans texts with a fitted field; scores of tokens are computed once and looked up."""

    def __init__(self, field: Field):
        self.field = field
        self.words = Words()
        self.scores = np.zeros((1024, len(ROLES), 3))
        self.shapes: dict[object, tuple[float, ...]] = {}

    def shape_score(self, token: str) -> tuple[float, ...]:
        """Score of the token's shape; without digits, kinds of characters and length are all of it."""
        size = len(token)
        plain = size > 1 and DIGIT.search(token) is None
        key: object = token
        if plain:
            key = (token.lower() != token, token.upper() != token, token.isalpha(), size)
        score = self.shapes.get(key)
        if score is None:
            found = [feature(f"own {name}") for name in token_shape(token)]
            score = tuple(self.field.emit[found].sum(axis=0).tolist())
            if plain or size == 1:
                self.shapes[key] = score
        return score

    def lookup(self, words: list[str]) -> np.ndarray:
        """The numbers of the words' tokens in order; new tokens get scores."""
        if len(self.words) > KNOWN_TOKENS:
            self.words = Words()
        known = self.words
        numbers = np.fromiter(chain.from_iterable(map(known.__getitem__, words)), np.int64)
        new, known.new = known.new, []
        if new:
            first = len(known.numbers) - len(new)
            while len(known.numbers) > len(self.scores):
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            ids = np.array([word_ids(token_word(token)) for token in new])
            scores = self.field.emit[ids]
            scores[:, 0] += [self.shape_score(token) for token in new]
            self.scores[first : first + len(new)] = scores
        return numbers

    def learned_spans(self, text: str, base: list[Span]) -> list[Span]:
        """Spans that the field tags and no base span touches."""
        numbers = self.lookup(text.split())
        if not len(numbers):
            return []
        shared = file_features(text, len(numbers))
        scores = self.scores[numbers, 0] + self.field.emit[shared].sum(axis=0)
        scores[1:] += self.scores[numbers[:-1], 1]
        scores[2:] += self.scores[numbers[:-2], 2]
        scores[:-1] += self.scores[numbers[1:], 3]
        tags = self.field.decode(scores)
        if not tags.any():
            return []
        starts, ends = [], []
        for match, tag, before in zip(
            TOKEN.finditer(text), tags.tolist(), [OUTSIDE, *tags.tolist()], strict=False
        ):
            if tag == INSIDE and before != OUTSIDE:
                ends[-1] = match.end()
            elif tag != OUTSIDE:
                starts.append(match.start())
                ends.append(match.end())
        taken = [(start, end) for _, start, end in base]
        return [
            (LEARNED, start, end)
            for start, end in zip(starts, ends, strict=True)
            if end - start >= SHORTEST and not any(a < end and start < b for a, b in taken)
        ]

    def scan(self, text: str | None) -> tuple[list[Span], list[Span]]:
        """(base spans, all spans), each by start and then kind."""
        base = base_spans(text or "")
        learned = self.learned_spans(text or "", base)
        return base, sorted([*base, *learned], key=lambda span: (span[1], KINDS.index(span[0])))


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find_secrets(
    documents: DataFrame,
    base: str = "base_spans",
    spans: str = "secret_spans",
    wanted: Sequence[str] | None = None,
) -> DataFrame:
    """``documents`` with all base spans and all spans, as arrays of (kind, start, end).

    Whole texts are scanned; null counts as empty; positions are code points. The
    field is trained on the documents' own base spans and adds spans that touch
    none of them. Columns that have the new names are replaced. ``wanted`` selects
    columns of ``documents`` to return; all by default.
    """
    rows = documents.drop(base, spans)
    wanted = rows.columns if wanted is None else list(wanted)
    context = documents.sparkSession.sparkContext.broadcast(fit_field(rows))
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(context.value)

        def records(found: list[list[Span]]) -> pa.Array:
            return pa.array(
                [[dict(zip(PARTS, x, strict=True)) for x in xs] for xs in found],
                kind,
            )

        for batch in sliced(batches):
            found = [scanner.scan(value.as_py()) for value in batch.column("text")]
            columns = [batch.column(name) for name in wanted]
            columns += [records([pair[side] for pair in found]) for side in range(2)]
            yield pa.RecordBatch.from_arrays(columns, [*wanted, base, spans])

    empty = F.expr("CAST(array() AS array<struct<kind:string,start:bigint,end:bigint>>)")
    shape = rows.select(*wanted).withColumn(base, empty).withColumn(spans, empty).schema
    return rows.mapInArrow(apply, shape)


def secret_report(documents: DataFrame) -> DataFrame:
    """Counts of base spans, the digest of their list, and the list of all spans.

    Repeated rows have the same spans each; an empty table has no rows.
    """
    found = find_secrets(documents.select("doc_id", "text"), wanted=["doc_id"])

    def listed(column: str) -> Column:
        parts = F.transform(column, lambda span: F.concat_ws(":", *[span[x] for x in PARTS]))
        return F.array_join(parts, ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda span: span["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind, _, _ in BASE],
        F.sha2(listed("base_spans"), 256).alias("base_sha256"),
        listed("secret_spans").alias("spans"),
    )
