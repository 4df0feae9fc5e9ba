"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.quality import text_bytes
from tallyworks.session import settle

# Bytes of context at most; a counted gram is a context and the byte after it.
ORDER = 3
# Tables that one broadcast holds at most, and that one part of a tree takes at most.
MODEL_BYTES = 256 << 20
PART_BYTES = 64 << 20
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
CHUNK = 1 << 20
# Bytes of letters stay, A-Z as a-z; digits and marks, which say nothing of the language, part words.
LETTER_BYTES = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if 97 <= byte <= 122 or byte >= 128 else 32
    for byte in range(256)
)


def words_only(text: bytes) -> bytes:
    """The whole text's words of letters, each followed by a space."""
    return b" ".join([*text.translate(LETTER_BYTES).split(), b""])


def grams(text: bytes) -> np.ndarray:
    """The ORDER + 1 bytes that end at each byte, as one number; zeros precede the text."""
    padded = np.frombuffer(bytes(ORDER) + text, dtype=np.uint8).astype(np.uint32)
    size = len(text)
    packed = np.zeros(size, dtype=np.uint32)
    for back in range(ORDER + 1):
        packed |= padded[ORDER - back : ORDER - back + size] << np.uint32(8 * back)
    return packed


def count_grams(documents: DataFrame) -> DataFrame:
    """(lang, gram, seen) over the whole texts of documents that have a language and a text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(lang: str, pieces: list[np.ndarray]) -> pa.RecordBatch:
            found, seen = np.unique(np.concatenate(pieces), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found)), pa.array(found.astype(np.int64)), pa.array(seen)],
                ["lang", "gram", "seen"],
            )

        held: defaultdict[str, list[np.ndarray]] = defaultdict(list)
        size: defaultdict[str, int] = defaultdict(int)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), text_bytes(batch), strict=True):
                held[lang].append(grams(words_only(text)))
                size[lang] += len(text)
                if size[lang] >= 8 * CHUNK:
                    yield out(lang, held.pop(lang))
                    size[lang] = 0
        for lang, pieces in held.items():
            yield out(lang, pieces)

    labelled = documents.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    return (
        labelled.mapInArrow(count, "lang string, gram long, seen long")
        .groupBy("lang", "gram")
        .agg(F.sum("seen").alias("seen"))
    )


def smoothed(counts: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Shares of the next byte after each context, escaping to ``below`` by method C.

    A context that was seen n times with d different bytes gives a byte seen k times
    k / (n + d), and d / (n + d) to all others, whose shares come from the context that
    is one byte shorter, without the bytes already seen here.
    """
    here = counts > 0
    # A byte outside the alphabet is never seen, so its symbol is never excluded.
    rest = np.where(here, 0.0, below)
    remaining = rest.sum(axis=1, keepdims=True)
    total = counts.sum(axis=1, keepdims=True)
    distinct = here.sum(axis=1, keepdims=True)
    escape = np.where(remaining > 0, distinct / (total + distinct), 0.0)
    return counts / total * (1 - escape) + rest / np.where(remaining > 0, remaining, 1.0) * escape


class ContextTree:
    """One language's frozen statistics: the code length in bits of each byte after each context.

    Every gram that was counted is kept. Below the empty context all bytes are equally likely.
    """

    def __init__(self, counted: np.ndarray, seen: np.ndarray, alphabet: np.ndarray):
        """``alphabet``: symbol number of each byte; the last symbol stands for all unseen bytes."""
        self.symbols = int(alphabet.max()) + 1
        self.unseen = max(1, int((alphabet == self.symbols - 1).sum()))
        self.places = [alphabet[counted >> (8 * back) & 255] for back in range(ORDER + 1)]
        self.seen = seen
        self.nodes = [np.unique(self.contexts(order)) for order in range(ORDER + 1)]

    def contexts(self, order: int) -> np.ndarray:
        """The ``order`` symbols before each gram's last byte, as one number."""
        context = np.zeros(len(self.seen), dtype=np.int64)
        for back in range(order, 0, -1):
            context = context * self.symbols + self.places[back]
        return context

    def rows(self) -> np.ndarray:
        """Row of the longest known context for every triple of symbols."""
        first = np.cumsum([0, *[len(keys) for keys in self.nodes]])
        triple = np.arange(self.symbols**ORDER)
        rows = np.zeros(len(triple), dtype=np.int32)
        for order in range(1, ORDER + 1):
            suffix = triple % self.symbols**order
            place = np.minimum(np.searchsorted(self.nodes[order], suffix), len(self.nodes[order]) - 1)
            hit = self.nodes[order][place] == suffix
            rows[hit] = first[order] + place[hit]
        return rows

    def tables(self, rows_at_once: int) -> Iterator[np.ndarray]:
        """Bits of each symbol after each context: shorter contexts first, some rows at a time."""
        weight = np.ones((1, self.symbols))
        weight[0, -1] = self.unseen
        # The parts of a distribution add up over symbols; unseen bytes share the last one's.
        below, known = weight / weight.sum(), np.zeros(1, dtype=np.int64)
        for order, keys in enumerate(self.nodes):
            context = self.contexts(order)
            by_context = np.argsort(context, kind="stable")
            context = context[by_context]
            shares = []
            for start in range(0, len(keys), rows_at_once):
                some = keys[start : start + rows_at_once]
                own = slice(*np.searchsorted(context, [some[0], some[-1] + 1]))
                pick = by_context[own]
                counts = np.zeros((len(some), self.symbols))
                np.add.at(counts, (np.searchsorted(some, context[own]), self.places[0][pick]), self.seen[pick])
                shorter = some % self.symbols ** max(0, order - 1)
                share = smoothed(counts, below[np.searchsorted(known, shorter)])
                if order < ORDER:
                    shares.append(share)
                bits = share.copy()
                bits[:, -1] /= self.unseen
                yield -np.log2(np.maximum(bits, 1e-30)).astype(np.float32)
            if order < ORDER:
                below, known = np.concatenate(shares), keys


class TreePart:
    """Some rows of a language's tables; the code lengths of all its parts add up to its own."""

    def __init__(self, language: int, row: np.ndarray, first: int, bits: np.ndarray, whole: bool):
        self.language, self.row, self.first, self.bits, self.whole = language, row, first, bits, whole

    @property
    def size(self) -> int:
        return self.row.nbytes + self.bits.nbytes

    def code_length(self, context: np.ndarray, symbol: np.ndarray) -> float:
        row = self.row[context]
        if not self.whole:
            row = row - self.first
            inside = (row >= 0) & (row < len(self.bits))
            row, symbol = row[inside], symbol[inside]
        return float(self.bits[row, symbol].sum(dtype=np.float64))


def tree_parts(language: int, tree: ContextTree, part_bytes: int) -> Iterator[TreePart]:
    """The tree cut into consecutive rows of at most ``part_bytes``, or one row."""
    row = tree.rows()
    rows_at_once = max(1, part_bytes // (4 * tree.symbols))
    total = sum(len(keys) for keys in tree.nodes)
    first, held = 0, []
    for table in tree.tables(rows_at_once):
        if held and sum(map(len, held)) + len(table) > rows_at_once:
            yield TreePart(language, row, first, np.concatenate(held), False)
            first, held = first + sum(map(len, held)), []
        held.append(table)
    yield TreePart(language, row, first, np.concatenate(held), sum(map(len, held)) == total)


class LanguageModels:
    """Parts of the languages' context trees over one alphabet: the bytes that training saw."""

    def __init__(self, languages: list[str], alphabet: np.ndarray, parts: list[TreePart]):
        self.languages, self.alphabet, self.parts = languages, alphabet, parts
        self.symbols = int(alphabet.max()) + 1

    def code_lengths(self, text: bytes) -> np.ndarray:
        """Bits that each language's tree needs for all bytes, as far as the parts here tell."""
        bits = np.zeros(len(self.languages))
        symbols = self.alphabet.astype(np.int32)[np.frombuffer(bytes(ORDER) + text, np.uint8)]
        for start in range(0, len(text), CHUNK):
            size = min(CHUNK, len(text) - start)
            context = np.zeros(size, dtype=np.int32)
            for place in range(ORDER):
                context = context * self.symbols + symbols[start + place : start + place + size]
            symbol = symbols[start + ORDER : start + ORDER + size]
            for part in self.parts:
                bits[part.language] += part.code_length(context, symbol)
        return bits

    def decide(self, text: bytes, bits: np.ndarray) -> tuple[str, float]:
        """The language with the shortest code, and its share of 2 to the minus code length."""
        if not self.languages or not LETTER.search(text.decode("utf-8", "replace")):
            return UNKNOWN, 0.0
        best = int(bits.argmin())
        return self.languages[best], float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum())


def alphabet_of(seen_bytes: list[int]) -> np.ndarray:
    """Symbol number of each byte; bytes that training did not see share the last one."""
    seen = np.zeros(256, dtype=bool)
    seen[[0, *seen_bytes]] = True
    if seen.all():  # keeps a last symbol, for no byte
        return np.arange(256)
    return np.where(seen, np.cumsum(seen) - 1, int(seen.sum()))


def fit_languages(
    documents: DataFrame, model_bytes: int = MODEL_BYTES, part_bytes: int = PART_BYTES
) -> Iterator[LanguageModels]:
    """Models from all grams of all given documents, as groups of parts of ``model_bytes`` or one part.

    One language's grams at a time meet the driver. They are windows of four
    bytes of its writing, so their number stops growing with the corpus.
    """
    counts = settle(count_grams(documents).where(F.length("lang") > 0), "grams")
    languages = sorted(row.lang for row in counts.select("lang").distinct().collect())
    last_bytes = counts.select((F.col("gram") % 256).cast("int").alias("byte")).distinct()
    alphabet = alphabet_of([row.byte for row in last_bytes.collect()])
    held: list[TreePart] = []
    for number, lang in enumerate(languages):
        grams_of = counts.where(F.col("lang") == lang).select("gram", "seen").toPandas().sort_values("gram")
        tree = ContextTree(
            grams_of["gram"].to_numpy(np.int64), grams_of["seen"].to_numpy(np.float64), alphabet
        )
        for part in tree_parts(number, tree, part_bytes):
            if held and sum(other.size for other in held) + part.size > model_bytes:
                yield LanguageModels(languages, alphabet, held)
                held = []
            held.append(part)
    yield LanguageModels(languages, alphabet, held)


def identify(
    documents: DataFrame,
    models: Iterable[LanguageModels],
    name: str = "lang_pred",
    score: str = "score",
) -> DataFrame:
    """``documents`` with the predicted language and its posterior share, from the text alone.

    A null text or one without letters gives ``und`` and 0. Columns that have
    the new names are replaced. Each group of models is broadcast by itself: where there are
    several, the code lengths so far are written beside the documents and the next group adds its own.
    """
    rows = documents.drop(name, score)
    shape = rows.withColumn(name, F.lit("")).withColumn(score, F.lit(0.0)).schema
    so_far = "code_lengths"
    while so_far in rows.columns:
        so_far += "_"
    groups = iter(models)
    group, following = next(groups), next(groups, None)
    while following is not None:
        wider = rows.drop(so_far).withColumn(so_far, F.array(F.lit(0.0))).schema
        rows = settle(rows.mapInArrow(add_code_lengths(rows, group, so_far), wider), "code_lengths")
        group, following = following, next(groups, None)
    return rows.mapInArrow(add_code_lengths(rows, group, so_far, (name, score)), shape)


def add_code_lengths(
    rows: DataFrame, models: LanguageModels, so_far: str, decided: tuple[str, ...] = ()
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of batches that adds the models' code lengths to those so far, or decides by them."""
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            kept = [name for name in batch.schema.names if name != so_far]
            columns = [batch.column(name) for name in kept]
            earlier = batch.column(so_far).to_pylist() if so_far in batch.schema.names else None
            found = []
            for place, text in enumerate(text_bytes(batch)):
                bits = models.code_lengths(words_only(text))
                if earlier is not None:
                    bits += earlier[place]
                found.append(models.decide(text, bits) if decided else bits.tolist())
            if decided:
                columns.append(pa.array([lang for lang, _ in found], pa.string()))
                columns.append(pa.array([share for _, share in found], pa.float64()))
            else:
                columns.append(pa.array(found, pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(columns, [*kept, *(decided or [so_far])])

    return apply


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2."""
    remainder = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))
    return F.coalesce(remainder == 2, F.lit(False))


def language_report(documents: DataFrame) -> DataFrame:
    """Predictions for all documents by models of the documents that are not held out.

    Of languages with equally short codes the first by name wins. Repeated rows are predicted alike;
    an empty table has no rows, and without any language to learn all are ``und``.
    """
    models = fit_languages(documents.where(~held_out(F.col("doc_id"))))
    rows = documents.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return identify(rows, models).select("doc_id", "held_out", "lang_pred", "score")
