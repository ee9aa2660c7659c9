"""Language identification by unigram pieces, summed over all segmentations.

A language is a distribution over the pieces of a fixed public vocabulary. The likelihood of a word
is the sum over all its segmentations of the product of their pieces' probabilities: a forward
pass over the word's positions, for all languages and many words at once. Training is expectation
maximisation with the same pass and its backward twin: expected piece counts, summed by Spark.

No segmentation crosses a word, so a text's likelihood is the product of its words', and a word is
scored once and remembered in bounded memory. A text of any length needs its distinct words only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import materialize
from .columns import for_workers, fresh, map_arrow, named

# Bound on the sample that a language is learnt from: rows expected, drawn by a hash of the id.
TRAINING_ROWS = 4000
ROUNDS = 3
SMOOTHING = 0.05
UNKNOWN = "und"
# Words scored at once, and words remembered before all are forgotten.
BLOCK = 4096
REMEMBERED = 50_000
# Characters of texts that are taken at once.
CHARS = 1 << 18
# Rows whose texts are unpacked at once.
ROWS = 256
# Positions between rescalings of the forward pass.
RESCALE = 8
# Code points of a word up to which products of probabilities don't vanish in training.
PLAIN = 64

_word = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_START = "▁"


def words_of(text: str) -> list[str]:
    return _word.findall(text.lower())


class Pieces:
    """The vocabulary's pieces that may stand in a lower-case word, and the unknown character.

    Pieces are found in many words at once, by rolling hashes of their characters.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        skipped = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
        texts = (model.id_to_piece(i) for i in range(model.vocab_size()) if not skipped(i))
        texts = sorted({t for t in texts if t == t.lower() and all(c == _START or c.isalpha() for c in t)})
        self.texts = ["", *texts]  # 0 is any character without a piece
        self.count = len(self.texts)
        self.longest = max(map(len, texts), default=1)
        hashes = [0]
        for text in texts:
            value = np.zeros(1, np.uint64)
            for code in _codes(text):
                value = value * _BASE + code
            hashes.append(int(_mixed(value)[0]))
        self.hashes = np.array(hashes, np.uint64)
        # Slots by the hash's high bits; the few pieces whose slot is taken go to the next table.
        self.tables, left, bits = [], np.arange(1, self.count), 21
        while len(left):
            table = np.zeros(1 << bits, np.int32)
            slots = (self.hashes[left] >> np.uint64(64 - bits)).astype(np.int64)
            table[slots] = left
            self.tables.append((np.uint64(64 - bits), table))
            left, bits = left[table[slots] != left], 16

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The piece of each hash, 0 if there is none."""
        out = np.zeros(len(hashes), np.int32)
        for shift, table in self.tables:
            found = table[(hashes >> shift).astype(np.int64)]
            out = np.where((found > 0) & (self.hashes[found] == hashes), found, out)
        return out

    def edges(self, words: list[str]):
        """Steps of the lattices of words: for each end and length the words and their pieces."""
        lengths = np.array([len(w) + 1 for w in words])
        codes = _codes("".join(_START + w for w in words))
        starts = np.cumsum(lengths) - lengths
        row = np.repeat(np.arange(len(words)), lengths)
        place = np.arange(len(codes)) - starts[row]
        left = lengths[row] - place
        at, value, found = np.arange(len(codes)), np.zeros(len(codes), np.uint64), []
        for n in range(1, self.longest + 1):
            fits = left[at] >= n
            at, value = at[fits], value[fits]
            value = value * _BASE + codes[at + n - 1]
            piece = self.find(_mixed(value))
            hit = slice(None) if n == 1 else np.flatnonzero(piece)
            found.append((row[at[hit]], place[at[hit]] + n, np.full(len(at[hit]), n), piece[hit]))
        row, end, size, piece = (np.concatenate(x) for x in zip(*found))
        key = end * (self.longest + 1) + size
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        for part in np.split(order, cuts) if len(order) else []:
            yield int(end[part[0]]), int(size[part[0]]), row[part], piece[part]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return value ^ (value >> np.uint64(29))


@cache
def pieces(path: str) -> Pieces:
    """Read once per worker."""
    return Pieces(path)


def blocks(words: list[str], size: int = BLOCK) -> Iterator[list[int]]:
    """Places of words of like length, so that a block has no more positions than it needs."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    at = 0
    while at < len(order):
        # Long words come in small blocks.
        n = max(1, min(size, (size * 16) // (len(words[order[min(at + size, len(order)) - 1]]) + 1)))
        yield order[at : at + n]
        at += n


def forward(vocabulary: Pieces, words: list[str], probability: np.ndarray) -> np.ndarray:
    """Log-likelihoods (words, languages); ``probability`` is (pieces, languages)."""
    keep = vocabulary.longest + 1
    lengths = np.array([len(w) + 1 for w in words])
    alpha = np.zeros((keep, len(words), probability.shape[1]))
    scale = np.zeros((len(words), probability.shape[1]))
    out = np.zeros_like(scale)
    alpha[0], last = 1.0, 0
    for end, n, rows, found in vocabulary.edges(words):
        if end != last:
            if last:
                _close(alpha, last, keep, lengths, scale, out)
            alpha[end % keep], last = 0.0, end
        alpha[end % keep, rows] += alpha[(end - n) % keep, rows] * probability[found]
    if last:
        _close(alpha, last, keep, lengths, scale, out)
    return out


def _close(alpha, end, keep, lengths, scale, out) -> None:
    """A position is complete: read words that end there, keep the others from vanishing."""
    here = alpha[end % keep]
    ended = np.flatnonzero(lengths == end)
    out[ended] = np.log(here[ended]) + scale[ended]
    if end % RESCALE == 0:
        going = np.flatnonzero(lengths > end)
        by = here[going].copy()
        alpha[:, going] /= by
        scale[going] += np.log(by)


def expected_counts(vocabulary: Pieces, words: list[str], probability: np.ndarray) -> list[tuple]:
    """(word, piece, expected number) under each word's own ``probability`` (words, pieces).

    One alpha and one beta per position. Where words are longer than ``PLAIN``, all is in
    logarithms, so that no product vanishes.
    """
    width = max(map(len, words)) + 2
    if width > PLAIN + 2:
        return _expected_in_logs(vocabulary, words, probability, width)
    lengths, every = np.array([len(w) + 1 for w in words]), np.arange(len(words))
    steps = list(vocabulary.edges(words))
    alpha, beta = np.zeros((width, len(words))), np.zeros((width, len(words)))
    alpha[0], beta[lengths, every] = 1.0, 1.0
    for end, n, rows, found in steps:
        alpha[end, rows] += alpha[end - n, rows] * probability(rows, found)
    for end, n, rows, found in reversed(steps):
        beta[end - n, rows] += beta[end, rows] * probability(rows, found)
    total = alpha[lengths, every]
    return [
        (rows, found, alpha[end - n, rows] * probability(rows, found) * beta[end, rows] / total[rows])
        for end, n, rows, found in steps
    ]


def _expected_in_logs(vocabulary: Pieces, words: list[str], probability, width: int) -> list[tuple]:
    lengths, every = np.array([len(w) + 1 for w in words]), np.arange(len(words))
    steps = [(end, n, rows, found, np.log(probability(rows, found))) for end, n, rows, found in vocabulary.edges(words)]
    alpha, beta = np.full((width, len(words)), -np.inf), np.full((width, len(words)), -np.inf)
    alpha[0], beta[lengths, every] = 0.0, 0.0
    # A word has one piece at most of a length at an end, so no row comes twice in a step.
    for end, n, rows, _, weight in steps:
        alpha[end, rows] = np.logaddexp(alpha[end, rows], alpha[end - n, rows] + weight)
    for end, n, rows, _, weight in reversed(steps):
        beta[end - n, rows] = np.logaddexp(beta[end - n, rows], beta[end, rows] + weight)
    total = alpha[lengths, every]
    return [
        (rows, found, np.exp(alpha[end - n, rows] + weight + beta[end, rows] - total[rows]))
        for end, n, rows, found, weight in steps
    ]


class Model:
    """Languages, their log priors and piece probabilities; scores texts."""

    def __init__(self, path: str, languages: list[str], prior: np.ndarray, probability: np.ndarray):
        self.path, self.languages, self.prior, self.probability = path, languages, prior, probability
        self._young: dict[str, int] = {}
        self._table = np.zeros((0, len(languages)))

    def __getstate__(self):
        return (self.path, self.languages, self.prior, self.probability)

    def __setstate__(self, state):
        self.__init__(*state)

    def _learn(self, words: list[str]) -> None:
        """Score words that aren't remembered."""
        vocabulary = pieces(self.path)
        new = [w for w in words if w not in self._young]
        if not new:
            return
        if len(self._young) > REMEMBERED:
            new, self._young, self._table = words, {}, self._table[:0]
        scores = np.empty((len(new), len(self.languages)))
        for block in blocks(new):
            scores[block] = forward(vocabulary, [new[i] for i in block], self.probability)
        base = len(self._table)
        self._young.update((w, base + n) for n, w in enumerate(new))
        self._table = np.concatenate([self._table, scores])

    def scores(self, texts: list[str]) -> list[tuple[str, float]]:
        """(language, its posterior) per text; (UNKNOWN, 0) without a letter."""
        out: list[tuple[str, float]] = []
        at = 0
        while at < len(texts):
            group, size = [], 0
            while at < len(texts) and (not group or size + len(texts[at]) <= CHARS):
                group.append(words_of(texts[at]))
                size += len(texts[at])
                at += 1
            self._learn(list({w for words in group for w in words}))
            for words in group:
                if not words or not self.languages:
                    out.append((UNKNOWN, 0.0))
                    continue
                rows = np.fromiter(map(self._young.__getitem__, words), np.int64, len(words))
                total = self.prior + self._table[rows].sum(0)
                best = int(total.argmax())
                out.append((self.languages[best], float(1 / np.exp(total - total[best]).sum())))
        return out


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) per batch."""
    for batch in batches:
        counts: dict[tuple[str, str], int] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            for word in words_of(text.as_py()):
                counts[lang, word] = counts.get((lang, word), 0) + 1
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.string()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            names=["lang", "word", "n"],
        )


def _expect(path: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path)
        languages, probability = shared.value
        place = {lang: n for n, lang in enumerate(languages)}
        counts = np.zeros((vocabulary.count, len(languages)))
        for batch in batches:
            words = batch.column("word").to_pylist()
            langs = np.array([place[x] for x in batch.column("lang").to_pylist()], np.int64)
            times = batch.column("n").to_numpy().astype(float)
            for block in blocks(words):
                own, weight = langs[block], times[block]
                steps = expected_counts(
                    vocabulary, [words[i] for i in block], lambda rows, found: probability[found, own[rows]]
                )
                for rows, found, n in steps:
                    np.add.at(counts, (found, own[rows]), n * weight[rows])
        piece, lang = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([languages[i] for i in lang], pa.string()),
                pa.array(piece, pa.int64()),
                pa.array(counts[piece, lang], pa.float64()),
            ],
            names=["lang", "piece", "n"],
        )

    return run


def train(
    labelled: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows: int = TRAINING_ROWS,
    rounds: int = ROUNDS,
) -> Model:
    """Learn from the rows of ``labelled`` that have a text and a language.

    About ``rows`` rows per language are used; a language with fewer gives all it has. What
    comes to the driver is a row per language and piece.
    """
    spark = labelled.sparkSession
    for_workers(spark)
    known = labelled.select(
        named(labelled, id_col).cast("string").alias("id"),
        named(labelled, text_col).cast("string").alias("text"),
        named(labelled, lang_col).cast("string").alias("lang"),
    ).filter("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: int(r["count"]) for r in known.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    vocabulary = pieces(path)
    if not languages:
        return Model(path, [], np.zeros(0), np.zeros((vocabulary.count, 0)))
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, rows / sizes[lang]))])
    drawn = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    sample = known.filter(drawn < F.element_at(share, F.col("lang"))).select("lang", "text")
    counts = map_arrow(sample, _word_counts, "lang string, word string, n bigint")
    counts = materialize(counts.groupBy("lang", "word").agg(F.sum("n").alias("n")), "langid-words")
    probability = np.full((vocabulary.count, len(languages)), 1 / vocabulary.count)
    place = {lang: n for n, lang in enumerate(languages)}
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((languages, probability))
        found = (
            map_arrow(counts, _expect(path, shared), "lang string, piece bigint, n double")
            .groupBy("lang", "piece")
            .agg(F.sum("n").alias("n"))
            .toPandas()
        )
        probability = np.full_like(probability, SMOOTHING)
        np.add.at(probability, (found["piece"].to_numpy(), found["lang"].map(place).to_numpy()), found["n"].to_numpy())
        probability /= probability.sum(0)
    total = sum(sizes.values()) + len(languages)
    prior = np.array([math.log((sizes[lang] + 1) / total) for lang in languages])
    return Model(path, languages, prior, probability)


def with_language(docs: DataFrame, model: Model, text_col: str, lang: str, score: str) -> DataFrame:
    """``docs`` with two columns more: the language of ``text_col``, and its posterior."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = batch.column(place).cast(pa.string())
            found = []
            for at in range(0, len(texts), ROWS):
                found += own.scores([t or "" for t in texts.slice(at, ROWS).to_pylist()])
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, lang, score])

    added = [T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())]
    return map_arrow(docs, run, T.StructType([*docs.schema.fields, *added]))


def held_out(id_column: Column) -> Column:
    """True for the fifth of the ids that nothing is learnt from; false for a null id."""
    fold = F.crc32(id_column.cast("string").cast("binary")) % 5
    return F.coalesce(fold == 0, F.lit(False))


def learn_languages(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """The model of the rows of ``docs`` that are not held out and have an id."""
    own = named(docs, id_col)
    return train(docs.filter(own.isNotNull() & ~held_out(own)), path, id_col, text_col, lang_col)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out, lang_pred, score`` per row, from the text alone.

    A text that is null, empty or without a letter is ``und`` with score 0, as is every text
    if nothing could be learnt. Ties go to the first language by name. Null ids and repeated
    rows pass through; an empty table gives an empty result; no other column is read.
    """
    own = named(docs, id_col)
    rows = docs.select(own.alias("id"), held_out(own).alias("held_out"), named(docs, text_col).cast("string").alias("text"))
    scored = with_language(rows, model, "text", "lang_pred", "score")
    return scored.select(F.col("id").alias(id_col), "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", least_score: float = 0.5) -> DataFrame:
    """Rows of ``docs`` whose language is known with ``least_score`` or more; columns as they are."""
    lang, score = fresh(docs, "_language"), fresh(docs, "_language_score")
    scored = with_language(docs, model, text_col, lang, score)
    kept = (F.col(lang) != UNKNOWN) & (F.col(score) >= least_score)
    return scored.filter(kept).select(*[F.col(f"`{c}`") for c in docs.columns])
