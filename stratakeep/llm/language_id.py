"""Language identification: averaged hashed subword embeddings and a softmax.

A word gives itself and its character n-grams, with marks at both ends; each is
hashed to a bucket with a small vector. The mean of the vectors of a whole text
goes through one linear layer and a softmax. Since mean and layer are linear, a
word's part of the class scores is computed once and kept.

The model is trained by stochastic gradient descent in numpy on a bounded sample. A
part of the sample is left out of that and calibrates the result: a temperature
makes the probabilities honest, and texts whose best class is less likely than
a threshold can be rejected.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratakeep.llm.batches import map_texts, remainder, slices

# The sample: rows of one language and of all languages, at most.
MAX_PER_LANGUAGE = 1_000
MAX_LABELLED = 6_000
# Rows of a frequent language that are looked at for each one wanted.
OVERSAMPLED = 4
# Ids whose crc32 modulo this is zero are never learned from.
HELD_OUT_MODULUS = 5
# One sampled row in so many calibrates instead of training.
CALIBRATE_EVERY = 5
BUCKETS = 1 << 14
DIMENSIONS = 16
N_GRAMS = (2, 3, 4)
EPOCHS, BATCH, RATE = 12, 16, 4.0
SEED = 12
# Share of accepted texts that are to be right.
ACCEPTED_RIGHT = 0.995
UNKNOWN = "und"

# Words kept per Python worker, and the longest that are.
CACHE_WORDS = 300_000
CACHE_CHARS = 40
# Characters of words that are hashed at once.
RUN_CHARS = 1 << 18

_MIX = np.uint64(0x9E3779B97F4A7C15)

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> Counter[str]:
    """Lower-cased runs of letters and how often each comes."""
    return Counter(_WORD.findall(text.lower()))


def has_letter(words: Counter[str]) -> bool:
    """Whether a word has a letter; signs such as fractions are none."""
    return any(map(str.isalpha, words)) or any(c.isalpha() for word in words for c in word)


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and of the n-grams of the marked words, and the
    word that each belongs to."""
    lengths = np.array([len(word) + 2 for word in words], dtype=np.int64)
    codes = np.frombuffer("".join([f"<{word}>" for word in words]).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    of_word = np.repeat(np.arange(len(words)), lengths)
    to_end = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))
    buckets = [np.array([xxhash.xxh32_intdigest(word, SEED) for word in words], dtype=np.uint64) % np.uint64(BUCKETS)]
    owners = [np.arange(len(words))]
    for n in N_GRAMS:
        at = np.nonzero(to_end >= n)[0]
        mixed = np.full(len(at), n, dtype=np.uint64)
        for i in range(n):
            mixed = (mixed ^ codes[at + i]) * _MIX
            mixed ^= mixed >> np.uint64(29)
        buckets.append(mixed % np.uint64(BUCKETS))
        owners.append(of_word[at])
    return np.concatenate(buckets).astype(np.int64), np.concatenate(owners)


def _parts(words: list[str]) -> Iterator[list[str]]:
    """The words in runs of bounded length."""
    run, size = [], 0
    for word in words:
        run.append(word)
        size += len(word)
        if size > RUN_CHARS:
            yield run
            run, size = [], 0
    if run:
        yield run


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and the share of its subwords in each."""
    words, counts = words_of(text), np.zeros(BUCKETS)
    for run in _parts(list(words)):
        buckets, owners = subwords(run)
        counts += np.bincount(buckets, np.array([words[word] for word in run], dtype=float)[owners], BUCKETS)
    used = np.nonzero(counts)[0]
    return used, counts[used] / max(counts.sum(), 1.0)


@dataclass(frozen=True)
class LanguageModel:
    """Class scores of every bucket, and how to read them."""

    languages: tuple[str, ...]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return softmax(logits / self.temperature)

    def logits(self, bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return np.array([share @ self.scores[used] + self.bias for used, share in bags]).reshape(len(bags), -1)


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def fit(bags: list[tuple[np.ndarray, np.ndarray]], classes: np.ndarray, languages: tuple[str, ...]) -> LanguageModel:
    """Stochastic gradient descent over embeddings and linear layer.

    Every class weighs the same in total, so a rare language is not drowned.
    The rate falls in a straight line to zero.
    """
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    layer, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    sizes = np.bincount(classes, minlength=len(languages))
    weight = len(classes) / (np.maximum(sizes, 1) * np.count_nonzero(sizes))
    steps, step = EPOCHS * -(-len(bags) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for start in range(0, len(order), BATCH):
            rows = order[start : start + BATCH]
            rate = RATE * (1 - step / steps)
            step += 1
            means = np.array([bags[i][1] @ vectors[bags[i][0]] for i in rows])
            error = softmax(means @ layer + bias)
            error[np.arange(len(rows)), classes[rows]] -= 1
            error *= weight[classes[rows]][:, None]
            back = error @ layer.T
            layer -= rate / len(rows) * means.T @ error
            bias -= rate / len(rows) * 0.1 * error.sum(axis=0)
            for i, slope in zip(rows, back, strict=True):
                # A bag holds each bucket once.
                used, share = bags[i]
                vectors[used] -= rate * share[:, None] * slope
    return LanguageModel(languages, vectors @ layer, bias)


def calibrate(model: LanguageModel, bags: list[tuple[np.ndarray, np.ndarray]], classes: np.ndarray) -> LanguageModel:
    """The model with the temperature that makes the rows given likeliest, and
    the least threshold above which ``ACCEPTED_RIGHT`` of them are right.
    Without rows it stays as it is."""
    if not len(classes):
        return model
    logits = model.logits(bags)
    temperatures = np.geomspace(0.01, 100, 161)
    # As if one more row were wrong, so that few rows make no certainty.
    doubt = 1 / (len(classes) + 2)
    wanted = np.full(logits.shape, doubt / max(1, logits.shape[1] - 1))
    wanted[np.arange(len(classes)), classes] = 1 - doubt
    losses = [-(wanted * np.log(softmax(logits / t) + 1e-300)).sum(axis=1).mean() for t in temperatures]
    temperature = float(temperatures[int(np.argmin(losses))])
    found = softmax(logits / temperature)
    best, right = found.max(axis=1), found.argmax(axis=1) == classes
    order = np.argsort(-best, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    # Rows of one probability are accepted or rejected together.
    last_of_equals = np.append(np.diff(best[order]) < 0, True)
    good = np.nonzero((share >= ACCEPTED_RIGHT) & last_of_equals)[0]
    threshold = 1.0 if not len(good) else 0.0 if good[-1] == len(order) - 1 else float(best[order[good[-1]]])
    return LanguageModel(model.languages, model.scores, model.bias, temperature, threshold)


def _lists(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    """The rows of a list column as arrays, without an object per value."""
    whole = column.combine_chunks()
    values, ends = whole.flatten().to_numpy().astype(kind), np.cumsum(whole.value_lengths().to_numpy())
    return np.split(values, ends[:-1])


def train(docs: DataFrame, lang: str = "lang", doc_id: str = "doc_id", text: str = "text") -> LanguageModel:
    """A model of the languages of ``docs``.

    Learned from are distinct rows with a language, a text and an id whose
    crc32 modulo 5 is not zero: of each language the ``MAX_PER_LANGUAGE`` with
    the smallest hash, of all together the first ``MAX_LABELLED``, every
    language's first rows first. The whole text of a row is hashed where it
    lies; the driver gets buckets and shares, ``BUCKETS`` of each per row at most. Without
    such rows the model knows no language.
    """
    usable = docs.where(
        F.col(lang).isNotNull() & F.col(text).isNotNull() & (remainder(F.col(doc_id), HELD_OUT_MODULUS) != 0)
    ).select(F.col(lang).cast("string").alias("_lang"), F.xxhash64(F.col(text)).alias("_hash"), F.col(doc_id).alias("_id"))
    # Of a frequent language only small hashes take part, a few times the rows
    # wanted, so that its window holds few rows whatever the size of the table.
    wanted = OVERSAMPLED * MAX_PER_LANGUAGE
    often = usable.groupBy("_lang").count().where(F.col("count") > wanted).orderBy(F.desc("count"), "_lang").limit(MAX_LABELLED).collect()
    shares = [F.lit(x) for row in often for x in (row["_lang"], wanted / row["count"])]
    share = F.coalesce(F.create_map(*shares)[F.col("_lang")], F.lit(1.0)) if shares else F.lit(1.0)
    usable = usable.withColumn("_drawn", F.pmod(F.xxhash64("_id", "_hash"), F.lit(1 << 30)))
    of_language = Window.partitionBy("_lang").orderBy("_drawn", "_id", "_hash")
    chosen = (
        usable.where(F.col("_drawn") < share * (1 << 30))
        .withColumn("_place", F.row_number().over(of_language))
        .where(F.col("_place") <= MAX_PER_LANGUAGE)
        .orderBy("_place", "_lang")
        .limit(MAX_LABELLED)
        .select("_id", "_lang", "_hash")
        .distinct()
    )
    keyed = docs.select(
        F.col(doc_id).alias("_id"), F.col(lang).cast("string").alias("_lang"), F.xxhash64(F.col(text)).alias("_hash"), F.col(text).alias("_text")
    )
    known = keyed.join(F.broadcast(chosen), ["_id", "_lang", "_hash"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            bags = [bag(x) for x in part.column(2).to_pylist()]
            used = pa.array([x for x, _ in bags], pa.list_(pa.int32()))
            share = pa.array([y.astype(np.float32) for _, y in bags], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), used, share], names=["_lang", "_hash", "used", "share"])

    rows = (
        known.select("_lang", "_hash", "_text")
        .mapInArrow(hashed, "_lang string, _hash long, used array<int>, share array<float>")
        .dropDuplicates(["_lang", "_hash"])
        .orderBy("_hash", "_lang")
        .toArrow()
    )
    names = rows["_lang"].to_pylist()
    languages = tuple(sorted(set(names)))
    if not languages:
        return LanguageModel((), np.zeros((BUCKETS, 0)), np.zeros(0))
    bags = list(zip(_lists(rows["used"], np.int32), _lists(rows["share"], np.float32), strict=True))
    classes = np.array([languages.index(name) for name in names])
    aside = np.array([i % CALIBRATE_EVERY == 0 for i in range(len(bags))])
    # A language's only rows are better learned than set aside.
    aside &= np.bincount(classes)[classes] >= 2 * CALIBRATE_EVERY
    learn, judge = np.nonzero(~aside)[0], np.nonzero(aside)[0]
    model = fit([bags[i] for i in learn], classes[learn], languages)
    return calibrate(model, [bags[i] for i in judge], classes[judge])


class WordParts:
    """Sums of class scores of words and the number of their subwords, kept in
    rows of one table per worker."""

    def __init__(self, model: LanguageModel) -> None:
        self._model = model
        self._clear()

    def _clear(self) -> None:
        self._row: dict[str, int] = {}
        self._table = np.zeros((1 << 12, len(self._model.languages) + 1))
        self._used = 0

    def _add(self, words: list[str]) -> None:
        buckets, owners = subwords(words)
        scores = self._model.scores
        columns = [np.bincount(owners, scores[buckets, k], len(words)) for k in range(scores.shape[1])]
        columns.append(np.bincount(owners, minlength=len(words)))
        end = self._used + len(words)
        while end > len(self._table):
            self._table = np.concatenate([self._table, np.zeros_like(self._table)])
        self._table[self._used : end] = np.stack(columns, axis=1)
        self._row.update(zip(words, range(self._used, end), strict=True))
        self._used = end

    def sums(self, bags: list[Counter[str]]) -> list[np.ndarray]:
        """Sums over the words of each text."""
        if self._used > CACHE_WORDS:
            self._clear()
        row = self._row
        new = list({word for words in bags for word in words} - row.keys())
        for run in _parts(new):
            self._add(run)
        out = []
        for words in bags:
            counts = np.array(list(words.values()), dtype=float)
            out.append(counts @ self._table[[row[word] for word in words]] if words else self._table[0] * 0)
        for word in new:
            if len(word) > CACHE_CHARS:
                del row[word]
        return out


def identify(docs: DataFrame, model: LanguageModel, carried: list[str], text: str = "text") -> DataFrame:
    """``carried`` columns with ``lang_pred, score, accepted`` of the whole text.

    ``score`` is the calibrated probability of ``lang_pred``; ``accepted`` tells
    that it reaches the model's threshold, so a caller rejects a text by reading
    a language only where it is set. A text that is null, empty or without a
    letter, or a model that knows no language, gives ``und``, score 0, not accepted.
    Ties go to the first language in order. Rows stay as they are, repeated
    ones too; an empty table gives an empty result; a carried column of a new
    column's name is replaced.
    """

    def start():
        parts = WordParts(model)
        none = np.zeros(len(model.languages) + 1)

        def make(texts: list[str]) -> list[pa.Array]:
            bags = [words_of(text) for text in texts]
            lettered = np.array([bool(model.languages) and has_letter(words) for words in bags])
            sums = parts.sums(bags) if model.languages else []
            rows = np.array([sums[i] / sums[i][-1] if ok else none for i, ok in enumerate(lettered)])
            if not model.languages:
                best, score = np.zeros(len(texts), dtype=int), np.zeros(len(texts))
            else:
                found = model.probabilities(rows[:, :-1] + model.bias)
                best, score = found.argmax(axis=1), np.where(lettered, found.max(axis=1), 0.0)
            names = [model.languages[i] if ok else UNKNOWN for i, ok in zip(best, lettered, strict=True)]
            return [pa.array(names, pa.string()), pa.array(score), pa.array(lettered & (score >= model.threshold))]

        return make

    return map_texts(docs, carried, text, "lang_pred string, score double, accepted boolean", start)
