"""Language model over subword lattices.

A word has many segmentations into pieces of an existing vocabulary. Its
probability is the sum over all of them, which one forward pass in log space
gives. Piece probabilities start from the vocabulary's own segmentation of the
training words and are improved by expectation-maximisation over their lattices.

Next to it stands a plain unigram model of words. Counts of the training words
are a table that grows with the corpus: they are joined, not broadcast. Only
words that make up at least one token in ``FREQUENT`` travel with the task, of
which there can be no more than that number; so the words that every document
has are not shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from stratakeep.llm.batches import remainder, slices
from stratakeep.sources.tables import stage

MODULUS, HELD_OUT = 5, 1
# Rounds of expectation-maximisation over all training words.
ROUNDS = 1
# Added to the expected count of every piece.
SMOOTHING = 0.1
FREQUENT = 250_000
# Frequent words longer than this many bytes are joined like all others.
FREQUENT_BYTES = 64
# Distinct words counted in memory before they are passed on.
HELD_WORDS = 300_000
CACHED_WORDS = 300_000
# Words up to this length, and no less probable than this, have expectations
# whose products stay in the range of a double.
PLAIN_LENGTH, LEAST_CHANCE = 32, 1e-200
# The sign that begins a word in the vocabulary (fixed value).
BEGIN = "▁"
_LN10 = math.log(10)


def words_of(text: str) -> list[bytes]:
    """Words of a text: A-Z in lower case, parted at ASCII white space."""
    return text.encode().lower().split()


@dataclass(frozen=True)
class Pieces:
    """Pieces inside a word, and how bytes stand in for other characters."""

    ids: dict[str, int]
    byte_ids: list[int]
    size: int


@cache
def _processor(path: str) -> SentencePieceProcessor:
    return SentencePieceProcessor(model_file=path)


@cache
def pieces_of(path: str) -> Pieces:
    """The vocabulary in the file; a piece has the begin sign in front only."""
    processor = _processor(path)
    size = processor.get_piece_size()
    plain = [i for i in range(size) if not (processor.is_byte(i) or processor.is_control(i) or processor.is_unknown(i))]
    names = {processor.id_to_piece(i): i for i in plain}
    ids = {name: i for name, i in names.items() if BEGIN not in name[1:]}
    return Pieces(ids, [processor.piece_to_id(f"<0x{byte:02X}>") for byte in range(256)], size)


class Lattice:
    """All segmentations of words, weighted by piece log probabilities.

    What belongs to a prefix does not depend on what follows. The values along
    the last word are kept, so words in order share those of common prefixes.
    """

    def __init__(self, pieces: Pieces, weights: np.ndarray) -> None:
        self._pieces = pieces
        self._weights = weights.tolist()
        self._chances = np.exp(weights).tolist()
        lengths: dict[str, set[int]] = {}
        for name in pieces.ids:
            lengths.setdefault(name[-2:], set()).add(len(name))
        self._lengths = {tail: sorted(found) for tail, found in lengths.items()}
        self._single = {name for name in pieces.ids if len(name) == 1}
        self._last, self._forward = "", [0.0]

    def _pieces_ending(self, word: str, end: int) -> list[tuple[int, int]]:
        """Where the pieces that end at a place start, and their ids."""
        ids = self._pieces.ids
        lengths = self._lengths.get(word[end - 1 : end], ())
        if end > 1:
            lengths = (*lengths, *self._lengths.get(word[end - 2 : end], ()))
        return [(end - length, ids[word[end - length : end]]) for length in lengths if length <= end and word[end - length : end] in ids]

    def _ending(self, word: str, end: int) -> list[tuple[int, float, tuple[int, ...]]]:
        """Arcs that end at a place: where they start, weight, piece ids."""
        weights = self._weights
        arcs = [(start, weights[found], (found,)) for start, found in self._pieces_ending(word, end)]
        if word[end - 1] not in self._single:
            spelled = tuple(self._pieces.byte_ids[byte] for byte in word[end - 1].encode())
            arcs.append((end - 1, sum(weights[i] for i in spelled), spelled))
        return arcs

    def log_probability(self, word: str) -> float:
        """Natural logarithm of the sum over all segmentations."""
        whole, values = BEGIN + word, self._forward
        shared = _common(whole, self._last)
        del values[shared + 1 :]
        for end in range(shared + 1, len(whole) + 1):
            values.append(_log_sum([values[start] + weight for start, weight, _ in self._ending(whole, end)]))
        self._last = whole
        return values[-1]

    def add_expected(self, words: list[str], times: list[int], totals: list[float]) -> None:
        """Add the expected number of each piece in words seen ``times``.

        Words in order are walked as one tree. A place in it is passed forward
        once, and backward once with the sum over all words below it, when the
        walk leaves it. Words that are long, improbable or have characters
        spelled in bytes go by logarithms, one by one.
        """
        chances = self._chances
        last, forward, behind = "", [1.0], [0.0]
        arcs: list[list[tuple[int, int]]] = [[]]

        def leave(depth: int) -> None:
            while len(forward) > depth + 1:
                forward.pop()
                below = behind.pop()
                for start, found in arcs.pop():
                    through = chances[found] * below
                    totals[found] += forward[start] * through
                    behind[start] += through

        for word, n in zip(words, times, strict=True):
            whole = BEGIN + word
            if len(whole) > PLAIN_LENGTH or not self._single.issuperset(whole):
                self._add_by_logarithms(whole, n, totals)
                continue
            shared = _common(whole, last)
            leave(shared)
            for end in range(shared + 1, len(whole) + 1):
                ending = self._pieces_ending(whole, end)
                arcs.append(ending)
                forward.append(sum([forward[start] * chances[found] for start, found in ending]))
                behind.append(0.0)
            last = whole
            if forward[-1] < LEAST_CHANCE:
                self._add_by_logarithms(whole, n, totals)
            else:
                behind[-1] += n / forward[-1]
        leave(0)

    def _add_by_logarithms(self, whole: str, times: float, totals: list[float]) -> None:
        size = len(whole)
        arcs = [self._ending(whole, end) for end in range(1, size + 1)]
        forward, backward = [0.0] * (size + 1), [-math.inf] * (size + 1)
        for end, ending in enumerate(arcs, 1):
            forward[end] = _log_sum([forward[start] + weight for start, weight, _ in ending])
        backward[size] = 0.0
        for end in range(size, 0, -1):
            for start, weight, found in arcs[end - 1]:
                through = weight + backward[end]
                share = times * math.exp(forward[start] + through - forward[size])
                for piece in found:
                    totals[piece] += share
                backward[start] = _log_sum([backward[start], through])


def _common(word: str, other: str) -> int:
    """Number of leading characters that two words share."""
    if other.startswith(word):
        return len(word)
    for at, (a, b) in enumerate(zip(word, other, strict=False)):
        if a != b:
            return at
    return len(other)


def _log_sum(values: list[float]) -> float:
    if len(values) == 1:
        return values[0]
    most = max(values)
    if most == -math.inf:
        return most
    return most + math.log(sum([math.exp(value - most) for value in values]))


@dataclass(frozen=True)
class Model:
    """``vocabulary`` (``word, n, score``) of the training words, each with its
    log10 probability, the sums over it, and piece log probabilities with that
    of the end of a text."""

    path: str
    vocabulary: DataFrame
    train_docs: int
    train_tokens: int
    distinct: int
    weights: np.ndarray
    end: float


def _counted(texts: DataFrame) -> DataFrame:
    """``word, n`` over a column of texts, combined in Python, then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def passed() -> pa.RecordBatch:
            columns = [pa.array(held.keys(), pa.binary()).cast(pa.string()), pa.array(held.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for part in slices(batches):
            for text in part.column(0).to_pylist():
                held.update(words_of(text))
            if len(held) > HELD_WORDS:
                yield passed()
                held.clear()
        if held:
            yield passed()

    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _piece_counts(vocabulary: DataFrame, path: str, weights: np.ndarray | None) -> np.ndarray:
    """Number of each piece over the training words: by the vocabulary's own
    segmentation without weights, expected over all segmentations with them.

    The driver gets one number per piece of the vocabulary file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(pieces_of(path).size)
        expected = [0.0] * len(totals)
        lattice = None if weights is None else Lattice(pieces_of(path), weights)
        for part in slices(batches, 16_384):
            words, times = part.column(0).to_pylist(), part.column(1).to_pylist()
            if lattice is None:
                found = _processor(path).encode(words, num_threads=1)
                counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
                flat = np.fromiter((i for ids in found for i in ids), dtype=np.int64, count=int(counts.sum()))
                totals += np.bincount(flat, weights=np.repeat(times, counts), minlength=len(totals))
            else:
                lattice.add_expected(words, times, expected)
        totals += expected
        used = np.nonzero(totals)[0]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], ["piece", "n"])

    out = np.zeros(pieces_of(path).size)
    for row in vocabulary.select("word", "n").mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect():
        out[row["piece"]] = row["n"]
    return out


def train(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> Model:
    """The models of the documents that are not held out.

    Held out are those with crc32 of the id as text modulo 5 equal to 1; a
    document without an id is training. Null texts count as empty.
    """
    texts = docs.where(F.coalesce(remainder(F.col(doc_id), MODULUS) != HELD_OUT, F.lit(True))).select(F.coalesce(text, F.lit("")).alias("text"))
    # In order, so that neighbours share prefixes.
    vocabulary = stage(_counted(texts).sortWithinPartitions("word"), "vocabulary")
    sums = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("words")).first()
    train_docs = texts.count()

    def probabilities(counts: np.ndarray) -> tuple[np.ndarray, float]:
        smooth = counts + SMOOTHING
        total = smooth.sum() + train_docs + SMOOTHING
        return np.log(smooth / total), math.log((train_docs + SMOOTHING) / total)

    weights, end = probabilities(_piece_counts(vocabulary, path, None))
    for _ in range(rounds):
        weights, end = probabilities(_piece_counts(vocabulary, path, weights))

    def with_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces_of(path), weights)
        for part in slices(batches, 4096):
            found = [lattice.log_probability(word) / _LN10 for word in part.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.float64())], ["word", "n", "score"])

    vocabulary = stage(vocabulary.mapInArrow(with_scores, "word string, n long, score double"), "scored-vocabulary")
    return Model(path, vocabulary, train_docs, sums["tokens"] + train_docs, sums["words"] + (train_docs > 0), weights, end)


def _passes_over(docs: DataFrame, model: Model, doc_id: str, text: str) -> DataFrame:
    """One row per document: what frequent words give, and its other words."""
    smooth = math.log10(model.train_tokens + 0.5 * (model.distinct + 1))
    least = model.train_tokens / FREQUENT
    frequent = model.vocabulary.where((F.col("n") >= least) & (F.octet_length("word") <= FREQUENT_BYTES))
    known = {row["word"].encode(): (math.log10(row["n"] + 0.5) - smooth, row["score"]) for row in frequent.collect()}
    end = model.end / _LN10
    end_base = math.log10(model.train_docs + 0.5) - smooth
    end_known = int(model.train_docs > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for part in slices(batches):
            rows = {name: [] for name in ("n_tokens", "known", "base", "score")}
            others, times, ends = [], [], [0]
            for content in part.column(1).to_pylist():
                counts = Counter(words_of(content))
                base, score, seen = end_base, end, end_known
                for word, n in counts.items():
                    found = known.get(word)
                    if found is None:
                        others.append(word)
                        times.append(n)
                    else:
                        base += n * found[0]
                        score += n * found[1]
                        seen += n
                for name, value in zip(rows, (counts.total() + 1, seen, base, score), strict=True):
                    rows[name].append(value)
                ends.append(len(others))
            entries = pa.StructArray.from_arrays(
                [pa.array(others, pa.binary()).cast(pa.string()), pa.array(times, pa.int64())], ["word", "times"]
            )
            size = part.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(number, number + size)),
                    part.column(0),
                    pa.array(rows["n_tokens"], pa.int64()),
                    pa.array(rows["known"], pa.int64()),
                    pa.array(rows["base"], pa.float64()),
                    pa.array(rows["score"], pa.float64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries),
                ],
                ["row", doc_id, *rows, "others"],
            )
            number += size

    source = docs.select(doc_id, F.coalesce(text, F.lit("")).alias("_text"))
    kind = source.schema[0].dataType.simpleString()
    schema = f"row long, `{doc_id}` {kind}, n_tokens long, known long, base double, score double, others array<struct<word:string,times:long>>"
    return stage(source.mapInArrow(run, schema), "scored-documents")


def _completed(found: DataFrame, model: Model) -> DataFrame:
    """``row, times, n, score`` with the scores of words that training lacks.

    The join has brought equal words to one task, so each is scored once.
    """
    path, weights = model.path, model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces_of(path), weights)
        scores: dict[str, float] = {}
        for part in batches:
            values = part.column(3).to_numpy(zero_copy_only=False).copy()
            new = np.nonzero(part.column(3).is_null().to_numpy(zero_copy_only=False))[0]
            if len(scores) > CACHED_WORDS:
                scores.clear()
            words = part.column(4).take(pa.array(new)).to_pylist()
            for at, word in zip(new, words, strict=True):
                if word not in scores:
                    scores[word] = lattice.log_probability(word) / _LN10
                values[at] = scores[word]
            columns = [part.column(i) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values)], ["row", "times", "n", "score"])

    missing = F.when(F.col("score").isNull(), F.col("word")).alias("word")
    return found.select("row", "times", "n", "score", missing).mapInArrow(run, "row long, times long, n long, score double")


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of every row of ``docs`` under the word and the lattice model.

    ``n_tokens`` are the words and one end; ``n_known`` those that the
    training documents have; ``base_score`` is the sum of log10((c + 0.5) / (N +
    0.5 * (V + 1))) and ``score`` the log10 marginal probability of the
    words and the end of the text. Repeated rows stay; an empty text is its end
    only; an empty table gives an empty result.
    """
    rows = _passes_over(docs, model, doc_id, text)
    words = rows.select("row", F.explode("others").alias("one")).select("row", "one.word", "one.times")
    found = _completed(words.join(model.vocabulary, "word", "left"), model)
    total = F.lit(model.train_tokens + 0.5 * (model.distinct + 1))
    summed = found.groupBy("row").agg(
        F.sum(F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 0.5) / total)).alias("more_base"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.col("score")).alias("more_score"),
    )
    return rows.join(summed, "row", "left").select(
        doc_id,
        F.coalesce(remainder(F.col(doc_id), MODULUS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
