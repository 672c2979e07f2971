"""Quality classifier: boosted trees over statistics of a document."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratakeep.llm.batches import map_texts, remainder
from stratakeep.llm.boosting import Trees, fit
from stratakeep.llm.text_stats import statistics

# Labelled rows that the trees are fitted on, at most.
MAX_LABELLED = 20_000
HELD_OUT_MODULUS = 5
THRESHOLD = 0.3


def features(texts: list[str]) -> np.ndarray:
    """One row of ratios per text; an empty text has zeros."""
    stats = np.array([statistics(x) for x in texts], dtype=float).reshape(len(texts), -1)
    words, chars, symbols, dup_lines, repeats, lines, upper, digits, marks, distinct, short, ends = stats.T
    per_word, per_char, per_line = np.maximum(words, 1), np.maximum(chars, 1), np.maximum(lines, 1)
    return np.stack(
        [
            np.log1p(words),
            chars / per_word,
            symbols / per_word,
            dup_lines / per_line,
            repeats / per_word,
            words / per_line,
            upper / per_char,
            digits / per_char,
            marks / per_word,
            distinct / per_word,
            short / per_word,
            ends / per_word,
        ],
        axis=1,
    )


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text") -> Trees:
    """Trees fitted on labelled documents that are not held out.

    Of the label rows with a class and an id whose crc32 modulo 5 is not zero,
    the ``MAX_LABELLED`` with the smallest hash are taken, so the sample is the
    same in every run and small enough to broadcast and to fit on the driver.
    Repeated documents count once per class.
    """
    usable = labels.where(F.col(label).isin(0, 1) & (remainder(F.col(doc_id), HELD_OUT_MODULUS) != 0))
    sample = (
        usable.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label"))
        .distinct()
        .orderBy(F.xxhash64("_id"), "_id", "_label")
        .limit(MAX_LABELLED)
    )
    known = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(sample), "_id")

    def start():
        def make(texts: list[str]) -> list[pa.Array]:
            return [pa.array(features(texts).tolist(), pa.list_(pa.float64()))]

        return make

    rows = (
        map_texts(known, ["_id", "_label"], "_text", "features array<double>", start)
        .groupBy("_id", "_label")
        .agg(F.min("features").alias("features"))
        .orderBy("_id", "_label")
        .collect()
    )
    width = features([""]).shape[1]
    matrix = np.array([row["features"] for row in rows], dtype=float).reshape(len(rows), width)
    return fit(matrix, np.array([row["_label"] for row in rows], dtype=float))


def scored(docs: DataFrame, model: Trees, carried: list[str], text: str = "text") -> DataFrame:
    """``carried`` columns with ``score``, the probability of good quality.

    Null texts count as empty. Nothing but the text is an input.
    """

    def start():
        def make(texts: list[str]) -> list[pa.Array]:
            return [pa.array(model.probability(features(texts)))]

        return make

    return map_texts(docs, carried, text, "score double", start)


def keep_good(docs: DataFrame, model: Trees, text: str = "text") -> DataFrame:
    """The documents that the classifier accepts, with the columns of ``docs``."""
    # Numbered names cannot clash with that of the score.
    names = [f"c{i}" for i in range(len(docs.columns))]
    found = scored(docs.toDF(*names), model, names, names[docs.columns.index(text)])
    return found.where(F.col("score") >= THRESHOLD).select(*names).toDF(*docs.columns)
