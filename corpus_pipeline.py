"""Cleans a corpus: quality, near duplicates, personal data, mix, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All stages but the last
return the columns of ``documents``. An empty table passes through all of them;
what each does with nulls and repeated rows is said at its operator.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stratakeep.llm import byte_bpe, mixing, pii, quality_classifier, simhash
from stratakeep.llm.queries import MULTI_RANKS
from stratakeep.sources.tables import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go (operator 10).

    A null text is judged as the empty one. Each row is judged by its text alone,
    so repeated rows and rows without an id, language or source stay or go alike;
    a score at the threshold stays.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.keep_good(docs, quality_classifier.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near fingerprints stays (operator 2).

    The smallest id stays, and of rows repeated in id and text one. Texts without
    a word, null ones included, are one group. Rows without an id are all kept.
    """
    return simhash.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind (operator 7), and ``n_chars`` follows.

    Null and empty texts stay as they are; no row is added, merged or removed.
    """
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights and shuffled (operator 6).

    A null source is a source of its own. Rows with the same id, null included, are
    repeated equally often; a document may come up several times or not at all.
    """
    return mixing.mix(docs).select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with offsets and whether they decode to the text (operator 3).

    Null and empty texts have empty lists; repeated rows are rows like any other.
    """
    others = [name for name in docs.columns if name != "text"]
    return byte_bpe.encode(docs, MULTI_RANKS, public_tokenizers.PATTERN, others)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mix", mix_sources),
    ("tokens", encode_tokens),
]

# Fingerprints, boosted trees and token ids have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
