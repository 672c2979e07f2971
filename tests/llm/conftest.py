from __future__ import annotations

import pytest
from pyspark.sql import DataFrame

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score string, spans string, ids string, copy int"

WORDS = "the quick brown fox jumps over a lazy dog near the river bank while seven small boats drift slowly past old stone walls"


@pytest.fixture(scope="session")
def edge_docs(spark) -> DataFrame:
    """Nulls in every column, empty and long texts, copies, repeated rows and
    columns with names that operators use."""
    long = " ".join(f"{word}{i % 97}" for i in range(3000) for word in WORDS.split())
    rows = [
        (1, WORDS, "en", "a"),
        (2, WORDS, "en", "a"),
        (2, WORDS, "en", "a"),
        (3, None, "en", "a"),
        (4, "", None, "b"),
        (5, " \n\t ", "fr", None),
        (6, long, "en", "b"),
        (7, "x" * 50_000, "de", "a"),
        (None, "no id, mail me@example.org", "en", "a"),
        (None, None, None, None),
        (8, "é🙂 <|endoftext|>  two  spaces\n\nand 's 're", "en", "b"),
    ]
    full = [(i, t, lang, source, None if t is None else len(t), "s", "p", "i", 9) for i, t, lang, source in rows]
    return spark.createDataFrame(full, COLUMNS).repartition(3).cache()


@pytest.fixture(scope="session")
def empty_docs(spark) -> DataFrame:
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def documents(spark) -> DataFrame:
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
