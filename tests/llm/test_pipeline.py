from __future__ import annotations

import numpy as np
import pytest
import tiktoken
import public_tokenizers

import __spark_entry__ as contract
import corpus_pipeline
from stratakeep.llm import byte_bpe, simhash
from stratakeep.llm.queries import MULTI_RANKS, ORACLE, QUERIES
from tests.llm.conftest import SF_DIR
from tests.llm.test_pii import base


@pytest.fixture(scope="module")
def stages(spark, documents, tmp_path_factory):
    """Every stage's rows, each written and read again."""
    docs, out = documents, [documents]
    for name, apply in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "rows")
        apply(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(contract.oracle_sql())


def test_all_stages_but_the_last_keep_the_columns(stages):
    for docs in stages[1:-1]:
        assert docs.columns == stages[0].columns and docs.count() > 0


def test_quality_keeps_the_good(spark, stages):
    labels = {row["doc_id"]: row["quality"] for row in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {row["doc_id"] for row in stages[1].collect()}
    wrong = sum((i in kept) != bool(q) for i, q in labels.items())
    assert wrong / len(labels) < 0.02


def test_near_duplicates_leave_no_pair_and_drop_nothing_else(stages):
    before = stages[1].select("doc_id", "text").collect()
    prints = {row["doc_id"]: np.uint64(simhash.fingerprint(row["text"])) for row in before}
    kept = sorted(row["doc_id"] for row in stages[2].collect())
    values = np.array([prints[i] for i in kept], dtype=np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    assert near.sum() == len(values)
    for i in set(prints) - set(kept):
        assert any(bin(int(prints[i] ^ prints[j])).count("1") <= 4 for j in prints if j < i)


def test_personal_data_is_gone(stages):
    dirty = {row["doc_id"]: row["text"] for row in stages[2].collect()}
    assert any(base(text) for text in dirty.values())
    for row in stages[3].collect():
        assert not base(row["text"]) and row["n_chars"] == len(row["text"])
        assert base(dirty[row["doc_id"]]) or "<" in row["text"] or row["text"] == dirty[row["doc_id"]]


def test_mix_repeats_whole_documents(stages):
    texts = {row["doc_id"]: row["text"] for row in stages[3].collect()}
    mixed = stages[4].collect()
    assert all(texts[row["doc_id"]] == row["text"] for row in mixed)
    assert abs(len(mixed) - len(texts)) < 6 * len(texts) ** 0.5


def test_tokens_are_those_of_the_texts(spark, stages):
    ranks = byte_bpe.read_ranks(MULTI_RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {row["doc_id"]: row["text"] for row in stages[4].collect()}
    rows = stages[5].collect()
    assert len(rows) == stages[4].count()
    for row in rows:
        assert row["round_trip"] and row["ids"] == library.encode_ordinary(texts[row["doc_id"]])
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert sorted((r["doc_id"], len(r["ids"])) for r in whole.collect()) == sorted((r["doc_id"], len(r["ids"])) for r in rows)


def test_odd_rows(spark, edge_docs, empty_docs):
    for docs in (edge_docs, empty_docs):
        current = docs
        for _, apply in corpus_pipeline.STAGES:
            current = apply(spark, current, SF_DIR)
        assert "ids" in current.columns
        current.collect()
