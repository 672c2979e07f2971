from __future__ import annotations

import zlib

import numpy as np
import pytest

from stratakeep.llm import language_id
from stratakeep.llm.queries import QUERIES
from tests.llm.conftest import SF_DIR


@pytest.fixture(scope="module")
def model(documents):
    return language_id.train(documents)


def test_held_out_documents(spark, documents):
    lang = {row["doc_id"]: row["lang"] for row in documents.collect()}
    rows = QUERIES["op12_language_id"](spark, SF_DIR).collect()
    assert sorted(row["doc_id"] for row in rows) == sorted(lang)
    held = [row for row in rows if row["held_out"]]
    assert {row["doc_id"] for row in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(0 <= row["score"] <= 1 for row in rows)
    right = np.array([row["lang_pred"] == lang[row["doc_id"]] for row in held])
    assert right.mean() > 0.98
    accepted = np.array([row["accepted"] for row in held])
    assert accepted.mean() > 0.9 and right[accepted].mean() > 0.99


def test_held_out_rows_and_other_columns_change_nothing(spark, documents, model):
    from pyspark.sql import functions as F

    changed = documents.withColumn(
        "lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, "xx").otherwise(F.col("lang"))
    ).withColumn("source", F.lit(None).cast("string"))
    again = language_id.train(changed.repartition(5))
    assert again.languages == model.languages
    assert np.allclose(again.scores, model.scores) and again.threshold == model.threshold


def test_kept_word_scores_equal_the_definition(spark, documents, model):
    rows = language_id.identify(documents, model, ["doc_id", "text"]).limit(50).collect()
    for row in rows:
        vectors = [s for word, n in language_id.words_of(row["text"]).items() for s in [model.scores[language_id.subwords([word])[0]]] * n]
        if not vectors:
            assert row["lang_pred"] == "und"
            continue
        logits = np.concatenate(vectors).mean(axis=0) + model.bias
        found = model.probabilities(logits[None, :])[0]
        assert row["lang_pred"] == model.languages[found.argmax()]
        assert abs(row["score"] - found.max()) < 1e-9


def test_calibration_lowers_the_loss_and_rejects(model):
    rng = np.random.default_rng(2)
    classes = rng.integers(0, 2, 2000)
    # Over-confident scores that are right three times in four.
    sign = np.where(rng.random(2000) < 0.75, 1, -1) * np.where(classes == 1, 1, -1)
    sure = np.arange(2000) % 10 < 3
    sign = np.where(sure, np.where(classes == 1, 1, -1), sign)
    size = np.where(sure, 30.0, 8.0)
    raw = language_id.LanguageModel(("a", "b"), np.array([[-1.0, 1.0]]), np.zeros(2))
    bags = [(np.array([0]), np.array([x])) for x in sign * size]
    tuned = language_id.calibrate(raw, bags, classes)

    def loss(m):
        return -np.log(m.probabilities(m.logits(bags))[np.arange(2000), classes] + 1e-300).mean()

    assert tuned.temperature > 1 and loss(tuned) < loss(raw)
    best = tuned.probabilities(tuned.logits(bags)).max(axis=1)
    assert (best >= tuned.threshold).mean() == 0.3


def test_sample_is_bounded_and_has_all_languages(documents, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_PER_LANGUAGE", 15)
    monkeypatch.setattr(language_id, "MAX_LABELLED", 40)
    seen = []
    monkeypatch.setattr(language_id, "fit", lambda bags, classes, names: seen.append(len(bags)) or language_id.LanguageModel(names, np.zeros((language_id.BUCKETS, len(names))), np.zeros(len(names))))
    found = language_id.train(documents)
    assert len(found.languages) == 4 and seen[0] <= 40


def test_odd_rows(spark, edge_docs, empty_docs, model):
    found = language_id.identify(edge_docs, model, edge_docs.columns).collect()
    assert len(found) == edge_docs.count()
    for row in found:
        letters = any(c.isalpha() for c in row["text"] or "")
        assert (row["lang_pred"] != "und") == letters and (letters or row["score"] == 0)
    signs = spark.createDataFrame([(1, "½ 12 _ ²"), (2, "½a")], "doc_id long, text string")
    got = {row["doc_id"]: row["lang_pred"] for row in language_id.identify(signs, model, ["doc_id"]).collect()}
    assert got[1] == "und" and got[2] in model.languages
    assert language_id.identify(empty_docs, model, ["doc_id"]).count() == 0
    blank = language_id.train(empty_docs)
    assert blank.languages == ()
    assert {row["lang_pred"] for row in language_id.identify(edge_docs, blank, ["doc_id"]).collect()} == {"und"}
    assert language_id.train(edge_docs).languages
