from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from stratakeep.llm import quality_classifier, quality_rules
from stratakeep.llm.boosting import fit
from stratakeep.llm.queries import QUERIES
from tests.llm.conftest import SF_DIR


def base(text: str | None) -> tuple[int, ...]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@pytest.fixture(scope="module")
def labels(spark):
    return {row["doc_id"]: row["quality"] for row in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}


def test_rules_query_against_plain_counting(spark, documents, labels):
    texts = {row["doc_id"]: row["text"] for row in documents.collect()}
    rows = QUERIES["op1_quality_rules"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for row in rows:
        n_words, *_, n_repeat = want = base(texts[row["doc_id"]])
        assert tuple(row[name] for name in BASE) == want
        assert row["base_failed"] == (n_words < 50 or 100 * n_repeat > 50 * n_words)
        assert not (row["kept"] and row["base_failed"])
        if row["doc_id"] in labels and not row["base_failed"]:
            assert row["kept"] == bool(labels[row["doc_id"]])


def test_sketch_quartiles_are_near_exact_and_merge(spark):
    rng = np.random.default_rng(4)
    values = {("en", "a"): rng.integers(0, 5000, 3000), ("en", "b"): rng.integers(4000, 90_000, 2000), (None, None): rng.integers(0, 60, 999)}
    table = spark.createDataFrame(
        [(lang, source, "x", int(v)) for (lang, source), found in values.items() for v in found], "lang string, source string, signal string, value long"
    )
    sketch = table.withColumn("bin", quality_rules._bin(table["value"])).groupBy("lang", "source", "signal", "bin").count()
    sketch = sketch.withColumnRenamed("count", "n")
    quarters = {"low": 0.25, "high": 0.75}
    for row in quality_rules.quantiles(sketch, quality_rules.GROUP, quarters).collect():
        found = np.sort(values[row["lang"], row["source"]])
        for name, share in (("low", 0.25), ("high", 0.75)):
            exact = found[int(np.ceil(share * len(found))) - 1]
            assert exact * 31 / 32 - 1 <= row[name] <= exact
    both = np.sort(np.concatenate([values["en", "a"], values["en", "b"]]))
    row = [r for r in quality_rules.quantiles(quality_rules.merged(sketch, ("lang",)), ("lang",), quarters).collect() if r["lang"] == "en"][0]
    exact = both[int(np.ceil(0.75 * len(both))) - 1]
    assert row["docs"] == len(both) and exact * 31 / 32 - 1 <= row["high"] <= exact


def habits(rng, n: int, source: str, marked: float, first: int) -> list[tuple]:
    """Documents of 200 words of which a share, more or less, is a symbol."""
    rows = []
    for i in range(n):
        words = [f"w{rng.integers(1 << 40):012x}"[:6] for _ in range(200)]
        for at in rng.choice(200, int(200 * marked * rng.uniform(0.5, 1.5)), replace=False):
            words[at] = "#"
        rows.append((first + i, " ".join(words), "en", source))
    return rows


def test_sources_of_different_habits_get_different_limits(spark):
    rng = np.random.default_rng(8)
    schema = "doc_id long, text string, lang string, source string"
    rows = habits(rng, 300, "plain", 0.0, 0) + habits(rng, 300, "code", 0.1, 1000)
    # The same documents under either name, and three of a source of its own.
    rows += [(i + 100 * k, t, "en", s) for k, s in enumerate(("plain", "code")) for i, t, *_ in habits(np.random.default_rng(9), 5, "", 0.15, 5000)]
    rows += habits(rng, 3, "rare", 0.0, 9000)
    found = {row["doc_id"]: row for row in quality_rules.judged(spark.createDataFrame(rows, schema)).collect()}
    assert all(found[i]["kept"] for i in [*range(300), *range(1000, 1300), *range(9000, 9003)])
    assert not any(found[5000 + i]["kept"] for i in range(5)) and all(found[5100 + i]["kept"] for i in range(5))
    plain, code, rare = (found[i]["most_symbols"] for i in (0, 1000, 9000))
    # Both habits blended are wider than either.
    assert plain < code / 2 and plain < rare


def test_blended_sketches_follow_the_group_as_it_grows(spark):
    def rows(n: int) -> list[tuple]:
        return [("en", "big", "x", 10, 10_000), ("en", "one", "x", 40, n), ("de", None, "x", 20, 500), (None, None, "x", 30, 5)]

    for n in (1, 100, 100_000):
        sketch = spark.createDataFrame(rows(n), "lang string, source string, signal string, bin long, n long")
        got = {(r["lang"], r["source"], r["bin"]): r["n"] for r in quality_rules.blended(sketch).collect()}
        everything = {10: 10_000, 40: n, 20: 500, 30: 5}
        total = sum(everything.values())
        for lang, source, own in (("en", "one", {40: n}), ("en", "big", {10: 10_000}), ("de", None, {20: 500}), (None, None, {30: 5})):
            mine = {"en": {10: 10_000, 40: n}, "de": {20: 500}, None: {30: 5}}[lang]
            for b, count in everything.items():
                share = (mine.get(b, 0) + 100 * count / total) / (sum(mine.values()) + 100)
                assert abs(got[lang, source, b] - own.get(b, 0) - 100 * share) < 1e-6


def test_rules_on_odd_rows(edge_docs, empty_docs):
    rows = quality_rules.judged(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    texts = {row["doc_id"]: row["text"] for row in edge_docs.collect()}
    for row in rows:
        if row["doc_id"] is not None:
            assert tuple(row[name] for name in BASE) == base(texts[row["doc_id"]])
    assert quality_rules.judged(empty_docs).count() == 0


def test_classifier_query_on_held_out_labels(spark, documents, labels):
    rows = QUERIES["op10_quality_classifier"](spark, SF_DIR).collect()
    assert len(rows) == documents.count() and all(0 <= row["score"] <= 1 for row in rows)
    held = [row for row in rows if row["held_out"] and row["doc_id"] in labels]
    right = sum(row["predicted"] == labels[row["doc_id"]] for row in held)
    assert len(held) > 50 and right / len(held) >= 0.97
    assert all(row["predicted"] == (row["score"] >= 0.3) for row in rows)


def test_classifier_on_odd_rows(spark, edge_docs, empty_docs):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (6, None), (99, 0)], "doc_id long, quality int")
    model = quality_classifier.train(edge_docs, labels)
    assert quality_classifier.scored(edge_docs, model, ["doc_id", "score"]).columns == ["doc_id", "score"]
    kept = quality_classifier.keep_good(edge_docs, model)
    assert kept.columns == edge_docs.columns and kept.count() <= edge_docs.count()
    none = quality_classifier.train(empty_docs, labels.limit(0))
    assert quality_classifier.keep_good(edge_docs, none).count() == edge_docs.count()
    assert quality_classifier.keep_good(empty_docs, model).count() == 0


def test_trees_learn_what_no_single_feature_shows():
    rng = np.random.default_rng(5)
    rows = rng.random((4000, 3))
    labels = ((rows[:, 0] > 0.5) != (rows[:, 1] > 0.5)).astype(float)
    model = fit(rows[:3000], labels[:3000])
    chance = model.probability(rows[3000:])
    assert ((chance > 0.5) == labels[3000:]).mean() > 0.95
    assert (fit(rows[:3000], labels[:3000]).value == model.value).all()
    # The walk over arrays equals a walk from node to node.
    for row, got in zip(rows[:20], model.probability(rows[:20]), strict=True):
        score = model.base
        for feature, threshold, value in zip(model.feature, model.threshold, model.value, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
            score += value[node - len(feature)]
        assert abs(got - 1 / (1 + np.exp(-score))) < 1e-12
