from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from stratakeep.llm import lattice_lm
from stratakeep.llm.queries import PIECES, QUERIES
from tests.llm.conftest import SF_DIR


@pytest.fixture(scope="module")
def model(documents):
    return lattice_lm.train(documents, PIECES)


def brute(model: lattice_lm.Model, word: str) -> tuple[float, dict[int, float]]:
    """Probability and expected pieces of a word by listing its segmentations."""
    pieces, whole = lattice_lm.pieces_of(PIECES), lattice_lm.BEGIN + word
    total, expected = 0.0, Counter()
    for cuts in itertools.product([False, True], repeat=len(whole) - 1):
        places = [0, *[i + 1 for i, cut in enumerate(cuts) if cut], len(whole)]
        ids: list[int] = []
        for a, b in itertools.pairwise(places):
            if whole[a:b] in pieces.ids:
                ids.append(pieces.ids[whole[a:b]])
            elif b - a == 1:
                ids += [pieces.byte_ids[x] for x in whole[a:b].encode()]
            else:
                break
        else:
            p = math.exp(sum(model.weights[i] for i in ids))
            total += p
            for i in ids:
                expected[i] += p
    return total, {i: n / total for i, n in expected.items()}


@pytest.mark.parametrize("word", ["the", "thonorin,", "éaué", "🙂a", "zq", "x"])
def test_lattice_against_all_segmentations(model, word):
    lattice = lattice_lm.Lattice(lattice_lm.pieces_of(PIECES), model.weights)
    total, expected = brute(model, word)
    assert abs(lattice.log_probability(word) - math.log(total)) < 1e-9
    sums = np.zeros(len(model.weights))
    lattice.add_expected([word], [2], sums)
    assert set(np.nonzero(sums)[0]) == set(expected)
    assert all(abs(sums[i] - 2 * n) < 1e-9 for i, n in expected.items())


def test_words_that_share_prefixes_are_as_words_alone(model):
    words = ["a", "the", "then", "thonorin", "then", "them", "x" * 40, "thé", "th", "the", "龘" * 31, "", "the"]
    lattice = lattice_lm.Lattice(lattice_lm.pieces_of(PIECES), model.weights)
    alone = [lattice_lm.Lattice(lattice_lm.pieces_of(PIECES), model.weights).log_probability(w) for w in words]
    assert [lattice.log_probability(w) for w in words] == alone
    for some in (words, sorted(words)):
        times = list(range(1, len(some) + 1))
        together, summed, logs = (np.zeros(len(model.weights)) for _ in range(3))
        lattice.add_expected(some, times, together)
        for word, n in zip(some, times, strict=True):
            lattice.add_expected([word], [n], summed)
            lattice._add_by_logarithms(lattice_lm.BEGIN + word, n, logs)
        assert np.allclose(together, summed, rtol=1e-9, atol=1e-12) and np.allclose(together, logs, rtol=1e-9, atol=1e-12)


def test_probabilities_sum_to_one_and_improve(documents, model):
    assert abs(np.exp(model.weights).sum() + math.exp(model.end) - 1) < 1e-9
    first = lattice_lm.train(documents, PIECES, rounds=0)
    words = [w.decode() for row in documents.limit(100).collect() for w in lattice_lm.words_of(row["text"])]
    before, after = (lattice_lm.Lattice(lattice_lm.pieces_of(PIECES), m.weights) for m in (first, model))
    assert sum(map(after.log_probability, words)) > sum(map(before.log_probability, words))


def test_query_against_plain_counting(spark, documents, model, monkeypatch):
    # So few frequent words that the join gives most of the counts.
    monkeypatch.setattr(lattice_lm, "FREQUENT", 20)
    texts = {row["doc_id"]: row["text"] for row in documents.collect()}
    words = {i: "".join(c.lower() if "A" <= c <= "Z" else c for c in t).encode().split() for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    counts = Counter(w for i, found in words.items() if not held[i] for w in found)
    ends = sum(not x for x in held.values())
    total, distinct = counts.total() + ends, len(counts) + 1
    lattice = lattice_lm.Lattice(lattice_lm.pieces_of(PIECES), model.weights)
    rows = QUERIES["op8_lattice_lm"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for row in rows:
        found = words[row["doc_id"]]
        base = sum(math.log10((n + 0.5) / (total + 0.5 * (distinct + 1))) for n in [*[counts[w] for w in found], ends])
        assert row["held_out"] == held[row["doc_id"]] and row["train_tokens"] == total
        assert row["n_tokens"] == len(found) + 1 and row["n_known"] == sum(counts[w] > 0 for w in found) + 1
        assert abs(row["base_score"] - base) < 1e-6
        score = (sum(lattice.log_probability(w.decode()) for w in found) + model.end) / math.log(10)
        assert abs(row["score"] - score) < 1e-6 * (1 + abs(score))


def test_odd_rows(edge_docs, empty_docs):
    model = lattice_lm.train(edge_docs, PIECES)
    rows = lattice_lm.scored(edge_docs, model).collect()
    assert len(rows) == edge_docs.count()
    empty = [row for row in rows if row["doc_id"] in (3, 4, 5)]
    assert {(row["n_tokens"], row["n_known"]) for row in empty} == {(1, 1)} and len({row["score"] for row in rows if row["n_tokens"] == 1}) == 1
    nothing = lattice_lm.train(empty_docs, PIECES)
    assert lattice_lm.scored(empty_docs, nothing).count() == 0
    assert {row["base_score"] for row in lattice_lm.scored(edge_docs.where("doc_id = 4"), nothing).collect()} == {0.0}
