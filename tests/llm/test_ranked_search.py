from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from stratakeep.llm import ranked_search
from stratakeep.llm.oracle import ORACLE
from stratakeep.llm.queries import QUERIES
from tests.compare import canonical, oracle_connection
from tests.llm.conftest import SF_DIR

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text: str | None) -> list[str]:
    return TERM.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))


def brute(docs, items, k: int) -> list[tuple]:
    """``docs`` and ``items`` are (id, text); the best of each item in turn."""
    held = [(i, Counter(found)) for i, text in docs if (found := words(text))]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(term for _, c in held for term in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in held:
            m = 75 + 25 * sum(c.values()) * n // length
            score = sum(ranked_search.weight(df[t], n) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in words(text) if t in c)
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scores)[:k], 1)]
    return out


def rows_of(found) -> list[tuple]:
    return [(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found.collect()]


def key(row: tuple) -> tuple:
    return tuple((x is None, x or 0) for x in row)


def test_terms_are_the_pattern_s():
    rng = np.random.default_rng(1)
    alphabet = [chr(i) for i in range(128)] + ["é", "É", "日", " ", "🙂", "\x85"]
    for _ in range(300):
        text = "".join(rng.choice(alphabet, 50))
        assert [term.decode() for term in ranked_search.terms_of(text)] == words(text)


def test_query_matches_sql(spark):
    got = QUERIES["op13_ranked_search"](spark, SF_DIR)
    want = oracle_connection(SF_DIR).sql(ORACLE["op13_ranked_search"])
    assert canonical(got.columns, got.collect()) == canonical(want.columns, want.fetchall())


@pytest.fixture(scope="module")
def made():
    """Documents of a few topics, with many copies, and items from them."""
    rng = np.random.default_rng(5)
    docs = []
    for i in range(600):
        topic = int(rng.integers(0, 6))
        docs.append((1000 - i, " ".join(f"t{topic}w{int(x)}" for x in rng.zipf(1.5, 30) % 40) + " Common the"))
    docs += [(2000 + i, docs[0][1]) for i in range(300)] + [(7, docs[3][1]), (7, docs[3][1]), (None, docs[0][1]), (8, ""), (9, None)]
    items = [(i, docs[i * 7][1] + (" the the" if i % 2 else "")) for i in range(40)]
    items += [(40, None), (41, ""), (42, "nowhere"), (43, "the"), (None, "t1w1 t2w2"), (3, "t3w1 t3w1")]
    return docs, items


def test_made_documents_in_small_trees_and_blocks(spark, made, monkeypatch):
    monkeypatch.setattr(ranked_search, "TREE_DOCS", 100)
    monkeypatch.setattr(ranked_search, "LEAF_DOCS", 4)
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", 12)
    monkeypatch.setattr(ranked_search, "GATHERED", 50)
    docs, items = made
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4).selectExpr("*", "'x' AS doc", "1 AS n", "2 AS terms")
    wanted = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "0 AS rank", "0 AS at")
    got = rows_of(ranked_search.search(table, wanted, 20))
    assert sorted(got, key=key) == sorted(brute(docs, items, 20), key=key)


def test_nodes_are_left_out_and_bounds_hold():
    """Items of one topic need not look at documents of the others."""
    rng = np.random.default_rng(9)
    size, topics = 2048, 16
    topic = np.repeat(np.arange(topics), size // topics)
    terms = (topic[:, None] * 50 + np.stack([rng.permutation(50)[:10] for _ in range(size)])).ravel()
    docs = ranked_search.maxima(np.repeat(np.arange(size), 10), terms, rng.integers(1, 1000, size * 10), size)
    owner = np.repeat(np.arange(64), 5)
    item_terms = (owner % topics) * 50 + rng.integers(0, 50, len(owner))
    items = ranked_search.maxima(owner, item_terms, np.ones(len(owner), dtype=np.int64), 64)
    n = topics * 50
    searched = ranked_search.Search(items, n, 5, np.zeros(64, dtype=np.int64), np.full(64, ranked_search._NO_ID))
    searched.add(docs, np.arange(size))
    at, score, doc = searched.best()
    dense = np.zeros((size, n), dtype=np.int64)
    dense[np.repeat(np.arange(size), np.diff(docs.starts)), docs.terms] = docs.values
    for i in range(64):
        span = slice(items.starts[i], items.starts[i + 1])
        scores = dense[:, items.terms[span]] @ items.values[span]
        order = np.lexsort((np.arange(size), -scores))[:5]
        order = order[scores[order] > 0]
        assert sorted(zip(score[at == i], doc[at == i])) == sorted(zip(scores[order], order))
    assert searched.scored < size * 64 / 8
    # Started from the k-th scores, the same are found with less work.
    weakest = np.array([score[at == i].min() for i in range(64)])
    again = ranked_search.Search(items, n, 5, weakest, np.full(64, ranked_search._NO_ID))
    again.add(docs, np.arange(size))
    assert sorted(zip(*again.best())) == sorted(zip(at, score, doc)) and again.scored < searched.scored


def test_odd_rows(spark, edge_docs, empty_docs):
    docs = [(row["doc_id"], row["text"]) for row in edge_docs.collect()]
    items = [(1, "the quick brown fox"), (2, "é🙂 s"), (3, None)]
    wanted = spark.createDataFrame(items, "item_id long, text string")
    got = rows_of(ranked_search.search(edge_docs, wanted, 3))
    assert sorted(got, key=key) == sorted(brute(docs, items, 3), key=key)
    assert ranked_search.search(empty_docs, wanted, 3).count() == 0
    assert ranked_search.search(edge_docs, wanted.where("false"), 3).count() == 0
