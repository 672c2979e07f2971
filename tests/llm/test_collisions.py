from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratakeep.llm import collisions
from stratakeep.llm.queries import QUERIES
from tests.llm.conftest import SF_DIR


def exact(ids: np.ndarray, vectors: np.ndarray, query: int, k: int) -> list[tuple[int, float]]:
    at = int(np.nonzero(ids == query)[0][0])
    scores = vectors @ vectors[at] / np.linalg.norm(vectors, axis=1) / np.linalg.norm(vectors[at])
    order = [i for i in np.lexsort((ids, -np.round(scores, 12))) if i != at]
    return [(int(ids[i]), float(scores[i])) for i in order[:k]]


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.1"])
def test_recall_and_scores_of_the_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    ids, vectors = table["vec_id"].to_numpy(), np.stack(table["embedding"].to_numpy()).astype(float)
    found: dict[int, list] = {}
    for row in QUERIES["op9_collisions"](spark, sf_dir).orderBy("query_id", "rank").collect():
        found.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
    assert set(found) == {int(i) for i in ids if i % 50 == 0}
    hits = 0
    for query, got in found.items():
        want = exact(ids, vectors, query, 5)
        everything = dict(exact(ids, vectors, query, len(ids)))
        assert len(got) == 5 and all(abs(score - everything[i]) < 1e-9 for i, score in got)
        assert [s for _, s in got] == sorted((s for _, s in got), reverse=True)
        hits += len({i for i, _ in got} & {i for i, _ in want})
    assert hits / (5 * len(found)) >= 0.9


@pytest.mark.parametrize("dimension", [8, 64, 128, 384, 768])
@pytest.mark.parametrize("clusters", [0, 50])
def test_recall_does_not_fall_with_the_dimension(dimension, clusters):
    rng = np.random.default_rng(dimension + clusters)
    vectors = rng.standard_normal((4096, dimension))
    if clusters:
        vectors += 2 * rng.standard_normal((clusters, dimension))[rng.integers(clusters, size=4096)]
    ids = np.arange(4096)
    asked = ids[::100]
    hits = 0
    for query, (found, scores) in zip(asked, collisions.Index(ids, vectors).nearest(asked, vectors[asked], 5), strict=True):
        want = exact(ids, vectors, query, 5)
        hits += len({i for i, _ in want} & set(found.tolist()))
        assert len(found) == 5 and np.allclose(scores, vectors[found] @ vectors[query] / np.linalg.norm(vectors[found], axis=1) / np.linalg.norm(vectors[query]))
    assert hits / (5 * len(asked)) >= 0.95


def test_several_blocks_and_copies(spark, monkeypatch):
    monkeypatch.setattr(collisions, "ROW_BLOCK", 100)
    monkeypatch.setattr(collisions, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(6)
    copy = rng.standard_normal(8).tolist()
    rows = [(i, copy if i % 3 == 0 else rng.standard_normal(8).tolist()) for i in range(600)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collisions.search(table, F.col("vec_id") % 50 == 0, 5).orderBy("query_id", "rank").collect()
    assert len(got) == 60 and [row["rank"] for row in got] == [1, 2, 3, 4, 5] * 12
    for query in (0, 150, 300, 450):
        assert [row["vec_id"] for row in got if row["query_id"] == query] == [i for i in range(0, 600, 3) if i != query][:5]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], "q"), (1, [1.0, 0.0], "a"), (1, [1.0, 0.0], "a"), (2, None, "a"), (3, [], "a"), (4, [0.0, 0.0], "a"),
        (5, [nan, 1.0], "a"), (6, [inf, 1.0], "a"), (7, [None, 1.0], "a"), (None, [1.0, 0.0], "a"), (8, [1.0, 2.0, 3.0], "a"),
        (9, [1e300, 1e300], "a"), (50, [0.0, 0.0], "q"), (100, [0.0, 1e-200], "q"),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = collisions.search(table, F.col("vec_id") % 50 == 0, 5).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 1), (0, 2, 9), (0, 3, 100), (100, 1, 9), (100, 2, 0), (100, 3, 1)]
    assert abs(got[0]["score"] - 1) < 1e-15 and abs(got[1]["score"] - 0.5**0.5) < 1e-12
    assert collisions.search(table.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0
