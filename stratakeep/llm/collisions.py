"""Nearest neighbours by counting collisions of single projections.

Every vector is projected on random lines, each kept as a sorted array. Around
a query's own projection a window is laid; a vector in it collides. Windows are
widened step by step (virtual rehashing), no hash table is built again, and vectors that
collide on enough lines are verified with their true cosine. Two vectors' distance
tells how often they collide at a width, whatever the dimension; so widening stops
when a vector as near as the k-th found would have been verified almost surely. Where
distances differ little, as in many dimensions without clusters, that is when
most of a block has been.

Rows are dealt to blocks by the hash of their id, queries too, and every block
of queries meets every block of rows: all rows are candidates, nothing
is sent to all tasks, and no task holds more than two blocks. Each meeting
gives its best rows only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LINES = 96
# Share of the lines on which a vector must collide to be verified.
THRESHOLD = 0.54
# Half widths of the windows in units of a projection's spread; the last
# window holds everything.
WIDTHS = (0.125, 0.25, 0.5, 0.75, 1.0, 1.25, 1.5, 2.0, np.inf)
# Standard deviations by which the collisions of a vector as near as the k-th
# found are expected beyond the threshold before widening stops.
SURE = 1.65
ROW_BLOCK, QUERY_BLOCK = 4096, 1024
SEED = 7


def usable(vector: str) -> Column:
    """Vectors without missing or infinite parts that are not zero."""
    parts = F.col(vector).cast("array<double>")
    odd = F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return parts.isNotNull() & ~odd & F.exists(parts, lambda x: x != 0)


def reaches(width: float, cosine: float) -> bool:
    """Whether a vector of that cosine is verified, almost surely, at a width.

    On a line of standard normal parts two unit vectors lie apart by a normal number
    whose spread is their distance.
    """
    apart = math.sqrt(max(2 - 2 * cosine, 0.0))
    chance = math.erf(width / (apart * math.sqrt(2))) if apart > 0 else 1.0
    return LINES * chance - SURE * math.sqrt(LINES * chance * (1 - chance)) >= THRESHOLD * LINES


class Index:
    """Sorted projections of a block of vectors.

    Each row is kept as its rank on every line, so whether it lies in a window
    is one comparison of its rank with the window's ends in the sorted array.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        self._norms = np.sqrt((vectors * vectors).sum(axis=1))
        self._lines = np.random.default_rng(SEED).standard_normal((vectors.shape[1], LINES))
        projected = (vectors / self._norms[:, None]) @ self._lines
        order = np.argsort(projected, axis=0, kind="stable")
        self._values = np.take_along_axis(projected, order, axis=0).T.copy()
        kind = np.uint16 if len(ids) < 1 << 16 else np.uint32
        self._ranks = np.empty((LINES, len(ids)), dtype=kind)
        np.put_along_axis(self._ranks, order.T, np.arange(len(ids), dtype=kind)[None, :], axis=1)

    def _windows(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First rank and number of ranks per query, width and line."""
        at = (queries / np.linalg.norm(queries, axis=1, keepdims=True)) @ self._lines
        widths = np.array(WIDTHS)
        first = np.stack([np.searchsorted(v, x[:, None] - widths) for v, x in zip(self._values, at.T, strict=True)], axis=2)
        last = np.stack(
            [np.searchsorted(v, x[:, None] + widths, side="right") for v, x in zip(self._values, at.T, strict=True)], axis=2
        )
        return first.astype(self._ranks.dtype), (last - first).astype(self._ranks.dtype)

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per query the ids and cosines of the best ``k`` rows, best first."""
        firsts, spans = self._windows(queries)
        least = int(np.ceil(THRESHOLD * LINES))
        for query_id, query, first, span in zip(query_ids, queries, firsts, spans, strict=True):
            others = self.ids != query_id
            length = np.sqrt((query * query).sum())
            for width, half in enumerate(WIDTHS):
                # Ranks below the window wrap around and count as far above it.
                inside = (self._ranks - first[width][:, None]) < span[width][:, None]
                hits = inside.view(np.uint8).sum(axis=0, dtype=np.uint8)
                verified = np.nonzero((hits >= least) & others)[0]
                if len(verified) < k and half < np.inf:
                    continue
                scores = (self.vectors[verified] * query).sum(axis=1) / (self._norms[verified] * length)
                if half == np.inf or reaches(half, np.partition(scores, -k)[-k]):
                    break
            best = np.lexsort((self.ids[verified], -scores))[:k]
            yield self.ids[verified[best]], scores[best]


def _matrix(table: pa.Table, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    table = table.combine_chunks()
    values = table.column("vector").combine_chunks().flatten().to_numpy()
    vectors = values.astype(float).reshape(-1, dimension)
    # Very large or small parts would leave the range of a double when squared.
    most = np.abs(vectors).max(axis=1, keepdims=True)
    vectors = np.where((most > 1e100) | (most < 1e-100), vectors / most, vectors)
    return table.column("id").to_numpy(), vectors


def search(vectors: DataFrame, queries: Column, k: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found per query.

    ``queries`` is a condition on the rows of ``vectors``; all rows but the query's
    own are candidates. Nearness is the cosine in double precision, ties go to
    the smaller id. Rows without an id and vectors that are null, zero, empty or hold
    null or non-finite parts take no part, and vectors of different length are not
    compared. Of rows with the same id the least vector counts. With fewer
    candidates all are given; an empty table gives an empty result.
    """
    clean = (
        vectors.where(F.col(vec_id).isNotNull() & usable(vector))
        .select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), queries.alias("asks"))
        .groupBy("id")
        .agg(F.min(F.struct("vector", "asks")).alias("one"))
        .select("id", "one.vector", "one.asks", F.size("one.vector").alias("dimension"))
    )
    sizes = clean.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("asks"), 1)).alias("queries")).first()
    row_blocks = max(1, -(-sizes["rows"] // ROW_BLOCK))
    query_blocks = max(1, -(-sizes["queries"] // QUERY_BLOCK))
    key = ["dimension", "row_block", "query_block"]

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return df.select("dimension", mine.alias(own), every.alias(other), "id", "vector").select(*key, "id", "vector")

    rows = dealt(clean, "row_block", row_blocks, "query_block", query_blocks)
    asked = dealt(clean.where("asks"), "query_block", query_blocks, "row_block", row_blocks)

    def meet(names: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        dimension = names[0].as_py()
        out: dict[str, list[np.ndarray]] = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            query_ids, queries = _matrix(right, dimension)
            found = Index(*_matrix(left, dimension)).nearest(query_ids, queries, k)
            for query_id, (ids, scores) in zip(query_ids, found, strict=True):
                for name, values in zip(out, (np.full(len(ids), query_id), ids, scores), strict=True):
                    out[name].append(values)
        kinds = {"query_id": np.int64, "vec_id": np.int64, "score": np.float64}
        return pa.table({name: np.concatenate([np.zeros(0, dtype=kinds[name]), *parts]) for name, parts in out.items()})

    best_found = rows.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(meet, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best_found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
