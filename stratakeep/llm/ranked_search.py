"""Ranked lexical search by a dual tree over items and documents.

Terms of the items make a space with one coordinate per term. A document's
coordinate is what one occurrence of the term in an item adds to the score; an
item's coordinate is how often it holds the term. Items and runs of documents
are put into trees whose nodes hold the maximum of each coordinate, so the
product of two nodes is an upper bound on the score of every item of the one
with every document of the other. A pair of nodes whose bound lies below the
weakest k-th score of its items is left out with all its items and documents;
what is left is scored exactly in 64-bit integers.

The k-th scores start from a search over a fixed share of the documents, which
bounds the true ones from below, and rise while a task works. Documents are
ordered by their strongest terms before they are cut into trees, so that nodes hold
documents alike. Items are taken in blocks of bounded size, each against all documents.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratakeep.llm.batches import map_texts, slices
from stratakeep.sources.tables import stage

# Items of a block, and their distinct terms (one item may have more alone).
BLOCK_ITEMS = 4096
BLOCK_TERMS = 500_000
# One document in so many sets the k-th scores that the search starts from.
SEED_EVERY = 32
# Documents of one tree, its leaves and its fan-out; the items' fan-out.
TREE_DOCS, LEAF_DOCS, FAN_DOCS, FAN_ITEMS = 4096, 16, 4, 4
# Candidates that are gathered before the k-th scores are raised.
GATHERED = 2048

# The score's constants.
SCALE, LOGARITHM_SCALE = 1_000_000_000, 1000
_NO_ID = np.iinfo(np.int64).max

_TERM_BYTES = bytes(
    ord(c.lower()) if c in string.ascii_letters else byte if byte > 0x7F or c in string.digits else 0x20
    for byte, c in ((byte, chr(byte)) for byte in range(256))
)


def terms_of(text: str) -> list[bytes]:
    """Runs of ASCII letters and digits and of all characters beyond ASCII;
    only A-Z are lower-cased."""
    return text.encode().translate(_TERM_BYTES).split()


def weight(df: int, documents: int) -> int:
    return math.floor(LOGARITHM_SCALE * math.log((2 * documents + 2) / (2 * df + 1)))


@dataclass(frozen=True)
class Rows:
    """Sparse rows: values at terms, sorted by row and term."""

    starts: np.ndarray
    terms: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def picked(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows' values, row after row, and where each row begins."""
        lengths = self.starts[rows + 1] - self.starts[rows]
        begins = np.cumsum(lengths) - lengths
        return np.repeat(self.starts[rows] - begins, lengths) + np.arange(lengths.sum()), begins

    def products(self, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Each row's product with a dense vector. Rows are never empty."""
        at, begins = self.picked(rows)
        return np.add.reduceat(dense[self.terms[at]] * self.values[at], begins)


def maxima(owner: np.ndarray, terms: np.ndarray, values: np.ndarray, n: int) -> Rows:
    """One row per owner with the largest value at each of its terms."""
    order = np.lexsort((terms, owner))
    owner, terms, values = owner[order], terms[order], values[order]
    first = np.nonzero(np.append(True, (np.diff(owner) != 0) | (np.diff(terms) != 0)))[0] if len(owner) else np.zeros(0, int)
    most = np.maximum.reduceat(values, first) if len(first) else values
    starts = np.searchsorted(owner[first], np.arange(n + 1))
    return Rows(starts, terms[first], most)


def tree(rows: Rows, leaf: int, fan: int) -> list[Rows]:
    """Levels of nodes from the leaves, of ``leaf`` rows each, to one root."""
    levels, size = [], leaf
    while not levels or len(levels[-1]) > 1:
        below = levels[-1] if levels else rows
        n = -(-len(below) // size)
        owner = np.repeat(np.arange(len(below)), np.diff(below.starts)) // size
        levels.append(maxima(owner, below.terms, below.values, n))
        size = fan
    return levels


@dataclass(frozen=True)
class Items:
    """The items of a block that have terms, their terms' numbers and weights."""

    ids: list
    vocabulary: dict[bytes, int]
    rows: Rows


def read_items(table: list) -> Items:
    """Items from collected rows (``item``, ``terms``, ``counts``), ordered by
    their most frequent terms, so that neighbours are alike."""
    texts = [list(map(bytes, row["terms"])) for row in table]
    held = Counter(term for terms in texts for term in terms)
    vocabulary = {term: i for i, (term, _) in enumerate(sorted(held.items(), key=lambda x: (-x[1], x[0])))}
    numbered = [
        sorted((vocabulary[term], count) for term, count in zip(terms, row["counts"], strict=True))
        for terms, row in zip(texts, table, strict=True)
    ]
    order = sorted(range(len(table)), key=lambda i: [term for term, _ in numbered[i]])
    starts = np.cumsum([0, *(len(numbered[i]) for i in order)])
    flat = [pair for i in order for pair in numbered[i]]
    terms, counts = (np.array(x, dtype=np.int64) for x in (zip(*flat, strict=True) if flat else ((), ())))
    return Items([table[i]["item"] for i in order], vocabulary, Rows(starts, terms, counts))


class Search:
    """The best documents of every item so far, ``k`` each at most.

    ``least`` holds per item the score and id below which, in that order, a
    document cannot be among the best.
    """

    def __init__(self, items: Rows, n_terms: int, k: int, scores: np.ndarray, ids: np.ndarray) -> None:
        self._items, self._k = items, k
        self._levels = [items, *tree(items, FAN_ITEMS, FAN_ITEMS)]
        self.least_score, self.least_id = scores.copy(), ids.copy()
        self._dense = np.zeros(n_terms, dtype=np.int64)
        self._found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._gathered = 0
        self.scored = 0

    def _weakest(self, level: int) -> np.ndarray:
        """The lowest score that a document must reach for any item of a node."""
        if not level:
            return self.least_score
        return np.minimum.reduceat(self.least_score, np.arange(0, len(self._items), FAN_ITEMS**level))

    def _alive(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """Item nodes that the document node now in ``_dense`` may serve."""
        bounds = self._levels[level].products(nodes, self._dense)
        return nodes[(bounds > 0) & (bounds >= self._weakest(level)[nodes])]

    def _children(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """Nodes of the level below."""
        below = (nodes[:, None] * FAN_ITEMS + np.arange(FAN_ITEMS)).ravel()
        return below[below < len(self._levels[level - 1])]

    def add(self, docs: Rows, ids: np.ndarray) -> None:
        """Look at one run of documents, none of them empty."""
        levels = tree(docs, LEAF_DOCS, FAN_DOCS)
        top = len(self._levels) - 1
        self._visit(docs, ids, levels, len(levels) - 1, 0, top, np.zeros(1, dtype=np.int64))
        self.compact()

    def _visit(self, docs, ids, levels, depth: int, node: int, level: int, nodes: np.ndarray) -> None:
        """Pairs of one document node and item nodes of one level."""
        rows = levels[depth]
        span = slice(rows.starts[node], rows.starts[node + 1])
        self._dense[rows.terms[span]] = rows.values[span]
        alive = self._alive(level, nodes)
        while depth == 0 and level and len(alive):
            alive, level = self._children(level, alive), level - 1
            alive = self._alive(level, alive)
        self._dense[rows.terms[span]] = 0
        if not len(alive):
            return
        if depth == 0:
            self._score(docs, ids, node * LEAF_DOCS, alive)
            return
        if level:
            alive, level = self._children(level, alive), level - 1
        for child in range(node * FAN_DOCS, min((node + 1) * FAN_DOCS, len(levels[depth - 1]))):
            self._visit(docs, ids, levels, depth - 1, child, level, alive)

    def _score(self, docs: Rows, ids: np.ndarray, first: int, items: np.ndarray) -> None:
        at, begins = self._items.picked(items)
        terms, counts = self._items.terms[at], self._items.values[at]
        for doc in range(first, min(first + LEAF_DOCS, len(docs))):
            span = slice(docs.starts[doc], docs.starts[doc + 1])
            self._dense[docs.terms[span]] = docs.values[span]
            scores = np.add.reduceat(self._dense[terms] * counts, begins)
            self._dense[docs.terms[span]] = 0
            least = self.least_score[items]
            good = (scores > least) | ((scores == least) & (ids[doc] <= self.least_id[items]))
            good &= scores > 0
            if good.any():
                kept = items[good]
                self._found.append((kept, scores[good], np.full(len(kept), ids[doc])))
                self._gathered += len(kept)
        self.scored += len(items) * min(LEAF_DOCS, len(docs) - first)
        if self._gathered > GATHERED:
            self.compact()

    def compact(self) -> None:
        """Keep the best of each item and raise what the next must reach."""
        if not self._found:
            return
        items, scores, ids = (np.concatenate(x) for x in zip(*self._found, strict=True))
        order = np.lexsort((ids, -scores, items))
        items, scores, ids = items[order], scores[order], ids[order]
        place = np.arange(len(items)) - np.searchsorted(items, items)
        last = place == self._k - 1
        self.least_score[items[last]], self.least_id[items[last]] = scores[last], ids[last]
        best = place < self._k
        self._found = [(items[best], scores[best], ids[best])]
        self._gathered = 0

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, score and id of all found."""
        self.compact()
        none = np.zeros(0, dtype=np.int64)
        return self._found[0] if self._found else (none, none, none)


def _item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Items with a term: ``item, terms, counts``."""

    def start():
        def make(texts: list[str]) -> list[pa.Array]:
            found = [Counter(terms_of(x)) for x in texts]
            terms = pa.array([list(x) for x in found], pa.list_(pa.binary()))
            return [terms, pa.array([list(x.values()) for x in found], pa.list_(pa.int64()))]

        return make

    narrow = items.select(F.col(item_id).alias("item"), F.col(text).alias("text"))
    return map_texts(narrow, ["item"], "text", "terms array<binary>, counts array<long>", start).where(F.size("terms") > 0)


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Documents with a term: ``doc, n`` and counts of the terms known."""

    def start():
        def make(texts: list[str]) -> list[pa.Array]:
            lengths, terms, counts = [], [], []
            for text in texts:
                words = terms_of(text)
                lengths.append(len(words))
                found = [(vocabulary[word], n) for word, n in Counter(words).items() if word in vocabulary]
                terms.append([term for term, _ in found])
                counts.append([n for _, n in found])
            return [pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))]

        return make

    return map_texts(docs, ["doc"], "text", "n long, terms array<int>, counts array<long>", start).where("n > 0")


def _holders(vectors: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that hold each term."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, dtype=np.int64)
        for part in batches:
            total += np.bincount(part.column(0).flatten().to_numpy(), minlength=n_terms)
        used = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["term", "held"])

    sums = vectors.select("terms").mapInArrow(counted, "term long, held long").groupBy("term").agg(F.sum("held").alias("df"))
    out = np.zeros(n_terms, dtype=np.int64)
    rows = sums.toArrow()
    out[rows["term"].to_numpy()] = rows["df"].to_numpy()
    return out


def _weighed(vectors: DataFrame, weights: np.ndarray, documents: int, length: int) -> DataFrame:
    """Documents that share a term with an item: ``doc, terms, parts`` and the
    two strongest terms. A part is what one occurrence in an item scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 4096):
            terms, tf = (part.column(i).flatten().to_numpy().astype(np.int64) for i in (2, 3))
            sizes = part.column(2).value_lengths().to_numpy()
            # In whole Python numbers: 25 * n * N may pass 64 bits on the way.
            m = np.array([75 + 25 * n * documents // length for n in part.column(1).to_pylist()], dtype=np.int64)
            values = weights[terms] * (SCALE * tf // (1000 * tf + 12 * np.repeat(m, sizes)))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((terms, -values, owner))
            begins = np.cumsum(sizes) - sizes
            first, second = np.full(len(sizes), -1), np.full(len(sizes), -1)
            first[sizes > 0] = terms[order[begins[sizes > 0]]]
            second[sizes > 1] = terms[order[begins[sizes > 1] + 1]]
            ends = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
            columns = [
                part.column(0),
                pa.ListArray.from_arrays(ends, pa.array(terms.astype(np.int32))),
                pa.ListArray.from_arrays(ends, pa.array(values)),
                pa.array(first, pa.int64()),
                pa.array(second, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "terms", "parts", "first", "second"])

    shape = "doc long, terms array<int>, parts array<long>, first long, second long"
    return vectors.where(F.size("terms") > 0).select("doc", "n", "terms", "counts").mapInArrow(run, shape)


def _best(weighed: DataFrame, items: Items, k: int, scores: np.ndarray, ids: np.ndarray) -> DataFrame:
    """``at, score, doc``: candidates of each item, among them its ``k`` best."""
    rows, n_terms = items.rows, len(items.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(rows, n_terms, k, scores, ids)
        held: list[pa.RecordBatch] = []

        def add() -> None:
            whole = pa.Table.from_batches(held).combine_chunks()
            doc = whole["doc"].fill_null(_NO_ID).to_numpy()
            terms, parts = (whole[name].combine_chunks() for name in ("terms", "parts"))
            starts = np.append(0, np.cumsum(terms.value_lengths().to_numpy()))
            search.add(Rows(starts, terms.flatten().to_numpy(), parts.flatten().to_numpy()), doc)
            held.clear()

        for part in slices(batches, TREE_DOCS):
            held.append(part)
            if sum(x.num_rows for x in held) >= TREE_DOCS:
                add()
        if held:
            add()
        at, score, doc = search.best()
        docs = pa.array(doc, mask=doc == _NO_ID)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(score), docs], names=["at", "score", "doc"])

    return weighed.select("doc", "terms", "parts").mapInArrow(run, "at long, score long, doc long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("at").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, items: Items, k: int) -> DataFrame:
    vectors = stage(_vectors(docs, items.vocabulary), "search-vectors")
    total = vectors.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
    holders = _holders(vectors, len(items.vocabulary))
    weights = np.array([weight(df, total["documents"]) for df in holders.tolist()], dtype=np.int64)
    near = _weighed(vectors, weights, total["documents"], total["length"] or 1)
    # Documents alike stand together; the id parts those that are equal.
    ordered = near.repartitionByRange("first", "second", "doc").sortWithinPartitions("first", "second", "doc")
    weighed = stage(ordered.drop("first", "second"), "search-parts")
    scores, ids = np.zeros(len(items.ids), dtype=np.int64), np.full(len(items.ids), _NO_ID)
    sample = weighed.where(F.pmod(F.xxhash64("doc", "terms"), F.lit(SEED_EVERY)) == 0)
    # At most one row per item of the block.
    weakest = _ranked(_best(sample, items, k, scores, ids), k).where(F.col("rank") == k)
    for row in weakest.collect():
        scores[row["at"]], ids[row["at"]] = row["score"], _NO_ID if row["doc"] is None else row["doc"]
    return stage(_ranked(_best(weighed, items, k, scores, ids), k), "search-best")


def search(
    docs: DataFrame, items: DataFrame, k: int, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` highest-scoring documents of
    every item with a score above 0, equal scores by ascending id.

    A term's weight is ``floor(1000 ln((2N + 2) / (2 df + 1)))``, N the documents
    with a term. A document scores, for each occurrence of a term in the
    item, the weight times ``10^9 tf div (1000 tf + 12 m)``, where ``m`` is 75 plus
    25 times its length over the mean length, rounded down.

    Each row of ``items`` is an item and each row of ``docs`` a document, repeated
    ids too; ranks of an item are unique. Document ids are whole numbers, null after all
    others. Null or empty texts have no terms: such items give no rows, such
    documents never come and are not counted. Other columns are not read. Either
    table empty gives an empty result.
    """
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    wanted = stage(_item_terms(items, item_id, text), "search-items")
    sizes = wanted.agg(F.count(F.lit(1)), F.sum(F.size("terms"))).first()
    n_blocks = max(1, math.ceil(sizes[0] / BLOCK_ITEMS), math.ceil((sizes[1] or 0) / BLOCK_TERMS))
    numbered = wanted.withColumn("_block", F.pmod(F.xxhash64("item", "terms"), F.lit(n_blocks)))
    spark, kind = docs.sparkSession, wanted.schema["item"].dataType.simpleString()
    out = spark.createDataFrame([], f"item {kind}, rank int, doc long, score long")
    for block in range(n_blocks):
        # A block is bounded by the numbers above, the text of one item aside.
        rows = numbered.where(F.col("_block") == block).orderBy("item", "terms").collect()
        if not rows:
            continue
        held = read_items(rows)
        names = spark.createDataFrame(list(enumerate(held.ids)), f"at long, item {kind}")
        best = _search_block(narrow, held, k).join(F.broadcast(names), "at")
        out = out.unionByName(best.select("item", "rank", "doc", "score"))
    return out.select(F.col("item").alias(item_id), "rank", F.col("doc").alias(doc_id), "score")
