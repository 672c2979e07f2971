"""SimHash near-duplicates found by Golay-code fuzzy hashing.

The 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits. When
two fingerprints differ in at most four bits, the segments' errors fall into
one of two cases, and a key of that case is shared:

* one segment agrees: then of the other two at least one has two errors or
  fewer. Key: the agreeing segment as it is and a Golay key of the other.
* no segment agrees: then two segments have exactly one error each, which
  flips their parity. Key: Golay indices of both segments and whether their
  parities differ. Fingerprints with even parity in the first of them give
  the nearest codewords only, the others all nearby ones.

Fingerprints that share a key are compared bit by bit, so a link is never a
guess, and none is missed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratakeep.llm import golay
from stratakeep.llm.batches import map_texts
from stratakeep.llm.components import components
from stratakeep.sources.tables import stage

SHINGLE_WORDS = 4
SEED = 42
MAX_DISTANCE = 4
# First bit and width of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
_TAG_SHIFT = 40
_ONE_AGREES = len(list(permutations(range(3), 2)))

# One fingerprint in so many is looked at to find keys that hold very many.
SAMPLED = 64
# A key expected to hold more fingerprints than this is dealt out in blocks.
BLOCK = 4096
# ... if it also holds more than this share of all key rows, which bounds the
# number of such keys and so the table that is broadcast.
LEAST_SHARE = 1e-5
# Larger groups give a spanning forest of their links instead of all links.
FOREST_FROM = 64


def fingerprint(text: str) -> int:
    """The fingerprint of one text; see ``fingerprints``."""
    words = text.encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= SHINGLE_WORDS:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = np.cumsum([len(word) + 1 for word in words]) - 1
        starts = [0, *(ends[:-SHINGLE_WORDS] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts, ends[SHINGLE_WORDS - 1 :].tolist(), strict=True)]
    votes = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[start : start + (1 << 16)], dtype="<u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carried: Sequence[str] = ()
) -> DataFrame:
    """``doc_id, fp``: SimHash over four-word shingles, as a signed long.

    A-Z are lower-cased and words parted at ASCII white space. A bit is set
    if it is set in more than half of the shingles' XXH64 (seed 42), repeats
    included. A text of fewer than four words is one shingle; a null text
    or one without words has fingerprint zero. ``carried`` columns come along.
    """

    def start():
        def make(texts: list[str]) -> list[pa.Array]:
            values = np.array([fingerprint(x) for x in texts], dtype=np.uint64)
            return [pa.array(values.view(np.int64))]

        return make

    return map_texts(docs, [doc_id, *carried], text, "fp long", start)


def fuzzy_keys(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints and the row each belongs to.

    The lowest bit of a key tells the side of the second case; the keys of
    the first case have it zero and are compared among themselves.
    """
    parts = [((values >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    near = [golay.nearby(part, width) for part, (_, width) in zip(parts, SEGMENTS, strict=True)]
    nearest = [golay.decode(part) for part in parts]
    odd = [np.bitwise_count(part).astype(np.int64) & 1 for part in parts]
    keys, rows = [], []

    def add(tag: int, low: np.ndarray, row: np.ndarray, side: np.ndarray | int) -> None:
        keys.append(((np.int64(tag) << _TAG_SHIFT | low) << 1) | side)
        rows.append(row)

    for tag, (i, j) in enumerate(permutations(range(3), 2)):
        row, cell = np.nonzero(near[j][1])
        add(tag, parts[i][row] << 12 | near[j][0][row, cell], row, 0)
    for tag, (i, j) in enumerate(combinations(range(3), 2), _ONE_AGREES):
        mixed = (odd[i] ^ odd[j]) << 24
        even = np.nonzero(odd[i] == 0)[0]
        add(tag, mixed[even] | nearest[i][even] << 12 | nearest[j][even], even, 0)
        row, a, b = np.nonzero((near[i][1] & (odd[i] == 1)[:, None])[:, :, None] & near[j][1][:, None, :])
        add(tag, mixed[row] | near[i][0][row, a] << 12 | near[j][0][row, b], row, 1)
    return np.concatenate(keys), np.concatenate(rows)


def _forest(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among ``values``, breadth first.

    Whatever a step reaches is not compared again, so a tight group costs
    little more than one pass over it.
    """
    left, right = [], []
    rest = np.unique(values)
    while len(rest):
        frontier, rest = rest[:1], rest[1:]
        while len(frontier) and len(rest):
            grown = []
            for value in frontier:
                hit = np.bitwise_count(rest ^ value) <= MAX_DISTANCE
                if hit.any():
                    reached = rest[hit]
                    rest = rest[~hit]
                    grown.append(reached)
                    left.append(np.full(len(reached), value))
                    right.append(reached)
                    if not len(rest):
                        break
            frontier = np.concatenate(grown) if grown else frontier[:0]
    if not left:
        return values[:0], values[:0]
    return np.concatenate(left), np.concatenate(right)


def _compared(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between each row and the ``count`` rows from ``first`` on."""
    left_out, right_out = [], []
    rows = np.nonzero(count)[0]
    ends = np.cumsum(count[rows])
    for part in np.split(rows, np.searchsorted(ends, np.arange(1 << 20, ends[-1] if len(ends) else 0, 1 << 20))):
        left = np.repeat(part, count[part])
        base = np.repeat(np.cumsum(count[part]) - count[part], count[part])
        right = np.repeat(first[part], count[part]) + np.arange(len(left)) - base
        hit = np.bitwise_count(values[left] ^ values[right]) <= MAX_DISTANCE
        left_out.append(values[left[hit]])
        right_out.append(values[right[hit]])
    return np.concatenate(left_out), np.concatenate(right_out)


def _links_of_runs(keys: np.ndarray, pieces: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal key and piece; rows are sorted by these."""
    n = len(keys)
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = (keys[1:] >> 1 != keys[:-1] >> 1) | (pieces[1:] != pieces[:-1])
    begins = np.nonzero(fresh)[0]
    sizes = np.diff(np.append(begins, n))
    odd_rows = np.add.reduceat(keys & 1, begins) if n else begins
    two_sided = keys[begins] >> (_TAG_SHIFT + 1) >= _ONE_AGREES if n else fresh
    large = sizes > FOREST_FROM
    run = np.repeat(np.arange(len(begins)), sizes)
    end = (begins + sizes)[run]
    index = np.arange(n)
    even_side = keys & 1 == 0
    first = np.where(two_sided[run], end - odd_rows[run], index + 1)
    count = np.where(two_sided[run] & ~even_side, 0, end - first)
    count[large[run]] = 0
    found = [_compared(values, first, count)]
    for at in np.nonzero(large)[0]:
        found.append(_forest(values[begins[at] : begins[at] + sizes[at]]))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links from rows sorted by key; the last run of a batch is carried on."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def links(columns: list[np.ndarray]) -> pa.RecordBatch:
        a, b = _links_of_runs(*columns)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].view(np.int64)), pa.array(pairs[:, 1].view(np.int64))], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys, pieces, values = (batch.column(i).to_numpy() for i in range(3))
        same = (keys >> 1 == keys[-1] >> 1) & (pieces == pieces[-1])
        if same.all() and held and held[0][0][0] >> 1 == keys[0] >> 1 and held[0][1][0] == pieces[0]:
            held.append((keys, pieces, values))
            continue
        cut = int(np.argmax(same))
        whole = [np.concatenate(x) for x in zip(*held, (keys[:cut], pieces[:cut], values[:cut]), strict=True)]
        if len(whole[0]):
            yield links([whole[0], whole[1], whole[2].view(np.uint64)])
        held = [(keys[cut:], pieces[cut:], values[cut:])]
    if held:
        whole = [np.concatenate(x) for x in zip(*held, strict=True)]
        yield links([whole[0], whole[1], whole[2].view(np.uint64)])


def _keyed(values: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.column(0).slice(start, 4096).to_numpy()
                keys, rows = fuzzy_keys(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], ["key", "fp"])

    return values.select("fp").mapInArrow(run, "key long, fp long")


def links(values: DataFrame) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``).

    Groups of up to ``FOREST_FROM`` fingerprints under a key give every link,
    larger ones a spanning forest, which has the same components. A key that
    holds very many fingerprints is dealt out: its fingerprints go to blocks
    and every two blocks meet in a group of their own, so no task holds more
    than two blocks and every two fingerprints still meet.
    """
    key = F.shiftright("key", 1).alias("_key")
    sampled = _keyed(values.where(F.pmod(F.xxhash64("fp"), F.lit(SAMPLED)) == 0)).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    sampled = stage(sampled.where(F.col("_n") * SAMPLED > BLOCK), "hot-keys")
    n_keys = values.count() * 80
    heavy = sampled.where(F.col("_n") * SAMPLED > LEAST_SHARE * n_keys).select(
        "_key", F.ceil(F.col("_n") * SAMPLED / BLOCK).cast("long").alias("_blocks")
    )
    own = F.pmod(F.xxhash64("fp"), F.col("_blocks"))
    other = F.explode(
        F.when(F.col("_blocks") > 1, F.sequence(F.lit(0), F.col("_blocks") - 1)).otherwise(F.array(F.lit(0).cast("long")))
    )
    meeting = F.when(
        F.col("_blocks") > 1,
        F.least(F.col("_own"), F.col("_other")) * F.col("_blocks") + F.greatest(F.col("_own"), F.col("_other")),
    ).otherwise(F.lit(0))
    dealt = (
        _keyed(values)
        .withColumn("_key", key)
        .join(F.broadcast(heavy), "_key", "left")
        .withColumn("_own", own)
        .withColumn("_other", other)
        .select("key", "_key", meeting.cast("long").alias("piece"), "fp")
        .repartition("_key", "piece")
        .select("key", "piece", "fp")
        .sortWithinPartitions(F.shiftright("key", 1), "piece", "key")
    )
    return dealt.mapInArrow(_edges, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carried: Sequence[str] = ()
) -> DataFrame:
    """``doc_id, fp, component_id``: one row per row of ``docs``.

    Documents are linked if their fingerprints differ in four bits or fewer;
    ``component_id`` is the smallest id reachable. Texts with equal
    fingerprints are one node, so copies are never paired. Repeated rows stay
    repeated; an id that is null never becomes a component's id while the
    component has another. An empty table gives an empty result. ``carried``
    columns come along.
    """
    table = stage(fingerprints(docs, doc_id, text, carried), "fingerprints")
    classes = stage(table.groupBy("fp").agg(F.min(doc_id).alias("_least")), "fingerprint-classes")
    rooted = components(links(classes.select("fp"))).withColumnRenamed("node", "fp")
    of_class = classes.join(rooted, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    of_class = stage(of_class, "rooted-classes")
    least = stage(
        of_class.join(rooted.select("root").distinct(), "root", "left_semi").groupBy("root").agg(F.min("_least").alias("_root_least")),
        "component-ids",
    )
    mapped = stage(
        of_class.join(least, "root", "left").select("fp", F.coalesce("_root_least", "_least").alias("component_id")),
        "fingerprint-components",
    )
    return table.join(mapped, "fp").select(doc_id, "fp", "component_id", *carried)


def fingerprint_text(fp: str = "fp"):
    """A fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each near-duplicate group, all columns.

    Groups are those of ``near_duplicates``. The document with the smallest id
    stays; of several texts of a group with that id the one with the least
    hash, and of rows repeated in id and text one. Rows that share an id but
    not a group are judged each for itself. Rows without an id are kept: they
    cannot be told apart. Survivors are found among ids and hashes; texts are
    shuffled once, and again only those repeated in id and text.
    """
    hashed = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_hash"), F.col(text).alias("_text"))
    found = near_duplicates(hashed, "_id", "_text", ["_hash"]).where("_id IS NOT NULL")
    row = F.struct("_id", "_hash")
    survivors = stage(
        found.groupBy("component_id", "_id", "_hash")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("component_id")
        .agg(F.min(row).alias("one"), F.min_by("_n", row).alias("_n"))
        .select("one.*", "_n"),
        "survivors",
    )
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_hash"))
    once = rows.join(survivors.where("_n = 1"), ["_id", "_hash"], "left_semi")
    repeated = rows.join(survivors.where("_n > 1"), ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"])
    kept = once.unionByName(repeated).unionByName(rows.where("_id IS NULL"))
    return kept.select("row.*")
