"""Alignment of the tokens that two tokenizers make of the same text.

Both encode the whole text. A place where a token of each ends is a shared end,
verified by byte offsets; shared ends before a token that begins with a space
are anchors. Anchors cut a document into windows of token ids. The same windows
come again and again, so they are aligned once per pair of id tuples: the
groups between neighbouring shared ends, and the links, which are the pairs of
tokens whose byte ranges overlap.

How often an id pair is linked corpus-wide is counted per chunk of documents
(a few megabytes of text), where every unit of text and every window has a
small number. When a chunk is full, its distinct units are encoded, cut into
windows and aligned as arrays that lie end to end, with no object per unit or
window, and its texts are put together from numbers. Chunks send
each of their distinct pairs once, get its count back, and add up the documents
from their windows; neither texts nor links are shuffled.
"""

from __future__ import annotations

import os
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import chain, count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratakeep.llm.batches import slices
from stratakeep.llm.byte_bpe import byte_characters
from stratakeep.llm.units import cut
from stratakeep.sources.tables import stage

# A chunk ends at so many bytes of text; one longer text is a chunk alone.
CHUNK_BYTES = 6 << 20
SLICE_ROWS = 256
# Pairs with more than one in so many links are broadcast; there are no more
# of them than this number.
FREQUENT = 200_000
# An id pair is written as one number: the first id times this, plus the second.
PAIR = 1 << 15
# Units that one line holds.
LINE_UNITS = 1024

_SPACE = "▁"

# The ids of a window on both sides, 32 bits each.
Key = tuple[bytes, bytes]


@dataclass
class Vocabulary:
    """Byte lengths of the tokens and whether each begins with a space."""

    bytes_of: list[bytes | None]
    widths: np.ndarray = field(init=False)
    spaced: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        known = [token or b"" for token in self.bytes_of]
        self.widths = np.array([len(token) for token in known], dtype=np.int64)
        self.spaced = np.array([token[:1] == b" " for token in known])

    def joined(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] or b"" for i in ids])


class Laid(NamedTuple):
    """Ids of both sides, laid end to end, and how many each unit or window has."""

    a: np.ndarray
    b: np.ndarray
    sizes_a: np.ndarray
    sizes_b: np.ndarray


def _end_to_end(parts: list[Laid]) -> Laid:
    nothing = np.zeros(0, dtype="<i4")
    return Laid(*[np.concatenate([nothing, *side]) for side in zip(*parts, strict=True)]) if parts else Laid(*[nothing] * 4)


def _piece_bytes(library: sentencepiece.SentencePieceProcessor, i: int) -> bytes:
    piece = library.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if library.is_byte(i) else piece.replace(_SPACE, " ").encode()


class Encoders:
    """The two tokenizers of one worker: byte-level BPE (A) and pieces (B).

    Both start a new token at every single space between characters that are
    not white space (see ``units``), so units are encoded once and their ids
    joined to those of the whole text, which both libraries begin with a space.
    """

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {character: byte for byte, character in enumerate(byte_characters())}
        entries = self._a.get_vocab(with_added_tokens=True)
        of_a: list[bytes | None] = [None] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            if all(character in byte_of for character in entry):
                of_a[i] = bytes(byte_of[character] for character in entry)
        self.a = Vocabulary(of_a)
        self.b = Vocabulary([_piece_bytes(self._b, i) for i in range(self._b.get_piece_size())])
        if self._b.get_piece_size() > PAIR or len(of_a) * PAIR > 1 << 31:
            raise ValueError("an id pair of these vocabularies does not fit one integer")
        # Such a token could reach over a cut between units.
        if any(re.search(r"\S ", (token or b"").decode(errors="replace")) for token in [*of_a, *self.b.bytes_of]):
            raise ValueError("a token of these vocabularies reaches over a space")

    def _encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of each text with a space in front; None where the bytes of
        either side's tokens are not those of space and text."""
        first = [one.ids for one in self._a.encode_batch_fast([" " + x for x in texts], add_special_tokens=False)]
        second = self._b.encode(texts, num_threads=1)
        out = []
        for text, a, b in zip(texts, first, second, strict=True):
            wanted = b" " + text.encode()
            same = self.a.joined(a) == wanted and self.b.joined(b) == wanted
            out.append((np.array(a, dtype="<i4"), np.array(b, dtype="<i4")) if same else None)
        return out

    def _encode_each(self, units: list[str]) -> Laid:
        nothing = np.zeros(0, dtype="<i4")
        found = [ids or (nothing, nothing) for ids in self._encode(units)]
        return _end_to_end([Laid(a, b, np.array([len(a)]), np.array([len(b)])) for a, b in found])

    def _encode_line(self, units: list[str]) -> Laid:
        """As ``_encode_each`` for units that neither begin nor end with white
        space: one line holds them all, and its tokens are dealt out again by
        byte offsets. If an offset is not where a unit ends, each goes alone."""
        if len(units) < 2:
            return self._encode_each(units)
        ends = np.cumsum([len(unit.encode()) + 1 for unit in units])
        found = self._encode([" ".join(units)])[0]
        if found is None:
            return self._encode_each(units)
        sizes = []
        for ids, vocabulary in zip(found, (self.a, self.b), strict=True):
            at = np.cumsum(vocabulary.widths[ids])
            place = np.searchsorted(at, ends)
            if (at[place] != ends).any():
                return self._encode_each(units)
            sizes.append(np.diff(place, prepend=-1))
        return Laid(*found, *sizes)

    def encode(self, units: list[str]) -> tuple[Laid, np.ndarray]:
        """Ids of the units, none where a side does not give its bytes back,
        and the place of each unit among them."""
        plain, odd = [], []
        for i, unit in enumerate(units):
            (odd if not unit or unit[0].isspace() or unit[-1].isspace() else plain).append(i)
        lines = (plain[start : start + LINE_UNITS] for start in range(0, len(plain), LINE_UNITS))
        parts = [self._encode_line([units[i] for i in line]) for line in lines]
        if odd:
            parts.append(self._encode_each([units[i] for i in odd]))
        places = np.empty(len(units), dtype=np.int64)
        places[plain + odd] = np.arange(len(units))
        return _end_to_end(parts), places

    def windows(self, units: list[str]) -> list[tuple[Key, ...] | None]:
        """The windows of each unit; None where a side does not give its bytes back."""
        laid, places = self.encode(units)
        found, numbers, counts = windows(laid, (self.a, self.b))
        keys = list(zip(_split(found.a, found.sizes_a), _split(found.b, found.sizes_b), strict=True))
        last = np.cumsum(counts)
        return [tuple([keys[i] for i in numbers[last[at] - counts[at] : last[at]]]) or None for at in places]


@cache
def encoders(path_a: str, path_b: str) -> Encoders:
    return Encoders(path_a, path_b)


class Aligned(NamedTuple):
    """Alignments of windows: their groups as one text, a line per window, the
    number of groups and of links per window, and the links one after another."""

    groups: str
    n_groups: np.ndarray
    n_links: np.ndarray
    pairs: np.ndarray


class Aligner:
    """Aligns windows in bulk."""

    def __init__(self, vocabularies: tuple[Vocabulary, Vocabulary]) -> None:
        self._widths = tuple(v.widths for v in vocabularies)
        size = self._size = len(self._widths[0])
        # An id as it is written before a token of its side, before the other
        # side, before the next group and at the end of a window.
        written = [f"{i}{mark}" for mark in ",|" for i in range(size)]
        written += [f"{i}{mark}" for mark in ",;\n" for i in range(len(self._widths[1]))]
        self._written = np.array(written, dtype=object)

    def align(self, found: Laid) -> Aligned:
        """Groups and links of windows, whose two sides cover the same bytes.

        The windows are laid end to end. Between two neighbouring ends, of
        either side, one token of each side covers the bytes: every such stretch
        is a link of its own.
        """
        width_a, width_b = self._widths
        a, b = found.a, found.b
        if not len(a):
            return Aligned("", *[np.zeros(0, dtype="<i4")] * 3)
        ends_a, ends_b = np.cumsum(width_a[a]), np.cumsum(width_b[b])
        stops_a, stops_b = np.cumsum(found.sizes_a) - 1, np.cumsum(found.sizes_b) - 1
        place = np.searchsorted(ends_b, ends_a)
        shared_a = ends_b[place] == ends_a
        shared_b = np.zeros(len(b), dtype=bool)
        shared_b[place[shared_a]] = True
        # Two sorted parts, which this kind of sort merges.
        ends = np.sort(np.concatenate([ends_a, ends_b[~shared_b]]), kind="stable")
        pairs = (a[np.searchsorted(ends_a, ends)] * PAIR + b[np.searchsorted(ends_b, ends)]).astype("<i4")
        n_links = np.diff(np.searchsorted(ends, ends_a[stops_a]), prepend=-1)
        group_a, group_b = np.cumsum(shared_a), np.cumsum(shared_b)
        n_groups = np.diff(group_a[stops_a], prepend=0)
        # A group is written as its tokens of A, then those of B.
        done_a, done_b = np.nonzero(shared_a)[0] + 1, np.append(0, np.nonzero(shared_b)[0] + 1)
        last_b = shared_b.astype(int)
        last_b[stops_b] = 2
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + done_b[group_a - shared_a]] = a + shared_a * self._size
        order[np.arange(len(b)) + done_a[group_b - shared_b]] = 2 * self._size + b + last_b * len(width_b)
        return Aligned("".join(self._written[order].tolist())[:-1], n_groups, n_links, pairs)


def _split(ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """The ids, as bytes, of each unit or window."""
    raw, last = ids.tobytes(), (np.cumsum(sizes) * ids.itemsize).tolist()
    return [raw[i:j] for i, j in zip([0, *last], last, strict=False)]


def windows(units: Laid, vocabularies: tuple[Vocabulary, Vocabulary]) -> tuple[Laid, np.ndarray, np.ndarray]:
    """The distinct windows between neighbouring anchors of the units, the
    windows of each unit in order, by number, and how many each unit has.

    Every unit begins with a space, so where one ends is an anchor itself. A
    window that is a whole unit occurs once, as units are distinct; windows of
    units that have several are compared by their two id tuples.
    """
    a, b = units.a, units.b
    ends_a, ends_b = (np.cumsum(v.widths[ids]) for ids, v in zip((a, b), vocabularies, strict=True))
    before_space = np.append(vocabularies[0].spaced[a[1:]], True)[: len(a)]
    place = np.searchsorted(ends_b, ends_a)
    anchors = np.nonzero(before_space & (ends_b[place] == ends_a))[0]
    found = Laid(a, b, np.diff(anchors, prepend=-1), np.diff(place[anchors], prepend=-1))
    counts = np.diff(np.searchsorted(anchors, np.cumsum(units.sizes_a) - 1, side="right"), prepend=0)
    numbers = np.arange(len(anchors))
    several = np.nonzero(np.repeat(counts > 1, counts))[0].tolist()
    if several:
        keys = zip(_split(a, found.sizes_a), _split(b, found.sizes_b), strict=True)
        first: dict[Key, int] = {}
        wanted = iter(several)
        at = next(wanted)
        for number, key in enumerate(keys):
            if number == at:
                numbers[number] = first.setdefault(key, number)
                at = next(wanted, -1)
        kept = numbers == np.arange(len(numbers))
        a, b = a[np.repeat(kept, found.sizes_a)], b[np.repeat(kept, found.sizes_b)]
        found = Laid(a, b, found.sizes_a[kept], found.sizes_b[kept])
        numbers = (np.cumsum(kept) - 1)[numbers]
    return found, numbers, counts


_FIELDS = (
    "chunk long, row int, n_a long, n_b long, n_groups long, windows array<int>, "
    "pairs array<int>, uses array<long>, window_pairs binary, window_sizes binary, texts binary"
)


def _chunked(docs: DataFrame, path_a: str, path_b: str, doc_id: str, text: str) -> DataFrame:
    """A row per document with the numbers of its windows, and a last row per
    chunk, with a null ``row``, that says what the windows are. What is sent on
    per window (numbers of its pairs, how many they are, its groups) is packed."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = encoders(path_a, path_b)
        vocabularies = (both.a, both.b)
        aligner, packer = Aligner(vocabularies), zstandard.ZstdCompressor(level=1)
        number, held = TaskContext.get().partitionId() << 32, 0
        # What the chunk holds: numbers of units, ids, units of its rows.
        unit_numbers: dict[str, int] = defaultdict(count().__next__)
        ids: list[pa.Array] = []
        sizes: list[int] = []
        units: list[np.ndarray] = []

        def close() -> Iterator[pa.RecordBatch]:
            encoded, places = both.encode(list(unit_numbers))
            found, numbers, counts = windows(encoded, vocabularies)
            of_rows = places[np.concatenate(units)]
            row_ends = np.cumsum([0, *sizes])
            # A text has no windows if one of its units has none.
            lost = np.append(0, np.cumsum(counts[of_rows] == 0))[row_ends]
            whole = np.repeat(lost[1:] == lost[:-1], sizes)
            uses = np.where(whole, counts[of_rows], 0)
            ends = np.append(0, np.cumsum(uses))
            starts = (np.cumsum(counts) - counts)[of_rows]
            flat = numbers[np.repeat(starts - ends[:-1], uses) + np.arange(ends[-1])]
            ends = ends[row_ends]

            aligned = aligner.align(found)
            shapes = (found.sizes_a, found.sizes_b, aligned.n_groups)
            sums = [np.append(0, np.cumsum(shape[flat], dtype=np.int64))[ends] for shape in shapes]
            rows = len(sizes)
            columns = [
                pa.chunked_array(ids, id_of).combine_chunks(),
                pa.array(np.full(rows, number)),
                pa.array(np.arange(rows), pa.int32()),
                *[pa.array(np.diff(x)) for x in sums],
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())),
                *[pa.nulls(rows, kind) for kind in (pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary())],
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

            pairs, at = np.unique(aligned.pairs, return_inverse=True)
            times = np.bincount(flat, minlength=len(found.sizes_a))
            links = np.bincount(at, weights=np.repeat(times.astype(float), aligned.n_links), minlength=len(pairs))
            packed = (at.astype("<i4").tobytes(), aligned.n_links.astype("<i4").tobytes(), aligned.groups.encode())
            blank = [None]
            columns = [
                pa.array(blank, id_of),
                pa.array([number], pa.int64()),
                *[pa.array(blank, kind) for kind in (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))],
                pa.array([pairs], pa.list_(pa.int32())),
                pa.array([links.astype(np.int64)], pa.list_(pa.int64())),
                *[pa.array([packer.compress(x)], pa.binary()) for x in packed],
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

        for batch in slices(batches, SLICE_ROWS):
            id_of = batch.schema.field(0).type
            texts = [x or "" for x in batch.column(1).to_pylist()]
            start = 0
            while start < len(texts):
                # Rows up to the end of the chunk.
                stop = start
                while stop < len(texts) and held < CHUNK_BYTES:
                    held += len(texts[stop])
                    stop += 1
                parted = [cut(text) if text else [] for text in texts[start:stop]]
                ids.append(batch.column(0).slice(start, stop - start))
                new_sizes = list(map(len, parted))
                sizes += new_sizes
                of = map(unit_numbers.__getitem__, chain.from_iterable(parted))
                units.append(np.fromiter(of, dtype=np.int32, count=sum(new_sizes)))
                start = stop
                if held >= CHUNK_BYTES:
                    yield from close()
                    number, held = number + 1, 0
                    unit_numbers, ids, sizes, units = defaultdict(count().__next__), [], [], []
        if sizes:
            yield from close()

    names = ["doc_id", *[part.split()[0] for part in _FIELDS.split(", ")]]
    return source.mapInArrow(run, f"doc_id {id_type}, {_FIELDS}")


def _counts(dictionaries: DataFrame) -> DataFrame:
    """``pair, n, best``: links that hold each pair, and whether no other pair
    of the same second id has more."""
    seen = dictionaries.select(F.explode(F.arrays_zip("pairs", "uses")).alias("x")).select(
        F.col("x.pairs").alias("pair"), F.col("x.uses").alias("uses")
    )
    counts = stage(seen.groupBy("pair").agg(F.sum("uses").alias("n")), "pair-counts")
    second = F.pmod("pair", F.lit(PAIR))
    # A row per id of the second vocabulary, PAIR at most.
    most = counts.groupBy(second.alias("_b")).agg(F.max("n").alias("_most"))
    joined = counts.withColumn("_b", second).join(F.broadcast(most), "_b")
    return stage(joined.select("pair", "n", (F.col("n") == F.col("_most")).alias("best")), "best-pairs")


def aligned(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links,
    n_best, count_sum, groups``.

    ``path_a`` names a byte-level BPE of the tokenizers library, which encodes
    space and text, and ``path_b`` a sentencepiece model, which adds the space
    itself; special strings are plain text. ``groups`` is
    ``a1,a2|b1;a3|b2,b3``: ids of both sides between shared ends, in order.
    ``n_links`` counts pairs of tokens whose bytes overlap, ``count_sum`` sums
    over them how many links of all ``docs`` hold the same id pair, and
    ``n_best`` counts those whose pair is the most frequent of its second id,
    ties included. A text that is null, empty or not given back byte for byte
    by both sides has no tokens: zeros and an empty ``groups``. Repeated
    rows and ids, and null ids, are rows like any other and count each; other
    columns are not read. An empty table gives an empty result.
    """
    table = stage(_chunked(docs, path_a, path_b, doc_id, text), "chunks")
    dictionaries = table.where("row IS NULL")
    counts = _counts(dictionaries)
    links = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    wanted = dictionaries.select("chunk", F.posexplode("pairs").alias("at", "pair"))
    often = F.col("n") * FREQUENT > links
    near = counts.where(often).select("pair", F.struct("n", "best").alias("_often"))
    rest = counts.where(~often).select("pair", F.struct("n", "best").alias("_rare"))
    placed = wanted.join(F.broadcast(near), "pair", "left")
    rare = placed.where("_often IS NULL").join(rest, "pair").select("chunk", "at", F.col("_rare").alias("x"))
    answered = placed.where("_often IS NOT NULL").select("chunk", "at", F.col("_often").alias("x")).union(rare)
    answered = answered.select(F.col("chunk").alias("of"), "at", "x.n", "x.best")

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        given = left.filter(pa.compute.is_null(left["row"]))
        rows = left.filter(pa.compute.is_valid(left["row"]))
        order = np.argsort(right["at"].to_numpy())
        n = right["n"].to_numpy()[order]
        best = right["best"].to_numpy(zero_copy_only=False)[order].astype(np.int64)
        unpack = zstandard.ZstdDecompressor().decompress
        at, sizes, texts = (unpack(given[x][0].as_py()) for x in ("window_pairs", "window_sizes", "texts"))
        at, sizes, texts = np.frombuffer(at, dtype="<i4"), np.frombuffer(sizes, dtype="<i4"), texts.decode().split("\n")
        starts = np.cumsum(sizes, dtype=np.int64) - sizes
        sums = np.add.reduceat(n[at], starts) if len(at) else n
        bests = np.add.reduceat(best[at], starts) if len(at) else best
        used = rows["windows"].combine_chunks()
        ends = np.cumsum(np.append(0, used.value_lengths().to_numpy()))
        places = used.flatten().to_numpy()
        n_best, count_sum = (np.append(0, np.cumsum(x[places])) for x in (bests, sums))
        n_best, count_sum = (x[ends[1:]] - x[ends[:-1]] for x in (n_best, count_sum))
        words = [texts[place] for place in places.tolist()]
        groups = [";".join(words[i:j]) for i, j in zip(ends.tolist(), ends[1:].tolist(), strict=False)]
        n_links = pa.compute.subtract(pa.compute.add(rows["n_a"], rows["n_b"]), rows["n_groups"])
        return pa.table(
            {
                "doc_id": rows["doc_id"],
                "n_a": rows["n_a"],
                "n_b": rows["n_b"],
                "n_groups": rows["n_groups"],
                "n_links": n_links,
                "n_best": pa.array(n_best, pa.int64()),
                "count_sum": pa.array(count_sum, pa.int64()),
                "groups": pa.array(groups, pa.string()),
            }
        )

    id_type = table.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    kept = table.select("chunk", "doc_id", "row", "n_a", "n_b", "n_groups", "windows", "window_pairs", "window_sizes", "texts")
    return kept.groupBy("chunk").cogroup(answered.groupBy("of")).applyInArrow(add_up, shape)
