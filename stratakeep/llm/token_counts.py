"""Exact token counts at every prefix of a text by dynamic programming.

For a vocabulary of byte-level BPE, the encoding of a prefix is the encoding of
a shorter prefix and one more token: the only token that ends there and may
follow the shorter prefix's last token. Two tokens may follow each other if
their joined text encodes to just these two. So one pass over the positions
gives the count at each of them, and questions about truncation or a budget are
answered from the stored counts without encoding again.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator
from functools import cache
from itertools import accumulate, chain
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from stratakeep.llm.batches import map_texts
from stratakeep.llm.byte_bpe import byte_characters
from stratakeep.llm.units import CACHE_CHARS, CACHE_UNITS, UnitCache, cut

# Runs of two or more characters with the White_Space property (fixed values).
_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2,}")
# Endings that only their last letter makes one piece (fixed values).
_LONG_ENDINGS = ("'re", "'ve", "'ll")

# Units of letters, digits, signs and single line ends, whose pieces are plain
# to see, and those pieces.
_LETTERS, _SIGNS = "A-Za-zÀ-ÖØ-öø-ÿ", r".,;:!?|#*$%&<>()_+@/-"
_PLAIN = re.compile(f" ?[{_LETTERS}0-9{_SIGNS}]+(?:\n[{_LETTERS}0-9{_SIGNS}]+)*")
_PLAIN_PIECES = re.compile(f" ?[{_LETTERS}]+| ?[0-9]+| ?[{_SIGNS}]+|\n")
_BYTES = dict(enumerate(byte_characters()))
_BYTE_OF = {character: byte for byte, character in _BYTES.items()}

# Longest piece, in bytes, that is counted together with others, and how many at once.
BULK_BYTES = 64
BULK_PIECES = 1 << 15
# Units kept per task: most of what a task of some 30 MB of text holds.
KEPT_UNITS = 2 * CACHE_UNITS


def _as_bytes(text: str) -> str:
    """One byte character per byte of the text."""
    return text.encode().decode("latin-1").translate(_BYTES)


def _steps(counts: list[int]) -> bytes:
    return struct.pack(f"<{len(counts)}i", *map(sub, counts, [0, *counts]))


class Endings:
    """Finds the tokens that end at a byte, by a tree of tokens read backwards.

    A branch is a node times 256 plus a byte; ``_keys`` holds all, in order.
    """

    def __init__(self, tokens: dict[bytes, int]) -> None:
        nodes = {b"": 0}
        branches: dict[int, int] = {}
        for token in tokens:
            at = 0
            for start in range(len(token) - 1, -1, -1):
                node = nodes.setdefault(token[start:], len(nodes))
                branches[at << 8 | token[start]] = node
                at = node
        self._token = np.full(len(nodes), -1, dtype=np.int64)
        for token, number in tokens.items():
            self._token[nodes[token]] = number
        self._keys = np.array(sorted(branches), dtype=np.int64)
        self._nodes = np.array([branches[key] for key in self._keys.tolist()], dtype=np.int64)

    def find(self, rows: np.ndarray, rights: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Of the places at byte ``ends`` of a row of ``rows``: those where a
        token ends, that token, and its length, by growing length."""
        at, node = np.arange(len(ends)), np.zeros(len(ends), dtype=np.int64)
        length = 0
        while len(at):
            length += 1
            inside = ends[at] >= length
            at, node = at[inside], node[inside]
            branch = node << 8 | rows[rights[at], ends[at] - length]
            place = np.minimum(np.searchsorted(self._keys, branch), len(self._keys) - 1)
            there = self._keys[place] == branch
            at, node = at[there], self._nodes[place[there]]
            token = self._token[node]
            whole = token >= 0
            if whole.any():
                yield at[whole], token[whole], length


class PrefixCounter:
    """Counts tokens at every prefix as the library's ``encode`` would."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as stored:
            parts = json.load(stored)
        self._library = Tokenizer.from_file(path)
        self.special = [token["content"] for token in parts["added_tokens"]]
        model = parts["model"]
        merges = [tuple(pair) for pair in model["merges"]]
        self._model = models.BPE(vocab=model["vocab"], merges=merges)
        added = set(self.special)
        whole = [token for token in model["vocab"] if token not in added]
        self._ids = {token: model["vocab"][token] for token in whole if len(self._model.tokenize(token)) == 1}
        self._text = {number: token for token, number in self._ids.items()}
        lengths: dict[str, set[int]] = {}
        for token in self._ids:
            if len(token) > 2:
                lengths.setdefault(token[-3:], set()).add(len(token))
        # Lengths of the tokens that end alike, the longest first.
        self._lengths = {tail: (*sorted(found, reverse=True), 2, 1) for tail, found in lengths.items()}
        self._known: dict[str, bytes] = {}
        self._follows: dict[int, bool] = {}
        self._endings = Endings({bytes(map(_BYTE_OF.__getitem__, token)): i for token, i in self._ids.items()})
        # Pairs of tokens in order, the first shifted, and whether the second may follow.
        self._pairs, self._fit = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)

    def _may_follow(self, first: int, second: int) -> bool:
        found = self._model.tokenize(self._text[first] + self._text[second])
        return len(found) == 2 and found[0].id == first and found[1].id == second

    def _fits(self, pairs: np.ndarray) -> np.ndarray:
        """``_may_follow`` of many pairs."""
        if len(self._pairs):
            place = np.minimum(np.searchsorted(self._pairs, pairs), len(self._pairs) - 1)
            known = self._pairs[place] == pairs
            if known.all():
                return self._fit[place]
            new = np.unique(pairs[~known])
        else:
            new = np.unique(pairs)
        if len(self._pairs) > 1_000_000:
            self._pairs, self._fit, new = self._pairs[:0], self._fit[:0], np.unique(pairs)
        fit = np.array([self._may_follow(pair >> 20, pair & (1 << 20) - 1) for pair in new.tolist()], dtype=bool)
        at = np.searchsorted(self._pairs, new)
        self._pairs, self._fit = np.insert(self._pairs, at, new), np.insert(self._fit, at, fit)
        return self._fit[np.searchsorted(self._pairs, pairs)]

    def pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Differences of the counts at each character of each piece, as
        ``_steps`` gives them for one.

        The pieces are in order, so those that begin alike are neighbours and a
        beginning is counted once, in the first row that has it. All rows go
        on by one byte at a time.
        """
        sizes = np.array(list(map(len, pieces)))
        width = int(sizes.max())
        rows = np.frombuffer(b"".join([x.ljust(width, b"\0") for x in pieces]), dtype=np.uint8).reshape(-1, width)
        # Bytes at the beginning that are those of the row before.
        same = np.append(0, np.argmin(np.pad(rows[1:] == rows[:-1], ((0, 0), (0, 1))), axis=1))
        by_end = np.arange(1, width + 1)
        # The places that are counted, one byte's after the other's.
        ends, rights = np.nonzero((by_end[:, None] > same) & (by_end[:, None] <= sizes))
        ends += 1
        found = list(self._endings.find(rows, rights, ends))
        at, tokens = (np.concatenate([x[i] for x in found]) for i in (0, 1))
        lengths = np.repeat([x[2] for x in found], [len(x[0]) for x in found])
        order = np.argsort(ends[at], kind="stable")
        at, tokens, starts, of = at[order], tokens[order], (ends[at] - lengths)[order], rights[at[order]]
        last_at = np.searchsorted(ends[at], np.arange(width + 1), side="right").tolist()
        counts, last = (np.full((width + 1, len(pieces)), fill, dtype=np.int32) for fill in (0, -1))
        first = np.arange(len(pieces))
        for end in range(1, width + 1):
            here = slice(last_at[end - 1], last_at[end])
            row, start, token = of[here], starts[here], tokens[here]
            fits = start == 0
            later = np.nonzero(~fits)[0]
            before = last[start[later], row[later]].astype(np.int64)
            later, before = later[before >= 0], before[before >= 0]
            if len(later):
                fits[later] = self._fits(before << 20 | token[later])
            row, start, token = row[fits], start[fits], token[fits]
            counts[end, row], last[end, row] = counts[start, row] + 1, token
            # Rows that begin like one before take its state.
            owner = np.maximum.accumulate(np.where(same < end, first, 0))
            counts[end], last[end] = counts[end, owner], last[end, owner]
        missing = (last[1:] < 0) & (by_end[:, None] <= sizes)
        if missing.any():
            end, row = (int(x[0]) for x in np.nonzero(missing))
            raise ValueError(f"no token of the vocabulary ends at byte {end + 1} of {pieces[row]!r}")
        # A character ends before a byte that does not go on with it.
        after = np.pad(rows[:, 1:], ((0, 0), (0, 1)))
        complete = (after & 0xC0 != 0x80) & (by_end <= sizes[:, None])
        at_ends = counts[1:].T[complete]
        stops = np.cumsum(complete.sum(axis=1))
        steps = np.diff(at_ends, prepend=np.int32(0))
        steps[stops[:-1]] = at_ends[stops[:-1]]
        raw, stops = steps.astype("<i4").tobytes(), (stops * 4).tolist()
        return [raw[i:j] for i, j in zip([0, *stops], stops, strict=False)]

    def piece(self, piece: str) -> list[int]:
        """Counts at every byte of one piece, given as byte characters."""
        ids, lengths, follows = self._ids, self._lengths, self._follows
        if len(follows) > 1_000_000:
            follows.clear()
        counts, last = [0], [-1]
        for end in range(1, len(piece) + 1):
            for length in lengths.get(piece[max(0, end - 3) : end], (2, 1)):
                start = end - length
                if start < 0:
                    continue
                token = ids.get(piece[start:end])
                if token is None:
                    continue
                if start:
                    pair = last[start] << 20 | token
                    fits = follows.get(pair)
                    if fits is None:
                        fits = follows[pair] = self._may_follow(last[start], token)
                    if not fits:
                        continue
                counts.append(counts[start] + 1)
                last.append(token)
                break
            else:
                raise ValueError(f"no token of the vocabulary ends at byte {end} of {piece!r}")
        return counts[1:]

    def units(self, units: list[str]) -> list[bytes]:
        """``unit`` of many units, whose new plain pieces are counted together."""
        plain = [_PLAIN_PIECES.findall(unit) if _PLAIN.fullmatch(unit) else None for unit in units]
        known = self._known
        if len(known) > CACHE_UNITS:
            known.clear()
        new = {piece.encode(): piece for piece in set(chain.from_iterable(filter(None, plain))) - known.keys()}
        short = sorted(piece for piece in new if len(piece) <= BULK_BYTES)
        for start in range(0, len(short), BULK_PIECES):
            part = short[start : start + BULK_PIECES]
            known.update(zip([new[piece] for piece in part], self.pieces(part), strict=True))
        return [self.unit(unit) if of is None else b"".join(map(self._plain, of)) for unit, of in zip(units, plain, strict=True)]

    def unit(self, unit: str) -> bytes:
        """Differences of the counts at each character of a unit to the
        character before, as 32-bit integers; see ``units.cut``."""
        if _PLAIN.fullmatch(unit):
            return b"".join(map(self._plain, _PLAIN_PIECES.findall(unit)))
        counts: list[int] = []
        starts: dict[int, int] = {}
        before = 0
        for text, piece in self._pieces(unit):
            starts[len(counts)] = before
            part = self._characters(text, piece, before)
            if text in _LONG_ENDINGS:
                part[1] = before + 2
            counts += part
            before = part[-1]
        # A run of blanks is one piece as long as nothing follows it; the piece
        # it starts with is the same.
        for run in _BLANKS.finditer(unit):
            blanks = self._pieces(run[0])
            if len(blanks) == 1:
                counts[run.start() : run.end()] = self._characters(*blanks[0], starts[run.start()])
        return _steps(counts)

    def _plain(self, text: str) -> bytes:
        """The differences within one piece, which are the same wherever it stands."""
        found = self._known.get(text)
        if found is None:
            found = _steps(self._characters(text, _as_bytes(text), 0))
            if len(text) <= CACHE_CHARS:
                self._known[text] = found
        return found

    def _pieces(self, text: str) -> list[tuple[str, str]]:
        found = self._library.pre_tokenizer.pre_tokenize_str(text)
        return [(text[start:end], piece) for piece, (start, end) in found]

    def _characters(self, text: str, piece: str, before: int) -> list[int]:
        counts = self.piece(piece)
        if len(text) < len(piece):
            ends = accumulate(len(character.encode()) for character in text)
            counts = [counts[end - 1] for end in ends]
        return [before + count for count in counts] if before else counts


@cache
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def prefix_counts(docs: DataFrame, path: str, carried: list[str], text: str = "text") -> DataFrame:
    """``carried`` columns with ``prefix_counts``: one count per character.

    Entry *i* is the number of tokens of the first *i* characters, as the
    library counts them for that text alone, without added special tokens; a
    special string inside the text is one token, as is the library's default.
    A null or empty text has an empty list. Counts may fall from one
    character to the next, because a longer text can merge better.
    """

    def start():
        counting = counter(path)
        kept = UnitCache(counting.units, KEPT_UNITS)
        special = re.compile("|".join(map(re.escape, counting.special))) if counting.special else None

        def plain(texts: list[str]) -> list[np.ndarray]:
            joined = [b"".join(steps) for steps in kept.values([cut(x) for x in texts])]
            return [np.cumsum(np.frombuffer(steps, dtype="<i4"), dtype="<i4") for steps in joined]

        def with_special(whole: str) -> np.ndarray:
            out, before, at = [], 0, 0
            for hit in special.finditer(whole):
                # Until its last character a special string is ordinary text.
                part = plain([whole[at : hit.end() - 1]])[0] + before
                before = (int(part[hit.start() - at - 1]) if hit.start() > at else before) + 1
                out += [part, np.array([before], dtype="<i4")]
                at = hit.end()
            return np.concatenate([*out, plain([whole[at:]])[0] + before])

        def make(texts: list[str]) -> list[pa.Array]:
            found = plain(texts)
            if special:
                found = [with_special(x) if special.search(x) else c for x, c in zip(texts, found, strict=True)]
            ends = np.cumsum([0, *map(len, found)])
            values = np.concatenate([*found, np.zeros(0, dtype="<i4")]).astype("<i4")
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))]

        return make

    return map_texts(docs, carried, text, "prefix_counts array<int>", start)


def tokens_of_prefix(counts: str, characters: Column | int) -> Column:
    """Tokens of the first ``characters`` characters, the whole text at most."""
    size = F.size(counts)
    at = F.least(F.lit(characters) if isinstance(characters, int) else characters, size)
    return F.when(at < 1, 0).otherwise(F.get(counts, at - 1))


def total_tokens(counts: str) -> Column:
    return F.coalesce(F.get(counts, F.size(counts) - 1), F.lit(0))


def longest_prefix(counts: str, budget: int) -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    fitting = F.transform(counts, lambda count, at: F.when(count <= budget, at + 1).otherwise(0))
    return F.coalesce(F.array_max(fitting), F.lit(0))
