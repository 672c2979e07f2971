"""Byte-level BPE with the tokenizers library over Arrow batches.

A ranks file lists byte strings in merge order. Each byte becomes one printable
character, so the library can hold the vocabulary; every way to put a token
together from two others becomes a merge of that token's rank. New units of text
are encoded many to a line. Decoding looks each id's bytes up and joins them, so a
character that was split over several tokens comes back whole.
"""

from __future__ import annotations

import base64
import os
import re
import struct
from functools import cache
from itertools import chain, compress
from operator import not_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from stratakeep.llm.batches import SLICE_ROWS, map_texts
from stratakeep.llm.units import CACHE_CHARS, CACHE_UNITS, UnitCache, cut

# Units that one line holds at most, and what they look like.
LINE_UNITS = 1024
_IN_LINE = re.compile(r" \S(?:.*\S)?", re.DOTALL)

FIELDS = "ids array<int>, starts array<int>, ends array<int>, round_trip boolean"
DECODED = "decoded binary"


@cache
def byte_characters() -> list[str]:
    """The character that stands for each byte.

    Printable bytes stand for themselves; the others take the code points from
    256 on, in order.
    """
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(byte if byte in printable else next(others)) for byte in range(256)]


@cache
def read_ranks(path: str) -> dict[bytes, int]:
    """Rank of each byte string of a ranks file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _merges(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """All pairs that make a token, in the order of the token they make."""
    return [
        (token[:at], token[at:])
        for token in sorted(ranks, key=ranks.__getitem__)
        for at in range(len(token) - 1, 0, -1)
        if token[:at] in ranks and token[at:] in ranks
    ]


@cache
def tokenizer(path: str, pattern: str) -> Tokenizer:
    """A tokenizer without special tokens, made once per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    ranks = read_ranks(path)
    as_text = byte_characters()
    written = {token: "".join(as_text[byte] for byte in token) for token in ranks}
    vocabulary = {written[token]: rank for token, rank in ranks.items()}
    merges = [(written[a], written[b]) for a, b in _merges(ranks)]
    made = Tokenizer(models.BPE(vocab=vocabulary, merges=merges))
    made.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return made


class UnitEncoder:
    """Ids of units, 32 bits each, as the library gives them for each alone."""

    def __init__(self, path: str, pattern: str) -> None:
        self._library = tokenizer(path, pattern)
        ranks = read_ranks(path)
        self.widths = np.zeros(max(ranks.values()) + 1, dtype=np.int32)
        for token, rank in ranks.items():
            self.widths[rank] = len(token)

    def _each(self, units: list[str]) -> list[bytes]:
        found = self._library.encode_batch_fast(units, add_special_tokens=False)
        return [struct.pack(f"<{len(ids)}i", *ids) for ids in (one.ids for one in found)]

    def _line(self, units: list[str]) -> list[bytes]:
        """As ``_each`` for units that begin with a single space and do not end
        with white space: one line holds them all, and its ids are dealt out
        again by the bytes they stand for. If these are not the line's, or a unit
        does not end where a token does, each goes alone."""
        ids = np.array(self._library.encode_batch_fast(["".join(units)], add_special_tokens=False)[0].ids, dtype="<i4")
        ends = np.cumsum([len(unit.encode()) for unit in units])
        at = np.cumsum(self.widths[ids])
        if not len(at) or at[-1] != ends[-1]:
            return self._each(units)
        place = np.searchsorted(at, ends)
        if (at[place] != ends).any():
            return self._each(units)
        raw, stops = ids.tobytes(), ((place + 1) * ids.itemsize).tolist()
        return [raw[i:j] for i, j in zip([0, *stops], stops, strict=False)]

    def units(self, units: list[str]) -> list[bytes]:
        lined = [len(unit) <= CACHE_CHARS and _IN_LINE.fullmatch(unit) is not None for unit in units]
        others = iter(self._each([*compress(units, map(not_, lined))]))
        plain = [*compress(units, lined)]
        lines = (self._line(plain[start : start + LINE_UNITS]) for start in range(0, len(plain), LINE_UNITS))
        in_lines = chain.from_iterable(lines)
        return [next(in_lines if inside else others) for inside in lined]


def _lists(parts: list[bytes]) -> pa.Array:
    """One list of 32-bit integers per part."""
    ends = np.cumsum([0, *map(len, parts)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), dtype="<i4")))


def _table(ranks: dict[bytes, int]) -> np.ndarray:
    """The bytes of each id."""
    table = np.empty(max(ranks.values()) + 1, dtype=object)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def encode(
    docs: DataFrame, path: str, pattern: str, carried: list[str], text: str = "text", decoded: bool = False
) -> DataFrame:
    """``carried`` columns with ``ids, starts, ends, round_trip`` of the whole text.

    ``round_trip`` tells that the bytes of the ids, joined, are those of the text;
    with ``decoded`` these bytes are a column, too, made in the same pass.
    ``starts`` and ``ends`` are offsets in characters, end exclusive; tokens
    that share a character have overlapping offsets. A null or empty text has
    empty lists and no bytes. Special strings are ordinary text. Repeated rows are
    rows like any other, an empty table gives an empty result, and a carried column
    with the name of a new one is left out.
    """

    def start():
        encoder = UnitEncoder(path, pattern)
        widths = encoder.widths

        def offsets(text: str, ids: bytes) -> tuple[bytes, bytes]:
            """Byte places of the tokens, as places of the characters they are in."""
            byte_ends = np.cumsum(widths[np.frombuffer(ids, dtype="<i4")])
            if text.isascii():
                ends = byte_ends.astype("<i4")
                return np.concatenate([ends[:0] if not len(ends) else [0], ends[:-1]]).astype("<i4").tobytes(), ends.tobytes()
            place = np.cumsum((np.frombuffer(text.encode(), dtype=np.uint8) & 0xC0) != 0x80, dtype="<i4") - 1
            firsts = np.concatenate([[0], byte_ends[:-1]])
            return place[firsts].astype("<i4").tobytes(), (place[byte_ends - 1] + 1).astype("<i4").tobytes()

        kept = UnitCache(encoder.units)

        table = _table(read_ranks(path))

        def make(texts: list[str]) -> list[pa.Array]:
            ids = [b"".join(found) for found in kept.values([cut(x) for x in texts])]
            places = [offsets(*x) for x in zip(texts, ids, strict=True)]
            back = [b"".join(table[np.frombuffer(x, dtype="<i4")].tolist()) for x in ids]
            same = pa.array([x == text.encode() for x, text in zip(back, texts, strict=True)], pa.bool_())
            made = [_lists(ids), _lists([first for first, _ in places]), _lists([last for _, last in places]), same]
            return [*made, pa.array(back, pa.binary())] if decoded else made

        return make

    return map_texts(docs, carried, text, f"{FIELDS}, {DECODED}" if decoded else FIELDS, start)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of its ids.

    Bytes are joined before anything is read as characters; ``cast("string")``
    gives the text. A null list gives no bytes; an id that the vocabulary does not have
    raises.
    """

    @F.arrow_udf("binary")
    def joined(lists: pa.Array) -> pa.Array:
        table = _table(read_ranks(path))
        out = []
        for start in range(0, len(lists), SLICE_ROWS):
            part = lists.slice(start, SLICE_ROWS)
            values = table[part.flatten().to_numpy()]
            lengths = part.value_lengths().fill_null(0).to_numpy()
            ends = np.cumsum(lengths)
            out.append(pa.array([b"".join(values[end - n : end]) for n, end in zip(lengths, ends, strict=True)], pa.binary()))
        return pa.concat_arrays(out) if out else pa.array([], pa.binary())

    return encoded.withColumn("decoded", joined(ids))
