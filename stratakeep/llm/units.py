"""Texts cut where no token of a byte-level BPE can cross.

The split pattern of these vocabularies starts a new piece at every space that
stands between two characters which are not white space. What lies between such
places is a unit: it can be encoded alone, and the same units come again
and again, so their results are kept in a bounded cache.
"""

from __future__ import annotations

import re

# Units kept per Python worker; the cache starts anew beyond that.
CACHE_UNITS = 300_000
# Longer units are not worth keeping.
CACHE_CHARS = 200

# A space without characters that are not white space on both sides.
_IRREGULAR = re.compile(r" (?:(?!\S)|(?<!\S ))")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def cut(text: str) -> list[str]:
    """Units without the single space that each but the first begins with."""
    return text.split(" ") if not _IRREGULAR.search(text) else _CUT.split(text)


class UnitCache[V]:
    """Values per unit; ``missing`` makes those of new units in one call."""

    def __init__(self, missing, size: int = CACHE_UNITS) -> None:
        self._missing, self._size = missing, size
        # First units, which have no space in front, and all others.
        self._firsts: dict[str, V] = {}
        self._others: dict[str, V] = {}

    def values(self, texts: list[list[str]]) -> list[list[V]]:
        if len(self._firsts) + len(self._others) > self._size:
            self._firsts.clear()
            self._others.clear()
        firsts, others = self._firsts, self._others
        seen: set[str] = set()
        for units in texts:
            seen.update(units[1:])
        # Unlike ``-``, this looks the units up instead of going through the cache.
        new_firsts = list({units[0] for units in texts}.difference(firsts))
        new_others = list(seen.difference(others))
        made = self._missing([*new_firsts, *[" " + unit for unit in new_others]])
        firsts.update(zip(new_firsts, made, strict=False))
        others.update(zip(new_others, made[len(new_firsts) :], strict=True))
        out = [[firsts[units[0]], *map(others.__getitem__, units[1:])] for units in texts]
        for unit in new_firsts:
            if len(unit) > CACHE_CHARS:
                del firsts[unit]
        for unit in new_others:
            if len(unit) > CACHE_CHARS:
                del others[unit]
        return out
