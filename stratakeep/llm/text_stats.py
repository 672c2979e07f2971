"""Statistics of a text that quality operators decide on."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np

# ASCII white space, which parts words (fixed values).
BLANKS = " \t\n\x0b\x0c\r"
# Signs that mark junk, and exclamation (fixed values).
SYMBOLS = "#*$%&|<>"
MARKS = "!?"

NAMES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_digits",
    "n_marks",
    "n_distinct_words",
    "n_short_words",
    "n_ends",
)

_UPPER = re.compile("[A-ZÀ-ÖØ-Þ]")
_DIGIT = re.compile("[0-9]")


def _repeated_words(words: list[bytes]) -> tuple[int, int]:
    """Words in three-word windows found twice or more, and distinct words."""
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(word, len(seen)) for word in words], dtype=np.int64)
    if len(ids) < 4:
        return 0, len(seen)
    pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)[1]
    _, window, count = np.unique(pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)
    again = count[window] > 1
    if not again.any():
        return 0, len(seen)
    covered = np.zeros(len(ids), dtype=bool)
    for shift in range(3):
        covered[shift : len(ids) - 2 + shift] |= again
    return int(covered.sum()), len(seen)


def statistics(text: str) -> tuple[int, ...]:
    """The values of ``NAMES``; all zero for a text without words but for
    characters counted anywhere in it."""
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    repeated, distinct = _repeated_words(words)
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        sum(n - 1 for n in Counter(lines).values()),
        repeated,
        len(lines),
        len(_UPPER.findall(text)),
        len(_DIGIT.findall(text)),
        sum(map(text.count, MARKS)),
        distinct,
        sum(len(word) < 4 for word in words),
        text.count("."),
    )
