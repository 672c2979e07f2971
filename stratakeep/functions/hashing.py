"""Hash keys and change digests as built-in column expressions.

Everything stays inside whole-stage code generation: no UDF is involved.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stored hashes depend on them.
SEPARATOR = "|"
NULL_TEXT = " "


def key_hash(column: str | Column) -> Column:
    """Lower-case hex MD5 of a business key; a null key stays null."""
    col = F.col(column) if isinstance(column, str) else column
    return F.md5(col.cast("string"))


def joined_key(columns: Iterable[str]) -> Column:
    """Raw member keys joined in the order given; null if any member is null."""
    parts: list[Column] = []
    for name in columns:
        if parts:
            parts.append(F.lit(SEPARATOR))
        parts.append(F.col(name).cast("string"))
    return F.concat(*parts)


def joined_hash(columns: Iterable[str]) -> Column:
    """Hash key of a relation between several business keys."""
    return F.md5(joined_key(columns))


def row_hash(columns: Iterable[str]) -> Column:
    """Change digest over the columns in alphabetical order of their names.

    A null counts as one space, so a null and a single space give the same
    digest; stored digests depend on this, so it is kept.
    """
    parts = [F.coalesce(F.col(name).cast("string"), F.lit(NULL_TEXT)) for name in sorted(columns)]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
