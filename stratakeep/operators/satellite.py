"""Satellite rows: attribute history that grows only when a digest changes.

``satellite_rows`` turns a batch into satellite form; the three ``*_delta``
functions say which of those rows are new:

* ``sequenced_delta`` compares every row with the one before it, across the
  batch and the stored history. Loading a batch at once or in pieces gives the
  same table.
* ``batch_delta`` compares every row of the batch only with the latest stored
  row of its key.
* ``event_delta`` treats rows as facts: a row is new unless the same key and
  digest are stored already, so recomputing all events adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratakeep.functions.hashing import joined_key, key_hash, row_hash
from stratakeep.operators.ordered import find_cuts, join_one_per_key, latest_per_key, previous_values

HASH_DIFF = "hash_diff"
LOADED_AT = "loaded_at"


def satellite_rows(
    batch: DataFrame,
    id_column: str,
    hash_key: str,
    record_source: str,
    loaded_at: Column,
    described_by: Sequence[str] | None = None,
    carried: Sequence[str] = (),
) -> DataFrame:
    """A batch in satellite form, before change detection.

    ``described_by`` are the columns under the digest, the id column included
    (by default every column not ``carried``). ``carried`` columns, such as an
    order column or the source file, are stored but do not count as a change.
    """
    carried = [name for name in dict.fromkeys(carried) if name in batch.columns]
    if described_by is None:
        described_by = [name for name in batch.columns if name not in carried]
    for field in batch.schema.fields:
        if field.name in described_by and isinstance(field.dataType, T.MapType):
            raise ValueError(f"map column {field.name} has no stable text form; drop it or turn it into columns")
    plain = [name for name in described_by if name != LOADED_AT]
    extra = [name for name in carried if name not in (*plain, LOADED_AT)]
    return batch.where(F.col(id_column).isNotNull()).select(
        *plain,
        *extra,
        row_hash(described_by).alias(HASH_DIFF),
        key_hash(id_column).alias(hash_key),
        loaded_at.alias(LOADED_AT),
        F.lit(record_source).alias("record_source"),
    )


def link_satellite_rows(
    batch: DataFrame,
    members: Sequence[str],
    id_column: str,
    hash_key: str,
    record_source: str,
    loaded_at: Column,
    described_by: Sequence[str] | None = None,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Satellite rows keyed by several business keys, joined as in the link."""
    keyed = batch.withColumn(id_column, joined_key(members))
    if described_by is not None and id_column not in described_by:
        described_by = [*described_by, id_column]
    return satellite_rows(keyed, id_column, hash_key, record_source, loaded_at, described_by, carried)


def _order(sequence: str | None) -> list[str]:
    return [name for name in dict.fromkeys((LOADED_AT, sequence, HASH_DIFF)) if name]


def sequenced_delta(
    new: DataFrame,
    hash_key: str,
    sequence: str | None = None,
    stored: DataFrame | None = None,
    max_rows: int | None = None,
    rows: int | None = None,
    late: bool = False,
) -> DataFrame:
    """Rows whose digest differs from the row before, stored history first.

    Rows of a batch are ordered by load time, ``sequence`` and digest, after
    the latest stored row of their key. One shuffle serves batch and stored
    rows; an oversized key is cut (see ``ordered``). A batch that repeats rows
    in bulk is collapsed on the map side first: equal neighbours never
    survive. ``rows`` is an upper bound on the rows of ``new`` if known.

    With ``late`` the batch may hold events older than stored ones, or stored
    ones again: rows are placed among the whole stored history of their key by
    ``sequence``. Stored rows are never changed, so a stored row may repeat a
    late one that now precedes it.
    """
    if late and not sequence:
        raise ValueError("late events need a sequence column")
    order = _order(sequence)
    fresh = new.withColumn("_new", F.lit(True))
    position = [sequence, "_new", LOADED_AT, HASH_DIFF] if late else ["_new", *order]
    position = list(dict.fromkeys(position))
    if stored is not None:
        before = stored if late else latest_per_key(stored, [hash_key], order)
        before = before.select(hash_key, *order).withColumn("_new", F.lit(False))
    if stored is not None and late:
        cuts = find_cuts(fresh.unionByName(before, allowMissingColumns=True), [hash_key], position, max_rows)
    else:
        cuts = find_cuts(fresh, [hash_key], position, max_rows, rows=rows)
    if cuts.copies:
        fresh = fresh.dropDuplicates([hash_key, *order])
    placed = fresh if stored is None else fresh.unionByName(before, allowMissingColumns=True)
    compared = previous_values(placed, cuts, {"_before": HASH_DIFF})
    changed = ~F.col(HASH_DIFF).eqNullSafe(F.col("_before"))
    return compared.where(F.col("_new") & changed).select(*new.columns)


def batch_delta(
    new: DataFrame,
    hash_key: str,
    sequence: str | None = None,
    stored: DataFrame | None = None,
    max_rows: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Distinct rows whose digest differs from the latest stored row of the key.

    Rows of one batch are not compared with each other. Copies are combined
    before the shuffle; rows of an oversized key meet its one stored row
    without one.
    """
    distinct = new.distinct()
    if stored is None:
        return distinct
    latest = latest_per_key(stored, [hash_key], _order(sequence)).select(hash_key, F.col(HASH_DIFF).alias("_known"))
    cuts = find_cuts(new, [hash_key], [sequence or LOADED_AT], max_rows, rows=rows)
    joined = join_one_per_key(distinct, latest, cuts, "left")
    return joined.where(~F.col(HASH_DIFF).eqNullSafe(F.col("_known"))).select(*new.columns)


def event_delta(
    new: DataFrame, hash_key: str, stored: DataFrame | None = None, carried: Sequence[str] = ()
) -> DataFrame:
    """Rows whose key and digest are not stored yet, each once.

    Copies are combined on the map side; the shuffles on whole rows and on
    (key, digest) spread an oversized key over all tasks. ``carried`` columns
    may differ between copies of an event.
    """
    distinct = new.dropDuplicates([hash_key, HASH_DIFF]) if carried else new.distinct()
    if stored is None:
        return distinct
    known = stored.select(hash_key, HASH_DIFF)
    return distinct.join(known, [hash_key, HASH_DIFF], "left_anti").select(*new.columns)


def net_events(rows: DataFrame, hash_key: str) -> DataFrame:
    """Events that count: those written and not taken back, once each.

    ``rows`` carry a ``sign``, 1 or null for an event written and -1 for one
    taken back; what counts is the sum of signs of a key and digest.
    """
    others = [name for name in rows.columns if name not in (hash_key, HASH_DIFF, "sign")]
    total = F.sum(F.coalesce("sign", F.lit(1)))
    summed = rows.groupBy(hash_key, HASH_DIFF).agg(total.alias("_net"), F.max_by(F.struct(*others), LOADED_AT).alias("_row"))
    return summed.where("_net > 0").select(hash_key, HASH_DIFF, "_row.*").select(*[c for c in rows.columns if c != "sign"])


def signed_delta(
    new: DataFrame, hash_key: str, stored: DataFrame | None, scope: DataFrame, loaded_at: Column
) -> DataFrame:
    """Rows with a ``sign`` that turn the stored events of some keys into ``new``.

    ``scope`` names the keys derived anew: their events not stored come with
    1, stored events of theirs that are not in ``new`` are taken back with -1. Events
    of other keys stay. Shuffles on (key, digest) spread an oversized key.
    """
    wanted = new.dropDuplicates([hash_key, HASH_DIFF])
    if stored is None:
        return wanted.withColumn("sign", F.lit(1))
    event = [hash_key, HASH_DIFF]
    counting = net_events(stored, hash_key).join(scope.select(hash_key).distinct(), hash_key, "left_semi")
    added = wanted.join(counting.select(*event), event, "left_anti").withColumn("sign", F.lit(1))
    gone = counting.join(wanted.select(*event), event, "left_anti").withColumn("sign", F.lit(-1))
    return added.unionByName(gone.withColumn(LOADED_AT, loaded_at).select(*added.columns))
