"""Previous / next value and running maximum per key, safe for oversized keys.

A window partitioned by key puts the whole history of a key into one task.
That is the right plan until one key holds a large share of the table. These
operators then cut the history of such keys into ordered pieces:

1. ``find_cuts`` looks at a sample for keys with more rows than one task
   should hold and picks cut points in their order columns, one for about
   every ``max_rows`` rows whatever the size of the table. The sample decides only
   where to cut; every row takes part in the result.
2. The window runs per (key, piece). Keys of normal size have no pieces, so
   their plan is unchanged.
3. What crosses a cut (the last value of a piece, the first of the next, the
   maximum so far) is one row per piece, combined before any shuffle, and is
   joined back: by broadcast up to ``BROADCAST_PIECES`` pieces, else by shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratakeep.sources.tables import stage

# Rows of one key that a single task sorts without trouble.
MAX_ROWS_PER_TASK = 1_000_000
# Most cut points and carried rows that are broadcast.
BROADCAST_PIECES = 1_000_000
# Sampled rows wanted per piece, so that piece sizes are near the target.
SAMPLES_PER_PIECE = 100
# Sampled rows of one key that a single task sorts, and how many of those that
# stand for a piece are kept when a key has more.
SORTED_SAMPLES = 1_000_000
KEPT_PER_PIECE = 4
# Into how many groups rows are spread that need no partner in a join.
SPREAD = 100_000

_PIECE = "_piece"
_BLOCK = "_block"
_POINTS = "_points"
_AT = "_at"


@dataclass(frozen=True)
class Cuts:
    """Where oversized keys are cut.

    The cut points of a key come in blocks of ``width``. ``heads`` holds per
    key the first point of every block but the first, ``blocks`` the points of
    each block. Both are None when no key is oversized.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    cut_on: tuple[str, ...]
    rows: int
    heads: DataFrame | None = None
    blocks: DataFrame | None = None
    width: int = 0
    pieces: int = 0
    copies: bool = False

    @property
    def cut(self) -> bool:
        return self.heads is not None

    @property
    def group(self) -> list[str]:
        """Columns that bound one task's share of rows."""
        return [*self.keys, _PIECE] if self.cut else list(self.keys)

    def small(self, table: DataFrame) -> DataFrame:
        """A table of about one row per piece, marked for broadcast if its
        size allows that; adaptive execution then splits what is skewed."""
        return F.broadcast(table) if self.pieces <= BROADCAST_PIECES else table

    def at(self) -> Column:
        return F.struct(*[F.col(name) for name in self.cut_on])

    def position(self) -> Column:
        return F.struct(*[F.col(name) for name in self.order])


def _thinned(sample: DataFrame, keys: Sequence[str], every: int, least: int, small: bool) -> DataFrame:
    """Every ``every``-th sampled row, in order, of keys with ``least`` rows or more.

    A key's rows are dealt at random into parts of at most about
    ``SORTED_SAMPLES``, and each part is sorted by a task of its own. The rows a
    part keeps are a summary of its quantiles; those of all parts together
    are one of the key, so only these are sorted in one place. Null keys are left out.
    """
    sizes = sample.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") >= least)
    sizes = F.broadcast(sizes) if small else sizes
    part = F.floor(F.rand(20) * F.ceil(F.col("_rows") / SORTED_SAMPLES))
    in_part = Window.partitionBy(*keys, "_part").orderBy(_AT)
    dealt = sample.join(sizes, list(keys)).withColumn("_part", part).withColumn("_n", F.row_number().over(in_part))
    return dealt.where(F.col("_n") % every == 0).select(*keys, _AT)


def find_cuts(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    max_rows: int | None = None,
    cut_on: Sequence[str] | None = None,
    rows: int | None = None,
) -> Cuts:
    """Choose cut points for keys with more than ``max_rows`` rows.

    ``cut_on`` are the leading order columns to cut on, by default all of
    them; leaving out a computed tie-breaker keeps its inputs out of this scan.
    ``rows`` is the number of rows of ``df`` or an upper bound on it; left out,
    the rows are counted, which is quick for a stored table.
    ``copies`` tells that so many rows share one position that cutting cannot
    part them.

    A table of at most ``max_rows`` rows needs no second look. Otherwise a
    sample of about ``SAMPLES_PER_PIECE`` rows per ``max_rows`` is taken, and
    every hundredth or so of a key's sampled rows, in order, is a cut point; a sample that is
    large itself is sorted and thinned in parts first. The points are
    written to the shared folder, since all passes over the data must see the
    same ones; the driver gets only their number.
    """
    max_rows = max_rows or MAX_ROWS_PER_TASK
    rows = df.count() if rows is None else rows
    plain = Cuts(tuple(keys), tuple(order), tuple(cut_on or order), rows)
    if rows <= max_rows:
        return plain

    fraction = min(1.0, SAMPLES_PER_PIECE / max_rows)
    step = max(1, int(max_rows * fraction))
    in_key = Window.partitionBy(*keys).orderBy(_AT)
    sample = df.select(*keys, plain.at().alias(_AT)).sample(fraction=fraction, seed=20)
    if rows * fraction > SORTED_SAMPLES:
        every = max(1, step // KEPT_PER_PIECE)
        sample = _thinned(stage(sample, "cut-sample"), keys, every, step, rows / max_rows <= BROADCAST_PIECES)
        step = max(1, step // every)
    numbered = sample.withColumn("_n", F.row_number().over(in_key))
    picked = stage(numbered.where(F.col("_n") % step == 0).drop("_n"), "cut-points")
    per_key = picked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_points"), F.count_distinct(_AT).alias("_distinct"))
    found = per_key.agg(
        F.sum("_points").alias("all"), F.max("_points").alias("most"), F.max(F.col("_points") > F.col("_distinct")).alias("copies")
    ).first()
    if not found["all"]:
        return plain
    width = math.isqrt(found["most"]) + 1
    placed = picked.distinct().withColumn(_BLOCK, F.floor((F.row_number().over(in_key) - 1) / width).cast("int"))
    blocks = placed.groupBy(*keys, _BLOCK).agg(F.array_sort(F.collect_list(_AT)).alias(_POINTS))
    blocks = stage(blocks, "cut-blocks")
    firsts = F.array_sort(F.collect_list(F.when(F.col(_BLOCK) > 0, F.col(_POINTS)[0])))
    heads = stage(blocks.groupBy(*keys).agg(firsts.alias(_POINTS)), "cut-heads")
    return replace(plain, heads=heads, blocks=blocks, width=width, pieces=found["all"], copies=found["copies"])


def _points_passed(most: int) -> Column:
    """How many of at most ``most`` sorted points lie at or below the row,
    found by halving."""
    strides = F.array(*[F.lit(1 << bit) for bit in reversed(range(most.bit_length()))])
    return F.aggregate(
        strides,
        F.lit(0),
        lambda low, stride: F.when(F.get(F.col(_POINTS), low + stride - 1) <= F.col(_AT), low + stride).otherwise(low),
    )


def with_piece(df: DataFrame, cuts: Cuts) -> DataFrame:
    """Add the piece number of each row: null for keys that are not cut.

    The piece is the number of cut points at or below the row, found first
    among the heads of the blocks and then within one block. A row meets two
    lists of about the square root of the number of pieces.
    """
    if not cuts.cut:
        return df
    keys = list(cuts.keys)
    passed = F.when(F.col(_POINTS).isNotNull(), _points_passed(cuts.width))
    return (
        df.withColumn(_AT, cuts.at())
        .join(cuts.small(cuts.heads), keys, "left")
        .withColumn(_BLOCK, passed)
        .drop(_POINTS)
        .join(cuts.small(cuts.blocks), [*keys, _BLOCK], "left")
        .withColumn(_PIECE, F.col(_BLOCK) * cuts.width + passed)
        .drop(_POINTS, _BLOCK, _AT)
    )


def _pieces(parts: DataFrame, cuts: Cuts, summary: Column) -> DataFrame:
    """One row per piece, combined on the map side."""
    return parts.where(F.col(_PIECE).isNotNull()).groupBy(*cuts.group).agg(summary.alias("_carry"))


def _join_carry(parts: DataFrame, carry: DataFrame, cuts: Cuts) -> DataFrame:
    return parts.join(cuts.small(carry), cuts.group, "left")


def _neighbour(df: DataFrame, cuts: Cuts, values: Mapping[str, str], forward: bool) -> DataFrame:
    shift = F.lead if forward else F.lag
    pick = F.min_by if forward else F.max_by
    value = F.struct(*[F.col(source).alias(name) for name, source in values.items()])
    kept = df.columns
    parts = with_piece(df, cuts)
    in_piece = Window.partitionBy(*cuts.group).orderBy(*cuts.order)
    shifted = parts.withColumn("_near", shift(value).over(in_piece))
    near = F.col("_near")
    if cuts.cut:
        over_pieces = Window.partitionBy(*cuts.keys).orderBy(_PIECE)
        edges = _pieces(parts, cuts, pick(value, cuts.position()))
        carry = edges.withColumn("_carry", shift("_carry").over(over_pieces))
        shifted = _join_carry(shifted, carry, cuts)
        near = F.coalesce(near, F.col("_carry"))
    found = [F.col("_near")[name].alias(name) for name in values]
    return shifted.withColumn("_near", near).select(*kept, *found)


def previous_values(df: DataFrame, cuts: Cuts, values: Mapping[str, str]) -> DataFrame:
    """Add ``name`` = value of column ``source`` in the row before, per key."""
    return _neighbour(df, cuts, values, forward=False)


def next_values(df: DataFrame, cuts: Cuts, values: Mapping[str, str]) -> DataFrame:
    """Add ``name`` = value of column ``source`` in the row after, per key."""
    return _neighbour(df, cuts, values, forward=True)


def running_max(df: DataFrame, cuts: Cuts, columns: Sequence[str]) -> DataFrame:
    """Replace each column by its maximum up to this row, peers included.

    Columns may be missing from any row. The piece column is left in place for
    a caller that goes on grouping by ``cuts.group``.
    """
    others = [name for name in df.columns if name not in columns]
    parts = df if _PIECE in df.columns else with_piece(df, cuts)
    in_piece = (
        Window.partitionBy(*cuts.group)
        .orderBy(*cuts.order)
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    if not cuts.cut:
        return parts.select(*others, *[F.max(name).over(in_piece).alias(name) for name in columns])
    within = parts.select(
        *dict.fromkeys([*others, _PIECE]), *[F.max(name).over(in_piece).alias(name) for name in columns]
    )
    before = Window.partitionBy(*cuts.keys).orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        parts.where(F.col(_PIECE).isNotNull())
        .groupBy(*cuts.group)
        .agg(*[F.max(name).alias(f"_carry_{name}") for name in columns])
        .select(*cuts.group, *[F.max(f"_carry_{name}").over(before).alias(f"_carry_{name}") for name in columns])
    )
    joined = _join_carry(within, carry, cuts)
    return joined.select(
        *dict.fromkeys([*others, _PIECE]), *[F.greatest(name, f"_carry_{name}").alias(name) for name in columns]
    )


def join_one_per_key(left: DataFrame, right: DataFrame, cuts: Cuts, how: str) -> DataFrame:
    """Join on ``cuts.keys``, of which ``right`` holds at most one row each.

    ``cuts`` were found for the rows of ``left``; ``how`` is left or left_semi.
    The right side has one row for each oversized key, so these rows are as few
    as the keys and are broadcast. Left rows that found theirs, or that have a
    null key, are spread evenly over the shuffle of the remaining join, which
    they cannot match. Adaptive execution alone would split only a join whose
    two sides are both read straight from a shuffle.
    """
    keys = list(cuts.keys)
    if not cuts.cut:
        return left.join(right, keys, how)
    if how == "left_semi":
        right = right.select(*keys).distinct()
    added = [name for name in right.columns if name not in keys] if how == "left" else []
    value = F.struct(*[F.col(name) for name in added], F.lit(True).alias("_hit"))
    rows = right.select(*keys, value.alias("_found"), F.lit(0).alias("_spread"))
    oversized = cuts.heads.select(*keys, F.lit(True).alias("_oversized"))
    present = rows.join(cuts.small(oversized), keys, "left_semi").select(*keys, F.col("_found").alias("_few"))
    few = oversized.join(cuts.small(present), keys, "left")
    settled = F.col("_oversized").isNotNull()
    for key in keys:
        settled = settled | F.col(key).isNull()
    anywhere = F.pmod(F.hash(*left.columns), F.lit(SPREAD)) + 1
    found = F.coalesce("_few", "_found")
    joined = (
        left.join(cuts.small(few), keys, "left")
        .withColumn("_spread", F.when(settled, anywhere).otherwise(0))
        .join(rows, [*keys, "_spread"], "left")
    )
    if how == "left_semi":
        return joined.where(found.isNotNull()).select(*left.columns)
    return joined.select(*left.columns, *[found[name].alias(name) for name in added])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``.

    Spark keeps only the best row per key on the map side before it shuffles
    (window group limit), so an oversized key needs no cutting here.
    """
    last_first = Window.partitionBy(*keys).orderBy(*[F.col(name).desc() for name in order])
    return df.withColumn("_rank", F.row_number().over(last_first)).where("_rank = 1").drop("_rank")
