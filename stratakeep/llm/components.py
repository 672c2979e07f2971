"""Connected components of an edge table by alternating large and small stars.

Each round replaces the edges of every node by edges to the smallest node it
sees; after a number of rounds that grows with the logarithm of the longest
path, every node points straight at the smallest node of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratakeep.sources.tables import stage


def _to_minimum(arrows: DataFrame) -> DataFrame:
    """Each arrow with ``low``: the least of its start and all its ends.

    The minimum is combined on the map side; the join lets adaptive execution
    split the arrows of a node that has very many.
    """
    lows = arrows.groupBy("start").agg(F.min("end").alias("_least"))
    return arrows.join(lows, "start").select("start", "end", F.least("start", "_least").alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("high").alias("start"), F.col("low").alias("end")).union(
        edges.select(F.col("low").alias("start"), F.col("high").alias("end"))
    )
    return (
        _to_minimum(both).where("end > start").select(F.col("end").alias("high"), "low").where("high != low").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.col("high").alias("start"), F.col("low").alias("end"))
    moved = _to_minimum(down)
    ends = moved.select(F.col("end").alias("high"), "low").where("high != low")
    return ends.union(moved.select(F.col("start").alias("high"), "low")).distinct()


def _signature(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("high", "low")
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(mixed), F.sum(F.shiftright(mixed, 24))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a``, ``b``).

    ``root`` is the smallest node of the component; roots themselves are
    listed too. Loops and repeated edges change nothing; an empty table gives
    an empty one. Every round is written to the shared folder, so lineage stays
    short and a lost executor costs one round at most.
    """
    current = stage(
        edges.where("a != b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(),
        "edges",
    )
    before = _signature(current)
    while True:
        current = stage(_small_star(_large_star(current)), "stars")
        now = _signature(current)
        if now == before:
            break
        before = now
    roots = current.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    return current.select(F.col("high").alias("node"), F.col("low").alias("root")).union(roots)
