"""Mixing sources to target weights by Poisson replication.

A source's rate is the mean number of times each of its documents is to be
repeated. A document's count inverts the Poisson distribution at a number that
a hash of seed and id gives, so the same document always gets the same
count, whatever the cluster, and no counter or state is shared between tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratakeep.sources.tables import stage

# Sources are weighted by the square root of their size unless told otherwise.
TEMPERATURE = 0.5
# A larger rate is drawn as the sum of draws at this rate or a smaller one.
MAX_RATE = 16
# Hexadecimal digits of a hash that make a number from 0 to 1.
_DIGITS = 13


def _hashed(*parts: Column | str) -> Column:
    """A number of 52 bits from a hash of the parts; null counts as empty."""
    texts = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *texts)), 1, _DIGITS), 16, 10).cast("long")


def rates(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    temperature: float = TEMPERATURE,
    size: int | None = None,
    source: str = "source",
) -> DataFrame:
    """``source, docs, rate`` per source; a missing source is one of its own.

    ``weights`` are the sources' shares of the result (any positive scale;
    sources left out get none); without them a source weighs its number of
    documents to the power of ``temperature``. ``size`` is the wanted number of
    rows, by default that of ``docs``.
    """
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("docs"))
    if weights is None:
        weighed = counts.withColumn("weight", F.pow("docs", F.lit(float(temperature))))
    else:
        given = docs.sparkSession.createDataFrame([(name, float(x)) for name, x in weights.items()], "_source string, weight double")
        weighed = counts.join(F.broadcast(given), F.col("source").eqNullSafe(F.col("_source")), "left")
        weighed = weighed.select("source", "docs", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    weighed = stage(weighed, "source-weights")
    total = weighed.agg(F.sum("docs").alias("docs"), F.sum("weight").alias("weight")).first()
    wanted = float(size if size is not None else total["docs"] or 0)
    share = F.col("weight") / F.lit(total["weight"] or 1.0)
    return weighed.select("source", "docs", (F.lit(wanted) * share / F.col("docs")).alias("rate"))


def _distribution(rate: Column) -> Column:
    """Cumulative Poisson probabilities 0, 1, 2, ... until the rest is nil."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("upto"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(state["upto"], F.array(F.element_at(state["upto"], -1) + p)).alias("upto"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda state: state["upto"])


def mix(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    temperature: float = TEMPERATURE,
    size: int | None = None,
    seed: int = 0,
    doc_id: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """``docs`` repeated at their source's rate and shuffled globally.

    Adds ``copy`` (from 1) and ``shuffle_key``; columns of these names are
    replaced. The number of rows of a source is a random number around its
    share of ``size``; documents can come up zero times, as in any Poisson
    sample. Rows with the same id (null is an id, too) get the same count. Rows are
    dealt to partitions by the hash of a random key and sorted by it there,
    which is a random order of all rows with one shuffle and no hot partition.
    Rows without an id share a key and are dealt by their content as well.
    An empty table gives an empty result.
    """
    table = rates(docs, weights, temperature, size, source)
    parts = F.greatest(F.ceil(F.col("rate") / MAX_RATE), F.lit(1)).cast("int")
    drawn = stage(
        table.withColumn("_parts", parts)
        .withColumn("_upto", _distribution(F.col("rate") / F.col("_parts")))
        .select(F.col("source").alias("_source"), "_parts", "_upto"),
        "source-rates",
    )
    kept = [name for name in docs.columns if name not in ("copy", "shuffle_key")]
    joined = docs.select(*kept).join(drawn, F.col(source).eqNullSafe(F.col("_source")), "left")

    def draw(part: Column) -> Column:
        at = _hashed(F.lit(f"{seed}:repeat"), F.col(doc_id), part) / F.lit(float(1 << 4 * _DIGITS))
        return F.size(F.filter("_upto", lambda upto: upto <= at))

    count = F.aggregate(F.sequence(F.lit(0), F.col("_parts") - 1), F.lit(0), lambda total, part: total + draw(part))
    repeated = joined.withColumn("_count", count).where("_count > 0")
    content = F.when(F.col(doc_id).isNull(), F.xxhash64(F.to_json(F.struct(*kept))))
    return (
        repeated.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_count"))))
        .withColumn("shuffle_key", _hashed(F.lit(f"{seed}:order"), F.col(doc_id), F.col("copy")))
        .select(*kept, "copy", "shuffle_key")
        .repartition("shuffle_key", "copy", content)
        .sortWithinPartitions("shuffle_key")
    )
