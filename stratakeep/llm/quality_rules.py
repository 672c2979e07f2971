"""Quality rules whose thresholds follow each language and source.

A signal is a number of events in a document of some size, such as symbols
among words. A group's rates are kept as a quantile sketch: counts per bin,
where a bin holds whole numbers that agree in their leading six bits, so a
quantile is off by a thirty-second at most. Sketches merge by adding counts:
Spark combines them before it shuffles, and those of a language or of all
documents are sums of those of its sources.

A group's limits come from its own sketch to which its language's is added with
the weight of ``PRIOR`` documents, and to that in the same way the sketch of
all. So the fewer documents a group has, the more it follows the others,
without a switch. A limit is a rate; a document exceeds it when it has more
events than chance would give at that rate in a document of its size.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratakeep.llm.batches import map_texts
from stratakeep.llm.text_stats import NAMES, statistics
from stratakeep.sources.tables import stage

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
# Values that agree in so many leading bits share a bin.
PRECISION_BITS = 6
# Documents whose weight the sketch of the coarser group has.
PRIOR = 100
# A fence lies so many times beyond this quantile as it is from the median.
# It holds as long as less than that share of a group's documents is junk.
TAIL, REACH = 0.2, 6
# Standard deviations of a count by chance that are no reason to reject.
CHANCE = 4
GROUP = ("lang", "source")


@dataclass(frozen=True)
class Signal:
    """``count`` events in a document of ``size``, as a rate per ``scale``;
    ``both`` fences below, too."""

    name: str
    count: str
    size: str
    scale: int = 1000
    both: bool = False

    @property
    def rate(self) -> Column:
        return F.floor(F.lit(self.scale) * F.expr(self.count) / F.greatest(F.col(self.size), F.lit(1))).cast("long")

    def expected(self, limit: str) -> Column:
        return F.greatest(F.col(limit), F.lit(0)) * F.col(self.size) / self.scale

    def inside(self) -> Column:
        """Whether a row's count is within its limits, save for chance."""
        most = self.expected(f"most_{self.name}")
        within = F.expr(self.count) <= most + CHANCE * F.sqrt(F.greatest(most, F.lit(1.0)))
        if self.both:
            least = self.expected(f"least_{self.name}")
            within = within & (F.expr(self.count) >= least - CHANCE * F.sqrt(F.greatest(least, F.lit(1.0))))
        return within


# Repeated words come by the line, so a line's worth of them is one event.
SIGNALS = (
    Signal("symbols", "n_symbols", "n_words"),
    Signal("marks", "n_marks", "n_words"),
    Signal("upper", "n_upper", "word_chars"),
    Signal("dup_lines", "n_dup_lines", "n_lines"),
    Signal("repeats", "n_repeat_words * n_lines / greatest(n_words, 1)", "n_lines"),
    Signal("word_length", "word_chars", "n_words", 100, both=True),
)


def document_statistics(docs: DataFrame, carried: list[str], text: str = "text") -> DataFrame:
    """``carried`` columns with the statistics of the whole text as longs."""

    def start():
        def make(texts: list[str]) -> list[pa.Array]:
            return [pa.array(column, pa.int64()) for column in zip(*map(statistics, texts), strict=True)]

        return make

    return map_texts(docs, carried, text, ", ".join(f"{name} long" for name in NAMES), start)


def _spare_bits(value: Column) -> Column:
    return F.greatest(F.length(F.bin(value)) - PRECISION_BITS, F.lit(0))


def _bin(value: Column) -> Column:
    """The least value of the bin: all but the leading bits are cleared."""
    extra = _spare_bits(value)
    return F.call_function("shiftleft", F.call_function("shiftright", value, extra), extra)


def _bin_end(least: Column) -> Column:
    """The greatest value of the bin."""
    return least + F.call_function("shiftleft", F.lit(1).cast("long"), _spare_bits(least)) - 1


def sketches(stats: DataFrame, group: tuple[str, ...] = GROUP) -> DataFrame:
    """One row per group, signal and bin with the number of documents."""
    values = F.array(*[F.struct(F.lit(s.name).alias("signal"), _bin(s.rate).alias("bin")) for s in SIGNALS])
    return (
        stats.select(*group, F.explode(values).alias("one"))
        .groupBy(*group, "one.signal", "one.bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merged(sketch: DataFrame, group: tuple[str, ...]) -> DataFrame:
    """The sketches of a coarser group."""
    return sketch.groupBy(*group, "signal", "bin").agg(F.sum("n").alias("n"))


def blended(sketch: DataFrame) -> DataFrame:
    """Every group's sketch with those of its language and of all added.

    ``n`` becomes a weight. Per language and signal the bins are one row, whose
    length the number of bins bounds.
    """
    overall = merged(sketch, ())
    by_lang = merged(sketch, GROUP[:1])
    per_signal = F.sum("n").over(Window.partitionBy("signal"))
    shares = overall.withColumn("share", F.col("n") / per_signal).groupBy("signal").agg(
        F.collect_list(F.struct("bin", (PRIOR * F.col("share")).alias("n"))).alias("bins")
    )
    totals = by_lang.groupBy("lang", "signal").agg(F.sum("n").alias("docs"))
    added = totals.join(shares, "signal").select("lang", "signal", F.inline("bins"))
    smooth = by_lang.select("lang", "signal", "bin", F.col("n").cast("double").alias("n")).union(added)
    smooth = smooth.groupBy("lang", "signal", "bin").agg(F.sum("n").alias("n"))
    whole = F.sum("n").over(Window.partitionBy("lang", "signal").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    prior = smooth.withColumn("n", PRIOR * F.col("n") / whole).groupBy(F.col("lang").alias("_lang"), F.col("signal").alias("_signal")).agg(
        F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins")
    )
    groups = sketch.select(*GROUP, "signal").distinct()
    same = F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("signal") == F.col("_signal"))
    rows = sketch.select(*GROUP, "signal", "bin", F.col("n").cast("double").alias("n"))
    return merged(rows.union(groups.join(prior, same).select(*GROUP, "signal", F.inline("bins"))), GROUP)


def quantiles(sketch: DataFrame, group: tuple[str, ...], shares: dict[str, float]) -> DataFrame:
    """Per group and signal its weight ``docs`` and the bins of its quantiles.

    A window sees the bins of one sketch, whose number does not grow with the
    documents.
    """
    whole = Window.partitionBy(*group, "signal").orderBy("bin")
    upto = whole.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_bins = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sketch.withColumn("_upto", F.sum("n").over(upto)).withColumn("_all", F.sum("n").over(all_bins))
    # Weights are sums of fractions.
    found = [F.min(F.when(F.col("_upto") >= F.col("_all") * share * (1 - 1e-9), F.col("bin"))).alias(name) for name, share in shares.items()]
    return ranked.groupBy(*group, "signal").agg(F.max("_all").alias("docs"), *found)


def fences(sketch: DataFrame, group: tuple[str, ...] = GROUP) -> DataFrame:
    """One row per group: per signal the rates allowed."""
    wide = quantiles(sketch, group, {"low": TAIL, "middle": 0.5, "high": 1 - TAIL})
    columns = []
    for s in SIGNALS:
        mine = F.col("signal") == s.name
        most = _bin_end(F.col("high")) + REACH * (F.col("high") - F.col("middle"))
        columns.append(F.max(F.when(mine, most)).alias(f"most_{s.name}"))
        if s.both:
            columns.append(F.max(F.when(mine, F.col("low") - REACH * (F.col("middle") - F.col("low")))).alias(f"least_{s.name}"))
    return wide.groupBy(*group).agg(*columns)


def _limits() -> list[str]:
    return [name for s in SIGNALS for name in ([f"most_{s.name}", f"least_{s.name}"] if s.both else [f"most_{s.name}"])]


def thresholds(stats: DataFrame) -> DataFrame:
    """Limits per language and source; missing languages and sources are groups
    like any other."""
    return fences(blended(stage(sketches(stats), "sketches")))


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Statistics, thresholds and verdict of every row of ``docs``.

    ``base_failed``: fewer than 50 words, or over half of the words are in
    repeated three-word windows. ``kept``: not failed, and no signal is beyond
    the thresholds of its language and source by more than chance. Thresholds are learnt from all
    documents that did not fail, so a group that has none keeps none. Null
    texts count as empty; an empty table gives an empty result; rows are judged
    one by one, so repeated rows stay.
    """
    stats = document_statistics(docs, [doc_id, *GROUP], text).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT),
    )
    stats = stage(stats, "statistics")
    limits = stage(thresholds(stats.where("NOT base_failed")), "thresholds").select(
        F.col("lang").alias("_lang"), F.col("source").alias("_source"), *_limits()
    )
    inside = F.lit(True)
    for s in SIGNALS:
        inside = inside & s.inside()
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    return (
        stats.join(limits, same, "left")
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))
        .drop("_lang", "_source")
    )
