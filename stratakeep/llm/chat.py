"""Chat transcripts: speakers found by a hidden Markov model, turns rendered.

A line of a transcript is in one of six states: it begins or goes on with a
turn of one of three roles. What is seen of a line is the speaker marker it
begins with and its form. Counts over transcripts with known roles give the
model; Viterbi finds the most likely states.

A transcript may be of any length: it comes in pieces. A piece is summed up by
a table of six by six scores, best path from each state at its start to each at its
end; such tables combine like matrices, so states at the pieces' borders are
found level by level and each piece is then decoded alone, with the same result
as a decoding of the whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratakeep.llm.batches import slices
from stratakeep.operators.ordered import Cuts, find_cuts, join_one_per_key, previous_values, with_piece
from stratakeep.sources.tables import stage

ROLES = ("system", "user", "assistant")
STATES = tuple((role, begins) for role in ROLES for begins in (True, False))
# Names of speakers in transcripts and the role they most often stand for
# (fixed values); only their place in this list is a feature.
MARKERS = ("system", "instructions", "user", "human", "question", "q", "assistant", "bot", "answer", "a", "ai")
# Turns in a piece, and pieces whose borders are found in one group.
TURNS, FAN = 64, 256
# Rows that may share the turn numbers of a piece before it is split.
MOST_ROWS = 16 * TURNS
# A line that is blank by the same characters as in ``str.strip`` (fixed value).
_BLANK = "\\A[\\x09-\\x0D\\x1C-\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]*\\z"

_MARKER = re.compile(r"^(?:[#>*\[<|\s]*)(" + "|".join(MARKERS) + r")(?:[\]>|*]*\s*(?::|$)|[\]>|]+)\s*", re.IGNORECASE)


def marker(line: str) -> tuple[int, str]:
    """Number of the marker (0: none) and the line without it."""
    found = _MARKER.match(line)
    if not found:
        return 0, line
    return MARKERS.index(found[1].lower()) + 1, line[found.end() :]


def observed(lines: list[str], after_blank: bool = True) -> np.ndarray:
    """One row of features per line: marker, blank, after a blank, end, length.

    ``after_blank``: the line before the first is blank, or there is none.
    """
    out = np.zeros((len(lines), 5), dtype=np.int64)
    blank_before = int(after_blank)
    for at, line in enumerate(lines):
        found, rest = marker(line)
        blank = not rest.strip()
        out[at] = (found, blank, blank_before, 1 + "?!.".find(rest.rstrip()[-1:] or " "), min(len(rest).bit_length(), 9))
        blank_before = int(blank and not found)
    return out


# Values each feature can take.
SIZES = (len(MARKERS) + 1, 2, 2, 4, 10)


class Model:
    """Log probabilities of first states, transitions and features."""

    def __init__(self, counts: dict[tuple[str, int, int], float]) -> None:
        states = len(STATES)
        self.first = np.ones(states)
        self.steps = np.ones((states, states))
        self.features = [np.ones((states, size)) for size in SIZES]
        for (kind, a, b), n in counts.items():
            if kind == "first":
                self.first[b] += n
            elif kind == "step":
                self.steps[a, b] += n
            else:
                self.features[int(kind)][a, b] += n
        self.first = np.log(self.first / self.first.sum())
        self.steps = np.log(self.steps / self.steps.sum(axis=1, keepdims=True))
        self.features = [np.log(x / x.sum(axis=1, keepdims=True)) for x in self.features]

    def emissions(self, lines: list[str], after_blank: bool = True) -> np.ndarray:
        seen = observed(lines, after_blank)
        return sum(table[:, seen[:, i]].T for i, table in enumerate(self.features))

    def summary(self, lines: list[str], first: bool, after_blank: bool = True) -> np.ndarray:
        """Best score from the state before a piece to each at its end.

        The first piece of a transcript has no state before it: its rows
        are all the same.
        """
        scores = self.emissions(lines, after_blank)
        table = np.broadcast_to(self.first + scores[0], self.steps.shape) if first else self.steps + scores[0]
        for row in scores[1:]:
            table = combined(table, self.steps) + row
        return table

    def decode(self, lines: list[str], before: int | None, last: int | None, after_blank: bool = True) -> list[int]:
        """States of a piece by Viterbi; ``before`` and ``last`` are the states
        before it and at its end, where known."""
        scores = self.emissions(lines, after_blank)
        value = (self.first if before is None else self.steps[before]) + scores[0]
        back = []
        for row in scores[1:]:
            through = value[:, None] + self.steps
            back.append(through.argmax(axis=0))
            value = through.max(axis=0) + row
        path = [int(value.argmax()) if last is None else last]
        for best in reversed(back):
            path.append(int(best[path[-1]]))
        return path[::-1]


def combined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Best scores over two stretches, one after the other."""
    return (left[:, :, None] + right[None, :, :]).max(axis=1)


def _split(rows: DataFrame, cuts: Cuts) -> DataFrame:
    """Further pieces where more than ``MOST_ROWS`` rows have the numbers of one.

    Only transcripts with such a piece are numbered anew, in the same order;
    their turn numbers are taken to be in the range of an integer. A window
    holds no more than ``cuts`` leave together.
    """
    heavy = stage(rows.groupBy("key", "piece").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MOST_ROWS), "heavy-pieces")
    if heavy.isEmpty():
        return rows
    cut = F.coalesce(*cuts.group[len(cuts.keys) :], F.lit(0)).cast("long")
    in_piece = Window.partitionBy(*cuts.group, "piece").orderBy("turn", "lines")
    parts = with_piece(rows, cuts).withColumn("_part", F.floor((F.row_number().over(in_piece) - 1) / TURNS) + F.shiftleft(cut, 22))
    parts = parts.select(*rows.columns, "_part")
    parts = join_one_per_key(parts, heavy.select("key").distinct().withColumn("_heavy", F.lit(True)), cuts, "left")
    piece = F.when(F.col("_heavy"), F.shiftleft("piece", 38) + F.col("_part")).otherwise(F.col("piece"))
    return parts.withColumn("piece", piece).select(*rows.columns)


def pieces(turns: DataFrame, key: str, turn: str, lines: Column) -> DataFrame:
    """``key, piece, after_blank, lines``: transcripts cut into pieces of ``TURNS`` turns.

    ``lines`` makes the list of lines of a row, strings or structs with a ``line``.
    All rows stay: those with the same key and turn go by their lines,
    repeated rows one after the other. ``after_blank`` tells whether the line before
    the piece is blank; it is true at a transcript's begin. A row without key
    or turn is a transcript of its own, with piece null; a row without lines
    gives none. A group never holds more than ``MOST_ROWS`` rows.
    """
    rows = turns.select(F.col(key).alias("key"), F.col(turn).cast("long").alias("turn"), lines.alias("lines")).where(F.size("lines") > 0)
    final = F.element_at("lines", -1)
    if isinstance(rows.schema["lines"].dataType.elementType, StructType):
        final = final["line"]
    known = rows.where("key IS NOT NULL AND turn IS NOT NULL").withColumns(
        {"piece": F.floor(F.col("turn") / TURNS), "blank": F.coalesce(F.regexp_like(final, F.lit(_BLANK)), F.lit(True))}
    )
    cuts = find_cuts(known, ["key"], ["turn", "lines", "piece"], cut_on=["turn", "lines"])
    known = previous_values(_split(known, cuts), cuts, {"after_blank": "blank", "before": "piece"})
    # Of the rows of a piece only its first comes after another piece's or none.
    first = F.when(F.col("before").isNull() | (F.col("before") != F.col("piece")), F.coalesce("after_blank", F.lit(True)))
    whole = known.groupBy("key", "piece").agg(
        F.max(first).alias("after_blank"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("turn", "lines"))), lambda x: x["lines"])).alias("lines"),
    )
    single = rows.where("key IS NULL OR turn IS NULL").select("key", F.lit(None).cast("long").alias("piece"), F.lit(True).alias("after_blank"), "lines")
    return whole.union(single)


def train(labelled: DataFrame) -> Model:
    """The model of pieces whose lines are structs of ``line, state``.

    Counts are summed per task and then by Spark; there are as many sums as
    the model has entries. Without rows all states are equally likely.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int, int], int] = {}

        def add(*entry) -> None:
            held[entry] = held.get(entry, 0) + 1

        for part in slices(batches):
            for first, after_blank, lines in zip(*[part.column(i).to_pylist() for i in range(3)], strict=True):
                states = [line["state"] for line in lines]
                if first:
                    add("first", 0, states[0])
                for a, b in zip(states, states[1:], strict=False):
                    add("step", a, b)
                for state, seen in zip(states, observed([line["line"] or "" for line in lines], after_blank).tolist(), strict=True):
                    for i, value in enumerate(seen):
                        add(str(i), state, value)
        kinds, a, b = zip(*held, strict=True) if held else ((), (), ())
        columns = [pa.array(kinds, pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(held.values(), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["kind", "a", "b", "n"])

    first = F.coalesce(F.col("piece") == 0, F.lit(True))
    counted = labelled.select(first.alias("first"), "after_blank", "lines").mapInArrow(run, "kind string, a long, b long, n long")
    rows = counted.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect()
    return Model({(row["kind"], row["a"], row["b"]): float(row["n"]) for row in rows})


def _solved(tables: list[np.ndarray], before: int | None, last: int | None) -> list[int]:
    """State at the end of each stretch on the best path through all."""
    value = tables[0][0 if before is None else before]
    back = []
    for table in tables[1:]:
        through = value[:, None] + table
        back.append(through.argmax(axis=0))
        value = through.max(axis=0)
    path = [int(value.argmax()) if last is None else last]
    for best in reversed(back):
        path.append(int(best[path[-1]]))
    return path[::-1]


def _borders(tables: DataFrame) -> DataFrame:
    """``key, piece, before, last`` for ``key, piece, scores`` of transcripts
    with more than one piece; ``before`` is null for a transcript's first."""
    states = len(STATES)

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("piece")
        stretch = [np.array(x).reshape(states, states) for x in frame["scores"]]
        before, last = (None if pd.isna(frame[name].iloc[0]) else int(frame[name].iloc[0]) for name in ("before", "last"))
        ends = _solved(stretch, before, last)
        out = frame[["key", "piece"]].copy()
        out["before"] = pd.array([before, *ends[:-1]], dtype="Int64")
        out["last"] = pd.array(ends, dtype="Int64")
        return out

    def product(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("piece")
        whole = reduce(combined, [np.array(x).reshape(states, states) for x in frame["scores"]])
        return pd.DataFrame({"key": frame["key"].iloc[:1], "piece": frame["piece"].iloc[:1] // FAN, "scores": [whole.ravel().tolist()]})

    kind = tables.schema["key"].dataType.simpleString()
    group = F.floor(F.col("piece") / FAN).alias("group")
    spread = tables.agg(F.min("piece"), F.max("piece")).first()
    nothing = F.lit(None).cast("long")
    if spread[0] is None or spread[0] // FAN == spread[1] // FAN:
        known = tables.withColumns({"before": nothing, "last": nothing})
        return known.groupBy("key").applyInPandas(solve, f"key {kind}, piece long, before long, last long")
    above = tables.groupBy("key", group).applyInPandas(lambda _, x: product(x), f"key {kind}, piece long, scores array<double>")
    outer = _borders(stage(above, "chat-stretches")).withColumnRenamed("piece", "group")
    known = tables.withColumn("group", F.floor(F.col("piece") / FAN)).join(outer, ["key", "group"])
    return known.groupBy("key", "group").applyInPandas(lambda _, x: solve(x), f"key {kind}, piece long, before long, last long")


def rendered(lines: list[str], states: list[int], opened: bool, closes: bool) -> str:
    """Canonical form: each turn as ``<|role|>``, its lines and ``<|end|>``.

    ``opened``: a turn goes on from the piece before; ``closes``: no piece follows.
    The marker of a turn's first line is taken out, and that line if nothing
    else is in it; all other lines stay as they are.
    """
    out: list[str] = []
    for line, state in zip(lines, states, strict=True):
        role, begins = STATES[state]
        if begins or not opened:
            out.append(f"<|end|>\n<|{role}|>\n" if opened else f"<|{role}|>\n")
            opened = True
        text = marker(line)[1] if begins else line
        if text or not begins:
            out.append(text + "\n")
    return "".join(out) + ("<|end|>\n" if closes else "")


def parse(transcripts: DataFrame, model: Model) -> DataFrame:
    """``key, piece, lines, states, n_turns, rendered`` per piece.

    The renderings of a transcript's pieces, one after the other, are the
    rendering of the whole. A null line counts as empty; pieces without lines
    are not given; an empty table gives an empty result.
    """
    kind = transcripts.schema["key"].dataType.simpleString()
    counts = transcripts.where("piece IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("piece").alias("begin"), F.max("piece").alias("end"))
    several = stage(counts.where("n > 1"), "long-transcripts")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = zip(*[part.column(i).to_pylist() for i in range(2, 5)], strict=True)
            found = [model.summary([x or "" for x in lines], first, after_blank).ravel().tolist() for first, after_blank, lines in rows]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.list_(pa.float64()))], ["key", "piece", "scores"])

    long = transcripts.join(several, "key").select("key", "piece", (F.col("piece") == F.col("begin")).alias("first"), "after_blank", "lines")
    tables = stage(long.mapInArrow(summed, f"key {kind}, piece long, scores array<double>"), "chat-summaries")
    borders = stage(_borders(tables), "chat-borders").join(several.select("key", "end"), "key")
    borders = borders.select(F.col("key").alias("_key"), F.col("piece").alias("_piece"), "before", "last", (F.col("piece") == F.col("end")).alias("closes"))
    ready = transcripts.join(borders, (F.col("key") == F.col("_key")) & (F.col("piece") == F.col("_piece")), "left").select(
        "key", "piece", "before", "last", F.coalesce("closes", F.lit(True)).alias("closes"), "after_blank", "lines"
    )

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            states, turns, texts = [], [], []
            for before, last, closes, after_blank, lines in zip(*[part.column(i).to_pylist() for i in range(2, 7)], strict=True):
                lines = [x or "" for x in lines]
                path = model.decode(lines, before, last, after_blank)
                states.append(path)
                turns.append(sum(STATES[s][1] or (at == 0 and before is None) for at, s in enumerate(path)))
                texts.append(rendered(lines, path, before is not None, closes))
            columns = [part.column(0), part.column(1), part.column(6), pa.array(states, pa.list_(pa.int32())), pa.array(turns, pa.int64()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "piece", "lines", "states", "n_turns", "rendered"])

    return ready.mapInArrow(decoded, f"key {kind}, piece long, lines array<string>, states array<int>, n_turns long, rendered string")
