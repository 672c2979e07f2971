from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratakeep.llm import chat
from stratakeep.llm.queries import QUERIES, transcripts
from stratakeep.operators import ordered
from tests.llm.conftest import SF_DIR


def test_roles_of_held_out_conversations(spark):
    truth = transcripts(spark.read.parquet(f"{SF_DIR}/conversations.parquet")).collect()
    want = {(row["key"], row["piece"]): [line["state"] for line in row["lines"]] for row in truth}
    right = lines = 0
    rows = QUERIES["op4_chat"](spark, SF_DIR).collect()
    assert len(rows) == len(want)
    for row in rows:
        states = want[row["conv_id"], row["piece"]]
        roles = row["roles"].split(",")
        assert len(roles) == len(states) == row["n_lines"]
        assert row["rendered"].count("<|end|>") == row["n_turns"]
        if row["held_out"]:
            lines += len(states)
            right += sum(chat.STATES[s][0] == r for s, r in zip(states, roles, strict=True))
    assert lines > 100 and right / lines > 0.95


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(7)
    counts = {("first", 0, b): float(rng.integers(1, 50)) for b in range(6)}
    counts |= {("step", a, b): float(rng.integers(1, 50)) for a in range(6) for b in range(6)}
    counts |= {(str(i), a, b): float(rng.integers(1, 50)) for i, n in enumerate(chat.SIZES) for a in range(6) for b in range(n)}
    model = chat.Model(counts)
    lines = ["User: hi?", "more", "", "ok.", "Assistant:"]
    scores = model.emissions(lines)

    def of(path) -> float:
        return model.first[path[0]] + sum(model.steps[a, b] for a, b in zip(path, path[1:], strict=False)) + sum(scores[i, s] for i, s in enumerate(path))

    best = max(np.ndindex(*[6] * len(lines)), key=of)
    assert model.decode(lines, None, None) == list(best)
    assert abs(model.summary(lines, True)[0].max() - of(best)) < 1e-9
    halves = chat.combined(model.summary(lines[:2], True), model.summary(lines[2:], False))
    # The second half does not see that its first line comes after no blank line.
    assert halves.shape == (6, 6)


def test_a_transcript_in_many_pieces_is_decoded_as_a_whole(spark):
    """More pieces than one group takes, so borders are found on two levels."""
    n = chat.TURNS * (chat.FAN + 10)
    rng = np.random.default_rng(8)
    texts = rng.choice(["User: hello there?", "Bot: fine.", "and more", "Q: why", "x", "Answer: so", "", " \u2003"], n)
    turns = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts.tolist())] + [(2, 0, "System: be kind"), (2, 1, "hello")], "c long, t long, text string")
    found = chat.pieces(turns, "c", "t", F.array("text"))
    marked = found.withColumn("lines", F.transform("lines", lambda x: F.struct(x.alias("line"), F.when(x.like("%:%"), 2).otherwise(3).cast("long").alias("state"))))
    model = chat.train(marked)
    parsed = chat.parse(found, model).where("key = 1").orderBy("piece").collect()
    got = [s for row in parsed for s in row["states"]]
    scores = model.emissions(texts.tolist())
    value, back = model.first + scores[0], []
    for row in scores[1:]:
        through = value[:, None] + model.steps
        back.append(through.argmax(axis=0))
        value = through.max(axis=0) + row
    path = [int(value.argmax())]
    for best in reversed(back):
        path.append(int(best[path[-1]]))
    assert got == path[::-1]
    whole = "".join(row["rendered"] for row in parsed)
    assert whole == chat.rendered(texts.tolist(), got, False, True)
    assert sum(row["n_turns"] for row in parsed) == whole.count("<|end|>")


@pytest.mark.parametrize("cut", [False, True])
def test_repeated_turns_stay_and_large_ties_are_split(spark, monkeypatch, cut):
    monkeypatch.setattr(chat, "MOST_ROWS", 100)
    if cut:
        monkeypatch.setattr(ordered, "MAX_ROWS_PER_TASK", 150)
    rows = [(1, 5, f"line {i % 400:03}" if i % 400 else "") for i in range(1200)] + [(1, 6, "last"), (1, -1, ""), (2, 0, "x"), (2, 0, "x"), (2, 64, "y")]
    found = chat.pieces(spark.createDataFrame(rows, "c long, t long, text string"), "c", "t", F.array("text")).collect()
    assert max(len(row["lines"]) for row in found) <= 100
    for key in (1, 2):
        mine = sorted((row for row in found if row["key"] == key), key=lambda row: row["piece"])
        lines = [x for row in mine for x in row["lines"]]
        assert lines == [text for c, _, text in sorted(rows) if c == key]
        at = 0
        for row in mine:
            assert row["after_blank"] == (at == 0 or not lines[at - 1])
            at += len(row["lines"])
    assert sorted(row["piece"] for row in found if row["key"] == 2) == [0, 1]


def test_rendering():
    assert chat.rendered(["User: hi", "there", "", "[assistant]", "yes"], [2, 3, 3, 4, 5], False, True) == (
        "<|user|>\nhi\nthere\n\n<|end|>\n<|assistant|>\nyes\n<|end|>\n"
    )


def test_odd_rows(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "b"), (1, None, "user", "c"), (None, 0, None, None), (2, 3, "robot", ""), (3, -70, "system", "x\n" * 2000)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("lines", F.lit(1))
    found = transcripts(table)
    assert sorted((r["key"] or 0, -9 if r["piece"] is None else r["piece"]) for r in found.collect()) == [(0, -9), (1, -9), (1, 0), (2, 0), (3, -2)]
    model = chat.train(found)
    parsed = chat.parse(found.withColumn("lines", F.transform("lines", lambda x: x["line"])), model).collect()
    assert len(parsed) == 5
    empty = transcripts(table.limit(0))
    assert chat.parse(empty.withColumn("lines", F.transform("lines", lambda x: x["line"])), chat.train(empty)).count() == 0
