"""Cut windows against the plain window and against brute force."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratakeep.operators.ordered import (
    find_cuts,
    join_one_per_key,
    latest_per_key,
    next_values,
    previous_values,
    running_max,
)

DAY = datetime(2024, 1, 1)
SCHEMA = "k string, at timestamp_ntz, seq long, v string, m long"


def make_rows(seed: int, n: int = 3000, hot_share: float = 0.4):
    """A third and more of all rows under one key, some under none."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < hot_share else rng.choice([None, *"abcdefghij"])
        at = DAY + timedelta(minutes=rng.randrange(n // 3))
        rows.append((key, at, i, rng.choice("xyz") if rng.random() < 0.9 else None, rng.choice([None, rng.randrange(n)])))
    return rows


def by_key(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    return {k: sorted(g, key=lambda r: (r[1], r[2])) for k, g in groups.items()}


@pytest.mark.parametrize("max_rows", [40, 500, 10_000])
def test_previous_and_next_match_brute_force(spark, max_rows):
    rows = make_rows(1)
    df = spark.createDataFrame(rows, SCHEMA)
    cuts = find_cuts(df, ["k"], ["at", "seq"], max_rows=max_rows)
    assert cuts.cut == (max_rows < 3000)
    want_before, want_after = {}, {}
    for group in by_key(rows).values():
        for i, row in enumerate(group):
            want_before[row[2]] = (group[i - 1][3], group[i - 1][4]) if i else (None, None)
            want_after[row[2]] = (group[i + 1][3], group[i + 1][4]) if i + 1 < len(group) else (None, None)
    values = {"near_v": "v", "near_m": "m"}
    before = previous_values(df, cuts, values).collect()
    after = next_values(df, cuts, values).collect()
    assert {r.seq: (r.near_v, r.near_m) for r in before} == want_before
    assert {r.seq: (r.near_v, r.near_m) for r in after} == want_after
    assert len(before) == len(after) == len(rows)


@pytest.mark.parametrize("max_rows", [40, 10_000])
def test_running_max_includes_peers(spark, max_rows):
    rows = make_rows(2)
    df = spark.createDataFrame(rows, SCHEMA)
    cuts = find_cuts(df, ["k"], ["at"], max_rows=max_rows)
    want = {}
    for group in by_key(rows).values():
        for row in group:
            seen = [r[4] for r in group if r[1] <= row[1] and r[4] is not None]
            want[row[2]] = max(seen, default=None)
    got = running_max(df, cuts, ["m"]).select("seq", "m").collect()
    assert {r.seq: r.m for r in got} == want
    assert len(got) == len(rows)


def test_pieces_of_an_oversized_key_are_near_the_target(spark):
    from stratakeep.operators.ordered import with_piece

    df = spark.range(200_000).selectExpr("case when id % 3 = 0 then 'hot' else cast(id as string) end as k", "id as at")
    cuts = find_cuts(df, ["k"], ["at"], max_rows=5_000)
    sizes = [r["count"] for r in with_piece(df, cuts).groupBy(*cuts.group).count().collect()]
    assert sum(sizes) == 200_000
    assert max(sizes) < 10_000
    assert cuts.heads.count() == 1


def test_the_number_of_pieces_has_no_cap(spark):
    """Many times more pieces than shuffle partitions, all near the target."""
    from stratakeep.operators.ordered import with_piece

    df = spark.range(300_000).selectExpr("case when id % 3 = 0 then 'hot' else cast(id as string) end as k", "id as at")
    cuts = find_cuts(df, ["k"], ["at"], max_rows=30)
    assert cuts.pieces > 2_500 > 10 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = [r["count"] for r in with_piece(df, cuts).groupBy(*cuts.group).count().collect()]
    assert sum(sizes) == 300_000 and max(sizes) <= 60


def test_rows_that_share_time_and_sequence_are_parted_by_digest(spark):
    from stratakeep.operators.ordered import with_piece

    df = spark.range(4000).selectExpr("'k' as k", "cast(null as long) as seq", "md5(cast(id as string)) as digest")
    cuts = find_cuts(df, ["k"], ["seq", "digest"], max_rows=200)
    sizes = [r["count"] for r in with_piece(df, cuts).groupBy(*cuts.group).count().collect()]
    assert len(sizes) >= 18 and max(sizes) < 400


@pytest.mark.parametrize("broadcast", [0, 1_000_000])
def test_a_key_twice_on_the_right_is_one_match(spark, monkeypatch, broadcast):
    from stratakeep.operators import ordered

    monkeypatch.setattr(ordered, "BROADCAST_PIECES", broadcast)
    df = spark.createDataFrame(make_rows(4), SCHEMA)
    right = spark.createDataFrame([("hot",), ("hot",), ("a",), ("a",)], "k string")
    cuts = find_cuts(df, ["k"], ["at", "seq"], max_rows=40)
    assert cuts.cut
    want = df.join(right, "k", "left_semi")
    assert join_one_per_key(df, right, cuts, "left_semi").select(*want.columns).exceptAll(want).count() == 0
    assert join_one_per_key(df, right, cuts, "left_semi").count() == want.count()


def test_copies_are_reported(spark):
    df = spark.range(4000).selectExpr("'k' as k", "case when id < 3000 then 7 else id end as at")
    assert find_cuts(df, ["k"], ["at"], max_rows=200).copies
    spread = spark.range(4000).selectExpr("'k' as k", "id as at")
    assert not find_cuts(spread, ["k"], ["at"], max_rows=200).copies


@pytest.mark.parametrize("max_rows", [40, 10_000])
def test_join_with_one_row_per_key(spark, max_rows):
    df = spark.createDataFrame(make_rows(4), SCHEMA)
    cuts = find_cuts(df, ["k"], ["at", "seq"], max_rows=max_rows)
    for keys in (["hot", "a", "b"], ["a", "z"]):
        right = spark.createDataFrame([(k, f"of {k}", None) for k in keys], "k string, label string, spare int")
        for how in ("left", "left_semi"):
            want = df.join(right, "k", how)
            got = join_one_per_key(df, right, cuts, how)
            assert sorted(got.columns) == sorted(want.columns)
            assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))


def test_latest_per_key_keeps_one_row_and_limits_before_the_shuffle(spark):
    rows = make_rows(3)
    df = spark.createDataFrame(rows, SCHEMA)
    latest = latest_per_key(df, ["k"], ["at", "seq"])
    want = {k: group[-1][2] for k, group in by_key(rows).items()}
    assert {r.k: r.seq for r in latest.collect()} == want
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 30), st.sampled_from("xy")), min_size=2, max_size=60),
    st.integers(1, 20),
)
def test_cut_window_equals_plain_window(spark, items, max_rows):
    df = spark.createDataFrame([(k, at, i, v) for i, (k, at, v) in enumerate(items)], "k string, at int, i int, v string")
    cut = find_cuts(df, ["k"], ["at", "i"], max_rows=max_rows)
    plain = find_cuts(df, ["k"], ["at", "i"], max_rows=1000)
    for shifted in (previous_values, next_values):
        got = shifted(df, cut, {"near": "v"}).collect()
        want = shifted(df, plain, {"near": "v"}).collect()
        assert sorted((r.i, str(r.near)) for r in got) == sorted((r.i, str(r.near)) for r in want)


def test_a_large_sample_is_sorted_in_parts(spark, monkeypatch):
    """Several tasks summarise the hot key; cuts are as good and results the same."""
    from stratakeep.operators import ordered

    sorted_parts = []
    thinned = ordered._thinned

    def watched(sample, *settings):
        kept = thinned(sample, *settings)
        hot = sample.where("k = 'hot'").count()
        sorted_parts.append((hot, kept.where("k = 'hot'").count()))
        assert "hashpartitioning(k#" in kept._jdf.queryExecution().toString() and "_part#" in kept._jdf.queryExecution().toString()
        return kept

    monkeypatch.setattr(ordered, "_thinned", watched)
    monkeypatch.setattr(ordered, "SORTED_SAMPLES", 2_000)
    df = spark.range(200_000).selectExpr("case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else cast(id as string) end as k", "id as at", "id % 11 as v")
    cuts = find_cuts(df, ["k"], ["at"], max_rows=1_000)
    (sampled, kept), = sorted_parts
    assert sampled > 3 * 2_000 and kept < sampled / 10
    sizes = [r["count"] for r in ordered.with_piece(df.where("k = 'hot'"), cuts).groupBy("_piece").count().collect()]
    assert sum(sizes) == 66_667 and 50 <= len(sizes) <= 90 and max(sizes) < 3_000
    got = previous_values(df, cuts, {"before": "v"}).where("k = 'hot'").orderBy("at").collect()
    assert [r["before"] for r in got] == [None, *[r["v"] for r in got[:-1]]]
    assert len(got) == 66_667
