from __future__ import annotations

import numpy as np
import pytest
import xxhash

from stratakeep.llm import golay, simhash
from stratakeep.llm.components import components
from tests.llm.conftest import SF_DIR


def plain_fingerprint(text: str | None) -> int:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_roots(values: list[int]) -> dict[int, int]:
    """Root of each value's component by comparing all pairs."""
    distinct = np.array(sorted(set(values)), dtype=np.uint64)
    label = np.arange(len(distinct))
    for i in range(len(distinct)):
        near = label[np.bitwise_count(distinct ^ distinct[i]) <= 4]
        label[np.isin(label, near)] = near.min()
    return dict(zip(distinct.tolist(), label.tolist(), strict=True))


def check(rows) -> None:
    root = brute_roots([row["fp"] % 2**64 for row in rows])
    least: dict[int, int] = {}
    for row in rows:
        if row["doc_id"] is not None:
            at = root[row["fp"] % 2**64]
            least[at] = min(least.get(at, row["doc_id"]), row["doc_id"])
    for row in rows:
        assert row["component_id"] == least.get(root[row["fp"] % 2**64])


def test_every_word_is_within_three_bits_of_its_codeword():
    words = np.random.default_rng(1).integers(0, 1 << 23, 5000).astype(np.int32)
    codewords = np.array([m << 11 | golay._remainder(m << 11) for m in range(1 << 12)])
    assert (np.bitwise_count(words ^ codewords[golay.decode(words)]) <= 3).all()


def test_fingerprints_within_four_bits_share_a_key_of_comparable_sides():
    rng = np.random.default_rng(2)
    left = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    right = left.copy()
    for row in range(len(left)):
        for bit in rng.choice(64, rng.integers(1, 5), replace=False):
            right[row] ^= np.uint64(1) << np.uint64(bit)
    found = [dict.fromkeys(range(len(left))) for _ in range(2)]
    for values, keys in zip((left, right), found, strict=True):
        made, rows = simhash.fuzzy_keys(values)
        for key, row in zip(made.tolist(), rows.tolist(), strict=True):
            keys[row] = (keys[row] or set()) | {key}
    two_sided = simhash._ONE_AGREES << simhash._TAG_SHIFT
    for row in range(len(left)):
        a, b = found[0][row], found[1][row]
        assert any(key in b if key >> 1 < two_sided else key ^ 1 in b for key in a)


def test_query_against_all_pairs(spark, documents):
    rows = simhash.near_duplicates(documents).collect()
    texts = {row["doc_id"]: row["text"] for row in documents.collect()}
    assert len(rows) == len(texts)
    assert all(row["fp"] % 2**64 == plain_fingerprint(texts[row["doc_id"]]) for row in rows[:200])
    check(rows)


def test_tight_group_dealt_out_in_blocks(spark, monkeypatch):
    """One centre with thousands of neighbours: every key of theirs is hot."""
    monkeypatch.setattr(simhash, "BLOCK", 128)
    monkeypatch.setattr(simhash, "LEAST_SHARE", 0.0)
    rng = np.random.default_rng(3)
    centre, values = 0x0F0F123456789ABC, set()
    bits = rng.choice(64, 16, replace=False)
    while len(values) < 3000:
        value = centre
        for bit in rng.choice(bits, rng.integers(0, 9), replace=False):
            value ^= 1 << int(bit)
        values.add(value)
    values |= {int(x) for x in rng.integers(0, 1 << 62, 500)}
    table = spark.createDataFrame([(v,) for v in values], "fp long")
    links = simhash.links(table)
    pairs = links.collect()
    assert pairs and all(bin(p["a"] ^ p["b"]).count("1") <= 4 for p in pairs)
    root = brute_roots(sorted(values))
    got = {row["node"]: row["root"] for row in components(links).collect()}
    for value in values:
        mates = [v for v in values if root[v] == root[value]]
        assert got.get(value, value) == min(mates)


@pytest.mark.parametrize("n", [1, 40])
def test_components_of_chains_and_loops(spark, n):
    edges = [(i, i + 1) for i in range(n)] + [(100, 100), (300, 200), (200, 300), (300, 250)]
    got = {row["node"]: row["root"] for row in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(n + 1), 0), 200: 200, 250: 200, 300: 200}


def test_odd_rows(spark, edge_docs, empty_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    check(rows)
    assert {row["component_id"] for row in rows if row["fp"] == 0} == {3}
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(row["doc_id"] or 0 for row in kept.collect()) == [0, 0, 1, 3, 6, 7, 8]
    assert simhash.near_duplicates(empty_docs).count() == 0 and simhash.keep_one(empty_docs).count() == 0


def test_registered_query(spark):
    from stratakeep.llm.queries import QUERIES

    found = QUERIES["op2_simhash"](spark, SF_DIR)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert all(len(row["fingerprint"]) == 16 for row in found.head(5))
