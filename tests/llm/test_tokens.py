from __future__ import annotations

import base64
import hashlib
import random
import re
import sys

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratakeep.llm import byte_bpe, token_counts
from stratakeep.llm.queries import ENGLISH_BPE, MULTI_RANKS, QUERIES
from stratakeep.llm.units import cut
from tests.llm.conftest import SF_DIR

PARTS = ["a", "aa", " ", "  ", "\n", " \n", "\t", "-", "--", "'", "'s", "'re", "'ll", "1", "22", "é", "ê", "中", "文",
         "🙂", "the", " the", "ing", " ", "　", "\x1c", "\x85", "word", "<|endoftext|>", "!", "ab", "ba"]


@pytest.fixture(scope="module")
def odd_texts() -> list[str]:
    rng = random.Random(5)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(1500)] + [c * 150 for c in "a -=\n0é中"]


@pytest.fixture(scope="module")
def library() -> tiktoken.Encoding:
    ranks = byte_bpe.read_ranks(MULTI_RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_offsets_and_round_trip(spark, odd_texts, library):
    table = spark.createDataFrame(list(enumerate(odd_texts)), "doc_id long, text string")
    encoded = byte_bpe.encode(table, MULTI_RANKS, public_tokenizers.PATTERN, ["doc_id", "text"], decoded=True)
    at_once = encoded.withColumnRenamed("decoded", "at_once")
    for row in byte_bpe.decode(at_once, MULTI_RANKS).collect():
        text = row["text"]
        assert row["round_trip"] and row["at_once"] == row["decoded"]
        assert row["ids"] == library.encode_ordinary(text)
        assert bytes(row["decoded"]) == text.encode()
        places = [len(text.encode()[:0])]
        for piece in library.decode_tokens_bytes(row["ids"]):
            places.append(places[-1] + len(piece))
        at = [i for i, c in enumerate(text) for _ in c.encode()]
        assert row["starts"] == [at[p] for p in places[:-1]]
        assert row["ends"] == [at[p - 1] + 1 for p in places[1:]]


def test_texts_are_cut_at_single_spaces(odd_texts):
    for text in [*odd_texts, "", " ", "a b", " a b", "a b ", "a  b c", "a b\n", "a \n", "a\u3000 b"]:
        assert cut(text) == re.split(r"(?<=\S) (?=\S)", text)


def _made(monkeypatch, path: str, texts: list[str]) -> tuple[list[list], list[str]]:
    """The new columns of texts, and what was given to the library."""
    given = []

    class Counted:
        def encode_batch_fast(self, texts, **how):
            given.extend(texts)
            return library.encode_batch_fast(texts, **how)

    library = byte_bpe.tokenizer(path, public_tokenizers.PATTERN)
    with monkeypatch.context() as patch:
        patch.setattr(byte_bpe, "tokenizer", lambda *_: Counted())
        patch.setattr(byte_bpe, "map_texts", lambda docs, carried, text, fields, start: start())
        make = byte_bpe.encode(None, path, public_tokenizers.PATTERN, [], decoded=True)
        return [column.to_pylist() for column in make(texts)], given


def test_new_units_are_encoded_together(monkeypatch, odd_texts, library):
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdeé中.,#'\n", k=9)).strip() for _ in range(6000)]
    texts = [" ".join(words[i : i + 60]) for i in range(0, 6000, 60)]
    long = " ".join(["x" * 500, "é" * 201, "中" * 200, "x" * 500])
    (ids, *_, back), given = _made(monkeypatch, MULTI_RANKS, texts)
    assert ids == [library.encode_ordinary(text) for text in texts]
    assert back == [text.encode() for text in texts]
    # A first word of a text goes alone, the others many to a line.
    assert len(given) < 200
    # Units that are long or have white space at an end do not share a line.
    (ids, *_), _ = _made(monkeypatch, MULTI_RANKS, [*odd_texts, *texts, long, "a b\n", " a b", "a b ", "c\n\n d"])
    for text, found in zip([*odd_texts, *texts, long, "a b\n", " a b", "a b ", "c\n\n d"], ids, strict=True):
        assert found == library.encode_ordinary(text)


def test_bytes_without_a_token_are_left_out(monkeypatch, tmp_path):
    ranks = [b"a", b"b", b" ", b"ab", b" a"]
    path = tmp_path / "few.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(x) + b" %d\n" % i for i, x in enumerate(ranks)))
    (ids, _, _, same, back), _ = _made(monkeypatch, str(path), ["a ab cab c b", "a b ab", "c c", ""])
    one = byte_bpe.tokenizer(str(path), public_tokenizers.PATTERN)
    assert ids == [one.encode(text).ids for text in ["a ab cab c b", "a b ab", "c c", ""]]
    assert back == [b"a ab ab  b", b"a b ab", b" ", b""] and same == [False, True, False, True]


def test_prefix_counts_against_encoding_every_prefix(spark, odd_texts):
    library = Tokenizer.from_file(ENGLISH_BPE)
    table = spark.createDataFrame(list(enumerate(odd_texts[:300])), "doc_id long, text string")
    counted = token_counts.prefix_counts(table, ENGLISH_BPE, ["text"]).select(
        "*",
        token_counts.total_tokens("prefix_counts").alias("total"),
        token_counts.tokens_of_prefix("prefix_counts", 7).alias("seven"),
        token_counts.longest_prefix("prefix_counts", 5).alias("fits"),
    )
    for row in counted.collect():
        text = row["text"]
        want = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(1, len(text) + 1)]
        assert row["prefix_counts"] == want
        assert row["total"] == (want[-1] if want else 0)
        assert row["seven"] == (want[min(7, len(want)) - 1] if want else 0)
        assert row["fits"] == max([i + 1 for i, n in enumerate(want) if n <= 5], default=0)


def test_queries_against_the_libraries(spark, documents, library):
    texts = {row["doc_id"]: row["text"] for row in documents.collect()}
    for row in QUERIES["op3_byte_bpe"](spark, SF_DIR).collect():
        ids = library.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
    other = Tokenizer.from_file(ENGLISH_BPE)
    for row in QUERIES["op5_token_counts"](spark, SF_DIR).collect():
        text = texts[row["doc_id"]]
        n = len(other.encode(text, add_special_tokens=False).ids)
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len(text.encode()), n, n > 512)


def test_odd_rows(edge_docs, empty_docs, library):
    encoded = byte_bpe.encode(edge_docs, MULTI_RANKS, public_tokenizers.PATTERN, edge_docs.columns)
    rows = byte_bpe.decode(encoded, MULTI_RANKS).collect()
    assert len(rows) == edge_docs.count()
    for row in rows:
        assert row["ids"] == library.encode_ordinary(row["text"] or "")
        assert bytes(row["decoded"]) == (row["text"] or "").encode()
    counted = token_counts.prefix_counts(edge_docs, ENGLISH_BPE, ["doc_id", "text"])
    assert all(len(row["prefix_counts"]) == len(row["text"] or "") for row in counted.collect())
    assert byte_bpe.encode(empty_docs, MULTI_RANKS, public_tokenizers.PATTERN, ["doc_id"]).count() == 0
    assert token_counts.prefix_counts(empty_docs, ENGLISH_BPE, ["doc_id"]).count() == 0


def test_null_ids_decode_to_nothing(spark):
    table = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [bytes(r["decoded"]) for r in byte_bpe.decode(table, MULTI_RANKS).collect()] == [b"", b""]
    assert table.select(token_counts.total_tokens("ids").alias("n")).agg(F.sum("n")).first()[0] == 0


def test_new_pieces_are_counted_together(monkeypatch):
    library = Tokenizer.from_file(ENGLISH_BPE)
    rng = random.Random(11)
    syllables = ["th", "er", "ent", "ion", "é", "ü", "ing", "ß", "a", "the", "STR", "12", "!!", "##", "\n"]
    units = ["".join(rng.choices(syllables, k=rng.randint(1, 14))).strip("\n") for _ in range(400)]
    units = list(dict.fromkeys([unit for text in units if text for unit in (text, " " + text)]))
    units += ["x", "é" * 40, "ab" * 60, "  odd", "中", "", "a\n\nb"]
    monkeypatch.setattr(token_counts, "BULK_PIECES", 100)
    counting = token_counts.PrefixCounter(ENGLISH_BPE)
    # Neither pieces seen before nor a cache that starts anew change a count.
    found = counting.units(units[:300]) + counting.units(units[300:])
    monkeypatch.setattr(token_counts, "CACHE_UNITS", 10)
    assert counting.units(units) == found
    for unit, steps in zip(units, found, strict=True):
        want = [len(library.encode(unit[:i], add_special_tokens=False).ids) for i in range(1, len(unit) + 1)]
        assert np.cumsum(np.frombuffer(steps, dtype="<i4")).tolist() == want
    # Once their pairs of tokens are known, pieces take no call per byte.
    pieces = sorted({"".join(rng.choices("abcdeirnst", k=9)).encode() for _ in range(2000)})
    once = counting.pieces(pieces)
    calls = []
    sys.setprofile(lambda frame, event, what: calls.append(event))
    try:
        assert counting.pieces(pieces) == once
    finally:
        sys.setprofile(None)
    assert len(calls) < sum(map(len, pieces)) / 2


def test_a_byte_without_a_token_is_an_error():
    counting = token_counts.PrefixCounter(ENGLISH_BPE)
    counting._endings = token_counts.Endings({b"a": 64, b"b": 65})
    with pytest.raises(ValueError, match="ends at byte 2"):
        counting.pieces([b"acb"])
