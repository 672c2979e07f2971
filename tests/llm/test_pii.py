from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from stratakeep.llm import pii
from stratakeep.llm.queries import QUERIES
from tests.llm.conftest import SF_DIR

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PARTS = ["a", "b@c", "@", ".", "x.y", "%d@e.f", "1", "22", "255", "256", "4111111111111111", "4111 1111 1111 1111", "-", " ",
         " +1 (706) 555-3138", "+", "(", ")", "é", "🙂", "\n", "007", "0", "a@b.co", "1.2.3.4",
         "GB82 WEST 1234 5698 7654 32", "078-05-1120", "call 706 555 3138"]


def luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


def base(text: str) -> list[tuple[int, int, str]]:
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in match[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((match.start(), rank, f"{kind}:{match.start()}:{match.end()}"))
    return sorted(out)


@pytest.fixture(scope="module")
def texts() -> list[str | None]:
    rng = random.Random(3)
    made = ["".join(rng.choices(PARTS, k=rng.randint(0, 30))) for _ in range(1500)]
    long = ["1 " * 20_000, "a" * 100_000, "1." * 20_000, "a@b.c " * 3_000, "+1" * 5_000, "a@" * 20_000]
    return [*made, *long, None, ""]


def test_base_spans_against_plain_matching(spark, texts):
    table = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(8)
    for row in pii.find(table).select("text", pii.written(pii.base_only()).alias("found")).collect():
        assert row["found"] == ",".join(x[2] for x in base(row["text"] or ""))


def test_checksums_and_context(spark):
    rows = {
        "pay to GB82 WEST 1234 5698 7654 32 now": "iban:7:34",
        "pay to GB83 WEST 1234 5698 7654 32 now": "",
        "number 078-05-1120": "",
        "my SSN: 078-05-1120": "ssn:8:19",
        "area 706-555-3138": "",
        "call me at 706-555-3138": "local_phone:11:23",
        "tel +1 (706) 555-3138": "phone:4:21",
    }
    table = spark.createDataFrame([(x,) for x in rows], "text string")
    found = {row["text"]: row["found"] for row in pii.find(table).select("text", pii.written(F.col("spans")).alias("found")).collect()}
    assert found == rows


def test_query_against_plain_matching(spark, documents):
    texts = {row["doc_id"]: row["text"] for row in documents.collect()}
    some = 0
    for row in QUERIES["op7_pii"](spark, SF_DIR).collect():
        want = base(texts[row["doc_id"]])
        some += len(want)
        assert [row[f"n_{kind}"] for kind in pii.BASE] == [sum(x[1] == rank for x in want) for rank in range(4)]
        assert row["base_sha256"] == hashlib.sha256(",".join(x[2] for x in want).encode()).hexdigest()
        assert set(filter(None, row["spans"].split(","))) >= {x[2] for x in want}
    assert some


def test_redaction(spark):
    table = spark.createDataFrame([("🙂 me@example.org or +44 20 7946 0958.", 5, "x"), (None, None, "y"), ("none", 4, "z")], "text string, n_chars int, spans string")
    rows = pii.redact(table).collect()
    assert [tuple(r) for r in rows] == [("🙂 <EMAIL> or <PHONE>.", 21, "x"), (None, None, "y"), ("none", 4, "z")]


def test_odd_rows(edge_docs, empty_docs):
    found = pii.find(edge_docs)
    assert found.count() == edge_docs.count() and sorted(found.columns) == sorted(edge_docs.columns)
    clean = pii.redact(edge_docs)
    assert clean.columns == edge_docs.columns and clean.dtypes == edge_docs.dtypes
    assert "no id, mail <EMAIL>" in [row["text"] for row in clean.collect()]
    assert pii.redact(empty_docs).count() == 0


def test_no_python_in_the_plan(edge_docs):
    plan = pii.redact(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
