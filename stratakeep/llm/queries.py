"""Registered queries of the training-data operators, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from stratakeep.llm import alignment, byte_bpe, chat, collisions, language_id, lattice_lm, mixing, pii, quality_classifier, quality_rules, ranked_search, simhash, token_counts
from stratakeep.llm.oracle import ORACLE
from stratakeep.llm.batches import remainder
from stratakeep.llm.text_stats import NAMES
from stratakeep.sources.tables import stage

# Vocabulary files, installed on every machine.
MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ENGLISH_BPE = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 512
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of all documents and whether the quality rules keep them."""
    found = quality_rules.judged(_table(spark, sf_dir, "documents"))
    limits = [name for name in found.columns if name.startswith(("most_", "least_"))]
    return found.select("doc_id", *NAMES, *limits, "base_failed", "kept")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_text().alias("fingerprint"), "component_id")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, their offsets and what they decode to, as digests."""
    docs = _table(spark, sf_dir, "documents")
    encoded = byte_bpe.encode(docs, MULTI_RANKS, public_tokenizers.PATTERN, ["doc_id"], decoded=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.xxhash64("starts", "ends").alias("offsets_hash"),
        "round_trip",
    )


def _written(role: Column, text: Column, style: Column) -> Column:
    """The lines of a turn in one of four styles of transcripts: a name and a
    colon, a heading, a name in brackets on its own line, a blank line only."""
    capital = F.initcap(role)
    head = (
        F.when(style == 0, F.concat(capital, F.lit(": ")))
        .when(style == 1, F.concat(F.lit("### "), F.when(role == "user", "Human").otherwise(capital), F.lit(":\n")))
        .when(style == 2, F.concat(F.lit("["), role, F.lit("]\n")))
        .otherwise("\n")
    )
    return F.split(F.concat(head, text), "\n", -1)


def transcripts(conversations: DataFrame) -> DataFrame:
    """Pieces of ``conversations`` as people write them down, with ``state``,
    the true state of each line; a null role is a user's, a null text empty."""
    role = F.when(F.col("role").isin(*chat.ROLES), F.col("role")).otherwise("user")
    style = F.pmod(F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")), F.lit(4))
    first = F.element_at(F.create_map(*[F.lit(x) for i, r in enumerate(chat.ROLES) for x in (r, 2 * i)]), role)
    lines = F.transform(
        _written(role, F.coalesce("text", F.lit("")), style),
        lambda line, at: F.struct(line.alias("line"), (first + (at > 0).cast("int")).cast("long").alias("state")),
    )
    return chat.pieces(conversations, "conv_id", "turn", lines)


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles and canonical turns recovered from all conversations, written down
    as transcripts; the model learns from four fifths of them."""
    known = stage(transcripts(_table(spark, sf_dir, "conversations")), "transcripts")
    held_out = F.coalesce(remainder(F.col("key"), 5) == 0, F.lit(False))
    model = chat.train(known.where(~held_out))
    parsed = chat.parse(known.select("key", "piece", "after_blank", F.transform("lines", lambda x: x["line"]).alias("lines")), model)
    roles = F.transform("states", lambda s: F.element_at(F.array(*[F.lit(r) for r, _ in chat.STATES]), s + 1))
    return parsed.select(
        F.col("key").alias("conv_id"),
        "piece",
        F.coalesce(remainder(F.col("key"), 5) == 0, F.lit(False)).alias("held_out"),
        F.size("lines").cast("long").alias("n_lines"),
        "n_turns",
        F.array_join(roles, ",").alias("roles"),
        "rendered",
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, read off the counts of their prefixes."""
    docs = _table(spark, sf_dir, "documents").withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))
    counted = token_counts.prefix_counts(docs, ENGLISH_BPE, ["doc_id", "n_bytes"])
    tokens = token_counts.total_tokens("prefix_counts")
    return counted.select(
        "doc_id", "n_bytes", tokens.cast("long").alias("n_tokens"), (tokens > TOKEN_LIMIT).alias("over_limit")
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by the square root of their sources' sizes."""
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    found = pii.find(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[pii.count_of(kind).alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(pii.written(pii.base_only()), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
    )


def op8_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of all documents; a fifth is held out of training."""
    docs = _table(spark, sf_dir, "documents")
    return lattice_lm.scored(docs, lattice_lm.train(docs, PIECES))


def op9_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of all embeddings for every fiftieth id."""
    return collisions.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents; a fifth of the ids is held out of training."""
    docs = _table(spark, sf_dir, "documents")
    model = quality_classifier.train(docs, _table(spark, sf_dir, "labels"))
    return quality_classifier.scored(docs, model, ["doc_id"]).select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), quality_classifier.HELD_OUT_MODULUS) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"),
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens over all documents."""
    found = alignment.aligned(_table(spark, sf_dir, "documents"), ENGLISH_BPE, PIECES)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return found.withColumn("groups_sha256", digest).drop("groups")


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents; a fifth of the ids is held out of training."""
    docs = _table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.train(docs), ["doc_id"])
    held_out = F.coalesce(remainder(F.col("doc_id"), language_id.HELD_OUT_MODULUS) == 0, F.lit(False))
    return found.withColumn("held_out", held_out)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents of every benchmark item."""
    return ranked_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_simhash": op2_simhash,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_chat": op4_chat,
    "op5_token_counts": op5_token_counts,
    "op6_mixing": op6_mixing,
    "op7_pii": op7_pii,
    "op8_lattice_lm": op8_lattice_lm,
    "op9_collisions": op9_collisions,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_alignment": op11_alignment,
    "op12_language_id": op12_language_id,
    "op13_ranked_search": op13_ranked_search,
}

__all__ = ["ORACLE", "QUERIES"]
