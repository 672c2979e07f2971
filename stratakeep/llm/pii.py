"""Personal data found with regular expressions, checksums and context.

Everything is built-in functions. A text is split at the matches of a pattern;
the lengths of what lies between and of the matches give the places, in
code points. Patterns are written so that they never go back over what they
have read: a run of characters is taken whole and started once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds of the base rules in the order of their rank (fixed values).
BASE = ("email", "ip", "card", "phone")
# Kinds that the method adds.
ADDED = ("iban", "ssn", "local_phone")
KINDS = (*BASE, *ADDED)

# How far around a span its context reaches, in code points.
CONTEXT = 40
# An added span needs this score.
ACCEPTED = 0.6

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"


@dataclass(frozen=True)
class Kind:
    """How a kind is found and scored.

    ``hint`` is a cheap condition on the text that every match implies.
    ``prior`` is the score of a match that passed its check; one of ``words``
    nearby adds ``lift``.
    """

    pattern: str
    hint: str
    prior: float
    words: str
    lift: float


_RULES = {
    "email": Kind(
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@", 0.9, "mail|contact|write|address", 0.1,
    ),
    "ip": Kind(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]", 0.6, r"\bip\b|host|server|address", 0.3),
    "card": Kind(r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]", 0.7, "card|visa|credit|payment", 0.3),
    "phone": Kind(r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.8, "phone|tel|call|mobile|fax", 0.2),
    "iban": Kind(
        r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?+\b",
        "[A-Z]{2}[0-9]{2}", 0.8, "iban|account|bank|konto|compte|cuenta", 0.2,
    ),
    "ssn": Kind(
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.4, r"\bssn\b|social security", 0.4,
    ),
    "local_phone": Kind(
        r"(?<![0-9+(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
        r"[0-9]{3}[\x20.-][0-9]{4}", 0.4, "phone|tel|call|mobile|fax", 0.3,
    ),
}


def _running(steps: Column) -> Column:
    """Sums up to and including each entry of a list of numbers.

    The list goes in blocks of about the square root of its length, so that
    no growing list is copied once per entry of the whole.
    """
    width = F.ceil(F.sqrt(F.greatest(F.size(steps), F.lit(1)))).cast("int")

    def upto(values: Column) -> Column:
        return F.aggregate(
            values, F.array(F.lit(0)), lambda done, value: F.concat(done, F.array(F.element_at(done, -1) + value))
        )

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / width).cast("int")),
        lambda at: F.slice(steps, at * width + 1, width),
    )
    sums = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda total, value: total + value))
    before = F.slice(upto(sums), 1, F.size(blocks))
    inside = F.transform(blocks, lambda block: F.slice(upto(block), 2, F.size(block)))
    moved = F.zip_with(inside, before, lambda block, start: F.transform(block, lambda value: value + start))
    return F.when(F.size(steps) > 0, F.flatten(moved)).otherwise(F.array().cast("array<int>"))


def _passes(kind: str, match: Column) -> Column:
    """Whether a match is what it looks like, by its own characters."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    count = F.length(digits)
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return count.between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return count.between(9, 15)
    if kind == "iban":
        compact = F.regexp_replace(match, " ", "")
        turned = F.concat(F.substring(compact, 5, 40), F.substring(compact, 1, 4))

        def digit(rest: Column, character: Column) -> Column:
            code = F.ascii(character)
            return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

        return F.aggregate(F.split(turned, ""), F.lit(0), digit) == 1
    if kind == "ssn":
        return ~match.rlike("^(?:000|666|9[0-9]{2})-|-00-|-0000$")
    return F.lit(True)


def _scored(kind: str, text: Column, span: Column) -> Column:
    rule = _RULES[kind]
    near = F.concat_ws(
        " ",
        F.substring(text, F.greatest(span["start"] - CONTEXT + 1, F.lit(1)), F.least(span["start"], F.lit(CONTEXT))),
        F.substring(text, span["end"] + 1, F.lit(CONTEXT)),
    )
    return F.lit(rule.prior) + F.when(F.lower(near).rlike(rule.words), rule.lift).otherwise(0.0)


def _with_spans(df: DataFrame, kind: str, text: str) -> DataFrame:
    """Adds column ``kind``: its spans, in order, with rank and score."""
    rule = _RULES[kind]
    none = F.array().cast("array<string>")
    source = F.col(text)
    df = df.withColumn("_found", F.when(source.rlike(rule.hint), F.regexp_extract_all(source, F.lit(rule.pattern), F.lit(0))).otherwise(none))
    df = df.withColumn("_gaps", F.when(F.size("_found") > 0, F.split(source, rule.pattern, -1)).otherwise(none))
    steps = F.zip_with("_gaps", "_found", lambda gap, match: F.length(gap) + F.coalesce(F.length(match), F.lit(0)))
    df = df.withColumn("_steps", F.slice(steps, 1, F.size("_found")))
    df = df.withColumn("_ends", F.when(F.size("_found") > 0, _running(F.col("_steps"))).otherwise(F.array().cast("array<int>")))
    spans = F.filter(
        F.zip_with(
            "_ends",
            "_found",
            lambda end, match: F.struct(
                (end - F.length(match)).alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"), match.alias("match")
            ),
        ),
        lambda span: _passes(kind, span["match"]),
    )
    df = df.withColumn("_spans", spans)
    whole = F.transform(
        "_spans",
        lambda span: F.struct(
            span["start"].alias("start"), span["rank"].alias("rank"), span["end"].alias("end"), F.lit(kind).alias("kind"),
            _scored(kind, source, span).alias("score"),
        ),
    )
    return df.withColumn(kind, whole).drop("_found", "_gaps", "_steps", "_ends", "_spans")


def _covered(spans: str) -> Column:
    """The stretches that sorted spans cover, overlaps joined."""
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        own = F.struct(span["start"].alias("start"), span["end"].alias("end"))
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        joins = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] > span["start"])
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))).otherwise(F.concat(done, F.array(own)))

    return F.aggregate(spans, none, step)


def _replaced(text: Column, stretches: Column, shown) -> Column:
    """The text with each stretch replaced by ``shown(stretch)``."""
    before = F.concat(F.array(F.lit(0)), F.transform(stretches, lambda x: x["end"]))
    pieces = F.zip_with(
        before,
        stretches,
        lambda at, x: F.when(x.isNull(), F.substring(text, at + 1, F.length(text))).otherwise(
            F.concat(F.substring(text, at + 1, x["start"] - at), shown(x))
        ),
    )
    return F.array_join(pieces, "")


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: personal data in the whole text.

    A span has ``start`` and ``end`` (code points, end exclusive), ``rank`` (place
    of its kind in ``KINDS``), ``kind`` and ``score``; spans are sorted by
    start, then rank. Base kinds are the leftmost matches that do not overlap within
    their kind and pass their check; a match that fails is dropped. Added
    kinds are looked for where no base span is, and need their check and a
    score of ``ACCEPTED``, which context can give. A null or empty text has
    none. A column named ``spans`` is replaced.
    """
    rows = docs.select(F.struct(*[F.col(n) for n in docs.columns if n != "spans"]).alias("row"), F.coalesce(text, F.lit("")).alias("_text"))
    for kind in BASE:
        rows = _with_spans(rows, kind, "_text")
    rows = rows.withColumn("_base", F.array_sort(F.concat(*BASE))).drop(*BASE)
    # Signs that no pattern has stand in for what base spans cover.
    hidden = _replaced(F.col("_text"), _covered("_base"), lambda x: F.repeat(F.lit("~"), x["end"] - x["start"]))
    rows = rows.withColumn("_rest", F.when(F.size("_base") > 0, hidden).otherwise(F.col("_text")))
    for kind in ADDED:
        rows = _with_spans(rows, kind, "_rest")
    added = F.filter(F.concat(*ADDED), lambda span: span["score"] >= ACCEPTED)
    return rows.select("row.*", F.array_sort(F.concat("_base", added)).alias("spans"))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined with commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_only(spans: str = "spans") -> Column:
    return F.filter(spans, lambda span: span["rank"] < len(BASE))


def count_of(kind: str, spans: str = "spans") -> Column:
    return F.size(F.filter(spans, lambda span: span["kind"] == kind)).cast("long")


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced by its kind in angle brackets.

    Overlapping spans become one, named after the first. ``length`` names a column that
    holds the text's number of code points and is brought up to date, where it exists.
    Texts without personal data, null ones included, stay as they are.
    """
    found = find(docs.select(F.struct("*").alias("row"), F.col(text).alias("_whole")), "_whole")
    stretches = _covered("spans")
    named = F.transform(
        stretches,
        lambda x: F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            F.get(F.filter("spans", lambda span: span["start"] == x["start"]), 0)["kind"].alias("kind"),
        ),
    )
    found = found.withColumn("_named", F.when(F.size("spans") > 0, named))
    clean = _replaced(F.col("_whole"), F.col("_named"), lambda x: F.concat(F.lit("<"), F.upper(x["kind"]), F.lit(">")))
    found = found.withColumn("_clean", F.when(F.size("spans") > 0, clean).otherwise(F.col("_whole")))
    columns = []
    for name in docs.columns:
        if name == text:
            columns.append(F.col("_clean").alias(name))
        elif name == length:
            changed = F.when(F.size("spans") > 0, F.length("_clean")).otherwise(F.col("row")[name])
            columns.append(changed.cast(docs.schema[name].dataType).alias(name))
        else:
            columns.append(F.col("row")[name].alias(name))
    return found.select(*columns)
