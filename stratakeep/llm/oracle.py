"""The training-data queries that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

from stratakeep.llm.mixing import TEMPERATURE

_OP6_MIXING = f"""
WITH RECURSIVE sources AS (
  SELECT source, count(*) AS docs, pow(count(*), CAST({TEMPERATURE} AS DOUBLE)) AS weight FROM documents GROUP BY source
), rates AS (
  SELECT source, (SELECT sum(docs) FROM sources)::DOUBLE * (weight / (SELECT sum(weight) FROM sources)) / docs AS rate
  FROM sources
), upto AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS upto FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), upto + p * rate / (k + 1)
  FROM upto WHERE k < ceil(rate + 12 * sqrt(rate) + 20)
), drawn AS (
  SELECT doc_id, source,
    ('0x' || substr(md5('0:repeat:' || coalesce(doc_id::VARCHAR, '') || ':0'), 1, 13))::BIGINT / 4503599627370496.0 AS at
  FROM documents
), counted AS (
  SELECT d.doc_id, d.source, count(*) AS n
  FROM drawn d JOIN upto u ON d.source IS NOT DISTINCT FROM u.source AND u.upto <= d.at GROUP BY ALL
), copies AS (
  SELECT doc_id, unnest(range(1, n + 1)) AS copy FROM counted
)
SELECT d.*, c.copy::INTEGER AS copy,
  ('0x' || substr(md5('0:order:' || coalesce(c.doc_id::VARCHAR, '') || ':' || c.copy), 1, 13))::BIGINT AS shuffle_key
FROM documents d JOIN copies c ON d.doc_id = c.doc_id
"""

_TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
_OP13_RANKED_SEARCH = f"""
WITH doc_terms AS (
  SELECT doc_id, unnest({_TERMS}) AS term FROM documents
), lengths AS (
  SELECT doc_id, count(*) AS n FROM doc_terms GROUP BY doc_id
), totals AS (
  SELECT count(*)::BIGINT AS all_docs, sum(n)::BIGINT AS all_terms FROM lengths
), item_terms AS (
  SELECT item_id, term, count(*)::BIGINT AS times
  FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item_id, term
), held AS (
  SELECT doc_id, term, count(*)::BIGINT AS tf FROM doc_terms
  WHERE term IN (SELECT term FROM item_terms) GROUP BY doc_id, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM held CROSS JOIN totals GROUP BY term, all_docs
), parts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * all_docs) // all_terms))) AS part
  FROM held JOIN lengths USING (doc_id) JOIN weights USING (term) CROSS JOIN totals
), scores AS (
  SELECT item_id, doc_id, sum(times * part)::BIGINT AS score
  FROM item_terms JOIN parts USING (term) GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 20
"""

ORACLE: dict[str, str] = {"op6_mixing": _OP6_MIXING, "op13_ranked_search": _OP13_RANKED_SEARCH}
