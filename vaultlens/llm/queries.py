"""Registered queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from vaultlens.llm.bpe import op5_bpe_encoding
from vaultlens.llm.decontaminate import op9_benchmark_decontamination
from vaultlens.llm.divergence import op12_source_divergence
from vaultlens.llm.lines import op2_line_dedup
from vaultlens.llm.lm import op6_lm_scores
from vaultlens.llm.pii import op7_pii
from vaultlens.llm.quality import op3_quality_rules
from vaultlens.llm.secrets import op8_secret_scan
from vaultlens.llm.simhash import op4_simhash_near_dedup
from vaultlens.llm.spelling import op13_spelling_variants
from vaultlens.llm.token_files import op1_token_counts
from vaultlens.llm.vectors import op11_embedding_near_dedup
from vaultlens.llm.warc import op10_warc

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_bpe_encoding": op5_bpe_encoding,
    "op6_lm_scores": op6_lm_scores,
    "op7_pii": op7_pii,
    "op8_secret_scan": op8_secret_scan,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_warc": op10_warc,
    "op11_embedding_near_dedup": op11_embedding_near_dedup,
    "op12_source_divergence": op12_source_divergence,
    "op13_spelling_variants": op13_spelling_variants,
    "pipeline": corpus_pipeline.run,
}

OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
win AS (SELECT doc_id, i, w[i:i + 4] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win), range(0, 5) AS r(k) WHERE c > 1 GROUP BY doc_id),
line AS (
  SELECT doc_id, source, t, raw,
         lower(trim(regexp_replace(regexp_replace(raw, '[\x20\x09-\x0D]+', ' ', 'g'), '[0-9]+', '0', 'g'))) AS l
  FROM (SELECT doc_id, source, t, unnest(lines) AS raw FROM d)),
freq AS (
  SELECT source, l FROM (SELECT source, l, count(DISTINCT t) AS n FROM line GROUP BY source, l)
  JOIN (SELECT source, count(DISTINCT t) AS docs FROM d GROUP BY source) USING (source) WHERE n >= 10 AND n > docs * 0.05),
lost AS (
  SELECT doc_id, count(*) AS n, sum(len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+'))) AS words
  FROM line JOIN freq USING (source, l) GROUP BY doc_id),
f AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         coalesce(lost.n, 0)::BIGINT AS n_removed_lines, (len(w) - coalesce(lost.words, 0))::BIGINT AS n_kept_words
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT n_kept_words < 0.3 * n_words AS kept
FROM f
"""

OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
phrase AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, w[i:i + least(10, len(w)) - 1] AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
place AS (
  SELECT doc_id, n, i, w[i:i + n - 1] AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM phrase) AS sizes)),
hit AS (SELECT doc_id, i, place.n, item_id FROM place JOIN phrase ON place.g = phrase.g),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
item AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (doc_id) LEFT JOIN item USING (doc_id)
"""

# The records written and read back must carry what the pages themselves say.
OP10_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
g AS (SELECT html, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY html HAVING count(*) > 1)
SELECT page_id, n::BIGINT AS payload_bytes, sha256(p.html) AS payload_digest,
       CASE WHEN g.first IS NULL OR page_id = g.first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> g.first THEN g.first END AS refers_to
FROM p LEFT JOIN g ON p.html = g.html
"""

OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
grp AS (
  SELECT lang, source, coalesce(sum(n), 0) AS n, any_value(coalesce(v, 0)) AS v
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN size USING (lang) LEFT JOIN c USING (lang, source) GROUP BY lang, source),
whole AS (SELECT lang, sum(n) AS n, any_value(v) AS v FROM grp GROUP BY lang),
p AS (
  SELECT grp.lang, grp.source, kept.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (grp.n + 2 * grp.v) AS p
  FROM grp JOIN kept USING (lang) LEFT JOIN c ON c.lang = grp.lang AND c.source = grp.source AND c.term = kept.term),
q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (t.n + 2)) // (whole.n + 2 * whole.v) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term) AS t JOIN whole USING (lang)),
both_ AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM grp AS a JOIN grp AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN both_ ON both_.lang = a.lang AND both_.source = a.source AND both_.item = b.source),
term AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

ORACLE: dict[str, str] = {
    "op12_source_divergence": OP12_SQL,
    "op3_quality_rules": OP3_SQL,
    "op9_benchmark_decontamination": OP9_SQL,
    "op10_warc": OP10_SQL,
}
