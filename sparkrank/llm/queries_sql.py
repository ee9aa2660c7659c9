"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op7_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents
), g AS (
  SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm
)
SELECT t.doc_id, g.keep_id, g.group_size, coalesce(t.doc_id = g.keep_id, false) AS kept,
       sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

SQL["op6_line_dedup"] = rf"""
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d
), k AS (
  SELECT *, translate(trim(line, {_BLANKS}), '{_UPPER}', '{_LOWER}') AS key FROM l
), f AS (
  SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) > 1
), m AS (
  SELECT k.*, coalesce(k.doc_id <> f.first, false) AS gone FROM k LEFT JOIN f USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

_SEPARATORS = r" [|>\x{bb}\x{b7}\x{2022}/] "
_SENTENCE_END = r"[\x{3002}\x{ff01}\x{ff1f}]|[.!?\x{2026}:;][''\")\]\x{bb}\x{201d}\x{2019}]*(\s|$)"
_LINE_END = r"[.!?\x{2026}\x{3002}\x{ff01}\x{ff1f}:;][''\")\]\x{bb}\x{201d}\x{2019}]*$"
_BOILERPLATE = (
    r"(?i)all rights reserved|terms of (use|service)|privacy policy|cookie policy|"
    r"(accept|uses?) (all )?cookies|sign up for|subscribe to|log ?in to|click here|read more|"
    r"share (this )?on|follow us on|enable javascript|skip to (main )?content|back to top"
)

SQL["op10_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, {_BLANKS}) <> '') AS lines
  FROM documents
), w AS (
  SELECT doc_id, unnest(range(1, len(words) - 6)) AS i, words FROM d
), v AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS win FROM w
), r AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM v
), c AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS place FROM r WHERE n > 1) GROUP BY doc_id
), l AS (
  SELECT doc_id, unnest(raw) AS line, generate_subscripts(raw, 1) AS i
  FROM (SELECT doc_id, string_split(text, chr(10)) AS raw FROM d)
), e AS (
  SELECT *, length(inner_line) AS size, length(string_split(inner_line, ' ')[1]) AS first_word
  FROM (SELECT *, trim(line, {_BLANKS}) AS inner_line FROM l)
), h AS (
  SELECT *, lead(size) OVER o AS next_size, size + 1 + lead(first_word) OVER o AS reach,
         max(size) FILTER (WHERE size <= 120) OVER near AS widest,
         coalesce(bool_or(regexp_matches(line, '{_SENTENCE_END}')) FILTER (WHERE size <= 120) OVER near, false) AS stops
  FROM e
  WINDOW o AS (PARTITION BY doc_id ORDER BY i),
         near AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)
), g AS (
  SELECT *, coalesce(size BETWEEN 24 AND 120 AND NOT regexp_matches(inner_line, '{_LINE_END}')
                     AND next_size > 0 AND reach > next_size AND reach > widest, false) AS flows
  FROM h
), y AS (
  SELECT *, stops AND (flows OR coalesce(lag(flows) OVER (PARTITION BY doc_id ORDER BY i), false)) AS wrapped FROM g
), m AS (
  SELECT doc_id, line, wrapped, length(line) AS chars, length(line) - length(replace(line, ' ', '')) + 1 AS words,
         len(regexp_extract_all(line, '{_SEPARATORS}')) AS links,
         length(line) - length(replace(line, '!!', '')) AS shouts,
         length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) AS symbols
  FROM y WHERE size > 0
), f AS (
  SELECT doc_id, chars,
         symbols * 100 > chars * 5
         OR (links >= 3 AND links * 4 >= words)
         OR (shouts >= 6 AND shouts * 50 > words * 30)
         OR (words < 12 AND NOT wrapped AND NOT regexp_matches(line, '{_SENTENCE_END}'))
         OR (words <= 30 AND regexp_matches(line, '{_BOILERPLATE}')) AS fails
  FROM m
), s AS (
  SELECT doc_id, sum(chars) AS chars, coalesce(sum(chars) FILTER (WHERE fails), 0) AS lost FROM f GROUP BY doc_id
), b AS (
  SELECT d.doc_id, len(words) AS n_words, list_sum(list_transform(words, lambda w: length(w))) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(chars, 0) AS chars, coalesce(lost, 0) AS lost
  FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN s ON d.doc_id = s.doc_id
), j AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b
)
SELECT doc_id, n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
       base_failed, NOT base_failed AND lost * 100 <= chars * 50 AS kept
FROM j
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}')"

SQL["op12_ranked_search"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS terms FROM documents
), s AS (
  SELECT count(*) FILTER (WHERE len(terms) > 0) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d
), q AS (
  SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)
), u AS (
  SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM d
), p AS (
  SELECT row, doc_id, n, term, count(*) AS tf FROM u WHERE term IN (SELECT term FROM q) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM p, s GROUP BY term, n_docs
), r AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY item_id, row, doc_id
), k AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM r WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""
