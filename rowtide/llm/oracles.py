"""DuckDB SQL for the rows of the registered queries, where SQL can say them."""

from __future__ import annotations

from rowtide.llm import quality
from rowtide.llm.chat import TURN_END, TURN_START

# Prefixes are compared as texts in which every part stands behind its length.
OP2 = f"""
WITH sized AS (
  SELECT conv_id, coalesce(turn, -9223372036854775808) AS turn, role, text,
         coalesce(length(role) || ':' || role, '-') || '|' || coalesce(length(text) || ':' || text, '-') || ';' AS part,
         CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS lone
  FROM conversations
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, lone ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k
  FROM sized
), prefixes AS (
  SELECT conv_id, lone, k,
         string_agg(part, '') OVER (PARTITION BY conv_id, lone ORDER BY k) AS prefix,
         count(*) OVER (PARTITION BY conv_id, lone) AS n_turns
  FROM numbered
), wholes AS (
  SELECT prefix, min(conv_id) AS conv_id, count(*) AS n_copies, any_value(n_turns) AS n_turns, min(lone) AS lone
  FROM prefixes WHERE k = n_turns GROUP BY prefix
), kept AS (
  SELECT * FROM wholes WHERE prefix NOT IN (SELECT prefix FROM prefixes WHERE k < n_turns)
)
SELECT kept.conv_id, kept.n_turns::INTEGER AS n_turns, kept.n_copies,
       string_agg('{TURN_START}' || coalesce(role, '') || chr(10) || coalesce(text, '') || '{TURN_END}' || chr(10), '' ORDER BY k)
         AS rendered
FROM kept JOIN numbered ON kept.conv_id IS NOT DISTINCT FROM numbered.conv_id
  AND (kept.conv_id IS NOT NULL OR kept.lone = numbered.lone)
GROUP BY ALL
"""

OP10 = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, unhex(sha1(coalesce(html, ''))) AS sha,
         max(page_id) OVER (PARTITION BY sha1(coalesce(html, ''))) AS last_id
  FROM pages
), bits AS (
  SELECT *, [substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ('0b' || substr(bin_text, 5 * i + 1, 5))::INTEGER + 1, 1)
             for i in range(0, 32)] AS letters
  FROM (SELECT *, replace(bit_text::VARCHAR, ' ', '') AS bin_text FROM (SELECT *, sha::BIT AS bit_text FROM payloads))
)
SELECT page_id, payload_bytes, list_aggregate(letters, 'string_agg', '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM last_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM last_id THEN last_id END AS refers_to
FROM bits
"""

# The base counts, the mean histograms of the documents that pass, and the distance from them.
_SPACE = r"[ \t\n\x0B\f\r]"
_DISTANCE = """
SELECT doc_id_, row_no, sqrt(greatest(0, sum(
    CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS d
FROM {0} GROUP BY ALL"""
OP3 = rf"""
WITH docs AS MATERIALIZED (
  SELECT doc_id AS doc_id_, row_number() OVER () AS row_no, coalesce(text, '') AS t, coalesce(lang, '') AS lang FROM documents
), cut AS (
  SELECT *, regexp_extract_all(t, '[^ \t\n\x0B\f\r]+') AS w, regexp_replace(t, '{_SPACE}', '', 'g') AS glued,
    regexp_extract_all(translate(lower(t), '.,;:!?"''()[]{{}}*#$%&|<>-_=+/\~^`@', ''), '[^ \t\n\x0B\f\r]+') AS plain
  FROM docs
), windows AS (
  SELECT row_no, i, w[i:i + 2] AS three FROM cut, unnest(range(1, len(w) - 1)) AS r(i)
), repeated AS (
  SELECT row_no, count(DISTINCT i + k) AS n FROM (
    SELECT row_no, i, count(*) OVER (PARTITION BY row_no, three) AS times FROM windows) AS x, (VALUES (0), (1), (2)) AS v(k)
  WHERE times > 1 GROUP BY row_no
), lines AS (
  SELECT row_no, count(*) - count(DISTINCT line) AS n FROM (SELECT row_no, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^ \t\n\x0B\f\r]') GROUP BY row_no
), counted AS (
  SELECT cut.*, len(w)::BIGINT AS n_words, length(glued)::BIGINT AS word_chars,
    length(regexp_replace(glued, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words
  FROM cut LEFT JOIN lines USING (row_no) LEFT JOIN repeated USING (row_no)
), judged AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
), sets(k, pattern) AS (VALUES
  (0, '[^a-z]'), (1, '[^A-Z]'), (2, '[^0-9]'), (3, '[^#*$%&|<>]'), (4, '[^.,;:!?''"()-]'),
  (5, '[a-zA-Z0-9#*$%&|<>.,;:!?''"()-]|[^\x00-\x7F]'), (6, '[^\p{{L}}]|[a-zA-Z]'), (7, '[\p{{L}}]|[\x00-\x7F]')
), classes AS (
  SELECT doc_id_, row_no, lang, base_failed, k, length(regexp_replace(glued, pattern, '', 'g')) / nullif(word_chars, 0) AS p
  FROM judged, sets
), class_pairs AS (
  SELECT c.*, q FROM classes c JOIN (SELECT lang, k, avg(p) AS q FROM classes WHERE NOT base_failed GROUP BY ALL) USING (lang, k)
  WHERE p IS NOT NULL
), each AS (
  SELECT row_no, word, count(*) AS n FROM (SELECT row_no, unnest(plain) AS word FROM judged) GROUP BY ALL
), sums AS (
  SELECT lang, sum(n_words) AS words, count(*) FILTER (WHERE NOT base_failed) AS docs FROM judged GROUP BY lang
), common AS (
  SELECT lang, word, share FROM (
    SELECT j.lang, word, coalesce(sum(n / n_words) FILTER (WHERE NOT base_failed), 0) / any_value(docs) AS share,
      sum(n) AS n, any_value(words) AS words
    FROM each JOIN judged j USING (row_no) JOIN sums ON sums.lang = j.lang WHERE docs > 0 GROUP BY j.lang, word)
  WHERE n >= {quality.COMMON_SHARE} * words
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= {quality.COMMON_WORDS}
), word_parts AS (
  SELECT doc_id_, j.row_no, j.lang, n_words, c.word, coalesce(n, 0) AS n, share FROM judged j JOIN common c ON c.lang = j.lang
  LEFT JOIN each e ON e.row_no = j.row_no AND e.word = c.word
), word_pairs AS (
  SELECT doc_id_, row_no, n / total AS p, share AS q FROM (
    SELECT *, greatest(n_words, sum(n) OVER (PARTITION BY row_no)) AS total FROM word_parts) WHERE total > 0
  UNION ALL
  SELECT doc_id_, row_no, greatest(0, n_words - sum(n)) / greatest(n_words, sum(n)) AS p, greatest(0, 1 - sum(share)) AS q
  FROM word_parts GROUP BY doc_id_, row_no, n_words HAVING greatest(n_words, sum(n)) > 0
), far AS (
  SELECT judged.*, c.d AS class_distance, v.d AS word_distance FROM judged
  LEFT JOIN ({_DISTANCE.format("class_pairs")}) c USING (row_no) LEFT JOIN ({_DISTANCE.format("word_pairs")}) v USING (row_no)
)
SELECT doc_id_ AS doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (n_words >= {quality.CLASS_WORDS} AND coalesce(class_distance > {quality.CLASS_DISTANCE}, false))
    AND NOT (n_words >= {quality.WORD_WORDS} AND coalesce(word_distance > {quality.WORD_DISTANCE}, false)) AS kept,
  round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance
FROM far
"""

ORACLES: dict[str, str] = {"op2_chat_snapshots": OP2, "op3_divergence_rules": OP3, "op10_warc_ranges": OP10}
