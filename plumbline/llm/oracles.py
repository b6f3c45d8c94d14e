"""SQL that gives the rows of the queries that SQL can express, on tables with unique ids as in the test data."""

from __future__ import annotations

from plumbline.llm import licenses

WARC = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(encode(coalesce(html, ''))) AS hex FROM pages
), parts AS (
  SELECT *, list_transform(range(0, 8), lambda g: CAST('0x' || substr(hex, 5 * g + 1, 5) AS INTEGER)) AS fives FROM payloads
), named AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((fives[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') AS payload_digest
  FROM parts
), firsts AS (SELECT payload_digest, payload_bytes, min(page_id) AS first_id FROM named GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM named JOIN firsts USING (payload_digest, payload_bytes)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    copyright_line = licenses.COPYRIGHT_LINE
    words = f"trim(regexp_replace(regexp_replace(lower({text}), {_quoted(copyright_line)}, ' ', 'g'), {_quoted(licenses.OTHER)}, ' ', 'g'))"
    words = f"' ' || replace({words}, ' ', '  ') || ' '"
    for spelling, one in licenses.SPELLINGS.items():
        words = f"replace({words}, ' {spelling.replace(' ', '  ')} ', ' {one.replace(' ', '  ')} ')"
    return f"trim(replace({words}, '  ', ' '))"


def _license_scan() -> str:
    texts = [*((text, name) for name, text in licenses.LICENSES.items()), *licenses.NOTICES.items(), *((f"SPDX-License-Identifier: {x}", x) for x in licenses.SPDX)]
    values = ", ".join(f"({_quoted(text)}, {_quoted(name)})" for text, name in texts)
    return f"""
WITH known AS (SELECT sha256({_canonical("t")}) AS digest, license FROM (VALUES {values}) v(t, license)),
lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
named AS (SELECT DISTINCT doc_id, license FROM (SELECT doc_id, sha256({_canonical("line")}) AS digest FROM lines) JOIN known USING (digest)),
notices AS (SELECT doc_id, string_agg(license, ',' ORDER BY license) AS notices FROM named GROUP BY doc_id),
whole AS (SELECT doc_id, sha256({_canonical("coalesce(text, '')")}) AS digest FROM documents)
SELECT doc_id, whole.digest, known.license, coalesce(notices, '') AS notices
FROM whole LEFT JOIN known USING (digest) LEFT JOIN notices USING (doc_id)
"""


LICENSE_SCAN = _license_scan()

QUALITY = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
worded AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS window_words
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM worded)
), repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, window_words) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest(range(0, 5)) AS k FROM repeated) GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) AS n_upper, length(regexp_replace(text, '[^\p{Ll}]+', '', 'g')) AS n_lower
  FROM worded LEFT JOIN covered USING (doc_id)
), judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 4 * n_lines OR n_upper > n_lower OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM judged
"""

TOP_K = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM scored QUALIFY rank <= 10
"""

LEXICAL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), counted AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counted GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * max(docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM counted SEMI JOIN asked USING (term) CROSS JOIN totals GROUP BY term
), scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN counted USING (term) JOIN lengths USING (doc_id) CROSS JOIN totals GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""
