"""DuckDB SQL giving the same rows as the queries that SQL can express.

Not expressible, and tested against brute force instead: context trees (op1),
the trained models (op4, op6, op9), packing (op5), term disclosure (op7), the
components of near-duplicates (op10), eigenvectors (op11) and BPE (op12).
"""

from __future__ import annotations

from tallyhouse.llm.quality_rules import BOILERPLATE, ENTRY_WORDS, MENU_LINES, SHORT_LINE

_WORD = r"[^\x20\x09-\x0D]+"
_ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PUNCTUATION = r"!-/:-@\[-`{-~"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PHRASE = " OR ".join(f"contains(lower(line), '{x}')" for x in BOILERPLATE)
_PHRASE_WORDS = " + ".join(f"CAST(length(lower(line)) - length(replace(lower(line), '{x}', '')) AS DOUBLE) / {len(x)} * {len(x.split())}"
                           for x in BOILERPLATE)
_BOILERPLATE = f"(({_PHRASE}) AND (n <= {SHORT_LINE} OR ({_PHRASE_WORDS}) * 5 >= n))"
_END = r"[.!?:;,…。！？][\"''»”’)\]]*[\x20\x09-\x0D]*$"


def _only(text: str, inside: str) -> str:
    return f"length(regexp_replace({text}, '[^{inside}]', '', 'g'))"


ORACLE: dict[str, str] = {
    "op2_decontamination": f"""
WITH i AS (SELECT DISTINCT item_id, regexp_extract_all({_LOWER}, '{_ITEM_WORD}') AS ws FROM benchmark),
items AS (SELECT item_id, ws, least(10, len(ws)) AS n FROM i WHERE len(ws) > 0),
wanted AS (SELECT DISTINCT item_id, n, array_to_string(ws[p:p + n - 1], ' ') AS k
  FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS p FROM items)),
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ITEM_WORD}') AS ws FROM documents),
seen AS (SELECT doc_id, n, p, array_to_string(ws[p:p + n - 1], ' ') AS k FROM (
  SELECT *, unnest(range(1, len(ws) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM items) WHERE len(ws) >= n)),
hit AS (SELECT doc_id, item_id, p, seen.n FROM seen JOIN wanted ON seen.n = wanted.n AND seen.k = wanted.k),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (
  SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (
  SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op3_substring_dedup": f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
win AS (SELECT doc_id, p, array_to_string(ws[p:p + 12], ' ') AS k FROM (
  SELECT *, unnest(range(1, len(ws) - 11)) AS p FROM d)),
firsts AS (SELECT k, min(doc_id) AS first_id FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS q FROM win JOIN firsts USING (k) WHERE first_id < doc_id),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS q FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY q) AS text FROM words ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op8_quality_rules": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
win AS (SELECT doc_id, p, array_to_string(ws[p:p + 2], ' ') AS k FROM (
  SELECT *, unnest(range(1, len(ws) - 1)) AS p FROM d)),
twice AS (SELECT doc_id, k FROM win GROUP BY doc_id, k HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT q) AS n FROM (
  SELECT doc_id, unnest(range(p, p + 3)) AS q FROM win JOIN twice USING (doc_id, k)) GROUP BY doc_id),
raw AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d),
worded AS (SELECT doc_id, line, pos, regexp_extract_all(line, '{_WORD}') AS lw, len(lw) AS n FROM raw WHERE len(regexp_extract_all(line, '{_WORD}')) > 0),
entries AS (SELECT *, n <= {ENTRY_WORDS} AND NOT regexp_matches(line, '{_END}') AS entry FROM worded),
runs AS (SELECT *, count(*) FILTER (entry) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {MENU_LINES - 1} FOLLOWING)
  = {MENU_LINES} AS begins FROM entries),
lines AS (SELECT *, bool_or(begins) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN {MENU_LINES - 1} PRECEDING AND CURRENT ROW) AS menu FROM runs),
judged AS (SELECT doc_id, line, n, menu OR (n >= 3 AND 2 * {_only('line', _PUNCTUATION)} > length(array_to_string(lw, ''))) OR (n >= 5 AND (
  ({_only('line', 'A-Z')} >= 6 AND {_only('line', 'A-Z')} > CAST(0.6 AS DOUBLE) * {_only('line', 'A-Za-z')})
  OR {_only('line', '#*$%&|<>')} > CAST(0.5 AS DOUBLE) * n
  OR len(list_filter(lw, lambda x: x IN ('|', '>', '»', '·', '/'))) * 3 >= n
  OR (n >= 15 AND len(list_distinct(lw)) <= 3))) OR {_BOILERPLATE} AS fails FROM lines),
l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, coalesce(sum(n) FILTER (fails), 0) AS lost
  FROM judged GROUP BY doc_id),
c AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
  CAST({_only('t', '#*$%&|<>')} AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
  coalesce(n, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN l USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost <= CAST(0.3 AS DOUBLE) * n_words AS kept FROM c""",
    "op13_ranked_search": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS ts FROM documents),
p AS (SELECT r, doc_id, CAST(len(ts) AS BIGINT) AS n, unnest(ts) AS t FROM d WHERE len(ts) > 0),
corpus AS (SELECT count(DISTINCT r) AS docs, count(*) AS total FROM p),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS t FROM benchmark),
tf AS (SELECT r, doc_id, n, t, count(*) AS tf FROM p WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, corpus GROUP BY t, docs),
v AS (SELECT r, doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total))) AS v
  FROM tf JOIN w USING (t), corpus),
s AS (SELECT item_id, r, doc_id, CAST(sum(v) AS BIGINT) AS score FROM q JOIN v USING (t) GROUP BY ALL HAVING sum(v) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
  doc_id, score FROM s QUALIFY rank <= 10""",
}
