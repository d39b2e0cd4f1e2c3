"""DuckDB SQL of the operators that SQL can express."""

from chainstar.llm import chat, quality as q

_SPACES = r"[\x20\x09-\x0D]"
_TRIM = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


EXACT_SQL = f"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_SPACES}+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

# Lines are judged by counts of the same patterns; 3-word windows are counted per text.
QUALITY_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS raw, generate_subscripts(string_split(t, chr(10)), 1) AS i
      FROM d),
m AS (SELECT doc_id, raw, i, trim(raw, {_TRIM}) AS s FROM l),
j AS (SELECT *, len(s) AS n_s, len(regexp_extract_all(s, '[^\\x20\\x09-\\x0D]+')) AS w,
             len(regexp_extract_all(s, {_text(q.NOISE)})) AS noise,
             len(regexp_extract_all(s, {_text(q.SEPARATOR)})) AS sep,
             len(regexp_extract_all(s, {_text(q.SHOUT)})) AS shout,
             len(regexp_extract_all(s, '[A-Z]')) AS caps, len(regexp_extract_all(s, '[A-Za-z]')) AS letters,
             regexp_matches(s, {_text(q.TERMINAL)}) AS ends, regexp_matches(lower(s), {_text(q.BOILERPLATE)}) AS boiler,
             row_number() OVER (PARTITION BY doc_id, raw ORDER BY i) > 1 AS again
      FROM m WHERE s <> ''),
f AS (SELECT doc_id, sum(n_s) AS line_chars, sum(again::INT) AS n_dup_lines,
             sum(CASE WHEN 100 * noise > {q.NOISE_PERCENT} * n_s OR 100 * sep > {q.SEPARATOR_PERCENT} * w
                        OR 100 * shout > {q.SHOUT_PERCENT} * w
                        OR (w >= {q.CAPS_WORDS} AND letters > 0 AND 100 * caps > {q.CAPS_PERCENT} * letters)
                        OR (w <= {q.NAV_WORDS} AND NOT ends) OR (w <= {q.BOILER_WORDS} AND boiler)
                 THEN n_s ELSE 0 END) AS lost_chars
      FROM j GROUP BY doc_id),
x AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
p AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS k, ws FROM x WHERE len(ws) >= 3),
g AS (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, ws[k], ws[k + 1], ws[k + 2]) AS n FROM p),
r AS (SELECT doc_id, count(DISTINCT k + o) AS n_repeat_words FROM g, (SELECT unnest([0, 1, 2]) AS o)
      WHERE n > 1 GROUP BY doc_id),
a AS (SELECT x.doc_id, len(ws) AS n_words, len(regexp_replace(t, '{_SPACES}', '', 'g')) AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost_chars, 0) AS lost_chars,
             coalesce(line_chars, 0) AS line_chars
      FROM x LEFT JOIN f USING (doc_id) LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words
         AND 100 * lost_chars <= {q.MAX_LOSS_PERCENT} * line_chars AS kept,
       lost_chars::BIGINT AS lost_chars, line_chars::BIGINT AS line_chars
FROM a
"""

CHAT_SQL = f"""
WITH t AS (SELECT conv_id, coalesce(role, '{chat.UNKNOWN}') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                                     coalesce(role, '{chat.UNKNOWN}'), coalesce(text, '')) - 1 AS place
           FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> '{chat.SYSTEM}'),
b AS (SELECT t.conv_id, speaker, place // {chat.PART_TURNS} AS part, place, text, role = speaker AS loss,
             CASE WHEN role = '{chat.SYSTEM}' THEN '<|system|>' || chr(10)
                  WHEN role = speaker THEN '<|assistant|>' || chr(10)
                  ELSE '<|user:' || role || '|>' || chr(10) END AS head
      FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
e AS (SELECT *, sum(len(head) + len(text) + 1) OVER (PARTITION BY conv_id, speaker ORDER BY place)
                  - len(text) - 1 AS start FROM b)
SELECT conv_id, speaker, part::BIGINT AS part, count(*) AS n_turns,
       sum(len(head) + len(text) + 1)::BIGINT AS n_chars,
       sum(CASE WHEN loss THEN len(text) ELSE 0 END)::BIGINT AS masked_chars,
       sha256(string_agg(head || text || chr(10), '' ORDER BY place)) AS text_sha256,
       string_agg(concat(start::BIGINT, ':', (start + len(text))::BIGINT, ':', loss::INT), ',' ORDER BY place) AS spans
FROM e GROUP BY conv_id, speaker, part
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WINDOW = 10

# Windows are lists of words, looked up among the documents' runs of the same lengths.
LEAKS_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS ws FROM benchmark),
w AS (SELECT DISTINCT item_id, ws[k:k + {_WINDOW - 1}] AS win
      FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - {_WINDOW - 1}, 1) + 1)) AS k FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM w),
g AS (SELECT r, k, n, ws[k:k + n - 1] AS win
      FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM d JOIN sizes ON len(ws) >= n)),
h AS (SELECT g.r, g.k, g.n, w.item_id FROM g JOIN w ON g.win = w.win),
p AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS place FROM h) GROUP BY r),
i AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN i USING (r)
"""

SEARCH_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS ws FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(ws))::BIGINT AS n_terms FROM d WHERE len(ws) > 0),
b AS (SELECT row_number() OVER () AS i, item_id,
             unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}')) AS term FROM benchmark),
q AS (SELECT i, item_id, term, count(*) AS times FROM b GROUP BY ALL),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d)
      WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM t, s GROUP BY term, n_docs),
v AS (SELECT t.r, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(ws) * n_docs) // n_terms))) AS v
      FROM t JOIN f USING (term) JOIN d USING (r), s),
x AS (SELECT i, item_id, r, sum(times * v)::BIGINT AS score FROM q JOIN v USING (term) GROUP BY ALL HAVING sum(times * v) > 0)
SELECT item_id, rank, doc_id, score
FROM (SELECT item_id, doc_id, score,
             row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
      FROM x JOIN d USING (r))
WHERE rank <= 10
"""
