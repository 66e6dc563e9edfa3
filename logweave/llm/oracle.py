"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

from logweave.llm import hard_negatives, line_dedup
from logweave.llm.chat import CONTROL, END, START

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str, blanks: str) -> str:
    return f"list_filter(string_split_regex({text}, '{blanks}'), lambda w: w <> '')"


SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {_words("coalesce(text, '')", r'[\x20\x09-\x0D]+')} AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
k AS (SELECT doc_id, i, list_aggregate(w[i:i + 12], 'string_agg', ' ') AS key FROM s),
m AS (SELECT key, min(doc_id) AS least FROM k GROUP BY key),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS at FROM k JOIN m USING (key) WHERE doc_id > least),
p AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS at FROM d WHERE len(w) > 0),
r AS (SELECT p.doc_id, count(*) AS n_words, count(g.at) AS n_removed,
             coalesce(string_agg(word, ' ' ORDER BY p.at) FILTER (WHERE g.at IS NULL), '') AS kept
      FROM p LEFT JOIN g ON p.doc_id = g.doc_id AND p.at = g.at GROUP BY p.doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)
"""

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_words(_LOWER, r'[\x00-\x2F\x3A-\x60\x7B-\x7F]+')} AS w FROM documents),
b AS (SELECT item_id, {_words(_LOWER, r'[\x00-\x2F\x3A-\x60\x7B-\x7F]+')} AS w FROM benchmark),
v AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0),
pat AS (SELECT DISTINCT item_id, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS key FROM v),
s AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
      FROM d JOIN (SELECT DISTINCT n FROM pat) ON len(w) >= n),
k AS (SELECT doc_id, n, i, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS key FROM s),
hit AS (SELECT doc_id, k.n, i, item_id FROM k JOIN pat ON k.key = pat.key AND k.n = pat.n),
h AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hit) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


def _escaped(text: str) -> str:
    """A backslash after the first character of every control string (one more where there are some)."""
    for c in CONTROL:
        head, rest = (s.replace("|", r"\|").replace("[", r"\[").replace("]", r"\]") for s in (c[0], c[1:]))
        text = f"regexp_replace({text}, '({head})(\\\\*)({rest})', '\\1\\\\\\2\\3', 'g')"
    return text


CHAT = f"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS msg FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY msg)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY msg) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({len(START) + len(END) + 2} + length(role) + length({_escaped('text')})) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id
"""

ORACLE = {
    "op2_line_dedup": line_dedup.ORACLE,
    "op6_substring_dedup": SUBSTRING_DEDUP,
    "op9_benchmark_decontamination": DECONTAMINATION,
    "op10_chat_formatting": CHAT,
    "op12_hard_negatives": hard_negatives.SQL,
}
