"""DuckDB SQL for the operators that SQL can express, written from their meaning."""

from __future__ import annotations

from footfall.llm.bagminhash import SHINGLE
from footfall.llm.chat import END, SAYS, TURN
from footfall.llm.decontam import WINDOW, WORD

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(text: str = "text") -> str:
    lowered = f"translate(coalesce({text}, ''), '{_UPPER}', '{_UPPER.lower()}')"
    return f"regexp_extract_all({lowered}, '{WORD}')"


DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_words()} AS w FROM documents),
b AS (SELECT item_id, {_words()} AS w FROM benchmark),
placed AS (
  SELECT item_id, list_slice(w, i, i + {WINDOW} - 1) AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS i
        FROM b WHERE len(w) > 0)),
wins AS (SELECT DISTINCT item_id, win FROM placed),
sizes AS (SELECT DISTINCT len(win) AS size FROM wins),
spots AS (
  SELECT doc_id, pos, list_slice(w, pos, pos + size - 1) AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM d, sizes
        WHERE len(w) >= size)),
found AS (SELECT doc_id, item_id, pos, len(win) AS size FROM spots JOIN wins USING (win)),
hit AS (
  SELECT doc_id, count(*) AS n FROM (
    SELECT DISTINCT doc_id, unnest(range(pos, pos + size)) AS word FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items.names, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""

NEAR_DEDUP = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words()} AS w FROM documents),
each AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE} + 1, 1) + 1)) AS i
  FROM d WHERE len(w) > 0),
s AS (
  SELECT doc_id, array_to_string(list_slice(w, i, i + {SHINGLE} - 1), ' ') AS g, count(*) AS c
  FROM each GROUP BY ALL),
size AS (SELECT doc_id, sum(c) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, sum(least(a.c, b.c)) AS common
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (
  SELECT x, y FROM p JOIN size m ON m.doc_id = x JOIN size n ON n.doc_id = y
  WHERE common >= 0.8 * (m.n + n.n - common)),
way AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(doc_id, root) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT y, root FROM r JOIN way ON r.doc_id = way.x),
c AS (SELECT doc_id, min(root) AS class_id FROM r GROUP BY doc_id)
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size FROM c"""

_CONTROL = r"'[<\[]\\*(?:\||/?s>|/?INST\])'"
_MARKS = len(f"{TURN}{SAYS}{END}\n")


def _escaped(column: str) -> str:
    """Length of a text after escaping: one more for every control string."""
    return f"length({column}) + len(regexp_extract_all({column}, {_CONTROL}))"


CHAT = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
         AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                         FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({_MARKS} + {_escaped('role')} + {_escaped('text')}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""

PREFIX_TRIE = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, coalesce(role, ''),
                                     md5(coalesce(text, ''))) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
crc AS (
  SELECT i, r8 AS v FROM (
    SELECT i, list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, _:
             CASE WHEN a % 2 = 1 THEN xor(3988292384, a // 2) ELSE a // 2 END) AS r8
    FROM range(256) u(i))),
table_of AS (SELECT list(v ORDER BY i) AS v FROM crc),
c AS (
  SELECT conv_id, CAST(xor(4294967295, list_reduce(
           list_concat([4294967295],
             list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1),
                            lambda i: CAST(ascii(CAST(conv_id AS VARCHAR)[i]) AS BIGINT))),
           lambda s, b: xor(s // 256, v[xor(s % 256, b) + 1]))) % 9
         AS BIGINT) AS h
  FROM (SELECT DISTINCT conv_id FROM t), table_of),
r AS (
  SELECT c.conv_id, t.k, t.role, t.text FROM c JOIN t
    ON t.conv_id = c.conv_id - ((c.conv_id % 5) + 5) % 5 AND t.k <= c.h
  UNION ALL
  SELECT c.conv_id, t.k, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.k > c.h),
n AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY k) AS d, role, text,
         octet_length(encode(text)) AS size
  FROM r),
p AS (
  SELECT conv_id, d, size,
         list(length(role) || ':' || role || sha256(text))
           OVER (PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING) AS path
  FROM n
  UNION ALL SELECT conv_id, 0, 0, [] FROM c),
last AS (SELECT conv_id, max(d) AS d FROM p GROUP BY conv_id),
node AS (
  SELECT p.path, p.d AS depth, min(p.conv_id) AS conv_id, count(*) AS n_convs,
         any_value(p.size) AS size,
         sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id)
                           FILTER (last.d = p.d), '')) AS ends_sha256
  FROM p JOIN last USING (conv_id) GROUP BY p.path, p.d),
kids AS (
  SELECT list_slice(path, 1, depth - 1) AS path, count(*) AS n_children
  FROM node WHERE depth > 0 GROUP BY 1),
every AS (
  SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (path)),
above AS (
  SELECT list_slice(path, 1, up) AS path, CAST(count(*) FILTER (n_children = 0) AS BIGINT) AS n_leaves,
         CAST(sum((n_convs - 1) * size) AS BIGINT) AS saved_tokens
  FROM (SELECT path, n_children, n_convs, size, unnest(range(0, depth + 1)) AS up FROM every)
  GROUP BY 1)
SELECT e.conv_id, e.depth, q.conv_id AS parent_conv_id, e.n_convs, e.n_children,
       above.n_leaves, above.saved_tokens, e.ends_sha256
FROM every e JOIN above USING (path)
LEFT JOIN node q ON e.depth > 0 AND q.path = list_slice(e.path, 1, e.depth - 1)"""

ORACLE = {
    "decontaminate_exact": DECONTAMINATE,
    "op4_near_dedup": NEAR_DEDUP,
    "op10_chat": CHAT,
    "op13_prefix_trie": PREFIX_TRIE,
}
