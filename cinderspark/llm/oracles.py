"""SQL for the operators that SQL can express, over the whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+')"


def _shingles(table: str, key: str, width: int) -> str:
    """key, s: distinct shingles; fewer words than a shingle are one."""
    return f"""SELECT DISTINCT {key}, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i:i + {width - 1}], ' ')) END) AS s
FROM (SELECT {key}, {_WORDS} AS w FROM {table})"""


def _reached(links: str) -> str:
    """node, component from a table of links (a, b), both ways."""
    return f"""r(node, seen) AS (SELECT a, a FROM {links} UNION SELECT r.node, b FROM r JOIN {links} ON seen = a),
c AS (SELECT node, min(seen) AS component FROM r GROUP BY node)"""


EMBEDDINGS = f"""WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE embedding IS NOT NULL),
n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS m FROM v),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM n x JOIN n y ON x.vec_id <> y.vec_id WHERE x.m > 0 AND y.m > 0 AND list_dot_product(x.e, y.e) / (x.m * y.m) >= 0.9),
{_reached('l')}
SELECT vec_id, (SELECT count(*) FROM l WHERE a = vec_id) AS n_links, coalesce(component, vec_id) AS component_id, coalesce(component, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN c ON node = vec_id"""

LEAKS = f"""WITH t AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
i AS (SELECT DISTINCT item_id, least(len(w), 5) AS k, unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' '))) AS s FROM t WHERE len(w) > 0),
n AS (SELECT item_id, count(*) AS n FROM i GROUP BY item_id),
d AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
FROM (SELECT doc_id, {_WORDS} AS w FROM documents), (SELECT DISTINCT CAST(k AS BIGINT) AS k FROM i) WHERE len(w) >= k),
h AS (SELECT doc_id, item_id, count(*) AS k FROM d JOIN i USING (k, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, CAST(k AS INTEGER) AS n_held, CAST(n AS INTEGER) AS n_shingles, CAST(k AS DOUBLE) / n AS containment FROM h JOIN n USING (item_id) WHERE 5 * k >= 4 * n"""

JACCARD = f"""WITH RECURSIVE s AS ({_shingles('documents', 'doc_id', 4)}), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
h AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM h JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id WHERE 100 * k >= 85 * (p.n + q.n - k)),
{_reached('l')}
SELECT documents.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, documents.doc_id) AS component_id
FROM documents LEFT JOIN n ON n.doc_id = documents.doc_id LEFT JOIN c ON node = documents.doc_id"""

# A line's keys: itself without its i-th word, and itself split there; lines of one key are within one edit.
# Rows are told apart by number, so that repeated rows are judged one after the other.
_BLANK = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"
LINES = f"""WITH d AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id NULLS FIRST, text) AS r FROM documents),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM d WHERE text IS NOT NULL),
f AS (SELECT *, string_split(trim(regexp_replace(line, '[\\x09\\x0B-\\x0D ]+', ' ', 'g')), ' ') AS w, row_number() OVER (ORDER BY r, i) AS place FROM l WHERE trim(line, {_BLANK}) <> ''),
u AS (SELECT line, any_value(w) AS w, min(place) AS first FROM f GROUP BY line),
v AS (SELECT first, w FROM u WHERE len(w) >= 5),
k AS (SELECT first, unnest(range(1, len(w) + 1)) AS pos, len(w) - 1 AS m, w FROM v UNION ALL SELECT first, unnest(range(1, len(w) + 2)) AS pos, len(w) AS m, w FROM v),
h AS (SELECT first, pos, m, md5(array_to_string(w[1:pos - 1], ' ') || '|' || array_to_string(CASE WHEN m = len(w) THEN w[pos:] ELSE w[pos + 1:] END, ' ')) AS v FROM k),
e AS (SELECT pos, m, v, min(first) AS head FROM h GROUP BY ALL HAVING count(*) > 1),
near AS (SELECT DISTINCT first FROM h JOIN e USING (pos, m, v) WHERE first > head),
j AS (SELECT f.r, f.i, near.first IS NOT NULL AS near FROM f JOIN u USING (line) LEFT JOIN near ON near.first = u.first WHERE near.first IS NOT NULL OR place <> u.first)
SELECT d.doc_id, CASE WHEN text IS NULL THEN NULL ELSE coalesce((SELECT string_agg(line, chr(10) ORDER BY i) FROM l WHERE l.r = d.r AND NOT EXISTS (FROM j WHERE j.r = l.r AND j.i = l.i)), '') END AS text,
coalesce(len(string_split(text, chr(10))), 0) AS n_lines, (SELECT count(*) FROM j WHERE j.r = d.r AND NOT near) AS n_exact, (SELECT count(*) FROM j WHERE j.r = d.r AND near) AS n_near FROM d"""
