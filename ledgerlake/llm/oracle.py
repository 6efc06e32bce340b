"""SQL twins of the operators on shingles and repeated windows, for DuckDB over the view ``documents``.

They form all windows and all pairs that share a shingle, which the operators do not; they are meant for
tables of some megabytes.
"""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return rf"coalesce(regexp_extract_all({text}, '[^\x20\x09-\x0D]+'), [])"


def components(words: int, percent: int, kept: bool = False) -> str:
    """Documents linked by the Jaccard similarity of their ``words``-word shingles."""
    return f"""
WITH RECURSIVE split AS (SELECT doc_id, {_words(f"translate(text, '{UPPER}', '{LOWER}')")} AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {words} THEN [array_to_string(ws, ' ')]
    ELSE list_distinct([array_to_string(ws[i:i + {words - 1}], ' ') FOR i IN range(1, len(ws) - {words - 2})]) END AS grams
  FROM split),
entries AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets),
shared AS (SELECT gram, row_number() OVER () AS k FROM entries GROUP BY gram HAVING count(*) > 1),
numbered AS (SELECT doc_id, n, k FROM entries JOIN shared USING (gram)),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM numbered x JOIN numbered y USING (k)
  WHERE x.doc_id < y.doc_id AND 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= {percent} * (x.n + y.n - count(*))),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, root) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT ways.b, reach.root FROM reach JOIN ways ON ways.a = reach.node)
SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, CAST(min(root) AS BIGINT) AS component_id{
    ", doc_id = min(root) AS kept" if kept else ""}
FROM sets JOIN reach ON node = doc_id GROUP BY doc_id, len(grams)"""


def repeated_words(window: int) -> str:
    """Documents without the words of windows that start more than once."""
    return f"""
WITH split AS (SELECT doc_id, {_words("text")} AS ws FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(ws) - {window - 2})) AS i, ws FROM split),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + {window - 1}], ' ') AS w FROM starts),
repeats AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY w) > 1),
words AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM split),
covered AS (
  SELECT x.doc_id, x.p, x.word, coalesce(max(r.i) OVER (PARTITION BY x.doc_id ORDER BY x.p) > x.p - {window}, false) AS gone
  FROM words x LEFT JOIN repeats r ON r.doc_id = x.doc_id AND r.i = x.p),
folded AS (
  SELECT doc_id, count_if(gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS kept
  FROM covered GROUP BY doc_id)
SELECT split.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN folded USING (doc_id)"""


def repeated_bytes(window: int) -> str:
    """Documents without the bytes of strings of ``window`` bytes that start more than once."""
    return f"""
WITH raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT doc_id, h, len(h) // 2 AS n FROM raw),
starts AS (SELECT doc_id, unnest(range(1, n - {window - 2})) AS i, h FROM sized),
windows AS (SELECT doc_id, i, md5(substring(h, 2 * i - 1, {2 * window})) AS w FROM starts),
repeats AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY w) > 1),
steps AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM repeats),
numbered AS (
  SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + {window} THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY i) AS run FROM steps),
runs AS (SELECT doc_id, run, min(i) AS a, max(i) + {window} AS b FROM numbered GROUP BY doc_id, run),
gaps AS (SELECT doc_id, a, b, lag(b, 1, 1) OVER (PARTITION BY doc_id ORDER BY a) AS since FROM runs),
folded AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
    string_agg(substring(h, 2 * since - 1, 2 * (a - since)), '' ORDER BY a) AS before_last
  FROM gaps JOIN sized USING (doc_id) GROUP BY doc_id)
SELECT sized.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(before_last, '') || substring(h, 2 * coalesce(last, 1) - 1))) AS kept_sha256
FROM sized LEFT JOIN folded USING (doc_id)"""
