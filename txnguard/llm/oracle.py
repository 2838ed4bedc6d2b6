"""DuckDB twins of the registered text queries that SQL can express."""

from __future__ import annotations

# Words: A-Z lower-cased, then runs of digits, lower-case letters and characters from U+0080 on.
_WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[0-9a-z\\x{80}-\\x{10FFFF}]+')"""

DECONTAMINATION = f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, list_slice(w, p + 1, p + 10) AS x
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 9, 1))) AS p FROM items WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT len(x) AS n FROM windows),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
places AS (
  SELECT r, n, p, list_slice(w, p + 1, p + n) AS x
  FROM (SELECT r, w, n, unnest(range(0, len(w) - n + 1)) AS p FROM docs CROSS JOIN sizes WHERE len(w) >= n)
),
found AS (SELECT r, p, n, item_id FROM places JOIN windows USING (x)),
hit AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM found) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT r, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""


def oracle_sql() -> dict[str, str]:
    return {"op5_decontamination": DECONTAMINATION}
