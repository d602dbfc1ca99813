"""DuckDB statements for the corpus queries that SQL can express."""

OP4 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 80 * ((SELECT n FROM n WHERE n.doc_id = a.doc_id) + (SELECT n FROM n WHERE n.doc_id = b.doc_id) - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
sets AS (SELECT doc_id, hash(list_sort(list(g))) AS s FROM g GROUP BY doc_id),
classes AS (SELECT s, min(doc_id) AS class_id FROM sets GROUP BY s)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.class_id, w.doc_id) AS class_id, r.component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN sets USING (doc_id) LEFT JOIN classes c ON c.s = sets.s
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = w.doc_id
"""

#: The steps of OP4 down to links and classes, without the recursive one.
OP4_LINKS = (
    OP4[: OP4.index("reach AS")]
    + OP4[OP4.index("sets AS") : OP4.index("SELECT w.doc_id, coalesce")].rstrip()
    + """,
of AS (SELECT DISTINCT coalesce(c.class_id, w.doc_id) AS class_id FROM w LEFT JOIN sets USING (doc_id) LEFT JOIN classes c ON c.s = sets.s)
SELECT of.class_id, count(l.b) AS n_links
FROM of LEFT JOIN (SELECT * FROM links WHERE b IN (SELECT class_id FROM of)) l ON l.a = of.class_id GROUP BY of.class_id
"""
)

OP5 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r AS r, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.r <> c.r)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

OP10 = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
i AS (
  SELECT DISTINCT item_id, least(len(w), 5) AS n, unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' '))) AS g
  FROM b WHERE len(w) > 0),
sized AS (SELECT *, count(*) OVER (PARTITION BY item_id) AS n_item FROM i),
d AS (
  SELECT DISTINCT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g
  FROM w, (SELECT DISTINCT n FROM i) WHERE len(w) >= n)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_item) AS n_item, round(count(*) / any_value(n_item), 9) AS containment
FROM d JOIN sized USING (n, g) GROUP BY doc_id, item_id HAVING count(*) >= ceil(any_value(n_item) * 0.8)
"""

ORACLES: dict[str, str] = {"op4_ngram_join": OP4, "op4_ngram_links": OP4_LINKS, "op5_topk": OP5, "op10_decontaminate": OP10}
