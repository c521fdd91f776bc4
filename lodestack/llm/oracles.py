"""DuckDB SQL for the queries that SQL can express: near-duplicates, embedding duplicates, line dedup."""

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

NEAR_DUPLICATES = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
e AS (SELECT doc_id, unnest(s) AS x FROM s),
n AS (SELECT doc_id, len(s) AS n FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
sym AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS id, doc_id AS reached FROM documents UNION SELECT r.id, sym.b FROM r JOIN sym ON sym.a = r.reached),
c AS (SELECT id, min(reached) AS component FROM r GROUP BY id)
SELECT n.doc_id, n.n AS n_shingles, c.component AS component_id, n.doc_id = c.component AS kept FROM n JOIN c ON c.id = n.doc_id
"""

EMBEDDING_DUPLICATES = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
u AS (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v
  WHERE len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
r AS (SELECT vec_id AS id, vec_id AS reached FROM embeddings UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.reached),
c AS (SELECT id, min(reached) AS component FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, c.component AS component_id, vec_id = c.component AS kept
FROM embeddings JOIN c ON c.id = vec_id LEFT JOIN n ON n.a = vec_id
"""

LINE_DEDUP = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
x AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM d),
k AS (SELECT *, translate(trim(line, {_BLANKS}), '{_UP}', '{_LOW}') AS key FROM x),
f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.keeper AS gone FROM k LEFT JOIN f ON f.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

ORACLES = {"op3_near_duplicates": NEAR_DUPLICATES, "op5_embedding_duplicates": EMBEDDING_DUPLICATES, "op8_line_dedup": LINE_DEDUP}
