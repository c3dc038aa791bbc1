"""DuckDB statements for the numbered queries that SQL can express."""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

OP1 = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id
      WHERE isfinite(list_cosine_similarity(a.e, b.e)) AND list_cosine_similarity(a.e, b.e) >= 0.9),
r(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY 1),
n AS (SELECT x, count(*) AS n_links FROM l GROUP BY 1)
SELECT c.x AS vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, c.x = c.component_id AS kept FROM c LEFT JOIN n ON n.x = c.x"""

OP3 = """
WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
w AS (SELECT text FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(DISTINCT source) >= 5),
x AS (SELECT d.*, w.text IS NOT NULL AS wide FROM d LEFT JOIN w ON w.text = d.text),
l AS (SELECT doc_id, source, wide, i, lines[i] AS line, trim(lines[i], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS k
      FROM (SELECT doc_id, source, wide, lines, unnest(range(1, len(lines) + 1)) AS i FROM x)),
b AS (SELECT k, count(DISTINCT CASE WHEN NOT wide THEN source END) >= 5 AS apart FROM l WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT source) >= 5),
h AS (SELECT l.doc_id, l.i, l.line, b.k IS NOT NULL AND (b.apart OR NOT l.wide) AS hit FROM l LEFT JOIN b ON b.k = l.k),
m AS (SELECT doc_id, count(*) FILTER (WHERE hit) AS n, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT hit), '') AS kept FROM h GROUP BY 1)
SELECT d.doc_id, d.source, CASE WHEN m.n > 0 THEN m.n ELSE 0 END AS n_removed, CASE WHEN m.n > 0 THEN m.kept ELSE d.text END AS text
FROM d LEFT JOIN m ON m.doc_id = d.doc_id"""

OP7 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                          ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
r(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY 1)
SELECT c.x AS doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM c LEFT JOIN n ON n.doc_id = c.x"""
