"""DuckDB twins of the queries that SQL can express: name -> SQL."""

from __future__ import annotations

from salesq.llm import pivot_index, url_filter

ORACLE: dict[str, str] = {}

ORACLE["op3_pivot_near_dup"] = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= CAST({pivot_index.COSINE} AS DOUBLE)),
reach AS (
  SELECT vec_id AS s, vec_id AS t FROM embeddings
  UNION SELECT r.s, l.b FROM reach r JOIN links l ON r.t = l.a),
least AS (SELECT s AS vec_id, min(t) AS component_id FROM reach GROUP BY s),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, m.component_id, e.vec_id = m.component_id AS kept
FROM embeddings e JOIN least m ON e.vec_id = m.vec_id LEFT JOIN counts c ON e.vec_id = c.vec_id"""


def _url_sql() -> str:
    u = url_filter
    depth = u.DEPTH
    rule = "NULL"
    for verdict, r in sorted(u.RULES, key=lambda x: (len(x[1]), x[1].find("/"))):
        host, slash, tail = r.partition("/")
        rule = (f"CASE WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{tail}') "
                f"THEN '{r}|{verdict}' ELSE {rule} END")
    parts = ["""
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages)""", """
cut AS (SELECT page_id, regexp_extract(r, '^([^/?#]*)', 1) AS raw_host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest)""",
             f"""
parsed AS (SELECT page_id, translate(raw_host, '{u._UPPER}', '{u._LOWER}') AS host, path,
                  regexp_replace(path, '[0-9]+', '0', 'g') AS shape FROM cut)""", """
marks AS (
  SELECT p.page_id, max(CAST(l.quality = 0 AS INTEGER)) AS reject
  FROM (SELECT page_id, TRY_CAST(regexp_extract(path, '/([0-9]{1,18})[^0-9]*$', 1) AS BIGINT) AS doc_id FROM cut) p
  JOIN labels l ON p.doc_id = l.doc_id WHERE l.quality IS NOT NULL AND p.page_id IS NOT NULL GROUP BY p.page_id)""", """
paths AS (
  SELECT host, shape, count(m.reject) AS labelled, coalesce(sum(m.reject), 0) AS rejected,
         string_split(shape, '/') AS p
  FROM parsed LEFT JOIN marks m ON parsed.page_id = m.page_id GROUP BY host, shape)""", f"""
t0 AS (SELECT host, shape, labelled, rejected, '' AS parent, '' AS template,
              CASE WHEN len(p) > {depth + 1} THEN list_concat(p[1:{depth}], [array_to_string(p[{depth + 1}:], '/')]) ELSE p END AS parts
       FROM paths)"""]
    for k in range(1, depth + 1):
        parts.append(f"""
w{k} AS (SELECT host, template FROM t{k - 1} WHERE len(parts) > {k} GROUP BY host, template
       HAVING count(DISTINCT parts[{k + 1}]) > {u.CHILDREN})""")
        parts.append(f"""
t{k} AS (SELECT t.host, shape, labelled, rejected, parts, CASE WHEN len(parts) > {k} THEN t.template ELSE parent END AS parent,
              t.template || CASE WHEN len(parts) <= {k} THEN '' WHEN w.host IS NOT NULL THEN '/*' ELSE '/' || parts[{k + 1}] END AS template
       FROM t{k - 1} t LEFT JOIN w{k} w ON t.host = w.host AND t.template = w.template)""")
    s = f"CAST({u.SMOOTH} AS DOUBLE)"
    parts += [f"""
leaves AS (SELECT host, parent, template, sum(labelled) AS labelled, sum(rejected) AS rejected FROM t{depth} GROUP BY ALL)""", """
ups AS (SELECT host, parent, sum(labelled) AS l, sum(rejected) AS r FROM leaves GROUP BY ALL)""", """
hosts AS (SELECT host, sum(labelled) AS l, sum(rejected) AS r FROM leaves GROUP BY host)""", """
whole AS (SELECT CAST(sum(rejected) AS DOUBLE) / greatest(sum(labelled), 1) AS rate FROM leaves)""", f"""
near AS (
  SELECT f.*, u.l AS up_l, u.r AS up_r,
         abs(f.rejected - f.labelled * (CAST(u.r AS DOUBLE) / greatest(u.l, 1)))
           <= CAST({u.SIMILAR} AS DOUBLE) * sqrt(f.labelled * (CAST(u.r AS DOUBLE) / greatest(u.l, 1))
                                                 * (1 - CAST(u.r AS DOUBLE) / greatest(u.l, 1))) + CAST(1e-9 AS DOUBLE) AS alike
  FROM leaves f JOIN ups u ON f.host = u.host AND f.parent = u.parent)""", """
pools AS (SELECT host, parent, sum(labelled) AS l, sum(rejected) AS r FROM near WHERE alike GROUP BY ALL)""", f"""
prior AS (SELECT n.*, (n.up_r + {s} * ((h.r + {s} * w.rate) / (h.l + {s}))) / (n.up_l + {s}) AS up_purity, p.l AS pool_l, p.r AS pool_r
          FROM near n JOIN hosts h ON n.host = h.host CROSS JOIN whole w
          LEFT JOIN pools p ON n.host = p.host AND n.parent = p.parent)""", f"""
judged AS (SELECT host, parent, template, CASE WHEN alike THEN (pool_r + {s} * up_purity) / (pool_l + {s})
                                               ELSE (rejected + {s} * up_purity) / (labelled + {s}) END AS purity FROM prior)""", f"""
ruled AS (SELECT page_id, host, path, shape, {rule} AS rule FROM parsed)"""]
    return "WITH " + ",".join(parts) + f"""
SELECT page_id, r.host, path, CASE WHEN rule IS NOT NULL THEN string_split(rule, '|')[1] END AS rule,
       CASE WHEN rule IS NOT NULL THEN string_split(rule, '|')[2] WHEN purity > CAST({u.PURITY} AS DOUBLE) THEN 'block' ELSE 'allow' END AS verdict,
       t.template, round(purity, 6) AS purity
FROM ruled r JOIN t{depth} t ON r.host = t.host AND r.shape = t.shape
JOIN judged j ON t.host = j.host AND t.parent = j.parent AND t.template = j.template"""


ORACLE["op9_url_filter"] = _url_sql()
