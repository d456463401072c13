"""Expected results of the registered queries as DuckDB SQL over the tables.

None of the statements sees the rendered files: they compute the rows straight
from the tables the files were rendered from.
"""

from __future__ import annotations

BLANKS = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

_TEXT_FILES = """
files AS (
  SELECT doc_id, text,
         ['.yaml', '.json', '.sql', '.py', '.md'][CAST(doc_id % 5 AS INTEGER) + 1] AS ext,
         '/repo/' || source || '/' || doc_id AS stem
  FROM documents)
"""

_ORDERS = """
sized AS (
  SELECT l.*, l_partkey % (1 + count(*) OVER (PARTITION BY l_orderkey) // 1000) AS file_no
  FROM lineitem l),
line AS (
  SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY l_orderkey, file_no) AS n_lines
  FROM sized
  WINDOW w AS (PARTITION BY l_orderkey, file_no ORDER BY l_linenumber, l_partkey, l_suppkey,
               l_extendedprice, l_shipdate, l_returnflag, l_linestatus)),
part_file AS (SELECT l_orderkey, file_no, count(*) AS n_lines FROM sized GROUP BY ALL),
ord AS (
  SELECT o_orderkey, o_custkey, o_orderpriority, c_name, coalesce(file_no, 0) AS file_no,
         coalesce(n_lines, 0) AS n_lines, 'order_' || o_orderkey AS dag_id,
         '0 5 * * ' || (o_custkey % 7) AS schedule
  FROM orders JOIN customer ON o_custkey = c_custkey
  LEFT JOIN part_file ON l_orderkey = o_orderkey)
"""

_ORDER_PATH = "'/dags/order_' || o_orderkey || '_' || file_no || '.yaml'"

_BATCHES = _ORDERS + """,
flagged AS (
  SELECT *, '/dags/batch_' || (o_orderkey // 5) || '_' || file_no || '.yaml' AS source,
         min(CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey END)
           OVER (PARTITION BY o_orderkey // 5, file_no) AS first_bad
  FROM ord),
kept AS (
  SELECT *, 1 + coalesce(sum(1 + n_lines) OVER (PARTITION BY source ORDER BY o_orderkey
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_ordinal
  FROM flagged WHERE first_bad IS NULL OR o_orderkey < first_bad)
"""

_DICTIONARY = """
dict AS (
  SELECT c.*, n_name, r_name, '/dict/' || n_name || '_' || (c_custkey // 1000) || '.json' AS source,
         row_number() OVER (PARTITION BY n_name, c_custkey // 1000 ORDER BY c_custkey DESC) AS n,
         CASE WHEN c_custkey % 7 = 0 THEN 'N/A' WHEN c_custkey % 5 = 0 THEN 'None'
              ELSE c_mktsegment END AS description
  FROM customer c JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)
"""

_SCRIPTS = """
names AS (
  SELECT p_partkey AS k, '/sql/' || p_partkey || '.sql' AS source,
         'brand_' || regexp_extract(p_brand, '[0-9]+') || '.size_' || p_size AS first_table,
         'types.' || lower(p_type) AS second_table
  FROM part),
scripts AS (
  SELECT *, k % 3 = 0 AND k % 10 = 3 AS cut,
         CASE WHEN k % 3 = 0 AND k % 10 = 3 THEN 'with c as (select * from ' || first_table
              WHEN k % 3 = 0 THEN 'with c as (select * from ' || first_table
                                  || ') select * from c join ' || second_table
              ELSE 'select 1 from ' || first_table || ' x join ' || second_table || ' y'
         END AS query
  FROM names)
"""

_PY = """
py AS (SELECT *, '/py/' || p_partkey || '.py' AS source FROM part)
"""

_WEIGHTS = """
tok AS (
  SELECT doc_id, unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}_]+')) AS term
  FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok WHERE term <> '' GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
size AS (SELECT count(*) + 1.0::DOUBLE AS n FROM documents),
raw AS (
  SELECT doc_id, term, tf * ln(n / (df + 1)) AS w FROM tf JOIN df USING (term) CROSS JOIN size),
weights AS (
  SELECT doc_id, term,
         coalesce(w / nullif(sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 0), 0) AS weight
  FROM raw)
"""

_TEXT_TOPK = _WEIGHTS + """,
qtok AS (
  SELECT item_id, unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}_]+')) AS term
  FROM benchmark),
qtf AS (SELECT item_id, term, count(*) AS tf FROM qtok WHERE term <> '' GROUP BY ALL),
qraw AS (
  SELECT item_id, term, tf * ln(n / (coalesce(df, 0) + 1)) AS w
  FROM qtf LEFT JOIN df USING (term) CROSS JOIN size),
qweights AS (
  SELECT item_id, term,
         coalesce(w / nullif(sqrt(sum(w * w) OVER (PARTITION BY item_id)), 0), 0) AS weight
  FROM qraw),
scored AS (
  SELECT item_id AS query_id, doc_id AS row_id, round(sum(q.weight * d.weight), 6) AS score
  FROM qweights q JOIN weights d USING (term) GROUP BY ALL),
topk AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id)
                        AS INTEGER) AS rank, row_id, score
  FROM scored WHERE score > 0 QUALIFY rank <= 5)
"""

_PAIRS = """
cosine AS (
  SELECT q.vec_id AS query_id, q.label AS q_label, d.vec_id AS row_id, d.label,
         round(list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), 6) AS score
  FROM embeddings q, embeddings d)
"""

_VECTOR_TOPK = _PAIRS + """,
topk AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id)
                        AS INTEGER) AS rank, row_id, score
  FROM cosine QUALIFY rank <= 5)
"""

_VECTOR_TOPK_L2 = """
WITH pairs AS (
  SELECT q.vec_id AS query_id, d.vec_id AS row_id,
         0.0 - round(list_distance(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), 6) AS score
  FROM embeddings q, embeddings d)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id)
                      AS INTEGER) AS rank, row_id, score
FROM pairs QUALIFY rank <= 5
"""

_MMR_STEPS = ", ".join(
    f"""
near{i} AS (
  SELECT c.query_id, c.row_id, c.score, c.rank, max(a.alike) AS near
  FROM cand c JOIN pick{i - 1} p ON p.query_id = c.query_id
  JOIN alike a ON a.query_id = c.query_id AND a.x = c.row_id AND a.y = p.row_id
  GROUP BY c.query_id, c.row_id, c.score, c.rank),
gain{i} AS (
  SELECT n.*, round(0.5 * n.score - 0.5 * near, 9) AS gain
  FROM near{i} n LEFT JOIN pick{i - 1} p ON p.query_id = n.query_id AND p.row_id = n.row_id
  WHERE p.row_id IS NULL),
pick{i} AS (
  SELECT * FROM pick{i - 1}
  UNION ALL
  SELECT query_id, row_id, score, {i} FROM gain{i}
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY gain DESC, rank) = 1)"""
    for i in range(2, 9)
)

_MMR = _PAIRS + f""",
cand AS (
  SELECT query_id, row_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id) AS rank
  FROM cosine QUALIFY rank <= 20),
alike AS (
  SELECT a.query_id, a.row_id AS x, b.row_id AS y, c.score AS alike
  FROM cand a JOIN cand b ON a.query_id = b.query_id
  JOIN cosine c ON c.query_id = a.row_id AND c.row_id = b.row_id),
pick1 AS (SELECT query_id, row_id, score, 1 AS step FROM cand WHERE rank = 1),
{_MMR_STEPS}
"""

_GOLDEN = """
golden AS (
  SELECT vec_id AS query_id, unnest(CASE WHEN vec_id % 3 = 0 THEN [vec_id, vec_id + 1]
                                         ELSE [vec_id] END) AS row_id
  FROM embeddings)
"""

# Pieces of a text at each border, the long ones again at the next. Consecutive short pieces
# are a run; a recursive step finds where the next chunk of a run ends and where the one after it
# begins. A long piece without borders is cut into windows.
_CHUNKS = """
texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g') AS text FROM documents),
l0 AS (
  SELECT doc_id, i AS a, 0 AS b, 0 AS c, piece FROM (
    SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i,
           CASE WHEN i = 1 THEN part ELSE chr(10) || chr(10) || part END AS piece
    FROM (SELECT doc_id, string_split(text, chr(10) || chr(10)) AS parts FROM texts))
  WHERE piece <> ''),
l1 AS (
  SELECT doc_id, a, i AS b, 0 AS c, piece FROM (
    SELECT doc_id, a, unnest(parts) AS part, generate_subscripts(parts, 1) AS i,
           CASE WHEN i = 1 THEN part ELSE chr(10) || part END AS piece
    FROM (SELECT doc_id, a, string_split(piece, chr(10)) AS parts FROM l0 WHERE length(piece) >= 1000))
  WHERE piece <> ''),
l2 AS (
  SELECT doc_id, a, b, i AS c, piece FROM (
    SELECT doc_id, a, b, unnest(parts) AS part, generate_subscripts(parts, 1) AS i,
           CASE WHEN i = 1 THEN part ELSE ' ' || part END AS piece
    FROM (SELECT doc_id, a, b, string_split(piece, ' ') AS parts FROM l1 WHERE length(piece) >= 1000))
  WHERE piece <> ''),
leaves AS (
  SELECT *, 0 AS level FROM l0 UNION ALL SELECT *, 1 FROM l1 UNION ALL SELECT *, 2 FROM l2),
short AS (
  SELECT *, row_number() OVER w - count(*) FILTER (short) OVER w AS run FROM (
    SELECT *, length(piece) < 1000 AS short,
           [level, CASE WHEN level > 0 THEN a END, CASE WHEN level > 1 THEN b END] AS parent
    FROM leaves)
  WINDOW w AS (PARTITION BY doc_id, parent ORDER BY a, b, c)),
placed AS (
  SELECT doc_id, parent, run, a, b, c, piece, row_number() OVER w AS k,
         sum(length(piece)) OVER w AS upto, sum(length(piece)) OVER w - length(piece) AS since
  FROM short WHERE short
  WINDOW w AS (PARTITION BY doc_id, parent, run ORDER BY a, b, c)),
numbered AS (
  SELECT *, dense_rank() OVER (ORDER BY doc_id, parent, run) AS r,
         count(*) OVER (PARTITION BY doc_id, parent, run) AS n
  FROM placed),
cut AS (
  SELECT r, 1::BIGINT AS head, 0::BIGINT AS tail, 1::BIGINT AS next_head, n, 1::BIGINT AS seen
  FROM numbered WHERE k = 1
  UNION ALL
  SELECT r, head, tail, next_head, n, seen FROM (
    SELECT x.r, x.next_head AS head, coalesce(x.last - 1, x.n) AS tail, x.n,
           coalesce(x.last, x.n + 1) AS seen,
           CASE WHEN x.last IS NULL THEN x.n + 1 ELSE (
             SELECT min(p.k) FROM numbered p
             WHERE p.r = x.r AND p.k >= x.next_head
               AND (p.k = x.last OR (x.begin_ - p.since <= 200 AND x.end_ - p.since <= 1000))) END
             AS next_head
    FROM (
      SELECT s.r, s.next_head, s.n, min(p.k) AS last, min(p.since) AS begin_, min(p.upto) AS end_
      FROM cut s JOIN numbered f ON f.r = s.r AND f.k = s.next_head
      LEFT JOIN numbered p ON p.r = s.r AND p.k >= s.seen AND p.k > s.next_head + 0
                          AND p.upto - f.since > 1000
      WHERE s.next_head <= s.n GROUP BY s.r, s.next_head, s.n) x)),
runs AS (
  SELECT doc_id, min(a) AS a, min(b) AS b, min(c) AS c, head AS i,
         string_agg(piece, '' ORDER BY k) AS chunk
  FROM cut JOIN numbered USING (r) WHERE tail > 0 AND k BETWEEN head AND tail
  GROUP BY doc_id, r, head, tail),
windows AS (
  SELECT doc_id, a, b, c, i, substring(piece, i * 800 + 1, 1000) AS chunk
  FROM (SELECT *, unnest(range(greatest(CAST(ceil((length(piece) - 1000) / 800.0) AS BIGINT), 0) + 1)) AS i
        FROM l2 WHERE length(piece) >= 1000)),
chunks AS (
  SELECT doc_id, a, b, c, i, regexp_replace(chunk, '^[BLANKS]+|[BLANKS]+$', '', 'g') AS chunk
  FROM (SELECT * FROM runs UNION ALL SELECT * FROM windows))
""".replace("BLANKS", BLANKS)

_CHUNK_RECURSIVE = f"""
WITH RECURSIVE {_CHUNKS}
SELECT '/text/' || doc_id || '.md' AS source,
       CAST(row_number() OVER (PARTITION BY doc_id ORDER BY a, b, c, i) - 1 AS INTEGER) AS ordinal,
       chunk AS page_content
FROM chunks WHERE chunk <> ''
"""

ORACLES = {
    "raw_documents": f"""
WITH {_TEXT_FILES}
SELECT stem || ext AS source,
       CASE WHEN ext = '.yaml' THEN 'raw:' || stem || ext END AS doc_id,
       CASE WHEN ext = '.sql' THEN
         regexp_replace(replace(text, '-- Databricks notebook source', ''),
                        '^[{BLANKS}]+|[{BLANKS}]+$', '', 'g')
       ELSE text END AS page_content
FROM (SELECT * REPLACE (regexp_replace(text, '\\r\\n?', chr(10), 'g') AS text) FROM files)
WHERE ext <> '.md'
""",
    "ext_dispatch_counts": f"""
WITH {_TEXT_FILES}
SELECT ext, count(*) AS n_files,
       CAST(sum(length(regexp_replace(text, '\\r\\n?', chr(10), 'g'))) AS BIGINT) AS n_chars
FROM files GROUP BY ext
""",
    "dag_summary_docs": f"""
WITH {_ORDERS}
SELECT {_ORDER_PATH} AS source, CAST(1 AS INTEGER) AS ordinal,
       dag_id || ':__DAG_SUMMARY__' AS doc_id,
       'This document describes the DAG configuration with ID ''' || dag_id
         || '''. The owner is ''' || c_name || ''', it runs on schedule: ''' || schedule
         || ''', and its description is: ''' || o_orderpriority || '''.' AS page_content,
       dag_id, c_name AS owner, schedule, o_orderpriority AS dag_description
FROM ord
""",
    "dag_edges": f"""
WITH {_ORDERS}
SELECT '/dags/order_' || l_orderkey || '_' || file_no || '.yaml' AS path,
       CAST(0 AS INTEGER) AS doc_idx, 'order_' || l_orderkey AS dag_id,
       CAST(0 AS INTEGER) AS flow_idx, CAST(n - 1 AS INTEGER) AS pair_idx,
       'line_' || n AS up, 'line_' || (n + 1) AS down
FROM line WHERE n < n_lines
""",
    "dag_task_docs": f"""
WITH {_ORDERS}
SELECT '/dags/order_' || l_orderkey || '_' || l.file_no || '.yaml' AS source,
       CAST(n + 1 AS INTEGER) AS ordinal, dag_id || ':line_' || n AS doc_id,
       'The DAG ''' || dag_id || ''' contains a task named ''line_' || n
         || '''. This task uses the ''' || l_returnflag || ''' operator and runs the script '''
         || CASE WHEN l_linestatus = 'O' THEN 'not specified' ELSE 'part_' || l_partkey || '.py' END
         || '''.'
         || CASE WHEN n > 1 THEN ' It runs after the following task(s): line_' || (n - 1) || '.'
                 ELSE '' END
         || CASE WHEN n < l.n_lines
                 THEN ' It runs before the following task(s): line_' || (n + 1) || '.' ELSE '' END
         AS page_content,
       'line_' || n AS task_name, l_returnflag AS operator,
       CASE WHEN l_linestatus = 'O' THEN 'not specified' ELSE 'part_' || l_partkey || '.py' END
         AS script_file,
       c_name AS owner
FROM line l JOIN ord ON l_orderkey = o_orderkey AND l.file_no = ord.file_no
""",
    "dag_by_schedule": f"""
WITH {_ORDERS}
SELECT dag_id, c_name AS owner FROM ord WHERE o_custkey % 7 = 1
""",
    "dag_fault_prefix": f"""
WITH {_BATCHES}
SELECT source, CAST(0 AS INTEGER) AS ordinal, 'raw' AS kind, 'raw:' || source AS doc_id
FROM (SELECT DISTINCT source FROM flagged)
UNION ALL
SELECT source, CAST(first_ordinal AS INTEGER), 'dag_summary', dag_id || ':__DAG_SUMMARY__' FROM kept
UNION ALL
SELECT source, CAST(first_ordinal + n AS INTEGER), 'dag_task', dag_id || ':line_' || n
FROM kept JOIN line l ON l_orderkey = o_orderkey AND l.file_no = kept.file_no
""",
    "file_warnings": f"""
WITH {_BATCHES}
SELECT DISTINCT source AS path, 'unexpected' AS class FROM flagged WHERE first_bad IS NOT NULL
UNION ALL
SELECT '/py/' || p_partkey || '.py', 'unexpected' FROM part WHERE p_partkey % 11 = 0
""",
    "table_function_docs": """
WITH file AS (SELECT *, '/settings/' || s_suppkey || '.ini' AS source FROM supplier)
SELECT source, 0::INTEGER AS ordinal, 'section' AS kind, 'supplier' AS doc_id,
       NULL::VARCHAR AS content_type, 'Section ''supplier'' sets name, nation.' AS page_content
FROM file
UNION ALL
SELECT source, 1::INTEGER, 'section', 'level ' || (s_suppkey % 3), NULL,
       'Section ''level ' || (s_suppkey % 3) || ''' sets depth.' FROM file
UNION ALL
SELECT source, 2::INTEGER, 'warning', NULL, 'unexpected', 'no value: without value'
FROM file WHERE s_suppkey % 7 = 0
""",
    "dag_shapes": """
WITH file AS (SELECT *, s_suppkey % 4 AS shape, '/shapes/' || s_suppkey || '.yaml' AS source FROM supplier),
dags AS (
  SELECT *, CASE shape WHEN 1 THEN 'N/A' WHEN 2 THEN 'None' ELSE 's_' || s_suppkey END AS dag_id,
         CASE shape WHEN 0 THEN 'own_' || s_nationkey WHEN 2 THEN 'None' ELSE 'N/A' END AS owner,
         CASE shape WHEN 0 THEN '@daily' WHEN 2 THEN 'None' ELSE 'N/A' END AS schedule,
         CASE shape WHEN 0 THEN 'fork' WHEN 2 THEN 'None'
                    ELSE 'No description provided.' END AS description
  FROM file),
tasks(shape, n, task, operator, script, after, before) AS (VALUES
  (0, 2, 'a', 'o', 'f.py', '', 'b, c'), (0, 3, 'b', 'o', 'not specified', 'a', 'd'),
  (0, 4, 'c', 'unknown', 'c.py', 'a', 'd'), (0, 5, 'd', 'unknown', 'not specified', 'b, c', ''),
  (1, 2, 't', 'unknown', 'not specified', '', ''), (2, 2, 't', 'None', 'None', '', ''),
  (3, 2, 'a', 'unknown', 'not specified', '', ''), (3, 3, 'b', 'unknown', 'not specified', '', ''))
SELECT source, 1::INTEGER AS ordinal, 'dag_summary' AS kind, dag_id || ':__DAG_SUMMARY__' AS doc_id,
       'This document describes the DAG configuration with ID ''' || dag_id || '''. The owner is '''
         || owner || ''', it runs on schedule: ''' || schedule || ''', and its description is: '''
         || description || '''.' AS page_content
FROM dags
UNION ALL
SELECT source, n::INTEGER, 'dag_task', dag_id || ':' || task,
       'The DAG ''' || dag_id || ''' contains a task named ''' || task || '''. This task uses the '''
         || operator || ''' operator and runs the script ''' || script || '''.'
         || CASE WHEN after <> '' THEN ' It runs after the following task(s): ' || after || '.' ELSE '' END
         || CASE WHEN before <> '' THEN ' It runs before the following task(s): ' || before || '.' ELSE '' END
FROM dags JOIN tasks USING (shape)
""",
    "nested_file_docs": """
WITH file AS (
  SELECT *, '/nested/' || s_suppkey || '.yaml' AS source, s_suppkey % 8 >= 5 AS large FROM supplier)
SELECT source, 0::INTEGER AS ordinal, 'raw' AS kind, 'raw:' || source AS doc_id,
       NULL::VARCHAR AS content_type FROM file
UNION ALL
SELECT source, 1::INTEGER, CASE WHEN large THEN 'warning' ELSE 'dag_summary' END,
       CASE WHEN NOT large THEN s_name || ':__DAG_SUMMARY__' END,
       CASE WHEN large THEN 'too_large' END FROM file
""",
    "dictionary_table_docs": f"""
WITH {_DICTIONARY}
SELECT DISTINCT source, CAST(1 AS INTEGER) AS ordinal,
       'This document describes the table ''' || n_name || ''' in the schema ''' || r_name
         || '''. Description: N/A' AS page_content,
       r_name AS schema, n_name AS "table", 'N/A' AS table_description
FROM dict
""",
    "dictionary_column_docs": f"""
WITH {_DICTIONARY}
SELECT source, CAST(n + 1 AS INTEGER) AS ordinal,
       'In table ''' || n_name || ''', column ''' || c_name || ''' has the description: '
         || description AS page_content,
       r_name AS schema, n_name AS "table", c_name AS "column"
FROM dict
""",
    "dictionary_rich_docs": f"""
WITH {_DICTIONARY}
SELECT DISTINCT source, 'table' AS kind, r_name || '.' || n_name AS "table",
       CAST(NULL AS VARCHAR) AS "column",
       'This document describes the table ''' || r_name || '.' || n_name
         || '''. Description: N/A The primary key(s) are: id, block. The data is sourced from the '
         || 'following locations: lake.' || lower(n_name) || '.' AS page_content
FROM dict
UNION ALL
SELECT source, 'column', r_name || '.' || n_name, c_name,
       'In table ''' || r_name || '.' || n_name || ''', the column ''' || c_name || ''''
         || CASE WHEN c_custkey % 3 = 0 THEN ' has type ''string'', a max length of ''25'', '
                 || 'a PII confidentiality impact level of ''low''' ELSE '' END
         || '. Description: ' || description
FROM dict
""",
    "sql_main_query": f"""
WITH {_SCRIPTS}
SELECT source AS path, query AS main_query FROM scripts
""",
    "sql_lineage": f"""
WITH {_SCRIPTS}
SELECT source, 'This SQL script reads from the following tables: ' || first_table
         || CASE WHEN cut THEN '' ELSE ', ' || second_table END || '.' AS page_content,
       'sql_summary' AS content_type
FROM scripts
""",
    "sql_table_readers": f"""
WITH {_SCRIPTS}
SELECT table_name, count(*) AS n_scripts, CAST(sum(position) AS BIGINT) AS sum_position
FROM (SELECT first_table AS table_name, 0 AS position FROM scripts
      UNION ALL SELECT second_table, 1 FROM scripts WHERE NOT cut)
GROUP BY table_name
""",
    "sql_lineage_shapes": """
WITH named AS (
  SELECT p_partkey, '/shapes/' || p_partkey || '.sql' AS source,
         'lake.part_' || p_partkey AS a, 'types.' || lower(p_type) AS b FROM part)
SELECT source, 'This SQL script reads from the following tables: '
         || CASE p_partkey % 6 WHEN 4 THEN b || ', ' || a WHEN 5 THEN a ELSE a || ', ' || b END
         || '.' AS page_content
FROM named
""",
    "python_imports": f"""
WITH {_PY}
SELECT source, 'This Python script imports the following libraries: '
         || array_to_string(list_sort(['lib_' || (p_size % 7), 'lib_' || (p_size % 5) || '.sub',
                                       'pkg_' || (p_size % 3)]), ', ') || '.' AS page_content,
       'python_summary' AS content_type
FROM py WHERE p_partkey % 11 <> 0
""",
    "python_functions": f"""
WITH {_PY}
SELECT source, CAST(2 AS INTEGER) AS ordinal,
       'Function ''f_' || p_partkey || ''': '
         || CASE WHEN p_partkey % 4 = 0 THEN 'No docstring provided.' ELSE p_name END
         AS page_content,
       'f_' || p_partkey AS function_name
FROM py WHERE p_partkey % 11 <> 0 AND p_partkey % 6 <> 0
""",
    "union_hybrid": f"""
WITH {_BATCHES}, {_DICTIONARY},
counted AS (
  SELECT 'raw' AS kind, true AS has_id, count(*) AS n FROM ord
  UNION ALL SELECT 'dag_summary', true, count(*) FROM ord
  UNION ALL SELECT 'dag_task', true, count(*) FROM lineitem
  UNION ALL SELECT 'raw', true, count(DISTINCT source) FROM flagged
  UNION ALL SELECT 'dag_summary', true, count(*) FROM kept
  UNION ALL SELECT 'dag_task', true, coalesce(sum(n_lines), 0) FROM kept
  UNION ALL SELECT 'raw', false, count(DISTINCT source) FROM dict
  UNION ALL SELECT 'table', false, count(DISTINCT source) FROM dict
  UNION ALL SELECT 'column', false, count(*) FROM dict
  UNION ALL SELECT 'raw', false, 2 * count(*) FROM part
  UNION ALL SELECT 'sql_summary', false, count(*) FROM part
  UNION ALL SELECT 'python_summary', false, count(*) FROM part WHERE p_partkey % 11 <> 0
  UNION ALL SELECT 'function', false, count(*) FROM part
            WHERE p_partkey % 11 <> 0 AND p_partkey % 6 <> 0)
SELECT kind, CAST(sum(n) AS BIGINT) AS n_rows,
       CAST(sum(CASE WHEN has_id THEN n ELSE 0 END) AS BIGINT) AS n_doc_ids
FROM counted GROUP BY kind HAVING sum(n) > 0
""",
    "chunk_windows": """
WITH bare AS (SELECT doc_id, regexp_replace(text, '[ \\t\\r\\n]+', '', 'g') AS t FROM documents),
numbered AS (
  SELECT doc_id, t, unnest(range(CASE WHEN length(t) = 0 THEN 0 WHEN length(t) <= 1000 THEN 1
                                 ELSE CAST(ceil((length(t) - 1000) / 800.0) AS BIGINT) + 1 END)) AS i
  FROM bare)
SELECT doc_id, CAST(i AS INTEGER) AS chunk_no, substring(t, i * 800 + 1, 1000) AS chunk
FROM numbered
""",
    "chunk_recursive": _CHUNK_RECURSIVE,
    "chunk_recursive_columns": _CHUNK_RECURSIVE,
    "chunk_coverage": f"""
SELECT doc_id, md5(regexp_replace(text, '[{BLANKS}]+', '', 'g')) AS digest, true AS all_fit
FROM documents
""",
    "tfidf_weights": f"""
WITH {_WEIGHTS}
SELECT doc_id, term, round(weight, 6) AS weight FROM weights
""",
    "text_topk": f"""
WITH {_TEXT_TOPK}
SELECT * FROM topk
""",
    "text_topk_postings": f"""
WITH {_TEXT_TOPK}
SELECT * FROM topk
""",
    "answer_context": f"""
WITH {_TEXT_TOPK}
SELECT query_id, count(*) AS n_rows, string_agg(text, chr(10) || chr(10) ORDER BY rank) AS context,
       array_to_string(list_sort(list_distinct(list(source))), ', ') AS sources
FROM topk JOIN documents ON doc_id = row_id GROUP BY query_id
""",
    "vector_topk_cosine": f"""
WITH {_VECTOR_TOPK}
SELECT * FROM topk
""",
    "vector_topk_cells": f"""
WITH {_VECTOR_TOPK}
SELECT * FROM topk
""",
    "latent_topk": """
WITH tok AS (
  SELECT p_partkey AS id, unnest(string_split_regex(lower(p_name), '[^\\p{L}\\p{N}_]+')) AS term
  FROM part),
tf AS (SELECT id, term, count(*) AS tf FROM tok WHERE term <> '' GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
size AS (SELECT count(*) + 1.0::DOUBLE AS n FROM part),
raw AS (SELECT id, term, tf * ln(n / (df + 1)) AS w FROM tf JOIN df USING (term) CROSS JOIN size),
weights AS (
  SELECT id, term, w / nullif(sqrt(sum(w * w) OVER (PARTITION BY id)), 0) AS weight FROM raw),
near AS (
  SELECT q.id AS query_id, d.id AS row_id, sum(q.weight * d.weight) AS score
  FROM weights q JOIN weights d USING (term) WHERE q.id % 20 = 0 GROUP BY ALL),
scored AS (
  SELECT q.p_partkey AS query_id, d.p_partkey AS row_id, round(coalesce(score, 0), 6) AS score
  FROM part q CROSS JOIN part d
  LEFT JOIN near ON near.query_id = q.p_partkey AND near.row_id = d.p_partkey
  WHERE q.p_partkey % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id)
                      AS INTEGER) AS rank, row_id, score
FROM scored QUALIFY rank <= 40
""",
    "vector_cells_all": f"""
WITH {_VECTOR_TOPK}
SELECT * FROM topk
""",
    "vector_cells_recall": """
SELECT 5 * count(*) AS n_expected, true AS enough FROM embeddings
""",
    "vector_topk_l2": _VECTOR_TOPK_L2,
    "vector_topk_filtered": f"""
WITH {_PAIRS}
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id)
                      AS INTEGER) AS rank, row_id, score
FROM cosine
WHERE CASE WHEN query_id % 2 = 0 THEN label = q_label
           ELSE label IN (q_label, (q_label + 1) % 10) OR label < 2 END
QUALIFY rank <= 1 + query_id % 7
""",
    "question_warnings": """
SELECT vec_id AS query_id, 'invalid_filter' AS class,
       CASE vec_id % 6 WHEN 1 THEN 'filter is not JSON' WHEN 2 THEN 'unknown comparison ''near'''
                       WHEN 3 THEN 'cannot filter on ''owner'''
                       ELSE 'value of ''label'' is not of type int' END AS message
FROM embeddings WHERE vec_id % 6 BETWEEN 1 AND 4
""",
    "answer_all_questions": f"""
WITH {_PAIRS},
found AS (
  SELECT query_id, row_id, label,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id) AS rank
  FROM cosine WHERE query_id % 4 = 3 OR query_id % 4 = 0 AND label = q_label
  QUALIFY rank <= 1 + query_id % 7)
SELECT vec_id AS query_id, count(row_id) AS n_rows,
       coalesce(string_agg('vector ' || row_id, chr(10) || chr(10) ORDER BY rank), '') AS context,
       coalesce(array_to_string(list_sort(list_distinct(list('label ' || found.label)
                FILTER (row_id IS NOT NULL))), ', '), '') AS sources
FROM embeddings LEFT JOIN found ON query_id = vec_id GROUP BY vec_id
""",
    "vector_mmr": f"""
WITH {_MMR}
SELECT query_id, CAST(step AS INTEGER) AS rank, row_id, score FROM pick8
""",
    "retrieval_eval": f"""
WITH {_PAIRS},
ranked AS (
  SELECT query_id, q_label = label AS hit,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id) AS rank
  FROM cosine WHERE query_id <> row_id QUALIFY rank <= 5),
per_question AS (
  SELECT vec_id AS query_id, coalesce(bool_or(hit), false) AS hit,
         coalesce(1.0::DOUBLE / min(CASE WHEN hit THEN rank END), 0) AS reciprocal_rank
  FROM embeddings LEFT JOIN ranked ON query_id = vec_id GROUP BY vec_id),
rates AS (
  SELECT count(*) AS n_questions, round(avg(hit::INTEGER::DOUBLE), 6) AS hit_rate,
         round(avg(reciprocal_rank), 6) AS mrr
  FROM per_question)
SELECT *, hit_rate >= 1.0 AS hit_rate_ok, mrr >= 0.9 AS mrr_ok FROM rates
""",
    "retrieval_must_find": f"""
WITH {_VECTOR_TOPK}, {_GOLDEN}
SELECT query_id, CAST(count(*) - count(topk.row_id) AS INTEGER) AS n_missing,
       count(*) = count(topk.row_id) AS found_all
FROM golden LEFT JOIN topk USING (query_id, row_id) GROUP BY query_id
""",
    "retrieval_golden": f"""
WITH {_VECTOR_TOPK}, {_GOLDEN}
SELECT query_id, count(rank) > 0 AS hit, coalesce(1.0::DOUBLE / min(rank), 0) AS reciprocal_rank
FROM golden LEFT JOIN topk USING (query_id, row_id) GROUP BY query_id
""",
    "index_roundtrip": f"""
WITH {_DICTIONARY},
counted AS (
  SELECT 'raw' AS kind, count(DISTINCT source) AS n FROM dict
  UNION ALL SELECT 'table', count(DISTINCT source) FROM dict
  UNION ALL SELECT 'column', count(*) FROM dict
  UNION ALL SELECT 'raw', count(*) FROM part
  UNION ALL SELECT 'sql_summary', count(*) FROM part)
SELECT kind, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n) AS BIGINT) AS n_ids,
       CAST(sum(n) AS BIGINT) AS n_vectors
FROM counted GROUP BY kind
""",
    "index_update": f"""
WITH {_PY},
left_ AS (
  SELECT source, p_partkey, CASE WHEN p_partkey % 10 = 3 THEN ['altered_' || p_partkey]
           ELSE list_sort(['lib_' || (p_size % 7), 'lib_' || (p_size % 5) || '.sub',
                           'pkg_' || (p_size % 3)]) END AS libraries
  FROM py WHERE p_partkey % 10 <> 4 AND (p_partkey % 10 = 3 OR p_partkey % 11 <> 0)),
texts AS (
  SELECT source, 'This Python script imports the following libraries: '
           || array_to_string(libraries, ', ') || '.' AS page_content FROM left_)
SELECT source, 1::INTEGER AS ordinal, page_content,
       CAST(len(list_distinct(list_filter(string_split_regex(lower(page_content),
            '[^\\p{{L}}\\p{{N}}_]+'), lambda t: t <> ''))) AS INTEGER) AS n_terms
FROM texts
""",
}

ORACLES["index_rows"] = f"""
SELECT source, ordinal, kind, page_content, 1.0::DOUBLE AS norm FROM (
  SELECT source, ordinal, 'table' AS kind, page_content FROM ({ORACLES["dictionary_table_docs"]})
  UNION ALL
  SELECT source, ordinal, 'column', page_content FROM ({ORACLES["dictionary_column_docs"]})
  UNION ALL
  SELECT source, 1::INTEGER, 'sql_summary', page_content FROM ({ORACLES["sql_lineage"]}))
"""
