"""SQL with the same answers as the registered queries, for comparison in DuckDB."""

from __future__ import annotations

from vicinal.plans.suite import RECALL_FLOORS

PQ_DIM = PQ_WIDTH = 8

_ITEMS = """
items AS (
  SELECT CAST(e.vec_id AS VARCHAR) AS id, CAST(e.embedding AS DOUBLE[]) AS v, e.label, d.text AS contents,
         d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM embeddings e
  LEFT JOIN documents d ON d.doc_id = e.vec_id
  LEFT JOIN labels l ON l.doc_id = e.vec_id)"""

_MEANS = """
parts AS (
  SELECT label, unnest(range(1, len(embedding) + 1)) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
means AS (
  SELECT label, list(x ORDER BY pos) AS m
  FROM (SELECT label, pos, avg(x) AS x FROM parts GROUP BY label, pos) GROUP BY label),
queries AS (SELECT CAST(label AS BIGINT) AS query_id, m AS q FROM means)"""

_DISTANCE = {
    "euclidean": "round(list_distance(q, v), 6)",
    "cosine": "round(1 - list_cosine_similarity(q, v), 6)",
    "dot_product": "round(-list_inner_product(q, v), 6)",
}

# One k-means round from the label means, then the lists that the new means lead.
_LISTS = """
first_lists AS (
  SELECT id, arg_min(label, (round(d, 6), label)) AS cell
  FROM (SELECT i.id, s.label, list_distance(s.m, i.v) AS d FROM items i, means s) GROUP BY id),
moved_parts AS (
  SELECT f.cell, unnest(range(1, len(i.v) + 1)) AS pos, unnest(i.v) AS x FROM items i JOIN first_lists f USING (id)),
moved AS (
  SELECT cell, list(x ORDER BY pos) AS m
  FROM (SELECT cell, pos, avg(x) AS x FROM moved_parts GROUP BY cell, pos) GROUP BY cell),
centroids AS (SELECT s.label AS cell, coalesce(n.m, s.m) AS m FROM means s LEFT JOIN moved n ON n.cell = s.label),
cells AS (
  SELECT id, arg_min(cell, (round(d, 6), cell)) AS cell
  FROM (SELECT i.id, c.cell, list_distance(c.m, i.v) AS d FROM items i, centroids c) GROUP BY id),
ranked_cells AS (
  SELECT query_id, cell,
         row_number() OVER (PARTITION BY query_id ORDER BY round(list_distance(q, m), 6), cell) AS place
  FROM queries, centroids)"""

_BOOKS = """
subs AS (SELECT unnest(range(0, 8)) AS sub),
books AS (SELECT s.sub, m.label AS code, m.m[s.sub * 8 + 1 : s.sub * 8 + 8] AS word FROM means m, subs s),
slices AS (SELECT i.id, s.sub, i.v[s.sub * 8 + 1 : s.sub * 8 + 8] AS w FROM items i, subs s),
codes AS (
  SELECT id, sub, arg_min(code, (round(d, 6), code)) AS code
  FROM (SELECT s.id, s.sub, b.code, list_distance(b.word, s.w) AS d FROM slices s JOIN books b USING (sub))
  GROUP BY id, sub)"""

_LOOKUP = """
tables AS (
  SELECT q.query_id, b.sub, b.code, list_distance(q.q[b.sub * 8 + 1 : b.sub * 8 + 8], b.word) AS d FROM queries q, books b)"""


def _top(source: str, top_k: int = 10, distance: str = _DISTANCE["euclidean"], extra: str = "") -> str:
    return f"""
SELECT query_id, CAST(rank AS INTEGER) AS rank, id, distance{extra} FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank
  FROM (SELECT *, {distance} AS distance FROM {source})) WHERE rank <= {top_k}"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _exact(where: str = "TRUE", metric: str = "euclidean", extra: str = "") -> str:
    source = f"(SELECT * FROM queries, items WHERE {where})"
    return _with(_ITEMS, _MEANS) + _top(source, distance=_DISTANCE[metric], extra=extra)


def _probed(where: str = "TRUE", top_k: int = 10) -> str:
    source = f"""(
      SELECT q.query_id, q.q, i.id, i.v FROM queries q
      JOIN ranked_cells r ON r.query_id = q.query_id AND r.place <= 3
      JOIN cells c ON c.cell = r.cell JOIN items i ON i.id = c.id WHERE {where})"""
    return _top(source, top_k)


_SRC = "source IN ('src1', 'src2', 'src5')"
_META = ", label, lang"
_BUCKET = "CAST(concat('0x', substr(md5(t), 1, 8)) AS BIGINT) % 64"


def _hashed(table: str, key: str, name: str) -> str:
    """Token-hash embeddings of a text table as ``name(key, v)``."""
    return f"""
{name}_tokens AS (SELECT {key} AS key, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS t FROM {table}),
{name}_counts AS (SELECT key, {_BUCKET} AS bucket, count(*) AS c FROM {name}_tokens GROUP BY ALL),
{name}_norms AS (SELECT key, sqrt(sum(CAST(c AS DOUBLE) * c)) AS norm FROM {name}_counts GROUP BY key),
{name} AS (
  SELECT g.key, list(CAST(CAST(coalesce(c.c / n.norm, 0) AS FLOAT) AS DOUBLE) ORDER BY g.bucket) AS v
  FROM (SELECT {key} AS key, unnest(range(0, 64)) AS bucket FROM {table}) g
  LEFT JOIN {name}_counts c ON c.key = g.key AND c.bucket = g.bucket
  LEFT JOIN {name}_norms n ON n.key = g.key GROUP BY g.key)"""


_UPSERTED = """
SELECT id, md5(contents) AS contents_md5, CAST(len(v) AS INTEGER) AS width, CAST(NULL AS INTEGER) AS toxic
FROM items WHERE id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)
UNION ALL
SELECT CAST(doc_id AS VARCHAR), md5('quality ' || quality), NULL, toxic FROM labels"""

_LATEST = """
latest AS (
  SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)"""

_COMPACTED = (
    _with(_LATEST)
    + """
SELECT CAST(user_id AS VARCHAR) AS id, event_type AS contents, CAST(props->>'$.k' AS INTEGER) AS k,
       CAST(CAST(value AS FLOAT) AS DOUBLE) AS value
FROM latest WHERE event_type <> 'error'"""
)

_CATALOG = (
    _with(_LATEST)
    + """
SELECT 'user-' || user_id AS index_name{columns} FROM latest WHERE event_type <> 'error'"""
)

_RECALL_LISTS = """
filters AS (SELECT unnest([1, 2, 3]) AS filter_id),
allowed AS (
  SELECT f.filter_id, i.id, i.v FROM filters f, items i
  WHERE (f.filter_id = 1 AND i.lang = 'en') OR (f.filter_id = 2 AND i.n_chars > 500) OR (f.filter_id = 3 AND i.lang = 'xx')),
truth AS (
  SELECT filter_id, query_id, id FROM queries, allowed
  QUALIFY row_number() OVER (PARTITION BY filter_id, query_id ORDER BY round(list_distance(q, v), 6), id) <= 10),
hits AS (
  SELECT a.filter_id, q.query_id, a.id FROM queries q
  JOIN ranked_cells r ON r.query_id = q.query_id AND r.place <= 1
  JOIN cells c ON c.cell = r.cell JOIN allowed a ON a.id = c.id
  QUALIFY row_number() OVER (PARTITION BY a.filter_id, q.query_id ORDER BY round(list_distance(q.q, a.v), 6), a.id) <= 10),
per_query AS (
  SELECT f.filter_id, q.query_id,
         (SELECT count(*) FROM truth t WHERE t.filter_id = f.filter_id AND t.query_id = q.query_id) AS expected,
         (SELECT count(*) FROM hits h WHERE h.filter_id = f.filter_id AND h.query_id = q.query_id) AS returned,
         (SELECT count(*) FROM truth t JOIN hits h USING (filter_id, query_id, id)
          WHERE t.filter_id = f.filter_id AND t.query_id = q.query_id) AS shared
  FROM filters f, queries q),
recalls AS (
  SELECT filter_id, count(*) AS n_queries,
         avg(CASE WHEN expected = 0 AND returned = 0 THEN 1.0 WHEN expected = 0 THEN 0.0
                  ELSE shared / CAST(least(expected, 100) AS DOUBLE) END) AS recall
  FROM per_query GROUP BY filter_id)"""

_INDEXED = (
    _with(_ITEMS, _MEANS)
    + _top(
        "(SELECT * FROM queries, items WHERE lang = 'en' AND coalesce(toxic, 0) <> 1)",
        extra=", label",
    )
)

# The hits of a search that promises exact distances and a recall floor.
_JUDGED = """
SELECT 'true_hits' AS what, 10 * count(DISTINCT label) AS n FROM embeddings UNION ALL SELECT 'floor_reached', 1"""

SQL = {
    "knn_single_euclidean": _with(_ITEMS)
    + """,
parts AS (
  SELECT unnest(range(1, len(embedding) + 1)) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
queries AS (
  SELECT CAST(0 AS BIGINT) AS query_id, list(x ORDER BY pos) AS q FROM (SELECT pos, avg(x) AS x FROM parts GROUP BY pos))"""
    + _top("(SELECT * FROM queries, items)"),
    "knn_batch_euclidean": _exact(),
    "knn_bounded": _exact(),
    "knn_batch_cosine": _exact(metric="cosine"),
    "knn_batch_dot": _exact(metric="dot_product"),
    "knn_include_vector": _exact(extra=", CAST(len(v) AS INTEGER) AS width, round(list_sum(v), 4) AS total"),
    "knn_include_metadata": "SELECT * EXCLUDE (distance) FROM ("
    + _exact(extra=", label, lang, md5(contents) AS contents_md5")
    + ")",
    "knn_filter_eq": _exact("lang = 'en'", extra=_META),
    "knn_filter_eq_int": _exact("label = 0", extra=_META),
    "knn_filter_gt": _exact("n_chars > 500", extra=_META),
    "knn_filter_in": _exact(_SRC, extra=_META),
    "knn_filter_and": _exact(f"lang = 'en' AND n_chars / 1000.0 > 0.8 AND {_SRC}", extra=_META),
    "knn_filter_path": _exact("quality = 1 AND toxic = 0", extra=_META),
    "knn_filter_none_match": _exact("lang = 'xx'", extra=_META),
    "filter_matches": _with(_ITEMS) + " SELECT id FROM items WHERE lang IN ('en', 'de') AND n_chars > 500",
    "filter_extensions": _with(_ITEMS)
    + """ SELECT id FROM items
WHERE (lang IS DISTINCT FROM 'en' OR n_chars BETWEEN 1000 AND 3000)
  AND source IS DISTINCT FROM 'src0' AND quality IS NOT NULL AND NOT coalesce(label < 3, FALSE)""",
    "filter_json_props": "SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events WHERE CAST(props->>'$.k' AS DOUBLE) > 50",
    "distance_metrics": _with(_ITEMS, _MEANS)
    + """
SELECT CAST(id AS BIGINT) AS vec_id, round(list_distance(v, m), 6) AS euclidean,
       round(1 - list_cosine_similarity(v, m), 6) AS cosine, round(-list_inner_product(v, m), 6) AS dot_product
FROM items JOIN means USING (label)""",
    "upsert_insert_replace": _with(_ITEMS) + _UPSERTED,
    "upsert_idempotent": _with(_ITEMS) + _UPSERTED,
    "upsert_ordered": _with(_ITEMS, _LATEST)
    + """
SELECT id, md5(contents) AS contents_md5, CAST(NULL AS INTEGER) AS k FROM items
WHERE id NOT IN (SELECT CAST(user_id AS VARCHAR) FROM events)
UNION ALL
SELECT CAST(user_id AS VARCHAR), md5(event_type), CAST(props->>'$.k' AS INTEGER) FROM latest""",
    "delete_ids": _with(_ITEMS) + " SELECT id, label FROM items WHERE coalesce(toxic, 0) <> 1",
    "get_by_ids_ordered": _with(_ITEMS)
    + """
SELECT event_id AS ordinal, id, label, lang FROM events JOIN items ON items.id = CAST(user_id AS VARCHAR) ORDER BY ordinal""",
    "list_ids": _with(_LATEST) + " SELECT CAST(user_id AS VARCHAR) AS id FROM latest WHERE event_type <> 'error'",
    "count_vectors": "SELECT count(*) AS n_items FROM embeddings",
    "validate_event_items": """
SELECT CAST(event_id AS VARCHAR) AS id,
       CASE event_type WHEN 'click' THEN 'wrong dimension' WHEN 'purchase' THEN 'empty vector'
                       WHEN 'signup' THEN 'vector component is not finite' ELSE 'missing vector' END AS reason
FROM events WHERE event_type <> 'view'""",
    "compact_log": _COMPACTED,
    "compact_over_snapshot": _with(_ITEMS, _LATEST)
    + """
SELECT id, md5(contents) AS contents_md5, CAST(len(v) AS INTEGER) AS width FROM items
WHERE id NOT IN (SELECT CAST(user_id AS VARCHAR) FROM events)
UNION ALL
SELECT CAST(user_id AS VARCHAR), md5(event_type), 2 FROM latest WHERE event_type <> 'error'""",
    "ivf_assign": _with(_ITEMS, _MEANS, _LISTS) + " SELECT id, cell FROM first_lists",
    "ivf_centroids": _with(_ITEMS, _MEANS, _LISTS)
    + """,
sizes AS (SELECT cell, count(*) AS n FROM first_lists GROUP BY cell)
SELECT c.cell, coalesce(s.n, 0) AS n, CAST(unnest(range(0, len(c.m))) AS INTEGER) AS pos, round(unnest(c.m), 6) AS x
FROM centroids c LEFT JOIN sizes s USING (cell)""",
    "ivf_probe": _with(_ITEMS, _MEANS, _LISTS) + _probed(),
    "ivf_full_probe": _exact(),
    "ivf_greedy": _with(_ITEMS, _MEANS, _LISTS)
    + """,
sizes AS (SELECT cell, count(*) AS n FROM cells GROUP BY cell),
visits AS (
  SELECT query_id, cell, coalesce(sum(n) OVER (PARTITION BY query_id ORDER BY place
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held
  FROM ranked_cells LEFT JOIN sizes USING (cell))"""
    + _top(
        """(SELECT q.query_id, q.q, i.id, i.v FROM queries q JOIN visits r ON r.query_id = q.query_id AND r.held < 60
      JOIN cells c ON c.cell = r.cell JOIN items i ON i.id = c.id)""",
        60,
    ),
    "ivf_filtered_probe": _with(_ITEMS, _MEANS, _LISTS) + _probed("i.lang = 'en' AND i.n_chars > 500"),
    "ivf_postings_probe": _with(_ITEMS, _MEANS, _LISTS) + _probed("i.lang = 'en'"),
    "pq_codebooks": _with(_ITEMS, _MEANS, _BOOKS)
    + """,
flat AS (
  SELECT c.sub, c.code, unnest(range(0, 8)) AS pos, unnest(s.w) AS x FROM codes c JOIN slices s USING (id, sub)),
moved AS (SELECT sub, code, pos, avg(x) AS x, count(*) AS n FROM flat GROUP BY sub, code, pos),
before AS (SELECT sub, code, unnest(range(0, 8)) AS pos, unnest(word) AS x FROM books)
SELECT CAST(b.sub AS INTEGER) AS sub, b.code, coalesce(m.n, 0) AS n, CAST(b.pos AS INTEGER) AS pos,
       round(coalesce(m.x, b.x), 6) AS x
FROM before b LEFT JOIN moved m ON m.sub = b.sub AND m.code = b.code AND m.pos = b.pos""",
    "pq_encode": _with(_ITEMS, _MEANS, _BOOKS) + " SELECT id, CAST(sub AS INTEGER) AS sub, code FROM codes",
    "pq_search": _with(_ITEMS, _MEANS, _BOOKS, _LOOKUP)
    + _top(
        """(SELECT t.query_id, c.id, sqrt(sum(t.d * t.d)) AS total
      FROM codes c JOIN tables t ON t.sub = c.sub AND t.code = c.code GROUP BY t.query_id, c.id)""",
        distance="round(total, 6)",
    ),
    "pq_search_rerank": _with(_ITEMS, _MEANS, _BOOKS, _LOOKUP)
    + """,
rough AS (
  SELECT query_id, id FROM (
    SELECT t.query_id, c.id, round(sqrt(sum(t.d * t.d)), 6) AS total
    FROM codes c JOIN tables t ON t.sub = c.sub AND t.code = c.code GROUP BY t.query_id, c.id)
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY total, id) <= 40)"""
    + _top("(SELECT r.query_id, q.q, i.id, i.v FROM rough r JOIN queries q USING (query_id) JOIN items i USING (id))"),
    "ivfpq_search": _with(_ITEMS, _MEANS, _LISTS, _BOOKS, _LOOKUP)
    + """,
rough AS (
  SELECT query_id, id FROM (
    SELECT t.query_id, c.id, round(sqrt(sum(t.d * t.d)), 6) AS total
    FROM codes c JOIN tables t ON t.sub = c.sub AND t.code = c.code
    JOIN cells l ON l.id = c.id JOIN ranked_cells r ON r.query_id = t.query_id AND r.cell = l.cell AND r.place <= 3
    GROUP BY t.query_id, c.id)
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY total, id) <= 40)"""
    + _top("(SELECT r.query_id, q.q, i.id, i.v FROM rough r JOIN queries q USING (query_id) JOIN items i USING (id))"),
    "recall_at_k": _with(_ITEMS, _MEANS, _LISTS)
    + f""",
truth AS ({_top("(SELECT * FROM queries, items)")}),
hits AS ({_probed()}),
shares AS (
  SELECT t.query_id, avg(CASE WHEN h.id IS NULL THEN 0.0 ELSE 1.0 END) AS recall
  FROM truth t LEFT JOIN hits h ON h.query_id = t.query_id AND h.id = t.id GROUP BY t.query_id)
SELECT count(*) AS n_queries, round(avg(recall), 6) AS recall FROM shares""",
    "recall_filtered": _with(_ITEMS, _MEANS, _LISTS, _RECALL_LISTS)
    + " SELECT filter_id, n_queries, round(recall, 6) AS recall FROM recalls",
    "recall_thresholds": _with(_ITEMS, _MEANS, _LISTS, _RECALL_LISTS)
    + f"""
SELECT filter_id, round(recall * 100, 4) AS recall_percent, round(threshold * 0.95, 4) AS floor
FROM recalls JOIN (VALUES {", ".join(f"({n}, {floor}::DOUBLE)" for n, floor in RECALL_FLOORS)}) AS t(filter_id, threshold) USING (filter_id)
WHERE recall * 100 < threshold * CAST(0.95 AS DOUBLE)""",
    "leak_check": _with(_ITEMS)
    + """,
deleted AS (SELECT CAST(doc_id AS VARCHAR) AS id FROM labels WHERE toxic = 1),
kept AS (SELECT id FROM items ANTI JOIN deleted USING (id))
SELECT 'list' AS source, count(*) AS n_leaks FROM kept SEMI JOIN deleted USING (id)
UNION ALL SELECT 'query', count(*) FROM kept SEMI JOIN deleted USING (id)
UNION ALL SELECT 'before', count(*) FROM items SEMI JOIN deleted USING (id)""",
    "roundtrip_integrity": "SELECT 'items' AS side, count(*) AS n_items FROM embeddings UNION ALL SELECT 'lost', 0",
    "roundtrip_changes": _with(_ITEMS)
    + """
SELECT coalesce(i.id, CAST(l.doc_id AS VARCHAR)) AS id, CASE WHEN i.id IS NULL THEN 'added' ELSE 'vector' END AS reason
FROM labels l LEFT JOIN items i ON i.id = CAST(l.doc_id AS VARCHAR)""",
    "id_prefix_count": "SELECT count(*) AS n_items FROM documents WHERE starts_with(lang || '-' || doc_id, 'en-')",
    "content_query": _with(_hashed("documents", "doc_id", "doc"), _hashed("benchmark", "item_id", "ask"))
    + _top(
        "(SELECT a.key AS query_id, a.v AS q, CAST(d.key AS VARCHAR) AS id, d.v FROM ask a, doc d)",
        5,
        """CASE WHEN list_inner_product(q, q) * list_inner_product(v, v) = 0 THEN 1.0
             ELSE round(1 - list_cosine_similarity(q, v), 6) END""",
    ),
    "embed_on_ingest": _with(_hashed("(SELECT conv_id || '-' || turn AS turn_id, text FROM conversations)", "turn_id", "turn"))
    + """
SELECT key AS id, CAST(len(list_filter(v, lambda x: x > 0)) AS INTEGER) AS n_used, round(list_max(v), 5) AS peak FROM turn""",
    "training_decision": """
WITH counts AS (
  SELECT d.source AS index_name, count(*) AS n_items, count(l.doc_id) AS trained_count
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.source)
SELECT index_name, trained_count > 0 AS is_trained, trained_count, n_items, CAST(2.5 AS DOUBLE) AS retrain_threshold,
       CASE WHEN trained_count = 0 THEN n_items >= 10 ELSE n_items >= trained_count * 2.5 END AS needs_training
FROM counts""",
    "catalog_list": _CATALOG.format(columns=""),
    "catalog_describe": _CATALOG.format(
        columns=""", CASE event_type WHEN 'click' THEN 'ivf' WHEN 'view' THEN 'ivfflat' ELSE 'ivfpq' END AS index_type,
       event_type <> 'click' AS is_trained, CAST(user_id + 1 AS INTEGER) AS dimension,
       CASE WHEN value > 20 THEN 'cosine' ELSE 'euclidean' END AS metric, CAST(floor(value) AS BIGINT) AS trained_count"""
    ),
    "encrypted_roundtrip": """
SELECT CAST(doc_id AS VARCHAR) AS id, md5(text) AS contents_md5, TRUE AS is_sealed, FALSE AS wrong_key_opens FROM documents""",
    "encrypted_vectors": "SELECT 'items' AS side, count(*) AS n_items FROM embeddings UNION ALL SELECT 'lost', 0",
    "index_query": _INDEXED,
    "index_trained_query": _INDEXED,
    "index_ivf_query": _INDEXED,
    "index_ivfpq_query": _INDEXED,
    "index_probe_query": _JUDGED,
    "index_filtered_auto": """
SELECT CAST(f AS INTEGER) AS filter_id, count(DISTINCT label) AS n_queries, TRUE AS floor_reached FROM embeddings, range(1, 4) r(f) GROUP BY f""",
    "index_get_after_compaction": _with(_ITEMS)
    + """
SELECT o.ordinal, o.id, round(list_sum(i.v), 4) AS total, i.label
FROM (SELECT CAST(doc_id AS VARCHAR) AS id, toxic, doc_id AS ordinal FROM labels) o JOIN items i USING (id)
WHERE o.toxic = 0""",
    "ivf_train": """
SELECT CAST(16 AS INTEGER) AS n_lists, count(*) AS n_items, CAST(0 AS BIGINT) AS wrong_cells, CAST(0 AS BIGINT) AS n_lost,
       TRUE AS recall_reached FROM embeddings""",
    "pq_residual": "SELECT count(*) AS n_items, TRUE AS nearer FROM embeddings",
    "ivf_train_mini": "SELECT count(*) AS n_items, CAST(0 AS BIGINT) AS n_lost, TRUE AS within FROM embeddings",
    "pq_train": f"""
SELECT CAST(s AS INTEGER) AS sub, least(16, count(DISTINCT embedding[s * {PQ_WIDTH} + 1:s * {PQ_WIDTH} + {PQ_WIDTH}])) AS n_codes,
       CAST(0 AS BIGINT) AS wrong_codes FROM embeddings, range({PQ_DIM}) r(s) GROUP BY s""",
    "index_contract": """
SELECT step, CAST(n AS BIGINT) AS n FROM (VALUES ('hits_of_empty', 0), ('trained_before', 0), ('trained_after', 1), ('wrong_key_opens', 0),
  ('two_inputs_pass', 0), ('no_input_passes', 0), ('second_create_passes', 0), ('listed', 1), ('listed_after_drop', 0),
  ('dropped_loads', 0)) t(step, n)
UNION ALL SELECT 'loaded_items', count(*) FROM embeddings""",
    "training_running": """
SELECT step, CAST(n AS BIGINT) AS n FROM (VALUES ('before', 0), ('during', 1), ('after', 0)) t(step, n)
UNION ALL SELECT 'trained_items', count(*) FROM embeddings""",
    "dead_claim_taken_over": """
SELECT step, CAST(n AS BIGINT) AS n FROM (VALUES ('created_within_lease', 0), ('late_writer_passes', 0)) t(step, n)
UNION ALL SELECT 'compacted_items', count(*) FROM embeddings""",
    "concurrent_upserts": "SELECT label, count(*) AS n_items FROM embeddings GROUP BY label",
    "stream_then_upsert": """
SELECT CASE WHEN label <= 2 THEN 'stream-3' WHEN label <= 4 THEN 'batch-2' WHEN label <= 6 THEN 'stream-1' ELSE 'batch-0' END AS contents,
       count(*) AS n_items FROM embeddings WHERE label <= 9 GROUP BY 1""",
    "filter_big_int": """
SELECT count(*) FILTER (event_id > 101) AS gt, count(*) FILTER (event_id >= 101) AS gte, count(*) FILTER (event_id < 101) AS lt,
       count(*) FILTER (event_id <= 101) AS lte FROM events""",
    "stream_upsert_log": _COMPACTED,
    "stream_query": _with(_MEANS)
    + _top("(SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS q, CAST(label AS VARCHAR) AS id, m AS v "
           "FROM (SELECT vec_id, embedding FROM embeddings), means)", 3),
}
