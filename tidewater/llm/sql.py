"""DuckDB SQL of the queries that SQL can express."""

_WORDS = r"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.98
), reach AS (
  SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), links AS (SELECT a, count(*) AS n FROM link GROUP BY a), least_id AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(b, e.vec_id)) AS component_id, e.vec_id = least(e.vec_id, coalesce(b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN links ON links.a = e.vec_id LEFT JOIN least_id ON least_id.a = e.vec_id
"""

OP5 = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, {_WORDS.format(text='text')} AS w FROM documents
), gram AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM worded, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0
), size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM gram x JOIN gram y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM shared JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE shared.n / (p.n + q.n - shared.n) >= 0.8
), reach AS (
  SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), links AS (SELECT a, count(*) AS n FROM link GROUP BY a), least_id AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, least(d.doc_id, coalesce(b, d.doc_id)) AS class_id, coalesce(n, 0) AS n_links, d.doc_id = least(d.doc_id, coalesce(b, d.doc_id)) AS kept
FROM documents d LEFT JOIN links ON links.a = d.doc_id LEFT JOIN least_id ON least_id.a = d.doc_id
"""

OP8 = f"""
WITH worded AS (
  SELECT doc_id, {_WORDS.format(text='text')} AS w FROM documents
), item AS (
  SELECT item_id, {_WORDS.format(text='text')} AS w FROM benchmark
), pattern AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + 9], ' ') AS p FROM item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0
), place AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS p
  FROM worded, (SELECT DISTINCT k FROM pattern) AS sizes, unnest(range(1, len(w) - k + 2)) AS t(i)
), hit AS (SELECT doc_id, i, place.k AS k, item_id FROM place JOIN pattern ON place.k = pattern.k AND place.p = pattern.p),
words AS (SELECT doc_id, count(DISTINCT j) AS n FROM hit, unnest(range(i, i + k)) AS t(j) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT worded.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, words.n IS NOT NULL AS contaminated
FROM worded LEFT JOIN words ON words.doc_id = worded.doc_id LEFT JOIN items ON items.doc_id = worded.doc_id
"""

SQL = {"op1_embedding_dedup": OP1.strip(), "op5_ngram_jaccard": OP5.strip(), "op8_decontamination": OP8.strip()}
