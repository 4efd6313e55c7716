"""DuckDB SQL of the queries that SQL can express, over the same tables."""

from __future__ import annotations

OP3 = """
WITH vectors AS (
  SELECT DISTINCT vec_id,
         list_transform(embedding, lambda x: CAST(floor(256.0 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM vectors q, vectors c
  WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP6 = r"""
WITH docs AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT / 4294967296.0 AS draw
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
ranked AS (
  SELECT *, source_size * 3.0::DOUBLE AS most,
         CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3
              WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sizes),
levels AS (
  SELECT *, (sum(source_size) OVER ()
             - coalesce(sum(most) OVER (ORDER BY most / weight, encode(source) NULLS LAST
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(weight) OVER (ORDER BY most / weight, encode(source) NULLS LAST
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
targets AS (
  SELECT source, source_size,
         least(most, max(level) OVER () * weight) AS target
  FROM levels),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0::DOUBLE) ELSE 0.0 END AS rate
  FROM targets)
SELECT d.doc_id, d.size, r.source_size, r.target,
       CAST(d.size * (floor(r.rate) + CASE WHEN d.draw < r.rate - floor(r.rate) THEN 1 ELSE 0 END)
            AS BIGINT) AS taken
FROM docs d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
"""

OP9 = """
WITH docs AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
grouped AS (
  SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id,
         count(*) OVER (PARTITION BY t) AS group_size
  FROM docs)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM grouped
"""

OP11 = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
placed AS (
  SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS place FROM docs),
windows AS (
  SELECT doc_id, place, words[place] AS word,
         CASE WHEN place + 19 <= len(words) THEN array_to_string(words[place:place + 19], ' ') END AS win
  FROM placed),
seen AS (
  SELECT *, win IS NOT NULL AND row_number() OVER (PARTITION BY win ORDER BY doc_id, place) > 1 AS again
  FROM windows),
marked AS (
  SELECT doc_id, place, word,
         bool_or(again) OVER (PARTITION BY doc_id ORDER BY place
                              ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM seen),
kept AS (
  SELECT doc_id, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY place) FILTER (WHERE NOT gone), '') AS text
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {"op3_vector_topk": OP3, "op6_mixing": OP6, "op9_exact_dedup": OP9,
                              "op11_substring_dedup": OP11}
