"""DuckDB SQL for the corpus queries that SQL can express."""

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS shuffle_key
  FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_rank FROM per_source
), weighted AS MATERIALIZED (
  SELECT *, [1, 2, 3][(source_rank % 3 + 1)::INT] AS weight FROM ranked
), filled AS (
  -- in the order in which they fill up, what is left for those not yet full
  SELECT *, (sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER w, 0))::BIGINT AS words_left,
         (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::BIGINT AS weight_left, row_number() OVER w AS place
  FROM weighted
  WINDOW w AS (ORDER BY source_size * 3.0 / weight, source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT coalesce(arg_min(words_left::DOUBLE / weight_left, place)
                  FILTER (words_left::DOUBLE / weight_left * weight < source_size * 3), 0) AS level
  FROM filled
), targets AS MATERIALIZED (
  SELECT source, source_rank, source_size, least(weight * level, (source_size * 3)::DOUBLE) AS target
  FROM weighted, level
), served AS MATERIALIZED (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.source_rank,
         coalesce(sum(s.size) OVER (PARTITION BY t.source_rank ORDER BY s.shuffle_key, s.doc_id, s.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
         row_number() OVER () AS nr
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), copies AS (
  SELECT *, start + copy * source_size AS begin_at FROM served, (SELECT unnest([0, 1, 2]) AS copy) WHERE size > 0
), turns AS (
  SELECT *, (begin_at + size) / target AS finish, least(size, ceil(target)::BIGINT - begin_at) AS words
  FROM copies WHERE begin_at < target
), placed AS (
  SELECT *, coalesce(sum(words) OVER (ORDER BY finish, source_rank, copy, begin_at
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS mix_start
  FROM turns
), taken AS (
  SELECT nr, sum(greatest(0, least(words, (SELECT sum(size) FROM sized) - mix_start)))::BIGINT AS taken
  FROM placed GROUP BY nr
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM served LEFT JOIN taken USING (nr)
"""

DECONTAMINATION = r"""
WITH low AS (
  SELECT doc_id, row_number() OVER () AS nr,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), docs AS MATERIALIZED (SELECT doc_id, nr, words, len(words) AS n FROM low
), items AS (
  SELECT item_id::VARCHAR AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), windows AS MATERIALIZED (
  SELECT DISTINCT item_id, len(win) AS n, array_to_string(win, ' ') AS win FROM (
    SELECT item_id, words[p:p + least(10, len(words)) - 1] AS win
    FROM items, LATERAL (SELECT unnest(generate_series(1, greatest(len(words) - 9, 1))) AS p) WHERE len(words) > 0)
), lengths AS (SELECT DISTINCT n FROM windows
), grams AS (
  SELECT doc_id, nr, p, l.n, array_to_string(words[p:p + l.n - 1], ' ') AS win
  FROM docs, lengths l, LATERAL (SELECT unnest(generate_series(1, docs.n - l.n + 1)) AS p) WHERE docs.n >= l.n
), hits AS MATERIALIZED (
  SELECT g.nr, g.p, g.n, w.item_id FROM grams g JOIN windows w ON g.n = w.n AND g.win = w.win
), covered AS (
  SELECT nr, count(DISTINCT p + k)::BIGINT AS n_hit
  FROM hits, LATERAL (SELECT unnest(generate_series(0, hits.n - 1)) AS k) GROUP BY nr
), found AS (
  SELECT nr, count(DISTINCT item_id)::BIGINT AS n_items,
         array_to_string(list_sort(list(DISTINCT item_id)), ',') AS ids
  FROM hits WHERE item_id IS NOT NULL GROUP BY nr
)
SELECT d.doc_id, d.n::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs d LEFT JOIN covered USING (nr) LEFT JOIN found USING (nr)
"""

REPEATS = r"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), starts AS (
  SELECT doc_id, p, md5(substr(x, (2 * p + 1)::INT, 200)) AS win
  FROM docs, LATERAL (SELECT unnest(generate_series(0, (length(x) // 2 - 100)::BIGINT)) AS p) WHERE length(x) >= 200
), later AS (
  SELECT doc_id, p FROM starts QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, p) > 1
), steps AS (
  SELECT doc_id, p, coalesce(p > lag(p) OVER w + 100, true)::INT AS new FROM later WINDOW w AS (PARTITION BY doc_id ORDER BY p)
), runs AS (
  SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM steps
), spans AS (
  SELECT doc_id, run, min(p) AS a, max(p) + 100 AS b FROM runs GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS kept_from FROM spans
), removed AS (
  SELECT g.doc_id, sum(b - a)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans,
         string_agg(substr(d.x, (2 * kept_from + 1)::INT, (2 * (a - kept_from))::INT), '' ORDER BY a) AS kept, max(b) AS last_end
  FROM gaps g JOIN docs d USING (doc_id) GROUP BY g.doc_id
)
SELECT d.doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(x, (2 * coalesce(last_end, 0) + 1)::INT))) AS kept_sha256
FROM docs d LEFT JOIN removed r USING (doc_id)
"""
