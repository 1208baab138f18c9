"""DuckDB statements for the queries that SQL can express on whole tables."""

SQL = {
    "op2_benchmark_decontamination": r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM benchmark),
win AS MATERIALIZED (
  SELECT DISTINCT item, least(13, len(w)) AS size, list_slice(w, i, i + least(13, len(w)) - 1) AS words
  FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM b WHERE len(w) > 0)),
place AS MATERIALIZED (
  SELECT r, s.size, p, list_slice(w, p, p + s.size - 1) AS words
  FROM (SELECT r, w, size, unnest(generate_series(1, len(w) - size + 1)) AS p
        FROM d, (SELECT DISTINCT size FROM win) WHERE len(w) >= size) s),
found AS MATERIALIZED (SELECT r, item, p, place.size FROM place JOIN win ON place.size = win.size AND place.words = win.words),
hits AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(generate_series(p, p + size - 1)) AS k FROM found) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)""",
    "op9_jaccard_join": r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT DISTINCT r, list_slice(w, i, i + 2) AS g
  FROM (SELECT r, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS i FROM d WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT r, count(*) AS n FROM sets GROUP BY r),
pairs AS MATERIALIZED (
  SELECT x.r AS a, y.r AS b, count(*) AS o FROM sets x JOIN sets y ON x.g = y.g AND x.r <> y.r GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT a, b, o, p.n AS n_a, q.n AS n_b FROM pairs JOIN sizes p ON p.r = a JOIN sizes q ON q.r = b WHERE 100 * o >= 90 * (p.n + q.n - o)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(doc_id) AS low FROM reach JOIN d ON d.r = reach.b GROUP BY a),
contents AS MATERIALIZED (SELECT r, list_sort(list(g)) AS s FROM sets GROUP BY r),
degree AS (SELECT a, count(DISTINCT c.s) AS n_links FROM links JOIN contents c ON c.r = links.b WHERE NOT (o = n_a AND o = n_b) GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id, coalesce(n_links, 0) AS n_links
FROM d LEFT JOIN sizes USING (r) LEFT JOIN least ON least.a = d.r LEFT JOIN degree ON degree.a = d.r""",
    "op10_source_mixing": r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest, text IS NULL AS no_text,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_docs,
         row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
weighted AS (
  SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         CAST(source_size * 2 AS DOUBLE) AS cap FROM totals),
filled AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 150 / 100.0::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS level
  FROM weighted),
levels AS (SELECT *, (SELECT level FROM filled f WHERE f.weight * f.level <= f.cap ORDER BY cap / weight, rank LIMIT 1) AS final_level FROM filled),
t AS MATERIALIZED (
  SELECT source, source_size, n_docs, CASE WHEN source_size = 0 THEN 0.0 ELSE least(cap, coalesce(weight * final_level, cap)) END AS target FROM levels),
x AS MATERIALIZED (
  SELECT *, target - whole * source_size AS rest FROM (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t)),
draws AS (
  SELECT d.*, source_size, n_docs, target, whole, rest,
         row_number() OVER (PARTITION BY doc_id, d.source, digest, no_text, size) AS copy
  FROM d JOIN x ON d.source IS NOT DISTINCT FROM x.source),
ranked AS (
  SELECT *, (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || digest || ':' || CAST(copy AS VARCHAR)), 1, 12) AS BIGINT) + 0.5::DOUBLE)
            / 281474976710656.0::DOUBLE AS u,
         CASE WHEN rest > 0 AND size > 0 THEN
           size / (size + (CAST(source_size AS DOUBLE) / n_docs) * (1.0::DOUBLE - rest / source_size) / (rest / source_size)) END AS p FROM draws),
keyed AS (SELECT *, (u / (1.0::DOUBLE - u)) / (p / (1.0::DOUBLE - p)) AS q FROM ranked),
summed AS (
  SELECT *, CASE WHEN q IS NOT NULL THEN coalesce(sum(size) OVER (
    PARTITION BY source, q IS NULL ORDER BY q / (1.0::DOUBLE + q), doc_id NULLS FIRST, digest, copy ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS before
  FROM keyed)
SELECT doc_id, size, source_size, target,
       CAST((whole + CASE WHEN before + size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM summed""",
    "op11_merkle_manifest": r"""
WITH RECURSIVE bytes AS MATERIALIZED (
  SELECT doc_id, source, lang, n_chars, text, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)) AS ascii_codes FROM documents),
crc AS MATERIALIZED (
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(ascii_codes, lambda b: CAST(b AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])),
                            lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) AS crc FROM bytes),
fields AS MATERIALIZED (
  SELECT doc_id, source, doc_id IS NOT NULL AND crc % 2 = 0 AS altered,
         coalesce(CAST(strlen(CAST(doc_id AS VARCHAR)) AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR), '-')
         || coalesce(CAST(strlen(source) AS VARCHAR) || ':' || source, '-') || coalesce(CAST(strlen(lang) AS VARCHAR) || ':' || lang, '-')
         || coalesce(CAST(strlen(CAST(n_chars AS VARCHAR)) AS VARCHAR) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
         text, replace(text, chr(10), '') AS changed FROM crc),
digests AS MATERIALIZED (
  SELECT doc_id, source, sha256(head || coalesce(CAST(strlen(text) AS VARCHAR) || ':' || text, '-')) AS leaf,
         CASE WHEN altered THEN sha256(head || coalesce(CAST(strlen(changed) AS VARCHAR) || ':' || changed, '-')) END AS other FROM fields),
leaves AS MATERIALIZED (
  SELECT doc_id, source, leaf, coalesce(other, leaf) AS tampered,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM digests),
nodes AS (
  SELECT source, 0 AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY source) AS n FROM leaves
  UNION ALL
  SELECT source, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3
  FROM nodes WHERE n > 1 GROUP BY source, level, pos // 3, n),
subroots AS MATERIALIZED (
  SELECT source, digest, level AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM nodes WHERE n = 1),
upper AS (
  SELECT 0 AS level, pos, digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3 FROM upper WHERE n > 1 GROUP BY level, pos // 3, n),
runs AS MATERIALIZED (SELECT source, level, pos // 3 AS run, list(digest ORDER BY pos) AS members FROM nodes WHERE n > 1 GROUP BY ALL),
upper_runs AS MATERIALIZED (SELECT level, pos // 3 AS run, list(digest ORDER BY pos) AS members FROM upper WHERE n > 1 GROUP BY ALL),
rows AS MATERIALIZED (
  SELECT row_number() OVER () AS r, l.*, s.digest AS subroot, s.height, s.pos AS s_pos FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source),
wanted AS (
  SELECT r, source, FALSE AS top, unnest(range(height)) AS level, pos, unnest(range(height)) AS step FROM rows
  UNION ALL
  SELECT r, NULL, TRUE, unnest(range(h)), s_pos, height + unnest(range(h)) FROM rows, (SELECT max(level) AS h FROM upper)),
places AS (SELECT r, source, top, level, step, pos // CAST(power(3, level) AS BIGINT) AS place FROM wanted),
members AS MATERIALIZED (
  SELECT FALSE AS top, source, level, run, members FROM runs UNION ALL SELECT TRUE, NULL, level, run, members FROM upper_runs),
steps AS (
  SELECT r, step, array_to_string(members[:place % 3], '') AS before, array_to_string(members[place % 3 + 2:], '') AS after
  FROM places p JOIN members m ON p.top = m.top AND p.level = m.level AND p.place // 3 = m.run AND p.source IS NOT DISTINCT FROM m.source),
paths AS (
  SELECT r, list(before || '|' || after ORDER BY step) AS path, string_agg(before || after, '' ORDER BY step) AS siblings FROM steps GROUP BY r),
folds AS (
  SELECT rows.*, coalesce(siblings, '') AS siblings,
         list_reduce(list_prepend(tampered, coalesce(path, [])),
                     lambda x, y: sha256(split_part(y, '|', 1) || x || split_part(y, '|', 2))) AS folded_root
  FROM rows LEFT JOIN paths USING (r))
SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, folded_root, folded_root = root AS verified
FROM folds, (SELECT digest AS root FROM upper WHERE n = 1)""",
}
