"""DuckDB SQL for the queries that SQL can express."""

OP1 = r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT r, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_distinct(list_transform(list_zip(ws, ws[2:], ws[3:], ws[4:], ws[5:])[:len(ws) - 4], lambda z: concat_ws(' ', z[1], z[2], z[3], z[4], z[5]))) END AS shingles FROM w),
n AS (SELECT r, doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, shingles FROM s),
t AS MATERIALIZED (SELECT min(r) AS t, n_shingles, shingles FROM (SELECT r, n_shingles, list_sort(shingles) AS shingles FROM n WHERE n_shingles > 0) GROUP BY n_shingles, shingles),
m AS MATERIALIZED (SELECT r, t FROM n JOIN t ON n.n_shingles = t.n_shingles AND list_sort(n.shingles) = t.shingles),
x AS MATERIALIZED (SELECT t, n_shingles, unnest(shingles) AS shingle FROM t),
p AS (SELECT a.t AS a, b.t AS b FROM x a JOIN x b ON a.shingle = b.shingle AND a.t < b.t AND 4 * least(a.n_shingles, b.n_shingles) >= 3 * greatest(a.n_shingles, b.n_shingles)
      GROUP BY a.t, b.t, a.n_shingles, b.n_shingles HAVING 100 * count(*) >= 75 * (a.n_shingles + b.n_shingles - count(*))),
e AS MATERIALIZED (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
c(t, l) AS (SELECT t, t FROM t UNION SELECT e.b, c.l FROM c JOIN e ON c.t = e.a WHERE c.l < e.b),
g AS (SELECT t, min(l) AS l FROM c GROUP BY t),
f AS (SELECT l, min(doc_id) AS component_id FROM g JOIN m USING (t) JOIN n USING (r) GROUP BY l),
k AS (SELECT r, component_id FROM m JOIN g USING (t) JOIN f USING (l))
SELECT doc_id, n_shingles, coalesce(component_id, doc_id) AS component_id, doc_id = coalesce(component_id, doc_id) AS kept FROM n LEFT JOIN k USING (r)
"""

# Hex digits, two a byte; strings of 200 bytes are compared by 64-bit hashes.
OP2 = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, CAST(doc_id AS BIGINT) AS doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
q AS (SELECT r, since, substr(h, 2 * since + 1, 2 * 511 + 400) AS h FROM (SELECT r, h, unnest(range(0, strlen(h) // 2 - 199, 512)) AS since FROM d)),
s AS (SELECT r, since + i AS i, hash(substr(h, 2 * i + 1, 400)) AS k FROM (SELECT r, since, h, unnest(range(0, strlen(h) // 2 - 199)) AS i FROM q)),
o AS (SELECT r, i FROM s QUALIFY count(*) OVER (PARTITION BY k) > 1),
b AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 0 ELSE 1 END AS opens FROM o),
n AS (SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i) AS span FROM b),
spans AS (SELECT r, span, min(i) AS since, max(i) + 200 AS until FROM n GROUP BY r, span),
kept AS (SELECT r, since, until, coalesce(lag(until) OVER (PARTITION BY r ORDER BY since), 0) AS before FROM spans),
c AS (SELECT r, CAST(sum(until - since) AS BIGINT) AS n_removed, count(*) AS n_spans, max(until) AS until,
      string_agg(substr(h, 2 * before + 1, 2 * (since - before)), '' ORDER BY since) AS head FROM kept JOIN d USING (r) GROUP BY r)
SELECT doc_id, CAST(strlen(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN until IS NULL THEN h ELSE head || substr(h, 2 * until + 1) END)) AS kept_sha256
FROM d LEFT JOIN c USING (r)
"""

OP6 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h FROM p),
f AS (SELECT h, min(page_id) AS first FROM d GROUP BY h)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM d JOIN f USING (h)
"""

OP7 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM c WHERE n > 1) GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, length(array_to_string(ws, '')) AS word_chars,
      length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
      CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
      len(ls) AS n_lines, length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) AS n_upper
      FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
      + (CASE WHEN 10 * n_symbols > n_words * 3 THEN 4 ELSE 0 END) + (CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 8 ELSE 0 END)
      + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END) + (CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END)
      + (CASE WHEN 2 * n_upper > word_chars THEN 64 ELSE 0 END) + (CASE WHEN n_words > 100000 THEN 128 ELSE 0 END) AS BIGINT) AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures & 3 <> 0 AS base_failed, failures & 127 = 0 AS kept, failures FROM b
"""

OP8 = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size, md5('0:' || doc_id) AS place FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY CAST(source AS BLOB) NULLS LAST) AS k FROM d GROUP BY source),
r AS (SELECT source, source_size, [3, 1, 2][(k - 1) % 3 + 1] AS weight, 2 * source_size AS most FROM s),
o AS (SELECT *, most / weight AS ratio,
      (CAST(sum(source_size) OVER () AS BIGINT) * 150 / 100 - (CAST(sum(most) OVER w AS BIGINT) - most)) / (CAST(sum(weight) OVER () AS BIGINT) - CAST(sum(weight) OVER w AS BIGINT) + weight) AS level
      FROM r WINDOW w AS (ORDER BY most / weight, CAST(source AS BLOB) NULLS LAST ROWS UNBOUNDED PRECEDING)),
l AS (SELECT arg_min(level, ratio) AS level FROM o WHERE ratio > level),
t AS (SELECT source, source_size, CASE WHEN l.level IS NULL OR ratio <= l.level THEN CAST(most AS DOUBLE) ELSE weight * l.level END AS target FROM o, l),
q AS (SELECT doc_id, size, source_size, target, CAST(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(least(greatest(floor(target) - start, 0), size) + least(greatest(floor(target) - start - source_size, 0), size) AS BIGINT) AS taken,
  CASE WHEN target > 0 THEN (start + size) / target ELSE 0.0 END AS virtual_finish
FROM q
"""

OP9 = r"""
WITH u AS (SELECT page_id, url, regexp_replace(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@\[\]]+)', 1)), '\.+$', ''), '^www\.', '') AS h,
      regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1) AS p,
      DATE '2024-01-01' + CAST(CAST('0x' || substr(md5('f' || page_id), 1, 4) AS BIGINT) % 366 AS INTEGER) AS day FROM pages),
v AS (SELECT page_id, url, nullif(h, '') AS host, p, day FROM u),
hosts AS (SELECT DISTINCT host FROM v WHERE host IS NOT NULL),
domains AS (SELECT DISTINCT regexp_extract(host, '([^.]+\.[^.]+)$', 1) AS value FROM hosts WHERE regexp_extract(host, '([^.]+\.[^.]+)$', 1) <> ''),
folders AS (SELECT DISTINCT host || '/' || regexp_extract(p, '^/([^/]+)', 1) AS value FROM v WHERE host IS NOT NULL AND regexp_extract(p, '^/([^/]+)', 1) <> ''),
n AS (SELECT 'malware' AS list, 'host' AS kind, host AS value, CAST('0x' || substr(md5('m' || host), 1, 4) AS BIGINT) % 366 AS since, 90 AS days FROM hosts
      UNION ALL SELECT 'adult', 'domain', value, CAST('0x' || substr(md5('a' || value), 1, 4) AS BIGINT) % 366 + 120, 100000 FROM domains
      UNION ALL SELECT 'allow', 'prefix', value, CAST('0x' || substr(md5('p' || value), 1, 4) AS BIGINT) % 366, 150 FROM folders),
i AS (SELECT list, kind, value, DATE '2024-01-01' + CAST(since AS INTEGER) AS since, DATE '2024-01-01' + CAST(since + days AS INTEGER) AS until FROM n),
hits AS (SELECT page_id, list FROM v JOIN i ON since <= day AND day < until AND
      ((kind = 'host' AND value = host) OR (kind = 'domain' AND (value = host OR ends_with(host, '.' || value)))
       OR (kind = 'prefix' AND (value = host || '/' || regexp_extract(p, '^/([^/]+)', 1)))))
SELECT v.page_id, v.host, count(hits.list) AS n_entries, coalesce(string_agg(DISTINCT hits.list, ',' ORDER BY hits.list), '') AS lists,
  coalesce(bool_or(hits.list <> 'allow') AND NOT bool_or(hits.list = 'allow'), false) AS blocked
FROM v LEFT JOIN hits ON v.page_id = hits.page_id GROUP BY v.page_id, v.host
"""

ORACLE: dict[str, str] = {"op1_minhash_dedup": OP1, "op2_suffix_dedup": OP2, "op6_warc": OP6, "op7_quality_rules": OP7, "op8_mixing": OP8, "op9_url_filters": OP9}
