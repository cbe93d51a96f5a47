"""SQL over the given tables for the text queries that SQL can express."""

from __future__ import annotations

MIX = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS shuffle
  FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
listed AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) AS ix, source_size * 2 AS cap
  FROM sums),
levels AS (
  SELECT *, ((sum(source_size) OVER () * 1.5::DOUBLE)
             - coalesce(sum(cap) OVER (ORDER BY source_size / weight, ix
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / (sum(weight) OVER ()
               - coalesce(sum(weight) OVER (ORDER BY source_size / weight, ix
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level,
         row_number() OVER (ORDER BY source_size / weight, ix) AS turn
  FROM listed),
flagged AS (SELECT *, cap <= level * weight AS is_full FROM levels),
open_level AS (SELECT arg_min(level, turn) AS common FROM flagged WHERE NOT is_full),
targets AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN cap::DOUBLE ELSE common * weight END AS target
  FROM flagged, open_level),
streams AS (
  SELECT s.*, t.source_size, t.target,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.shuffle, s.doc_id, s.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(start + size, round(target)) - start)
        + greatest(0, least(start + size + source_size, round(target)) - start - source_size))::BIGINT AS taken
FROM streams
"""

URL_RULES = r"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
split AS (
  SELECT page_id, url,
         coalesce(translate(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
fits AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY page_id
                            ORDER BY length(rule_host || rule_path) DESC NULLS LAST,
                                     length(rule_host) DESC) AS place
  FROM split LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM fits WHERE place = 1
"""

WARC = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(encode(coalesce(html, ''))) AS payload_digest
  FROM pages),
firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM firsts
"""
