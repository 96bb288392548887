"""SQL of the queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {
    "op4_bitsliced_topk": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id
            WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op6_mixing": r"""
        WITH sizes AS (
            SELECT doc_id, source,
                   CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
            FROM documents
        ), sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source
        ), capped AS (
            SELECT *, CAST(2 * source_size AS DOUBLE) AS cap,
                   CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
            FROM sources
        ), ladder AS (
            SELECT *, cap / weight AS meets,
                   (CAST(1.5 AS DOUBLE) * CAST(sum(source_size) OVER () AS DOUBLE)
                    - coalesce(sum(cap) OVER below, CAST(0 AS DOUBLE)))
                   / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER below, 0) AS DOUBLE) AS level
            FROM capped
            WINDOW below AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), reshared AS (
            SELECT *, max(CASE WHEN level <= meets THEN level END) OVER () AS final FROM ladder
        ), goals AS (
            SELECT source, source_size,
                   CASE WHEN meets <= final THEN cap ELSE coalesce(final * weight, cap) END AS target
            FROM reshared
        ), placed AS (
            SELECT doc_id, size, source, CASE WHEN source IS NULL THEN 'none' ELSE 's' || source END AS "of",
                   length(bin(size + 4)) * 4 + (((size + 4) >> (length(bin(size + 4)) - 3)) & 3) AS class,
                   CAST('0x' || substr(md5(concat_ws(':', doc_id, size, '20')), 1, 12) AS BIGINT)
                   % (SELECT count(*) // 50000 + 1 FROM documents) AS bucket
            FROM sizes
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY "of" ORDER BY class, bucket, size, doc_id) AS rank,
                   CAST('0x' || substr(md5("of" || ':20'), 1, 12) AS BIGINT) / CAST(281474976710656 AS DOUBLE) AS offset_
            FROM placed
        ), taken AS (
            SELECT r.doc_id, r.size, r.source, g.source_size, g.target,
                   CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS each, r.rank, r.offset_
            FROM ranked r JOIN goals g ON g.source IS NOT DISTINCT FROM r.source
        )
        SELECT doc_id, size, source_size, target, source,
               CAST(floor(rank * each + offset_) - floor((rank - 1) * each + offset_) AS BIGINT) AS copies,
               CAST(floor(rank * each + offset_) - floor((rank - 1) * each + offset_) AS BIGINT) * size AS taken
        FROM taken
    """,
    "op8_warc": """
        WITH hashed AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
        ), rows AS (
            SELECT page_id, payload_bytes,
                   array_to_string(list_transform(range(32), lambda k: substr(
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                       CAST(1 + ((CAST('0x' || substr(h, CAST(1 + 5 * (k // 4) AS BIGINT), 5) AS BIGINT)
                                  >> CAST(15 - 5 * (k % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '') AS payload_digest
            FROM hashed
        ), firsts AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM rows
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
        FROM firsts
    """,
    "op10_url_filter": r"""
        WITH judged AS (
            SELECT page_id, coalesce(url, '') AS address,
                   translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages
        ), ruled AS (
            SELECT *, CASE
                WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
            END AS rule FROM judged
        ), said AS (
            SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS says
            FROM ruled
        ), urls AS (
            SELECT address, any_value(says) AS says FROM said GROUP BY address
        ), coded AS (
            SELECT address, says, [0, 0] || list_transform(
                list_filter(string_split(regexp_replace(translate(address, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789',
                    'abcdefghijklmnopqrstuvwxyz000000000'), '[^a-z0\-\._/:\?=&#%\+]', '~', 'g'), ''), lambda c: c <> ''),
                lambda c: instr('^abcdefghijklmnopqrstuvwxyz0-._/:?=&#%+~', c) - 1) || [0] AS codes
            FROM urls
        ), placed AS (
            SELECT address, says, codes, unnest(range(1, len(codes) - 1)) AS i FROM coded
        ), runs AS (
            SELECT address, says, (codes[i] * 40 + codes[i + 1]) * 40 + codes[i + 2] AS gram FROM placed
        ), kept_out AS (
            SELECT address, CAST('0x' || substr(md5(address), 1, 8) AS BIGINT) % 5 = 0 AS out FROM urls
        ), counts AS (
            SELECT gram, count(*) FILTER (WHERE says = 'allow') AS allowed, count(*) FILTER (WHERE says = 'block') AS blocked
            FROM runs JOIN kept_out USING (address) WHERE says IS NOT NULL AND NOT out GROUP BY gram
        ), grid AS (
            SELECT g AS gram, g // 1600 AS a, g // 40 % 40 AS b, g % 40 AS c,
                   CAST(coalesce(allowed, 0) AS DOUBLE) AS n3_a, CAST(coalesce(blocked, 0) AS DOUBLE) AS n3_b
            FROM range(64000) t(g) LEFT JOIN counts ON counts.gram = g
        ), twos AS (
            SELECT *, sum(n3_a) OVER bc AS n2_a, sum(n3_b) OVER bc AS n2_b, sum(n3_a) OVER c1 AS n1_a, sum(n3_b) OVER c1 AS n1_b,
                   sum(n3_a) OVER () AS all_a, sum(n3_b) OVER () AS all_b
            FROM grid WINDOW bc AS (PARTITION BY b, c), c1 AS (PARTITION BY c)
        ), sums AS (
            SELECT *, CAST(count(*) FILTER (WHERE n3_a > 0) OVER ab AS DOUBLE) AS t3_a, sum(n3_a) OVER ab AS s3_a,
                   CAST(count(*) FILTER (WHERE n3_b > 0) OVER ab AS DOUBLE) AS t3_b, sum(n3_b) OVER ab AS s3_b,
                   CAST(count(*) FILTER (WHERE n2_a > 0) OVER b1 AS DOUBLE) / 40 AS t2_a, sum(n3_a) OVER b1 AS s2_a,
                   CAST(count(*) FILTER (WHERE n2_b > 0) OVER b1 AS DOUBLE) / 40 AS t2_b, sum(n3_b) OVER b1 AS s2_b,
                   CAST(count(*) FILTER (WHERE n1_a > 0) OVER () AS DOUBLE) / 1600 AS t1_a,
                   CAST(count(*) FILTER (WHERE n1_b > 0) OVER () AS DOUBLE) / 1600 AS t1_b
            FROM twos WINDOW ab AS (PARTITION BY a, b), b1 AS (PARTITION BY b)
        ), ones AS (
            SELECT *, CASE WHEN all_a > 0 THEN (n1_a + t1_a * (1.0::DOUBLE / 40)) / (all_a + t1_a) ELSE 1.0::DOUBLE / 40 END AS p1_a,
                   CASE WHEN all_b > 0 THEN (n1_b + t1_b * (1.0::DOUBLE / 40)) / (all_b + t1_b) ELSE 1.0::DOUBLE / 40 END AS p1_b
            FROM sums
        ), pairs AS (
            SELECT *, CASE WHEN s2_a > 0 THEN (n2_a + t2_a * p1_a) / (s2_a + t2_a) ELSE p1_a END AS p2_a,
                   CASE WHEN s2_b > 0 THEN (n2_b + t2_b * p1_b) / (s2_b + t2_b) ELSE p1_b END AS p2_b
            FROM ones
        ), ratios AS (
            SELECT gram, CAST(round((ln(CASE WHEN s3_a > 0 THEN (n3_a + t3_a * p2_a) / (s3_a + t3_a) ELSE p2_a END)
                   - ln(CASE WHEN s3_b > 0 THEN (n3_b + t3_b * p2_b) / (s3_b + t3_b) ELSE p2_b END)) * 1000000) AS BIGINT) AS ratio
            FROM pairs
        ), scored AS (
            SELECT address, any_value(says) AS says, CAST(sum(ratio) AS BIGINT) AS total, count(*) AS runs
            FROM runs JOIN ratios USING (gram) GROUP BY address
        ), bins AS (
            SELECT CAST(floor(CAST(total AS DOUBLE) / (runs * 1000)) AS BIGINT) AS bin,
                   count(*) FILTER (WHERE says = 'allow') AS allowed, count(*) FILTER (WHERE says = 'block') AS blocked
            FROM scored JOIN kept_out USING (address) WHERE says IS NOT NULL AND out GROUP BY 1
        ), rates AS (
            SELECT bin + coalesce(lag(bin) OVER (ORDER BY bin) + 1, bin) AS cut,
                   1 - coalesce(sum(allowed) OVER below, 0) / CAST(nullif(sum(allowed) OVER (), 0) AS DOUBLE)
                   + coalesce(sum(blocked) OVER below, 0) / CAST(nullif(sum(blocked) OVER (), 0) AS DOUBLE) AS rate
            FROM bins WINDOW below AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), best AS (
            SELECT coalesce((SELECT cut FROM rates WHERE rate IS NOT NULL ORDER BY rate DESC, abs(cut), cut DESC LIMIT 1), 0) AS cut
        )
        SELECT s.page_id, s.host, s.path, s.rule, CAST(total AS DOUBLE) / runs / 1000000 AS score,
               coalesce(s.says, CASE WHEN total * 2 >= cut * 1000 * runs THEN 'allow' ELSE 'block' END) AS verdict
        FROM said s JOIN scored USING (address), best
    """,
    "op9_exact_dedup": r"""
        WITH rows AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS normal FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept,
               sha256(normal) AS text_sha256
        FROM rows WINDOW same AS (PARTITION BY normal)
    """,
    "op11_fill_in_middle": r"""
        WITH hashed AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hash
            FROM documents
        ), cut AS (
            SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines,
                   CAST('0x' || substr(hash, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(hash, 9, 8) AS BIGINT) AS h2,
                   CAST('0x' || substr(hash, 25, 8) AS BIGINT) AS h4
            FROM hashed
        ), ends AS (
            SELECT doc_id, text, lines, CAST(len(lines) AS BIGINT) AS n,
                   least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a,
                   greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
                        WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
            FROM cut
        ), parts AS (
            SELECT doc_id, text, n, form, array_to_string(lines[1:a], '') AS prefix,
                   array_to_string(lines[a + 1:b], '') AS middle, array_to_string(lines[b + 1:], '') AS suffix
            FROM ends
        )
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts
    """,
}
