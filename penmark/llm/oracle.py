"""DuckDB SQL for the queries that SQL can express."""

SQL = {
    "op2_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op5_jaccard_join": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS s
    FROM words
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
    FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
    WHERE 100 * common >= 85 * (a.n + b.n - common)
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, l.y FROM reached r JOIN (SELECT x, y FROM links UNION ALL SELECT y, x FROM links) l ON l.x = r.other
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
""",
    "op8_warc": """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
), g AS (
    SELECT page_id, payload, strlen(payload) AS payload_bytes, max(page_id) OVER (PARTITION BY payload) AS keep FROM p
)
SELECT page_id, payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep THEN keep END AS refers_to
FROM g
""",
    "op12_conversation_repair": r"""
WITH RECURSIVE shown AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')) AS k
    FROM conversations
), drawn AS (
    SELECT *, xor(list_reduce(
        list_prepend(4294967295::UBIGINT, [('0x' || substr(hex(k), 2 * i - 1, 2))::UBIGINT FOR i IN range(1, octet_length(k) + 1)]),
        lambda c, b: list_reduce([xor(c, b), 1, 1, 1, 1, 1, 1, 1, 1],
            lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)), 4294967295::UBIGINT) % 20 AS fate
    FROM shown
), damaged AS (
    SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
           CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
    FROM drawn WHERE fate <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
           left(role, 1) AS initial, right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS last
    FROM damaged
), faults AS (
    SELECT *, CASE WHEN last = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                   WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
    FROM placed
), edges(p, q, edit, cost) AS (
    SELECT p, q, unnest(['R', 'I']), unnest([1, 5]) FROM (VALUES (0, 2), (1, 2), (2, 3), (3, 2)) v(p, q)
    UNION ALL SELECT unnest(range(4)), unnest(range(4)), 'D', 2
    UNION ALL SELECT p, q, 'K', 0 FROM (VALUES (0, 1), (0, 2), (1, 2), (2, 3), (3, 2)) v(p, q)
), inserts(p, q, cost, audit, said) AS (
    SELECT unnest(range(4)), unnest(range(4)), 0, '', []::VARCHAR[]
    UNION ALL
    SELECT i.p, e.q, i.cost + 5, i.audit || 'I', list_append(i.said, CASE e.q WHEN 2 THEN 'user:' ELSE 'assistant:' END)
    FROM inserts i JOIN edges e ON e.p = i.q AND e.edit = 'I' WHERE len(i.said) < 3
), states AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, 0 AS cost, '' AS audit, []::VARCHAR[] AS said FROM damaged
    UNION ALL
    SELECT conv_id, i, state, w.cost, w.audit, w.said FROM (
        SELECT s.conv_id, f.i, e.q AS state, min({
            'cost': s.cost + n.cost + e.cost + CASE WHEN fault = 't' AND edit <> 'D' THEN 5 ELSE 0 END,
            'audit': s.audit || n.audit || edit,
            'said': list_concat(list_concat(s.said, n.said), CASE edit WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text]
                ELSE [CASE e.q WHEN 2 THEN 'user:' ELSE 'assistant:' END || text] END)}) AS w
        FROM states s JOIN faults f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i + 1
        JOIN inserts n ON n.p = s.state JOIN edges e ON e.p = n.q
        WHERE edit <> 'I' AND (edit = 'D' OR fault NOT IN ('b', 'd')) AND (edit <> 'K' OR initial = substr('sua', e.q, 1))
        GROUP BY s.conv_id, f.i, e.q
    )
), ended AS (
    SELECT s.conv_id, min({'cost': s.cost + n.cost, 'audit': s.audit || n.audit, 'said': list_concat(s.said, n.said)}) AS w
    FROM states s JOIN (SELECT conv_id, max(i) AS i FROM faults GROUP BY conv_id) l
      ON l.conv_id IS NOT DISTINCT FROM s.conv_id AND l.i = s.i
    JOIN inserts n ON n.p = s.state WHERE n.q IN (0, 3) GROUP BY s.conv_id
), tallies AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
           count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faults GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(w.cost, 0)::BIGINT AS cost,
       coalesce(w.audit, '') AS audit, sha256(coalesce(array_to_string(w.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN tallies t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
""",
    "op13_suffix_array_dedup": """
WITH texts AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), strings AS (
    SELECT doc_id, p, substr(h, 2 * p - 1, 100) AS s
    FROM (SELECT doc_id, h, unnest(range(1, length(h) // 2 - 48)) AS p FROM texts)
), owners AS (
    SELECT s, min(doc_id) AS owner FROM strings GROUP BY s HAVING min(doc_id) < max(doc_id)
), gone AS (
    SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50, TRUE) AS fresh
    FROM strings JOIN owners USING (s) WHERE owner < doc_id
), numbered AS (
    SELECT doc_id, p, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM gone
), spans AS (
    SELECT doc_id, min(p) AS a, max(p) + 49 AS b FROM numbered GROUP BY doc_id, k
), before AS (
    SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS last FROM spans
), kept AS (
    SELECT doc_id, string_agg(substr(h, 2 * last + 1, 2 * (a - 1 - last)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS h,
           sum(b - a + 1) AS n_removed, count(*) AS n_spans
    FROM before JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, length(t.h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k.h, t.h))) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (doc_id)
""",
}
