"""DuckDB SQL for the queries that SQL can express on the given tables.

No SQL: op1 and op7 (byte and word windows of whole texts with digests of what is left: too many rows at full size), op3, op6 and
op9 (fitted models), op4 (seeded order by XXH64), op5 (XXH64), op8 (edit distance to a stretch), op13 (tokenizers) and the pipeline. Their tests compare
with brute force, held-out accuracy or exact round trips.
"""

ORACLES = {
    "op2_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, b.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.c, b.c), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v b ON q.vec_id <> b.vec_id
            WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
        FROM scored
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 5
    """,
    "op10_warc": """
        WITH p AS (
            SELECT page_id, sha1(coalesce(html, '')) AS payload_digest,
                   CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes
            FROM pages
        ), o AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS owner FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND owner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND owner <> page_id THEN owner END AS refers_to
        FROM o
    """,
    "op11_phrases": r"""
        WITH texts AS (
            SELECT coalesce(lang, 'und') AS lang,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        ), pieces AS (
            SELECT lang, list_filter(string_split_regex(unnest(string_split_regex(t, '[.,;:!?\n\x0b\x0c\r]')), '[ \t]+'), lambda w: w <> '') AS w
            FROM texts
        ), grams AS (
            SELECT lang, unnest(w) AS p, 1 AS size FROM pieces
            UNION ALL
            SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])), 2 FROM pieces
            UNION ALL
            SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])), 3 FROM pieces
        ), f AS (
            SELECT lang, p, size, count(*) AS n FROM grams GROUP BY ALL
        ), totals AS (
            SELECT lang, sum(n) AS n FROM f WHERE size = 1 GROUP BY lang
        ), cand AS (
            SELECT lang, p, size, n AS a, string_split(p, ' ') AS w FROM f WHERE size > 1 AND n >= 10
        ), cuts AS (
            SELECT lang, p, a, k, array_to_string(w[:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
            FROM cand, (SELECT unnest([1, 2]) AS k) WHERE k < size
        ), scored AS (
            SELECT c.lang, c.p, c.a, x.n AS l, y.n AS r, k,
                   (1000000::HUGEINT * c.a * c.a) // (x.n::HUGEINT * y.n) AS score
            FROM cuts c JOIN f x ON x.lang = c.lang AND x.p = c.head JOIN f y ON y.lang = c.lang AND y.p = c.tail
        ), lowest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
        ), held AS (
            SELECT lang, part, max(a) AS longer
            FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part FROM cand WHERE size = 3)
            GROUP BY lang, part
        )
        SELECT s.lang, row_number() OVER w AS rank, s.p AS phrase, s.a, s.l, s.r, CAST(t.n AS BIGINT) AS n, CAST(s.score AS BIGINT) AS score
        FROM lowest s JOIN totals t ON t.lang = s.lang LEFT JOIN held h ON h.lang = s.lang AND h.part = s.p
        WHERE h.longer IS NULL OR 100 * h.longer < 50 * s.a
        WINDOW w AS (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.p)
        QUALIFY row_number() OVER w <= 2000
    """,
    "op12_chat_format": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), e AS (
            SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?(?:INST|TURN)\]|\|(?:image|audio|document|other):[0-9]+\|>)', '\1\2\\\3', 'g')) AS size
            FROM t
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(size + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 5 ELSE length(url_encode(role)) + 14 END) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id
    """,
}
