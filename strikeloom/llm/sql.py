"""The registered queries that SQL can express, for another engine over the same tables."""

SQL: dict[str, str] = {}

SQL["op2_quality_rules"] = r"""
WITH words AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^ \t-\r]')) AS l
    FROM documents
), numbered AS (SELECT row_number() OVER () AS r, * FROM words),
windows AS (
    SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
    FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM numbered)
), twice AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT r, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS k(k) GROUP BY r
), measured AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
           CAST(len(l) AS BIGINT) AS n_lines,
           CAST(len(list_filter(regexp_extract_all(text, '\pL+'),
                lambda x: regexp_full_match(x, '\p{Lu}{2,}'))) AS BIGINT) AS n_shouted
    FROM numbered LEFT JOIN covered USING (r)
), judged AS (
    SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
        + 4 * (10 * n_symbols > n_words)::INT + 8 * (10 * n_shouted > 3 * n_words)::INT
        + 16 * (2 * n_dup_lines > n_lines)::INT
        + 32 * (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words))::INT
        AS BIGINT) AS failures
    FROM measured
)
SELECT *, failures & 3 <> 0 AS base_failed, failures = 0 AS kept FROM judged
"""

SQL["op3_line_dedup"] = r"""
WITH lines AS (
    SELECT doc_id, unnest(range(len(l))) AS line_no, unnest(l) AS line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)
), taking AS (
    SELECT doc_id, line_no, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line
    FROM lines
    WHERE length(trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12))) >= 1
), firsts AS (
    SELECT line, min({'d': doc_id, 'n': line_no}) AS first FROM taking GROUP BY line
), variants AS (
    SELECT line, first, line AS v FROM firsts WHERE length(line) >= 20
    UNION
    SELECT line, first, left(line, i) || substr(line, i + 2) AS v
    FROM (SELECT line, first, unnest(range(length(line))) AS i FROM firsts WHERE length(line) >= 20)
), near AS (
    SELECT DISTINCT a.line FROM variants a JOIN variants b ON a.v = b.v AND b.first < a.first
    WHERE levenshtein(a.line, b.line) <= 1
), dropped AS (
    SELECT DISTINCT doc_id, line_no FROM taking t JOIN firsts f USING (line)
    WHERE {'d': doc_id, 'n': line_no} > first OR t.line IN (SELECT line FROM near)
), kept AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (d.line_no IS NOT NULL) AS n_removed,
           coalesce(string_agg(line, chr(10) ORDER BY l.line_no) FILTER (d.line_no IS NULL), '') AS text
    FROM lines l LEFT JOIN dropped d USING (doc_id, line_no) GROUP BY doc_id
)
SELECT doc_id, n_lines, n_removed, sha256(text) AS text_sha256 FROM kept
"""

SQL["op8_packing"] = r"""
WITH RECURSIVE sized AS (
    SELECT doc_id, len(regexp_extract_all(text, '[^ \t-\r]+')) AS n FROM documents
), pieces AS (
    SELECT doc_id, first_token // 2048 AS piece, first_token, least(2048, n - first_token) AS n_tokens
    FROM (SELECT doc_id, n, unnest(range(0, n, 2048)) AS first_token FROM sized WHERE n > 0)
), held AS (
    SELECT e AS edge, (SELECT count(*) FROM pieces WHERE n_tokens <= e) AS upto
    FROM (SELECT unnest(range(0, 2049, 64)) AS e)
), paths AS (
    SELECT 0 AS k, 0 AS edge, {'cost': 0::BIGINT, 'path': []::BIGINT[]} AS best
    UNION ALL
    SELECT p.k + 1, h.edge::INT,
           min({'cost': (p.best.cost + h.edge * (h.upto - g.upto))::BIGINT,
                'path': list_append(p.best.path, h.edge)})
    FROM paths p JOIN held g ON g.edge = p.edge JOIN held h ON h.edge > p.edge
    WHERE p.k < 8 GROUP BY p.k, h.edge
), chosen AS (
    SELECT best.path AS path FROM paths WHERE edge = 2048 ORDER BY best.cost, k LIMIT 1
), placed AS (
    SELECT doc_id, piece, first_token, n_tokens,
           (SELECT list_min(list_filter(path, lambda e: e >= n_tokens)) FROM chosen) AS bucket_tokens,
           md5(doc_id || ':' || piece) AS key
    FROM pieces
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY bucket_tokens ORDER BY key, doc_id, piece) - 1 AS place
    FROM placed
)
SELECT doc_id, CAST(piece AS BIGINT) AS piece, CAST(first_token AS BIGINT) AS first_token,
       CAST(n_tokens AS BIGINT) AS n_tokens, CAST(bucket_tokens AS BIGINT) AS bucket_tokens,
       CAST(place // greatest(1, 65536 // bucket_tokens) AS BIGINT) AS batch,
       CAST(place % greatest(1, 65536 // bucket_tokens) AS BIGINT) AS slot
FROM numbered
"""

SQL["op9_warc"] = r"""
WITH digests AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
           sha1(coalesce(html, '')) AS hex
    FROM pages
), letters AS (
    SELECT page_id, payload_bytes, hex, list_transform(range(0, 32), lambda i:
        list_reduce(list_transform(range(5 * i, 5 * i + 5), lambda b:
            ((strpos('0123456789abcdef', hex[1 + b // 4]) - 1) >> (3 - b % 4)) & 1),
            lambda x, y: 2 * x + y)) AS picks
    FROM digests
), answers AS (SELECT hex, max(page_id) AS answer FROM digests GROUP BY hex)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(picks,
           lambda p: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(p AS INT) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = answer THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = answer THEN NULL ELSE answer END AS refers_to
FROM letters JOIN answers USING (hex)
"""


def _vector_codes(rounds: int) -> str:
    """Codebooks as relations (p, e, v), each made from the one before by an assignment of all parts."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
assigned{k} AS (
    SELECT r, p, any_value(a.v) AS v, min({{'d': d, 'e': e}}) AS best FROM (
        SELECT r, p, x.v, e, CAST(list_sum(list_transform(range(1, len(x.v) + 1),
            lambda i: (x.v[i] - b.v[i]) * (x.v[i] - b.v[i]))) AS BIGINT) AS d
        FROM parts x JOIN book{k} b USING (p)
    ) a GROUP BY r, p
)""")
        if k < rounds:
            steps.append(f"""
means{k} AS (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
        SELECT p, best.e AS e, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n
        FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM assigned{k}) GROUP BY p, best.e, i
    ) GROUP BY p, e
)""")
            steps.append(f"""
book{k + 1} AS (
    SELECT p, e, coalesce(m.v, b.v) AS v FROM book{k} b LEFT JOIN means{k} m USING (p, e)
)""")
    return f"""
WITH whole AS (
    SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), kept AS (
    SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, x) AS r FROM whole
), parts AS (
    SELECT r, p, x[p * (len(x) // 16) + 1 : (p + 1) * (len(x) // 16)] AS v
    FROM (SELECT r, x, unnest(range(16)) AS p FROM kept)
), book0 AS (SELECT p, r - 1 AS e, v FROM parts WHERE r <= 64),{",".join(steps)},
coded AS (
    SELECT r, string_agg(lpad(printf('%x', best.e), 2, '0'), '' ORDER BY p) AS code,
           CAST(sum(best.d) AS BIGINT) AS error
    FROM assigned{rounds} GROUP BY r
), listed AS (
    SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, i)) AS digest
    FROM (SELECT p, e, unnest(v) AS c, unnest(range(len(v))) AS i FROM book{rounds})
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       digest AS codebooks_sha256
FROM kept JOIN coded USING (r), listed
"""


SQL["op11_vector_codes"] = _vector_codes(rounds=2)
