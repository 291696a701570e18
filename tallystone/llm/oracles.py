"""DuckDB SQL for the queries of this subpackage that SQL can express."""

OP9 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, CASE WHEN lag(role) OVER w = role THEN 0 ELSE 1 END AS opens,
         regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') AS esc_text,
         regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') AS esc_role
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(esc_text) + 13 + opens * (length(esc_role) + 7))::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS rid,
         coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), sized AS (SELECT item_id, w, least(13, len(w)) AS k FROM items WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM sized)
), lengths AS (SELECT DISTINCT k FROM windows
), places AS (
  SELECT rid, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, lengths WHERE len(w) >= k)
), hits AS (SELECT p.rid, p.i, p.k, x.item_id FROM places p JOIN windows x ON p.s = x.s AND p.k = x.k
), covered AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS j FROM hits) GROUP BY rid
), named AS (
  SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS s FROM hits WHERE item_id IS NOT NULL) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)
"""

OP10 = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), windows AS (
  SELECT rid, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS s
  FROM (SELECT *, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50)
), least AS (SELECT s, min(doc_id) AS lo FROM windows GROUP BY s
), gone AS (
  SELECT DISTINCT rid, unnest(range(i, i + 50)) AS j FROM windows JOIN least USING (s) WHERE lo < doc_id
), kept AS (
  SELECT x.rid, string_agg(word, ' ' ORDER BY x.j) FILTER (g.j IS NULL) AS t, count(g.j) AS n_removed
  FROM (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM docs) x LEFT JOIN gone g ON x.rid = g.rid AND x.j = g.j
  GROUP BY x.rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)
"""

OP3 = """
WITH rows AS (
  SELECT vec_id, row_number() OVER () AS rid, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), queries AS (SELECT DISTINCT vec_id AS query_id, e AS q FROM rows WHERE vec_id % 20 = 0
), scored AS (SELECT query_id, q, vec_id, list_dot_product(q, e) AS score FROM queries JOIN rows ON vec_id <> query_id
), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id, q ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

OP5 = """
WITH rows AS (
  SELECT page_id, row_number() OVER () AS rid, sha256(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS size, url FROM pages
), ranked AS (
  SELECT *, row_number() OVER w AS r, first_value(page_id) OVER w AS lead
  FROM rows WINDOW w AS (PARTITION BY digest ORDER BY page_id NULLS LAST, url NULLS FIRST, rid)
)
SELECT page_id, size::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN size >= 100 AND r > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN size >= 100 AND r > 1 THEN lead END AS refers_to
FROM ranked
"""

OP8 = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, row_number() OVER () AS rid,
         coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), shingles AS (
  SELECT DISTINCT rid, md5(array_to_string(w[i:i + 3], ' ')) AS s
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM docs WHERE len(w) > 0)
), sizes AS (SELECT rid, count(*) AS n FROM shingles GROUP BY rid
), common AS (
  SELECT a.rid AS a, b.rid AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.rid < b.rid GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.rid = a JOIN sizes y ON y.rid = b WHERE 100 * k >= 80 * (x.n + y.n - k)
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT rid AS a, rid AS b FROM docs UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a
), comp AS (SELECT reach.a AS rid, min(doc_id) AS component_id FROM reach JOIN docs ON reach.b = docs.rid GROUP BY reach.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM docs JOIN comp USING (rid) LEFT JOIN sizes USING (rid)
"""

OP11 = OP8.replace(">= 80 *", ">= 85 *").replace(", doc_id = component_id AS kept", "")

# crc32 by the definition: reflected polynomial, bit by bit
OP12 = r"""
WITH RECURSIVE bytes AS (SELECT range::BIGINT AS b FROM range(256)
), crcs AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t FROM bytes
), named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), kinds AS (
  SELECT *, xor(list_reduce(list_transform(string_split(k, ''), lambda ch: ascii(ch)::BIGINT), lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1]), 4294967295), 4294967295) % 20 AS kind
  FROM named, crcs
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM damaged
), faults AS (
  SELECT *, left(role, 1) AS f,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN nth > 1 THEN 'd'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '' END AS fault FROM ordered
), told AS (
  SELECT conv_id, count(*) AS n, CASE WHEN count(turn) = 0 THEN 0 ELSE TRY_CAST(max(turn)::HUGEINT - min(turn) + 1 - count(DISTINCT turn) AS BIGINT) END AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || f NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(f) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM faults) GROUP BY conv_id
), steps AS (  -- states: 0 nothing, 1 behind system, 2 behind user, 3 behind assistant
  SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) v(state, role, then_)
), inserted AS (
  SELECT * FROM (VALUES (0, 0, 0), (0, 1, 2), (0, 2, 3), (1, 0, 1), (1, 1, 2), (1, 2, 3), (2, 0, 2), (2, 1, 3), (3, 0, 3), (3, 1, 2)) v(state, n, held)
), dp AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit FROM told
  UNION ALL
  SELECT conv_id, i, state, cost, audit FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) AS r FROM (
      SELECT dp.conv_id, dp.i + 1 AS i, x.held AS state, dp.cost + 5 * x.n + 2 AS cost, audit || repeat('I', x.n) || 'D' AS audit
      FROM dp JOIN faults q ON q.conv_id IS NOT DISTINCT FROM dp.conv_id AND q.i = dp.i + 1 JOIN inserted x ON x.state = dp.state
      UNION ALL
      SELECT dp.conv_id, dp.i + 1, s.then_, dp.cost + 5 * x.n + e.c + CASE WHEN fault = 't' THEN 5 ELSE 0 END, audit || repeat('I', x.n) || e.e
      FROM dp JOIN faults q ON q.conv_id IS NOT DISTINCT FROM dp.conv_id AND q.i = dp.i + 1 AND q.fault NOT IN ('b', 'd') JOIN inserted x ON x.state = dp.state
           JOIN steps s ON s.state = x.held JOIN (VALUES ('K', 0), ('R', 1)) e(e, c) ON CASE WHEN e.e = 'K' THEN s.role = q.f ELSE s.role <> 's' END
    )) WHERE r = 1
), solved AS (
  SELECT * FROM (
    SELECT dp.conv_id, cost + 5 * x.n AS cost, audit || repeat('I', x.n) AS audit,
           row_number() OVER (PARTITION BY dp.conv_id ORDER BY cost + 5 * x.n, audit || repeat('I', x.n)) AS r
    FROM dp JOIN told ON told.conv_id IS NOT DISTINCT FROM dp.conv_id AND dp.i = told.n JOIN inserted x ON x.state = dp.state WHERE x.held IN (0, 3)) WHERE r = 1
), edits AS (
  SELECT conv_id, e, p, count(*) FILTER (e <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i
  FROM (SELECT conv_id, unnest(string_split(audit, '')) AS e, unnest(range(1, len(audit) + 1)) AS p FROM solved WHERE audit <> '')
), kept AS (
  SELECT edits.conv_id, e, CASE WHEN e = 'I' THEN '' ELSE text END AS text, role, f, row_number() OVER (PARTITION BY edits.conv_id ORDER BY p) AS j
  FROM edits LEFT JOIN faults ON faults.conv_id IS NOT DISTINCT FROM edits.conv_id AND faults.i = edits.i WHERE e <> 'D'
), placed AS (
  SELECT *, max(CASE WHEN j = 1 AND e = 'K' AND f = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS led FROM kept
), joined AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (j - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j) AS t FROM placed GROUP BY conv_id
), ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, CASE WHEN n IS NULL THEN 0 END)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(t, '')) AS repaired_sha256
FROM ids LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN solved ON solved.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN joined ON joined.conv_id IS NOT DISTINCT FROM ids.conv_id
"""


def _lloyd(rounds: int = 10, k: int = 8, size: int = 64) -> str:
    """One relation of centroids a round; sums and divisions are whole numbers."""
    sql = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS rid, embedding::DOUBLE[] AS e, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, e) - 1 AS c, v AS m FROM (SELECT *, sha256('3:' || vec_id) AS h FROM kept ORDER BY h NULLS LAST, e LIMIT {k})
)"""
    for r in range(rounds + 1):
        sql += f""", a{r} AS MATERIALIZED (
  SELECT * FROM (
    SELECT rid, vec_id, v, c, d, row_number() OVER (PARTITION BY rid ORDER BY d, c) AS r
    FROM (SELECT *, list_sum(list_transform(range(1, {size + 1}), lambda i: (v[i] - m[i]) * (v[i] - m[i]))) AS d FROM kept, c{r})) WHERE r = 1
)"""
        if r < rounds:
            sql += f""", s{r} AS (
  SELECT c, i, sum(x) AS s, count(*)::HUGEINT AS n FROM (SELECT c, unnest(v) AS x, unnest(range(1, {size + 1})) AS i FROM a{r}) GROUP BY c, i
), c{r + 1} AS MATERIALIZED (
  SELECT c{r}.c, coalesce(n.m, c{r}.m) AS m
  FROM c{r} LEFT JOIN (SELECT c, list(((s - (s % n + n) % n) // n)::BIGINT ORDER BY i) AS m FROM s{r} GROUP BY c) n ON n.c = c{r}.c
)"""
    return sql + f"""
SELECT vec_id, a.c::INT AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} f ON a.c = f.c
"""


OP13 = _lloyd()

ORACLES = {
    "op2_benchmark_decontamination": OP2,
    "op9_chat_formatting": OP9,
    "op3_nearest_neighbours": OP3,
    "op5_warc": OP5,
    "op8_minhash_near_dedup": OP8,
    "op10_substring_dedup": OP10,
    "op11_jaccard_join": OP11,
    "op12_conversation_repair": OP12,
    "op13_centroid_clustering": OP13,
}
