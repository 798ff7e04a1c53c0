"""SQL of the training-data queries that SQL can express; the others are tested against brute force."""

EMBEDDING_NEAR_DUPS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (
  SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v WHERE vec_id IS NOT NULL UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT v.vec_id, coalesce(n, 0) AS n_links, c AS component_id, v.vec_id = c AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) ON a = v.vec_id LEFT JOIN (SELECT a AS k, min(b) AS c FROM reach GROUP BY a) ON k = v.vec_id
"""

REPEATED_LINES = r"""
WITH docs AS (
  SELECT doc_id, length(text) AS size, string_split(regexp_replace(text, '[.!?…。！？]', chr(10), 'g'), chr(10)) AS parts,
         regexp_extract_all(lower(text), '[\x{0E00}-\x{0E7F}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}]|[\p{L}\p{N}_]+') AS words
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
cut AS (
  SELECT doc_id, size, n, length(parts[n]) AS l, len(regexp_extract_all(lower(parts[n]), '[\x{0E00}-\x{0E7F}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}]|[\p{L}\p{N}_]+')) AS k
  FROM docs, unnest(range(1, len(parts) + 1)) AS t(n)),
placed AS (
  SELECT *, CAST(sum(l + 1) OVER w AS INT) - l - 1 AS start, CAST(sum(k) OVER w AS INT) AS upto FROM cut WINDOW w AS (PARTITION BY doc_id ORDER BY n)),
pieces AS (
  SELECT doc_id, start, CAST(least(start + l + 1, size) AS INT) AS "end", upto - k AS word, upto, upto - k + 35 AS need FROM placed WHERE k > 0),
runs AS (
  SELECT a.doc_id, CAST(a.start AS INT) AS start, b."end", CAST(a.word AS INT) AS word, b.upto FROM pieces a ASOF JOIN pieces b ON a.doc_id = b.doc_id AND a.need <= b.upto),
units AS (
  SELECT r.*, md5(array_to_string(list_slice(d.words, word + 1, upto), ' ')) AS digest FROM runs r JOIN docs d USING (doc_id)),
firsts AS (
  SELECT digest, count(*) AS copies, min({'d': doc_id, 's': start}) AS first FROM units GROUP BY digest HAVING count(*) > 1),
found AS (
  SELECT units.*, copies, first, (doc_id, start) <> (first.d, first.s) AS removed FROM units JOIN firsts USING (digest)),
marked AS (
  SELECT *, coalesce(word > max(upto) OVER (PARTITION BY doc_id, removed ORDER BY word ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TRUE) AS new FROM found),
numbered AS (
  SELECT *, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id, removed ORDER BY word) AS passage FROM marked)
SELECT doc_id, min(start) AS start, max("end") AS "end", max(upto) - min(word) AS n_words, removed, max(copies) AS copies, min(first).d AS kept_id, min(first).s AS kept_start
FROM numbered GROUP BY doc_id, removed, passage
"""

TOP_PRODUCTS = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, row_number() OVER () AS n FROM embeddings),
good AS (
  SELECT vec_id, n, list_transform(e, lambda x: floor(256 * x)) AS x FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
ranked AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score, row_number() OVER (PARTITION BY q.n ORDER BY list_inner_product(q.x, c.x) DESC, c.vec_id NULLS LAST, c.n) AS rank
  FROM good q JOIN good c ON q.n <> c.n AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

REPAIRED_CONVERSATIONS = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, coalesce('=' || conv_id, '') AS k, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
folded AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda c: CAST(ascii(c) AS BIGINT))),
                            lambda c, b: list_reduce(list_prepend(xor(c, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 20 AS fold FROM keyed),
damaged AS (
  SELECT k, turn, CASE WHEN fold = 4 THEN 'user' ELSE role END AS role, CASE fold WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM folded, range(1 + CAST(fold = 3 AS INT)) WHERE fold <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
rows AS (
  SELECT *, substr(role, 1, 1) AS c, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault FROM placed),
steps AS (
  SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000 WHEN fault = 'truncated' THEN 5 ELSE 0 END AS t, lag(c) OVER (PARTITION BY k ORDER BY i) AS previous FROM rows),
sums AS (
  SELECT k, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (previous || c NOT IN ('su', 'ua', 'au')) AS illegal FROM steps GROUP BY k),
behind AS (
  SELECT k, n + 1 AS i, [0, 10, 5, 0] AS f FROM sums
  UNION ALL
  SELECT k, i, [least(a[1], 5 + b), least(a[2], 5 + b), b, least(a[4], 5 + a[3])]
  FROM (SELECT k, i, a, least(a[3], 5 + a[4]) AS b
        FROM (SELECT s.k, s.i, [least(2 + f[1], CASE WHEN c = 's' THEN t + f[2] WHEN c = 'u' THEN t + f[3] ELSE 1 + t + f[3] END, 1 + t + f[3]), least(2 + f[2], t + f[3] + CAST(c <> 'u' AS INT)),
                                least(2 + f[3], t + f[4] + CAST(c <> 'a' AS INT)), least(2 + f[4], t + f[3] + CAST(c <> 'u' AS INT))] AS a
              FROM behind JOIN steps s ON s.k = behind.k AND s.i = behind.i - 1))),
trace AS (
  SELECT k, CAST(1 AS BIGINT) AS i, 1 AS q, '' AS audit, CAST([] AS VARCHAR[]) AS kept FROM sums
  UNION ALL
  SELECT k, CASE WHEN e = 'I' THEN i ELSE i + 1 END, CASE WHEN e = 'D' THEN q WHEN e = 'K' AND c = 's' THEN 2 ELSE nq END, audit || e,
         CASE e WHEN 'D' THEN kept WHEN 'K' THEN list_append(kept, role || ':' || text) ELSE list_append(kept, CASE WHEN nq = 3 THEN 'user:' ELSE 'assistant:' END || CASE WHEN e = 'R' THEN text ELSE '' END) END
  FROM (SELECT *, CASE WHEN s.i IS NULL THEN CASE WHEN h.f[q] > 0 THEN 'I' END WHEN 2 + b.f[q] = h.f[q] THEN 'D' WHEN 5 + h.f[nq] = h.f[q] THEN 'I'
                       WHEN c = 's' AND q = 1 AND t + b.f[2] = h.f[q] OR c = CASE WHEN nq = 3 THEN 'u' ELSE 'a' END AND t + b.f[nq] = h.f[q] THEN 'K' ELSE 'R' END AS e
        FROM (SELECT k, i, q, audit, kept, CASE WHEN q = 3 THEN 4 ELSE 3 END AS nq FROM trace) AS now
        JOIN (SELECT k, i, f FROM behind) AS h USING (k, i) LEFT JOIN (SELECT k, i, role, text, c, t FROM steps) AS s USING (k, i) LEFT JOIN (SELECT k, i - 1 AS i, f FROM behind) AS b USING (k, i))
  WHERE e IS NOT NULL),
done AS (
  SELECT k, arg_max(audit, length(audit)) AS audit, arg_max(kept, length(audit)) AS kept FROM trace GROUP BY k),
costs AS (
  SELECT k, f[1] AS cost FROM behind WHERE i = 1)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(kept, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, k FROM keyed) LEFT JOIN sums USING (k) LEFT JOIN done USING (k) LEFT JOIN costs USING (k)
"""
