"""SQL that DuckDB runs for the registered queries it can express.

The others are tested against brute force: they need a checksum, a tokenizer, a trained model
or hashes that DuckDB does not have.
"""

#: Reachability over links `e` (a, b), both ways, from every node of `v` (id).
REACH = """reach AS (
  SELECT id, id AS node FROM v
  UNION
  SELECT reach.id, e.b FROM reach JOIN e ON e.a = reach.node
), found AS (SELECT id, min(node) AS component_id FROM reach GROUP BY id)"""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [ws]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: ws[i:i + 3]) END) AS g FROM w
), n AS (SELECT w.doc_id, count(g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id
), shared AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1
), p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM (SELECT * FROM s SEMI JOIN shared USING (g)) x JOIN s y USING (g)
  WHERE x.doc_id < y.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), v AS (SELECT doc_id AS id FROM documents
), {REACH}
SELECT doc_id, n AS n_shingles, component_id FROM n JOIN found ON id = doc_id
"""

OP5 = rf"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS h
  FROM w, unnest(range(1, len(ws) - 11)) AS t(i)
), d AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS least FROM g) WHERE least < doc_id
), gone AS (SELECT doc_id, list(DISTINCT j) AS places FROM (SELECT doc_id, unnest(range(i, i + 13)) AS j FROM d) GROUP BY doc_id
), k AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(len(places), 0) AS n_removed,
    array_to_string(list_filter(ws, lambda x, i: NOT coalesce(list_contains(places, i), false)), ' ') AS kept
  FROM w LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM k
"""

OP6 = f"""
WITH RECURSIVE x AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS q FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), e AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM x a JOIN x b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE list_cosine_similarity(a.q, b.q) >= 0.93
), v AS (SELECT vec_id AS id FROM embeddings
), {REACH}
SELECT vec_id, (SELECT count(*) FROM e WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN found ON id = vec_id
"""

OP8 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len({WORDS}) AS size,
    ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS h FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM d GROUP BY source
), t AS (SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE AS budget FROM s
), fill AS (
  SELECT 0 AS round, source, source_size, weight, false AS held, 0.0::DOUBLE AS target FROM s
  UNION ALL
  SELECT round + 1, source, source_size, weight, target >= 2 * source_size AS held, target FROM (
    SELECT round, source, source_size, weight,
      CASE WHEN held THEN (2 * source_size)::DOUBLE ELSE weight * (
        (SELECT budget FROM t) - coalesce(sum(CASE WHEN held THEN 2 * source_size END) OVER (), 0)::DOUBLE
      ) / sum(CASE WHEN NOT held THEN weight END) OVER () END AS target FROM fill
  ) WHERE round < 60
), g AS (
  SELECT source, source_size, CASE WHEN target >= 2 * source_size THEN (2 * source_size)::DOUBLE ELSE target END AS target
  FROM fill WHERE round = 60
), b AS (
  SELECT source, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes FROM g
), c AS (SELECT source, h, sum(size) AS size FROM d GROUP BY source, h
), k AS (
  SELECT c.source, c.h, c.size, target - passes * source_size AS rest,
    sum(c.size) OVER (PARTITION BY c.source ORDER BY c.h) - c.size AS before
  FROM c JOIN b ON b.source IS NOT DISTINCT FROM c.source
), m AS (
  SELECT source, h, before + size <= rest OR (before <= rest AND rest - before > before + size - rest) AS once FROM k
)
SELECT d.doc_id, d.size::BIGINT AS size, b.source_size, b.target,
  (d.size * (b.passes + CASE WHEN m.once AND d.size > 0 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN b ON b.source IS NOT DISTINCT FROM d.source JOIN m ON m.source IS NOT DISTINCT FROM d.source AND m.h = d.h
"""

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

OP11 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({LOWER}, '{TERM}') AS ts FROM documents
), c AS (SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(ts) AS term FROM d) GROUP BY ALL
), k AS (SELECT lang, term FROM c GROUP BY lang, term HAVING count(*) >= 30
), g AS (SELECT DISTINCT lang, source FROM d
), u AS (SELECT lang, source, term, sum(n)::HUGEINT AS n FROM c SEMI JOIN k USING (lang, term) GROUP BY ALL
), f AS (
  SELECT g.lang, g.source, k.term, coalesce(u.n, 0::HUGEINT) AS n
  FROM g JOIN k ON k.lang = g.lang LEFT JOIN u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term
), p AS (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) //
    (sum(n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source))::HUGEINT AS p FROM f
), l AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM u GROUP BY ALL
), q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) //
    (sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang))::HUGEINT AS q FROM l
), s AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), e AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM e QUALIFY part = 'pair' OR rank <= 50
"""

#: The unsigned CRC-32 of an ASCII string: every byte is added, then takes eight steps (-1).
CRC = """xor(list_reduce(flatten(list_transform(string_split({}, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, CASE WHEN a % 2 = 1 THEN 3988292384 ELSE 0 END) END,
    4294967295::BIGINT), 4294967295::BIGINT)"""

OP12 = rf"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS r, {WORDS} AS ws, {CRC.format("doc_id::VARCHAR")} AS h FROM documents
), a AS (
  SELECT *, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM w
), t AS (
  SELECT doc_id, r, CASE WHEN a IS NULL THEN ws ELSE list_transform(range(len(ws)), lambda i:
    ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(ws) - a) // (3 + (h // 10) % 8)) END]) END AS ws FROM a
), x AS (SELECT r, len(ws) AS n, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM t
), m AS (
  -- Words that repeat q words later; a run of period q is 2 q of them in a row, 16 at least.
  SELECT p.r, q.i - p.i AS q, p.i FROM x p JOIN x q ON p.r = q.r AND p.word = q.word AND q.i > p.i AND (q.i - p.i) * 3 <= p.n
), b AS (
  SELECT r, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM m) GROUP BY r, q, island
  HAVING count(*) + q >= greatest(24, 3 * q)
), runs AS (SELECT r, start, length, min(q) AS period FROM b GROUP BY ALL
), best AS (
  SELECT DISTINCT ON (r) * FROM runs
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY length / period::DOUBLE DESC, start, period) = 1
), gone AS (SELECT r, list(DISTINCT j) AS places FROM (SELECT r, unnest(range(start + period, start + length)) AS j FROM runs) GROUP BY r
), total AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start, best.length, best.period,
  (1000 * best.length) // best.period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(coalesce(array_to_string(list_filter(ws, lambda v, i: NOT coalesce(list_contains(places, i - 1), false)), ' '), '')) AS collapsed_sha256
FROM t LEFT JOIN total USING (r) LEFT JOIN best USING (r) LEFT JOIN gone USING (r)
"""

ORACLES = {"op1_ngram_jaccard": OP1, "op5_substring_dedup": OP5, "op6_embedding_dedup": OP6, "op8_mixing": OP8}
ORACLES |= {"op11_source_divergence": OP11, "op12_periodic_runs": OP12}
