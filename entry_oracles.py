"""DuckDB SQL for the registered queries, over the same parquet tables."""

from __future__ import annotations

from kinseek.fixed_values import (
    BM25_B,
    BM25_K1,
    DIAGNOSIS_KEY_TERMS,
    RECORD_DIAGNOSES,
    SOURCE_PREFIXES,
)
from kinseek.operators.dense import OVERSAMPLE, PLANE_FACTORS, SKETCH_BITS
from kinseek.operators.dense import PLANE_MODULUS as _M
from kinseek.sources.derived import (
    BARE_COLUMNS,
    CHUNK_WORDS,
    LINE_SQL,
    NOTE_COLUMNS,
    QUERY_TEXTS,
    REPEATED_COLUMNS,
)

_F1, _F2 = PLANE_FACTORS


def _found(terms) -> str:
    cases = ", ".join(f"CASE WHEN contains(low, '{t}') THEN '{t}' END" for t in sorted(terms))
    return f"concat_ws('|', {cases})"


_PREFIX = " ".join(
    f"WHEN source_id = '{s}' THEN regexp_replace(upper(trim(mrn)), '^{p}', '')"
    for s, p in SOURCE_PREFIXES.items()
)
_UID = (
    "concat('P', upper(substr(sha256(CASE WHEN mrn_key = '' AND triplet = '' THEN concat('note:', note_uid) "
    "ELSE concat_ws('|', CASE WHEN mrn_key <> '' THEN concat('mrn:', mrn_key) END, "
    "CASE WHEN triplet <> '' THEN concat('triplet:', triplet) END) END), 1, 8)))"
)

# --- notes and keys -----------------------------------------------------------

_TIE = "substr(md5(concat_ws('|', coalesce(uid, ''), coalesce(mrn, ''), coalesce(source_id, ''), coalesce(dob, ''), coalesce(sex, ''), coalesce(raw_text, ''))), 1, 16)"


def _notes(columns: dict[str, str]) -> str:
    return f"""notes AS (
  SELECT {", ".join(f"{sql} AS {name}" for name, sql in columns.items())} FROM documents
), lowered AS (
  SELECT *, uid AS note_uid, lower(coalesce(raw_text, '')) AS low, {_TIE} AS tie FROM notes WHERE uid <> ''
), keys AS (
  SELECT ord, tie, note_uid, mrn, source_id, dob, sex, {_found(RECORD_DIAGNOSES)} AS phrases,
    {_found(DIAGNOSIS_KEY_TERMS)} AS dx,
    CASE {_PREFIX} ELSE upper(trim(mrn)) END AS mrn_key
  FROM lowered
), keyed AS (SELECT *, concat(dob, '|', sex, '|', dx) AS triplet FROM keys
), numbered AS (SELECT *, {_UID} AS own_uid, row_number() OVER (ORDER BY ord, tie) AS rn FROM keyed)"""


NOTES = _notes(NOTE_COLUMNS)

LINKED = f"""{NOTES}, walk AS (
  SELECT 0::BIGINT AS rn, ''::VARCHAR AS patient_uid, ''::VARCHAR AS rule,
    MAP {{}}::MAP(VARCHAR, VARCHAR) AS by_mrn, MAP {{}}::MAP(VARCHAR, VARCHAR) AS by_triplet
  UNION ALL
  SELECT rn,
    CASE rule WHEN 'mrn_match' THEN m WHEN 'triplet_match' THEN t ELSE own_uid END, rule,
    CASE WHEN rule = 'new_patient' AND mrn_key <> ''
      THEN map_concat(by_mrn, MAP([mrn_key], [own_uid])) ELSE by_mrn END,
    CASE WHEN rule = 'new_patient'
      THEN map_concat(by_triplet, MAP([triplet], [own_uid])) ELSE by_triplet END
  FROM (
    SELECT *, CASE WHEN m IS NOT NULL THEN 'mrn_match' WHEN t IS NOT NULL THEN 'triplet_match'
      ELSE 'new_patient' END AS rule
    FROM (
      SELECT n.rn, n.mrn_key, n.triplet, n.own_uid, w.by_mrn, w.by_triplet,
        CASE WHEN n.mrn_key <> '' THEN w.by_mrn[n.mrn_key] END AS m, w.by_triplet[n.triplet] AS t
      FROM walk w JOIN numbered n ON n.rn = w.rn + 1
    )
  )
), linked AS (
  SELECT n.*, w.patient_uid, w.rule FROM numbered n JOIN walk w USING (rn)
)"""

LINKED_REPEATED = LINKED.replace(NOTES, _notes(REPEATED_COLUMNS))

# Without identifiers there is no triplet to look up or to hold.
LINKED_STRICT = (
    LINKED.replace(NOTES, _notes(BARE_COLUMNS).replace("concat(dob, '|', sex, '|', dx) AS triplet", "CASE WHEN dob IS NULL AND sex IS NULL AND dx = '' THEN '' ELSE concat(dob, '|', sex, '|', dx) END AS triplet"))
    .replace("WHEN rule = 'new_patient'\n      THEN map_concat(by_triplet", "WHEN rule = 'new_patient' AND triplet <> ''\n      THEN map_concat(by_triplet")
    .replace("w.by_triplet[n.triplet] AS t", "CASE WHEN n.triplet <> '' THEN w.by_triplet[n.triplet] END AS t")
)
_LINK_ROWS = """SELECT note_uid, patient_uid, rule, mrn, source_id,
        CASE rule WHEN 'mrn_match' THEN 0.9::DOUBLE WHEN 'triplet_match' THEN 0.7 ELSE 1.0 END AS confidence
        FROM linked"""

_SORTED = (
    "coalesce(array_to_string(list_sort(list_distinct(list({0}) FILTER (WHERE {0} <> ''))), '|'), '')"
)


def _patients(members: str, extra: str = "") -> str:
    return f"""per_patient AS (
  SELECT patient_uid, {_SORTED.format("mrn")} AS mrn_set, arg_min(dob, ord) AS dob,
    arg_min(sex, ord) AS sex, count(*) AS notes_linked, {_SORTED.format("source_id")} AS sources
  FROM {members} GROUP BY patient_uid
), phrase_rows AS (
  SELECT DISTINCT patient_uid, unnest(string_split(phrases, '|')) AS p FROM {members}
), phrase_sets AS (
  SELECT patient_uid, string_agg(p, '|' ORDER BY p) AS diagnoses
  FROM phrase_rows WHERE p <> '' GROUP BY patient_uid
)
SELECT patient_uid, mrn_set, dob, sex, coalesce(diagnoses, '') AS diagnoses, notes_linked, sources
  {", coalesce(conflict_set, '') AS conflict_set" if extra else ""}
FROM per_patient LEFT JOIN phrase_sets USING (patient_uid) {extra}"""


# A uid that repeats has the content of its last line, whatever patient a line went to.
MEMBERS = """members AS (
  SELECT f.patient_uid, note_uid, f.rn, l.mrn, l.source_id, l.dob, l.sex, l.phrases
  FROM (SELECT patient_uid, note_uid, min(rn) AS rn FROM linked GROUP BY ALL) f
  JOIN (SELECT * FROM linked QUALIFY row_number() OVER (PARTITION BY note_uid ORDER BY rn DESC) = 1) l USING (note_uid)
)"""

CONFLICTS = """held AS (
  SELECT 'mrn' AS kind, mrn_key AS key, patient_uid, min(ord) AS seen, arg_min(note_uid, ord) AS note_uid
  FROM linked WHERE mrn_key <> '' GROUP BY ALL
  UNION ALL
  SELECT 'triplet', triplet, patient_uid, min(ord), arg_min(note_uid, ord) FROM linked GROUP BY ALL
), conflicts AS (
  SELECT concat(kind, '_conflict') AS type, CASE WHEN kind = 'mrn' THEN key END AS mrn,
    CASE WHEN kind = 'triplet' THEN key END AS triplet, patient_1, patient_uid AS patient_2, note_uid
  FROM (SELECT *, first_value(patient_uid) OVER (PARTITION BY kind, key ORDER BY seen) AS patient_1
        FROM held)
  WHERE patient_uid <> patient_1
), conflict_sets AS (
  SELECT patient_uid, string_agg(other, '|' ORDER BY other) AS conflict_set
  FROM (SELECT patient_1 AS patient_uid, patient_2 AS other FROM conflicts
        UNION SELECT patient_2, patient_1 FROM conflicts) GROUP BY patient_uid
)"""

STATS = """stats AS (
  SELECT count(DISTINCT note_uid) AS total_notes,
    count(DISTINCT patient_uid) FILTER (WHERE rule = 'new_patient') AS total_patients,
    count(*) FILTER (WHERE rule = 'mrn_match') AS mrn_match_count,
    count(*) FILTER (WHERE rule = 'triplet_match') AS triplet_match_count,
    count(*) FILTER (WHERE rule = 'new_patient') AS new_patient_count
  FROM linked)"""

# --- chunks and queries -------------------------------------------------------

CHUNKS = rf"""pieces AS (
  SELECT doc_id, source, regexp_extract_all(text, '(?:\S+\s*){{1,{CHUNK_WORDS}}}') AS p FROM documents
), placed AS (SELECT *, unnest(range(len(p))) AS i FROM pieces
), chunks AS (
  SELECT concat('chunk_', doc_id, '_', i) AS chunk_id, p[i + 1] AS text, source AS source_id,
    concat('note_', doc_id) AS note_uid, i * {CHUNK_WORDS} AS chunk_offset,
    concat(source, '.txt') AS source_file, lower(p[i + 1]) AS low
  FROM placed
)"""

_VALUES = ", ".join(f"({i}, '{q}')" for i, q in QUERY_TEXTS)
_TERMS = r"""qlists AS (
  SELECT query_id, list_filter(string_split_regex(lower(query), '\s+'), lambda x: x <> '') AS terms
  FROM queries
), qterms AS (SELECT query_id, unnest(terms) AS term, unnest(range(len(terms))) AS term_idx FROM qlists
), words AS (
  SELECT chunk_id, list_filter(string_split_regex(low, '\s+'), lambda x: x <> '') AS ws FROM chunks
)"""
TEXT_QUERIES = f"queries(query_id, query) AS (VALUES {_VALUES}), {_TERMS}"
BENCHMARK_QUERIES = f"queries AS (SELECT item_id AS query_id, text AS query FROM benchmark), {_TERMS}"

HITS = """term_counts AS (SELECT query_id, term, count(*) AS times FROM qterms GROUP BY ALL
), hits AS (
  SELECT query_id, chunk_id, source_id, note_uid,
    sum(times * ((length(low) - length(replace(low, term, ''))) // length(term)))::BIGINT AS tf,
    sum(times)::BIGINT AS present
  FROM chunks JOIN term_counts ON contains(low, term) GROUP BY ALL
), lexical AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY tf DESC, chunk_id) AS rank
  FROM hits QUALIFY rank <= 200
), presence AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY present DESC, chunk_id) AS rank
  FROM hits QUALIFY rank <= 200
)"""

BM25 = f"""corpus AS (SELECT count(*) AS n, avg(len(ws)) AS avgdl FROM words
), token_rows AS (SELECT chunk_id, len(ws) AS dl, unnest(ws) AS term FROM words
), tf AS (SELECT chunk_id, dl, term, count(*) AS tf FROM token_rows GROUP BY ALL
), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term
), bm25_all AS (
  SELECT query_id, chunk_id,
    round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * ({BM25_K1} + 1)
      / (tf + {BM25_K1} * (1 - {BM25_B} + {BM25_B} * dl / avgdl))), 9) AS score
  FROM qterms JOIN tf USING (term) JOIN df USING (term), corpus GROUP BY ALL
), bm25 AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank
  FROM bm25_all QUALIFY rank <= 200
)"""

MERGED = """merged AS (
  SELECT query_id, chunk_id, coalesce(l.tf * 0.1::DOUBLE, 0) AS s_bm25,
    coalesce(d.present * 0.2::DOUBLE, 0) AS s_dense, l.rank AS r1, d.rank AS r2,
    coalesce(l.source_id, d.source_id) AS source_id, coalesce(l.note_uid, d.note_uid) AS note_uid
  FROM lexical l FULL JOIN presence d USING (query_id, chunk_id)
)"""


def _scaled(x: str) -> str:
    return (
        f"CASE WHEN max({x}) OVER q = min({x}) OVER q THEN 0.5::DOUBLE ELSE "
        f"({x} - min({x}) OVER q) / (max({x}) OVER q - min({x}) OVER q) END"
    )


def _fused(w1: str = "0.5", w2: str = "0.5", left: str = "", right: str = "") -> str:
    left, right = left or _scaled("s_bm25"), right or _scaled("s_dense")
    return f"""fused_all AS (
  SELECT *, {w1}::DOUBLE * ({left}) + {w2}::DOUBLE * ({right}) AS fusion_score
  FROM merged WINDOW q AS (PARTITION BY query_id)
), fused AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(fusion_score, 9) DESC,
    r1 NULLS LAST, r2 NULLS LAST, chunk_id) AS rank FROM fused_all QUALIFY rank <= 200
)"""


def _logit(score: str, rank: str) -> str:
    place = (
        f"CASE WHEN {rank} IS NULL THEN count(*) OVER q ELSE "
        f"rank() OVER (PARTITION BY query_id ORDER BY {score} DESC) END"
    )
    p = f"((count(*) OVER q - ({place}) + 0.5::DOUBLE) / count(*) OVER q)"
    return f"ln({p} / (1 - {p}))"


_FLAT = """SELECT query_id, chunk_id, round(s_bm25, 6) AS s_bm25, round(s_dense, 6) AS s_dense,
  source_id, note_uid, round(fusion_score, 6) AS fusion_score, rank FROM fused"""
_STAGE_A = f"{CHUNKS}, {TEXT_QUERIES}, {HITS}, {MERGED}, {_fused()}"


def _rescored(depth: int = 50, max_len: int | None = None) -> str:
    ws = "ws" if max_len is None else f"ws[1:{max_len}]"
    return f"""taken AS (
  SELECT f.*, {ws} AS ws, low, chunk_offset, source_file
  FROM fused f JOIN words USING (chunk_id) JOIN chunks USING (chunk_id) WHERE f.rank <= {depth}
), word_rows AS (
  SELECT query_id, chunk_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM taken
), matches AS (
  SELECT w.*, term, term_idx FROM word_rows w JOIN qterms q
    ON w.query_id = q.query_id AND (contains(word, term) OR contains(term, word))
), counted AS (SELECT query_id, chunk_id, count(*) AS n FROM matches GROUP BY ALL
), rescored AS (
  SELECT * EXCLUDE (rank), rank AS before, row_number() OVER (PARTITION BY query_id
    ORDER BY round(s_li, 9) DESC, rank) AS new_rank
  FROM (SELECT t.*, least(0.3::DOUBLE * coalesce(n, 0) / len(terms), 1) AS s_li
        FROM taken t JOIN qlists USING (query_id) LEFT JOIN counted USING (query_id, chunk_id))
)"""


def _judged(clip: bool, k: int = 10) -> str:
    raw = "0.4::DOUBLE * present + 0.1::DOUBLE * overlap"
    raw = f"least({raw}, 1)" if clip else raw
    return f"""final_in AS (SELECT * EXCLUDE (new_rank), new_rank AS b_rank FROM rescored WHERE new_rank <= {k}
), pair_words AS (SELECT query_id, chunk_id, unnest(ws) AS word FROM final_in
), letter_overlaps AS (
  SELECT w.query_id, chunk_id,
    sum(len(list_intersect(list_distinct(string_split(word, '')), list_distinct(string_split(term, ''))))
      / len(list_distinct(string_split(concat(word, term), '')))) AS overlap
  FROM pair_words w JOIN qterms q ON w.query_id = q.query_id AND length(term) > 2 AND length(word) > 2
  GROUP BY ALL
), presents AS (
  SELECT f.query_id, f.chunk_id, count(*) AS present
  FROM final_in f JOIN qterms q ON f.query_id = q.query_id AND contains(low, term) GROUP BY ALL
), raws AS (
  SELECT f.*, {raw} AS raw_xenc_score
  FROM (SELECT f.*, coalesce(present, 0) AS present, coalesce(overlap, 0) AS overlap FROM final_in f
        LEFT JOIN letter_overlaps USING (query_id, chunk_id) LEFT JOIN presents USING (query_id, chunk_id)) f
), judged AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(calibrated_score, 9) DESC, b_rank)
    AS final_rank
  FROM (SELECT *, {_scaled("raw_xenc_score")} AS calibrated_score
        FROM raws WINDOW q AS (PARTITION BY query_id))
)"""


# --- vectors ------------------------------------------------------------------


def _means(name: str, keys: str) -> str:
    return f"""{name}_rows AS (
  SELECT {keys}, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS pos FROM embeddings
), {name}_avg AS (
  SELECT * EXCLUDE (v), avg(v) AS a FROM {name}_rows GROUP BY ALL
), {name} AS (SELECT * EXCLUDE (pos, a), list(a ORDER BY pos) AS vector FROM {name}_avg GROUP BY ALL)"""


def _cosine(vectors: str, queries: str, k: int, name: str = "ranked") -> str:
    return f"""{name}_all AS (
  SELECT query_id, chunk_id, round(list_cosine_similarity(v.vector, q.vector), 6) AS score
  FROM {vectors} v, {queries} q
), {name} AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank
  FROM {name}_all QUALIFY rank <= {k}
)"""


_LABELLED = """labelled AS (
  SELECT doc_id, ((length(low) - length(replace(low, 'the', ''))) // 3)::DOUBLE AS raw, quality::DOUBLE AS y
  FROM (SELECT doc_id, lower(text) AS low FROM documents) JOIN labels USING (doc_id)
), levels AS (SELECT raw, sum(y) AS s, count(*)::DOUBLE AS w FROM labelled GROUP BY raw)"""

_ISOTONIC = f"""WITH {_LABELLED}, spans AS (
  SELECT a.raw AS lo, b.raw AS hi, sum(l.s) / sum(l.w) AS mean
  FROM levels a JOIN levels b ON a.raw <= b.raw JOIN levels l ON l.raw BETWEEN a.raw AND b.raw GROUP BY ALL
), inner_min AS (
  SELECT x.raw, lo, min(mean) AS m FROM levels x JOIN spans ON lo <= x.raw AND hi >= x.raw GROUP BY ALL
), fitted AS (SELECT raw, max(m) AS calibrated FROM inner_min GROUP BY raw)
SELECT doc_id, raw, round(calibrated, 6) AS calibrated FROM labelled JOIN fitted USING (raw)"""

_PLATT = f"""WITH RECURSIVE {_LABELLED}, newton AS (
  SELECT 0 AS step, 0::DOUBLE AS a, 0::DOUBLE AS b
  UNION ALL
  SELECT step + 1, a + (h22 * g1 - h12 * g2) / (h11 * h22 - h12 * h12),
    b + (h11 * g2 - h12 * g1) / (h11 * h22 - h12 * h12)
  FROM (
    SELECT step, a, b, sum(s - w * p) AS g1, sum((s - w * p) * raw) AS g2, sum(w * p * (1 - p)) AS h11,
      sum(w * p * (1 - p) * raw) AS h12, sum(w * p * (1 - p) * raw * raw) AS h22
    FROM (SELECT step, a, b, raw, s, w, 1 / (1 + exp(-(a + b * raw))) AS p FROM newton, levels
          WHERE step < 40)
    GROUP BY step, a, b
  )
), fitted AS (SELECT a, b FROM newton ORDER BY step DESC LIMIT 1)
SELECT doc_id, raw, round(1 / (1 + exp(-(a + b * raw))), 4) AS calibrated FROM labelled, fitted"""

# --- schema checks ------------------------------------------------------------

_PATIENT_CHECK = f"""WITH {NOTES}
SELECT 'patients' AS "table", note_uid AS key, 'mrn_set' AS field, 'missing' AS problem
FROM keyed WHERE mrn = ''
UNION ALL SELECT 'patients', note_uid, 'demographics', 'missing' FROM keyed WHERE sex <> 'F'
UNION ALL SELECT 'patients', note_uid, 'provenance.notes_linked', 'type' FROM keyed
  WHERE source_id = 'Source-B'"""

_REPORT = f"""WITH RECURSIVE {LINKED}, {CONFLICTS}, {STATS}, shown AS (
  SELECT *, row_number() OVER (ORDER BY type, mrn NULLS FIRST, triplet NULLS FIRST, patient_1,
    patient_2, note_uid) AS i FROM conflicts QUALIFY i <= 10
), n AS (SELECT count(*) AS n FROM conflicts)
SELECT 1::BIGINT AS position, 'date' AS metric, '20240101' AS value
UNION ALL SELECT 2, 'timestamp', '2024-01-01T00:00:00'
UNION ALL SELECT 3, 'total_notes', total_notes::VARCHAR FROM stats
UNION ALL SELECT 4, 'total_patients', total_patients::VARCHAR FROM stats
UNION ALL SELECT 5, 'conflict_count', n::VARCHAR FROM n
UNION ALL SELECT 6, 'mrn_match_rate', printf('%.1f%%', 100 * mrn_match_count / total_notes) FROM stats
UNION ALL SELECT 7, 'triplet_match_rate', printf('%.1f%%', 100 * triplet_match_count / total_notes) FROM stats
UNION ALL SELECT 8, 'new_patient_rate', printf('%.1f%%', 100 * new_patient_count / total_notes) FROM stats
UNION ALL SELECT 8 + i, concat('conflict_', i), CASE type
    WHEN 'mrn_conflict' THEN concat('record number ', mrn, ' is held by ', patient_1, ', ', patient_2)
    ELSE concat('one triplet is held by ', patient_1, ', ', patient_2) END FROM shown
UNION ALL SELECT 19, 'more_conflicts', (n - 10)::VARCHAR FROM n WHERE n > 10"""

ORACLES = {
    "mrn_normalize": f"WITH {NOTES} SELECT note_uid, mrn_key FROM keyed",
    "diagnosis_key": f"WITH {NOTES} SELECT note_uid, dx AS diagnosis_key, phrases AS record_diagnoses FROM keyed",
    "triplet_key": f"WITH {NOTES} SELECT note_uid, triplet FROM keyed",
    "patient_uid": f"WITH {NOTES} SELECT note_uid, own_uid FROM numbered",
    "link_notes": f"""WITH RECURSIVE {LINKED} SELECT note_uid, patient_uid, rule, mrn, source_id,
        CASE rule WHEN 'mrn_match' THEN 0.9::DOUBLE WHEN 'triplet_match' THEN 0.7 ELSE 1.0 END AS confidence
        FROM linked""",
    "link_notes_repeated": f"WITH RECURSIVE {LINKED_REPEATED} {_LINK_ROWS}",
    "link_notes_strict": f"WITH RECURSIVE {LINKED_STRICT} {_LINK_ROWS}",
    "patient_records_repeated": (
        f"WITH RECURSIVE {LINKED_REPEATED}, {CONFLICTS}, {MEMBERS}, "
        + _patients("members", "LEFT JOIN conflict_sets USING (patient_uid)")
    ).replace("min(ord)", "min(rn)").replace(", ord)", ", rn)"),
    "parse_notes": f"""WITH lines AS (SELECT doc_id, {LINE_SQL} AS line FROM documents)
        SELECT doc_id, CASE WHEN ok THEN line ->> '$.uid' END AS uid, CASE WHEN ok THEN line ->> '$.mrn' END AS mrn,
          CASE WHEN ok THEN line ->> '$.demographics.dob' END AS dob, ok AS parses
        FROM (SELECT *, json_valid(line) AND starts_with(line, '{{') AS ok FROM lines)""",
    "rule_stats": f"""WITH RECURSIVE {LINKED}, {STATS} SELECT *,
        round(mrn_match_count / total_notes, 6) AS mrn_match_rate,
        round(triplet_match_count / total_notes, 6) AS triplet_match_rate,
        round(new_patient_count / total_notes, 6) AS new_patient_rate FROM stats""",
    "rule_counts": f"""WITH RECURSIVE {LINKED}
        SELECT r.rule, count(l.rule) AS links
        FROM (VALUES ('mrn_match'), ('triplet_match'), ('new_patient')) r(rule)
        LEFT JOIN linked l USING (rule) GROUP BY r.rule""",
    "patient_records": f"WITH RECURSIVE {LINKED}, {CONFLICTS}, "
    + _patients("linked", "LEFT JOIN conflict_sets USING (patient_uid)"),
    "patient_records_founder": f"""WITH RECURSIVE {LINKED}, founding AS (
        SELECT * FROM linked WHERE rule = 'new_patient'), """
    + _patients("founding"),
    "uid_collisions": f"""WITH RECURSIVE {LINKED}
        SELECT substr(patient_uid, 1, 3) AS patient_uid, count(*) AS founders,
          arg_min(note_uid, ord) AS first_note
        FROM linked WHERE rule = 'new_patient' GROUP BY 1 HAVING count(*) > 1""",
    "chunk_patients": f"""WITH RECURSIVE {LINKED}, {CHUNKS}
        SELECT chunk_id, patient_uid FROM chunks LEFT JOIN linked USING (note_uid)""",
    "link_conflicts": f"WITH RECURSIVE {LINKED}, {CONFLICTS} SELECT * FROM conflicts",
    "patient_conflict_sets": f"WITH RECURSIVE {LINKED}, {CONFLICTS} SELECT * FROM conflict_sets",
    "patient_mrns": f"WITH RECURSIVE {LINKED} SELECT DISTINCT patient_uid, mrn FROM linked WHERE mrn <> ''",
    "patient_conflict_pairs": f"""WITH RECURSIVE {LINKED}, {CONFLICTS}
        SELECT patient_1 AS patient_uid, patient_2 AS other FROM conflicts
        UNION SELECT patient_2, patient_1 FROM conflicts""",
    "report_summary": _REPORT,
    "link_schema_check": f"""WITH {NOTES} SELECT 'note_links' AS "table", note_uid AS key,
        'mrn' AS field, 'missing' AS problem FROM keyed WHERE mrn = ''""",
    "patient_schema_check": _PATIENT_CHECK,
    "chunks_latest": """SELECT concat(source, '_', lang) AS chunk_id, max(doc_id) AS version,
        arg_max(length(text), doc_id) AS n_chars FROM documents GROUP BY 1""",
    "links_latest": """SELECT source AS chunk_id, concat('P', arg_max(n_chars, doc_id)) AS patient_uid
        FROM documents WHERE source <> '' GROUP BY 1""",
    "lexical_topk": f"""WITH {CHUNKS}, {TEXT_QUERIES}, {HITS}
        SELECT query_id, chunk_id, round(tf * 0.1::DOUBLE, 6) AS score, rank FROM lexical""",
    "presence_topk": f"""WITH {CHUNKS}, {TEXT_QUERIES}, {HITS}
        SELECT query_id, chunk_id, round(present * 0.2::DOUBLE, 6) AS score, rank FROM presence""",
    "lexical_topk_batch": f"""WITH {CHUNKS}, {BENCHMARK_QUERIES}, {HITS}
        SELECT query_id, chunk_id, round(tf * 0.1::DOUBLE, 6) AS score, rank FROM lexical""",
    "bm25_topk": f"""WITH {CHUNKS}, {TEXT_QUERIES}, {BM25}
        SELECT query_id, chunk_id, round(score, 6) AS score, rank FROM bm25""",
    "bm25_topk_batch": f"""WITH {CHUNKS}, {BENCHMARK_QUERIES}, {BM25}
        SELECT query_id, chunk_id, round(score, 6) AS score, rank FROM bm25""",
    "dense_cosine_topk": f"""WITH {_means("q", "label::BIGINT AS query_id")}, v AS (
        SELECT vec_id AS chunk_id, embedding::DOUBLE[] AS vector FROM embeddings), {_cosine("v", "q", 50)}
        SELECT query_id, chunk_id, score, rank FROM ranked""",
    "dense_lsh_topk": f"""WITH {_means("q", "label::BIGINT AS query_id")}, planes AS (
          SELECT bit, list(((n * n % {_M} * n % {_M}) * {_F1} + n * {_F2}) % {_M} - {_M} // 2 ORDER BY n)::DOUBLE[] AS plane
          FROM (SELECT bit, bit * 64 + d + 1 AS n FROM range({SKETCH_BITS}) b(bit), range(64) w(d)) GROUP BY bit
        ), v AS (SELECT vec_id AS chunk_id, embedding::DOUBLE[] AS vector FROM embeddings
        ), vs AS (SELECT chunk_id, list(list_inner_product(vector, plane) > 0 ORDER BY bit) AS bits FROM v, planes GROUP BY chunk_id
        ), qs AS (SELECT query_id, list(list_inner_product(vector, plane) > 0 ORDER BY bit) AS bits FROM q, planes GROUP BY query_id
        ), near AS (
          SELECT query_id, chunk_id, len(list_filter(list_zip(qs.bits, vs.bits), lambda x: x[1] = x[2])) AS agree FROM qs, vs
          QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY agree DESC, chunk_id) <= 50 * {OVERSAMPLE}
        ), scored AS (
          SELECT query_id, chunk_id, round(list_cosine_similarity(v.vector, q.vector), 6) AS score
          FROM near JOIN v USING (chunk_id) JOIN q USING (query_id)
        )
        SELECT query_id, chunk_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank
        FROM scored QUALIFY rank <= 50""",
    "maxsim_rescore": f"""WITH {_means("q", "label::BIGINT AS query_id")},
        {_means("c", "vec_id // 10 AS chunk_id")}, {_means("m", "label::BIGINT AS query_id, vec_id % 3 AS query_pos")},
        {_cosine("c", "q", 20)}, best AS (
          SELECT r.query_id, r.chunk_id, r.rank AS before, m.query_pos,
            max(list_inner_product(m.vector, e.embedding::DOUBLE[])) AS best
          FROM ranked r JOIN embeddings e ON e.vec_id // 10 = r.chunk_id JOIN m ON m.query_id = r.query_id
          GROUP BY ALL
        ), summed AS (SELECT query_id, chunk_id, before, round(sum(best), 6) AS s_maxsim FROM best GROUP BY ALL)
        SELECT query_id, chunk_id, s_maxsim,
          row_number() OVER (PARTITION BY query_id ORDER BY s_maxsim DESC, before) AS rank
        FROM summed QUALIFY rank <= 10""",
    "fused_candidates": f"WITH {_STAGE_A} {_FLAT}",
    "fused_rank_logit": f"""WITH {CHUNKS}, {TEXT_QUERIES}, {HITS}, {MERGED},
        {_fused(left=_logit("s_bm25", "r1"), right=_logit("s_dense", "r2"))} {_FLAT}""",
    "fused_bm25_presence": f"""WITH {CHUNKS}, {TEXT_QUERIES}, {HITS}, {BM25}, merged AS (
          SELECT query_id, chunk_id, coalesce(l.score, 0) AS s_bm25,
            coalesce(d.present * 0.2::DOUBLE, 0) AS s_dense, l.rank AS r1, d.rank AS r2,
            c.source_id, c.note_uid
          FROM bm25 l FULL JOIN presence d USING (query_id, chunk_id) JOIN chunks c USING (chunk_id)
        ), {_fused("0.7", "0.3")} {_FLAT}""",
    "normalized_scores": f"""SELECT doc_id, lang, round({_scaled("n_chars")}, 6) AS scaled
        FROM documents WINDOW q AS (PARTITION BY lang)""",
    "late_interaction": f"""WITH {_STAGE_A}, {_rescored()}
        SELECT query_id, chunk_id, round(s_li, 6) AS s_li, round(fusion_score, 6) AS fusion_score,
          new_rank AS rank FROM rescored WHERE new_rank <= 50""",
    "late_interaction_deep": f"""WITH {_STAGE_A}, {_rescored(200)}
        SELECT query_id, chunk_id, round(s_li, 6) AS s_li, new_rank AS rank
        FROM rescored WHERE new_rank <= 50""",
    "li_evidence": f"""WITH {_STAGE_A}, {_rescored()}, listed AS (
          SELECT query_id, chunk_id, word AS token, 0.3::DOUBLE AS weight, pos,
            row_number() OVER (PARTITION BY query_id, chunk_id ORDER BY term_idx, pos) - 1 AS item
          FROM matches)
        SELECT query_id, chunk_id, item, token, weight, pos FROM listed WHERE item < 10""",
    "cross_scores": f"""WITH {_STAGE_A}, {_rescored()}, {_judged(False, 50)}
        SELECT query_id, chunk_id, round(raw_xenc_score, 6) AS raw_xenc_score,
          round(calibrated_score, 6) AS calibrated_score, final_rank AS rank FROM judged""",
    "calibrated_minmax": f"""WITH {_STAGE_A}, {_rescored()}, {_judged(True)}
        SELECT query_id, chunk_id, round(raw_xenc_score, 6) AS raw_xenc_score,
          round(calibrated_score, 6) AS calibrated_score, chunk_offset, source_file AS file,
          final_rank AS rank FROM judged""",
    "calibrated_isotonic": _ISOTONIC,
    "calibrated_platt": _PLATT,
    "final_with_patient": f"""WITH RECURSIVE {LINKED}, {_STAGE_A}, {_rescored()}, {_judged(False)}
        SELECT j.query_id, j.chunk_id, round(calibrated_score, 6) AS calibrated_score,
          round(raw_xenc_score, 6) AS raw_xenc_score, round(s_li, 6) AS s_li,
          round(fusion_score, 6) AS fusion_score, j.source_id, chunk_offset, source_file AS file,
          l.patient_uid, final_rank AS rank
        FROM judged j LEFT JOIN linked l USING (note_uid)""",
    "stage_diagnostics": f"""WITH RECURSIVE {LINKED}, {_STAGE_A}, {_rescored()}, {_judged(True)},
        total AS (SELECT count(*) AS total_chunks FROM chunks)
        SELECT q.query_id,
          (SELECT count(*) FROM lexical x WHERE x.query_id = q.query_id) AS bm25_results,
          (SELECT count(*) FROM presence x WHERE x.query_id = q.query_id) AS dense_results,
          (SELECT count(*) FROM fused x WHERE x.query_id = q.query_id) AS final_candidates,
          (SELECT count(*) FROM rescored x WHERE x.query_id = q.query_id) AS rescored_candidates,
          (SELECT count(*) FROM judged x WHERE x.query_id = q.query_id) AS final_results,
          (SELECT count(*) FROM judged x JOIN linked l USING (note_uid) WHERE x.query_id = q.query_id)
            AS patient_uid_attached, total_chunks
        FROM queries q, total""",
}

# The other name of the weighted sum, and isotonic calibration without labels, change no row.
ORACLES |= {
    "fused_ranked_logit": ORACLES["fused_candidates"],
    "calibrated_without_labels": ORACLES["calibrated_minmax"],
}

# Searches through a kept index find what the searches by scan find.
ORACLES |= {
    "lexical_topk_indexed": ORACLES["lexical_topk_batch"],
    "bm25_topk_indexed": ORACLES["bm25_topk_batch"],
    "presence_topk_indexed": ORACLES["presence_topk"],
}
