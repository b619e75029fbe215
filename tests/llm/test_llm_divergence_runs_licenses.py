"""Source divergence, periodic runs and licence scans against plain forms of the same results."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from random import Random

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import DOCS, FOLD, read, words
from kinseek.llm import license_scan, periodic_runs, source_divergence
from kinseek.llm import words as hashed
from kinseek.llm.license_templates import PHRASES, TEMPLATES
from kinseek.llm.queries import QUERIES

TERM = re.compile(source_divergence.TERM)


# --- source divergence --------------------------------------------------------


def plain_divergence(rows, least, top):
    docs = [((r.lang or ""), (r.source or ""), TERM.findall((r.text or "").translate(FOLD))) for r in rows]
    held = Counter((lang, t) for lang, _, ts in docs for t in set(ts))
    kept = defaultdict(set)
    for (lang, t), n in held.items():
        if n >= least:
            kept[lang].add(t)
    counts = defaultdict(Counter)
    for lang, source, ts in docs:
        own = Counter(t for t in ts if t in kept[lang])
        counts[lang, source] += own
        counts[lang, None] += own

    def share(group, t):
        n, v = sum(counts[group].values()), len(kept[group[0]])
        return 1 + 10**9 * (counts[group][t] + 5) // (n + 5 * v)

    out = set()
    groups = {(lang, source) for lang, source, _ in docs}
    for lang, source in groups:
        others = [s for la, s in groups if la == lang and s != source]
        pairs = [(-sum(abs(share((lang, source), t) - share((lang, s), t)) for t in kept[lang]), s.encode()) for s in others]
        terms = [(share((lang, None), t) - share((lang, source), t), t.encode()) for t in kept[lang] if counts[lang, source][t]]
        terms = sorted(x for x in terms if x[0] < 0)[:top]
        for part, items in (("pair", sorted(pairs)), ("term", terms)):
            out |= {(lang, source, part, item.decode(), -value, k) for k, (value, item) in enumerate(items, 1)}
    return out


def noisy_docs(spark, n=160):
    """Words in several spellings, spread over few or many documents; nulls and clashing names."""
    rng = Random(5)
    stems = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["élan", "ÉLAN", "naïve"]
    rows = []
    for i in range(n):
        picked = [stems[int(len(stems) * rng.random() ** 2)] for _ in range(rng.randint(0, 14))]
        spelled = [rng.choice([w, w.upper(), w + ",", f"({w})", f"{w}-{w}", w.capitalize() + "."]) for w in picked]
        rows.append((i % 90, rng.choice([" ", "\t", "\n", "  "]).join(spelled), [None, "", "en", "en", "de"][i % 5], [None, "", "s1", "s2"][i % 7 % 4], 0, "term", 1.0))
    rows.append((None, None, "xx", None, 0, "", 0.0))
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("least", [1, 5])
def test_divergence_of_spellings(spark, least):
    docs = noisy_docs(spark)
    got = [tuple(r) for r in source_divergence.divergence(docs, least, 5).collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain_divergence(docs.collect(), least, 5)


@pytest.mark.parametrize("name, value", [("BROADCAST_BYTES", 0), ("CELLS", 3), ("BROADCAST_ROWS", 0)])
def test_divergence_beyond_its_bounds(spark, monkeypatch, name, value):
    """The ways taken by large inputs: joins by shuffle, blocks of few terms and sources."""
    docs = noisy_docs(spark)
    monkeypatch.setattr(source_divergence, name, value)
    got = {tuple(r) for r in source_divergence.divergence(docs, 6, 5).collect()}
    assert got == plain_divergence(docs.collect(), 6, 5)


def test_divergence_settles_terms_by_bounds(spark):
    """A term of many spellings, each rare, is counted by documents; one document counts once."""
    rows = [(i, "Ab, ab (AB) ab-ab" if i < 3 else ["Cd", "cd,", "(cd)"][i % 3], "en", "s", 0, "", 0.0) for i in range(9)]
    _, uses = source_divergence.term_counts(spark.createDataFrame(rows, DOCS), 6)
    assert [(r.term, r["count"]) for r in uses.collect()] == [("cd", 6)]


def test_share_is_exact_for_large_counts(spark):
    from pyspark.sql import functions as F

    n, total, terms = 9_223_372_036_854_770_000, 9_223_372_036_854_775_000, 7
    got = spark.range(1).select(source_divergence._share(F.lit(n), F.lit(total), F.lit(terms))).first()[0]
    assert got == 1 + 10**9 * (n + 5) // (total + 5 * terms)


def test_divergence_odd_and_empty(spark, odd_docs, no_docs):
    assert source_divergence.divergence(no_docs).collect() == []
    assert {tuple(r) for r in source_divergence.divergence(odd_docs, 2, 50).collect()} == plain_divergence(odd_docs.collect(), 2, 50)


def test_divergence_counts_texts_of_a_group_together(spark, monkeypatch):
    """However scattered the texts, a task meets few groups, and a chunk's counts are few rows."""
    count, rows = source_divergence._count_chunks, spark.sparkContext.accumulator(0)

    def counted(batches):
        for out in count(batches):
            rows.add(out.num_rows)
            yield out

    monkeypatch.setattr(source_divergence, "_count_chunks", counted)
    text = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(100))
    docs = spark.createDataFrame([(i, text, "en", f"s{i % 8}", 0, "", 0.0) for i in range(640)], DOCS).repartition(40)
    groups, uses = source_divergence.term_counts(docs, 30)
    assert {(r.total, r.terms) for r in groups.collect()} == {(8000, 100)}
    assert {(r["count"], r.lang_count) for r in uses.collect()} == {(80, 640)} and uses.count() == 800
    # 100 chunks for each group of each task; 40 tasks of 8 groups would hand on 32,000.
    assert 800 <= rows.value <= 100 * (8 + int(spark.conf.get("spark.sql.shuffle.partitions")))


def test_divergence_spells_a_chunk_of_several_batches_once():
    names = ["chunk", "gid", "n", "docs"]
    rows = [("A,a", 1, 2, 1), ("A,a", 1, 3, 2), ("A,a", 4, 1, 1), ("b", 2, 5, 5), ("c-Éa", 1, 1, 1), ("c-Éa", 1, 1, 1), ("c-Éa", 9, 2, 2), ("--", 3, 7, 7)]
    found = [(1, "A,a", "a", 10, 3), (4, "A,a", "a", 2, 1), (2, "b", "b", 5, 5)]
    found += [(g, "c-Éa", t, n, n) for g, n in ((1, 2), (9, 2)) for t in ("c", "Éa")]
    for size in (1, 2, 3, 8):
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + size])], names) for i in range(0, len(rows), size)]
        got = [tuple(r.values()) for b in source_divergence._spell(iter([b for x in batches for b in (x.slice(0, 0), x)])) for r in b.to_pylist()]
        assert sorted(got) == sorted(found)
    assert list(source_divergence._spell(iter([]))) == []


def test_divergence_terms_of_chunks():
    """Bytes give the terms that the expression finds."""
    chunks = ["", "Ab,ab\x00AB", "élan-ÉLAN", "1234", "naïve1Naïve", "日本,日本", "x" * 70, "\x7fZ[z`@", "a\u0085b\u00a0c"]
    at, code, times, terms = source_divergence._terms(pa.array(["skipped", *chunks]).slice(1))
    got = {(chunks[a], terms[c].as_py(), n) for a, c, n in zip(at, code.tolist(), times.tolist())}
    assert got == {(c, t, n) for c in chunks for t, n in Counter(TERM.findall(c.translate(FOLD))).items()}


# --- periodic runs ------------------------------------------------------------


def plain_runs(ws, least, periods):
    out = []
    code = np.unique(np.array(ws, dtype=object), return_inverse=True)[1] if len(ws) else []
    for q in range(1, len(ws) // periods + 1):
        same = np.concatenate([[0], code[:-q] == code[q:], [0]]).astype(int)
        starts, ends = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)
        long = ends - starts + q >= max(least, periods * q)
        out += [(int(i), int(j + q - i), q) for i, j in zip(starts[long], ends[long])]
    first = {}
    for i, n, q in sorted(out, key=lambda r: r[2]):
        first.setdefault((i, n), q)
    return sorted((i, n, q) for (i, n), q in first.items())


def plain_planted(doc_id, text):
    ws = words(text)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is None or h % 10 or not ws:
        return ws
    a = g % len(ws)
    p = 1 + (len(ws) - a) // (3 + g % 8)
    return [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]


def plain_run_row(doc_id, text):
    ws = plain_planted(doc_id, text)
    runs = plain_runs(ws, 24, 3)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    gone = {j for s, n, q in runs for j in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    left = " ".join(w for i, w in enumerate(ws) if i not in gone)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_random_rows(seed):
    rng = Random(seed)
    for _ in range(150):
        least, periods = rng.choice([2, 4, 6, 24]), rng.choice([2, 3, 4])
        rows = []
        for _ in range(rng.randint(1, 6)):
            k = rng.choice([1, 2, 3, 5, 50])
            row = [rng.randrange(k) for _ in range(rng.randint(0, 60))]
            unit = [rng.randrange(k) for _ in range(rng.randint(1, 8))]
            at = rng.randint(0, len(row))
            rows.append(row[:at] + (unit * 20)[: rng.choice([0, 30, 60])] + row[at:])
        flat = hashed.mix(np.array([w for r in rows for w in r], np.uint64) + np.uint64(9))
        got = periodic_runs.runs_of_rows(flat, np.array([len(r) for r in rows]), least, periods)
        assert [got.get(i, []) for i in range(len(rows))] == [plain_runs(r, least, periods) for r in rows]


def test_runs_of_long_texts():
    n = 30_000
    flat = np.concatenate([np.full(n, 3), np.tile(np.arange(7), n // 7), np.arange(n)]).astype(np.uint64)
    got = periodic_runs.runs_of_rows(hashed.mix(flat), np.array([n, 7 * (n // 7), n]))
    assert got == {0: [(0, n, 1)], 1: [(0, 7 * (n // 7), 7)]}


def test_runs_query(spark, tmp_path, odd_docs, no_docs, sf):
    docs = read(spark, sf, "documents")
    got = [tuple(r) for r in QUERIES["op12_periodic_runs"](spark, sf).collect()]
    assert order(got) == order(plain_run_row(r.doc_id, r.text) for r in docs.collect())
    assert sum(r[1] > 0 for r in got) >= 5
    for name, table in (("odd", odd_docs), ("none", no_docs)):
        table.write.parquet(str(tmp_path / name / "documents.parquet"))
        got = [tuple(r) for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path / name)).collect()]
        assert order(got) == order(plain_run_row(r.doc_id, r.text) for r in table.collect())


def test_runs_keep_texts_and_rows(spark):
    rows = [(1, "a b c " * 9 + "tail", 1), (1, None, 2), (None, "x\ty\n" * 30, 3), (2, "naïve " * 24, 4), (2, "naïve " * 23, 5)]
    found = periodic_runs.find_runs(spark.createDataFrame(rows, "doc_id long, text string, runs int")).collect()
    assert [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found] == [
        (1, 28, [(0, 27, 3)], "a b c tail"),
        (1, 0, [], ""),
        (None, 60, [(0, 60, 2)], "x y"),
        (2, 24, [(0, 24, 1)], "naïve"),
        (2, 23, [], " ".join(["naïve"] * 23)),
    ]
    with pytest.raises(ValueError, match="twice"):
        periodic_runs.find_runs(spark.createDataFrame(rows, "doc_id long, text string, runs int"), periods=1)


# --- licence scans ------------------------------------------------------------


def as_pattern(parts):
    """A template as a regular expression over words that each end with a space."""
    out = ""
    for p in parts:
        if isinstance(p, str):
            out += re.escape(p) + " "
        elif p.most:
            out += r"(?:[^ ]+ ){%d,%d}" % (p.least, p.most)
        else:
            out += f"(?:{as_pattern(p.parts)})?"
    return out


def plain_matches(templates, text):
    """All matches by trying every regular expression at every word, longest first."""
    ws = license_scan.WORD.findall((text or "").translate(FOLD))
    found = []
    for k, (label, template) in enumerate(templates.items()):
        parts = license_scan.parse(template)
        pattern = re.compile(as_pattern(parts))
        for start in (i for i, w in enumerate(ws) if w == parts[0]):
            ends = [e for e in range(start + 1, min(len(ws), start + 400) + 1) if pattern.fullmatch("".join(w + " " for w in ws[start:e]))]
            if ends:
                found.append((start, k, label, max(ends)))
    return len(ws), [(label, start, end) for start, _, label, end in sorted(found)]


def one(template, text):
    machine = license_scan.Automaton({"t": template})
    data, offsets = hashed.buffers(license_scan.pa.array([text]))
    return [(s, e) for _, s, e in license_scan.scan_rows(machine, data, offsets)[1].get(0, [])]


def test_regions():
    optional = "Grant <<beginOptional>>of <<beginOptional>>all<<endOptional>> rights<<endOptional>> to you"
    assert one(optional, "grant to you. GRANT of Rights to you; grant of all rights to you, grant all rights to you") == [(0, 3), (3, 8), (8, 14)]
    assert one("held by <<var;name=who;words=1..3>> alone", "held by alone held by a b c alone; held by a b c d alone") == [(3, 9)]
    assert one("held by <<var;words=1..3>> alone", "held by a alone") == [(0, 4)]
    assert one("held by <<var;words=1..3>> alone", "held by a b c d alone") == []
    assert one("<<var;words=1..9>> as is <<var;words=1..9>>", "sold as is, today") == [(1, 3)]
    assert one("single", "a single, single") == [(1, 2), (2, 3)]
    assert one("no warranty <<beginOptional>>at all<<endOptional>>", "no warranty at all, no warranty at") == [(0, 4), (4, 6)]


@pytest.mark.parametrize("broken", ["a <<beginOptional>> b", "a <<endOptional>>", "a <<var;words=3..1>>", "<<var;words=1..2>>", "a <<other>>", ""])
def test_broken_markup(broken):
    with pytest.raises(ValueError):
        license_scan.Automaton({"t": broken})


def filled(template, rng):
    out = []

    def walk(parts):
        for p in parts:
            if isinstance(p, str):
                out.append(p.upper() if rng.random() < 0.3 else p)
            elif p.most:
                out.extend(rng.choice(["acme", "Inc", "élan", "the"]) for _ in range(rng.randint(p.least, p.most)))
            elif rng.random() < 0.6:
                walk(p.parts)

    walk(license_scan.parse(template))
    return rng.choice([" ", "  ", "\n * ", ", "]).join(out)


def test_texts_of_all_templates_are_found(spark):
    rng = Random(3)
    rows = []
    for k, (label, template) in enumerate({**PHRASES, **TEMPLATES}.items()):
        for n in range(3):
            text = filled(template, rng)
            rows.append((10 * k + n, f"some words before {text} and some after", label))
            ws = text.split()
            rows.append((10 * k + n + 5, " ".join(ws[:1] + ["changed"] + ws[1:]), None))
    got = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, label string")).collect()
    by_id = {r.doc_id: r for r in got}
    templates = {**PHRASES, **TEMPLATES}
    for doc_id, text, label in rows:
        n, want = plain_matches(templates, text)
        assert by_id[doc_id].n_words == n
        assert [tuple(m) for m in by_id[doc_id].matches] == want
        assert label is None or label in {m.label for m in by_id[doc_id].matches}


def test_random_templates():
    rng = Random(8)

    def template(depth=0):
        parts = [rng.choice("abc")]
        for _ in range(rng.randint(0, 4)):
            kind = rng.random()
            if kind < 0.5:
                parts.append(rng.choice("abc"))
            elif kind < 0.75:
                least = rng.randint(0, 2)
                parts.append(f"<<var;words={least}..{least + rng.randint(1, 2)}>>")
            elif depth < 2:
                parts.append(f"<<beginOptional>>{template(depth + 1)}<<endOptional>>")
        return " ".join(parts)

    for _ in range(60):
        templates = {f"t{i}": template() for i in range(rng.randint(1, 4))}
        text = " ".join(rng.choice("abcd") for _ in range(30))
        machine = license_scan.Automaton(templates)
        data, offsets = hashed.buffers(license_scan.pa.array([text]))
        _, found = license_scan.scan_rows(machine, data, offsets)
        assert [(machine.labels[m], s, e) for m, s, e in found.get(0, [])] == plain_matches(templates, text)[1], (templates, text)


def test_states_are_built_anew(monkeypatch):
    monkeypatch.setattr(license_scan, "STATES", 1)
    assert one("a b <<var;words=0..2>> c", "a b c a b x c a b x y c") == [(0, 3), (3, 7), (7, 12)]


def plain_license_row(doc_id, text):
    n, found = plain_matches({**PHRASES, **TEMPLATES}, text)
    base = [m for m in found if m[0] in PHRASES]
    covered = len({w for _, s, e in found for w in range(s, e)})
    starts = [s for _, s, _ in base]
    label = [",".join(sorted({m[0] for m in ms})) for ms in (base, found)]
    return (doc_id, n, len(base), min(starts, default=None), max(starts, default=None), *label, covered / n if n else 0.0)


def test_license_query(spark, sf, odd_docs, no_docs):
    hint = re.compile("licen|permission|redistrib|cc|source code|software|free and|under the", re.I)
    rows = {r.doc_id: r.text for r in read(spark, sf, "documents").collect()}
    got = {r.doc_id: tuple(r) for r in QUERIES["op13_license_scan"](spark, sf).collect()}
    assert set(got) == set(rows)
    for doc_id, text in rows.items():
        if hint.search(text or ""):
            assert got[doc_id] == plain_license_row(doc_id, text)
        else:
            assert got[doc_id][2:] == (0, None, None, "", "", 0.0) and got[doc_id][1] == len(license_scan.WORD.findall((text or "").translate(FOLD)))
    for table in (odd_docs, no_docs):
        got = [tuple(r) for r in license_scan.license_summary(table).collect()]
        n_words = [(r.doc_id, len(license_scan.WORD.findall((r.text or "").translate(FOLD)))) for r in table.collect()]
        assert order(got) == order((doc_id, n, 0, None, None, "", "", 0.0) for doc_id, n in n_words)


def test_phrases_in_any_dress(spark):
    rows = [
        (1, "UNDER THE-MIT\nlicense. Apache License (Version 2.0)! CC-BY_NC cc by nc cc by nc", "x"),
        (2, "under the mit licenses; undér the mit license; apache license version 20", "x"),
        (2, None, "x"),
        (None, "cc by nc", "x"),
    ]
    got = license_scan.license_summary(spark.createDataFrame(rows, "doc_id long, text string, labels string")).collect()
    assert order((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == order([
        (1, 18, 5, 0, 15, "apache-2,cc-by-nc,mit"),
        (2, 12, 0, None, None, ""),
        (2, 0, 0, None, None, ""),
        (None, 3, 1, 0, 0, "cc-by-nc"),
    ])
