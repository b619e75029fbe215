import hashlib
import math
import random
import re

from conftest_llm import read
from kinseek.llm.pii import find_personal_data, sanitised

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    found = []
    for rank, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text or "", re.A):
            if passes(kind, m[0]):
                found.append((m.start(), rank, m.end(), kind))
    return sorted(found)


def check(docs):
    given = docs.collect()
    rows = find_personal_data(docs).collect()
    assert len(rows) == len(given)
    want = {r.doc_id: base(r.text) for r in given}
    for r in rows:
        spans = want[r.doc_id]
        joined = ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), (r, joined)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[3] == k for s in spans) for k in KINDS]
        assert set(joined.split(",")) <= set(r.spans.split(","))
        if not r.n_terms:
            assert r.spans == joined
    return {r.doc_id: r for r in rows}


def test_table(spark, sf):
    assert sum(r.n_email for r in check(read(spark, sf, "documents")).values()) > 0


def test_hard_texts(spark):
    rng = random.Random(3)
    signs = ["@", ".", "+", "-", " ", "(", ")", "1", "25", "255.", "256.1", "a", "ab.c", "@x", "é", "\U0001f600", "_", "4111 1111 1111 1111", "4111-1111-1111-1112", "000255"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    texts += ["1.2.3.4.5.6.7.8", "a@b.c_d@e.f", "a@b.c@d.e", "a@b..c", "+1", "+12345678", "9" * 6_000, "a" * 6_000, "1 " * 6_000, "+1" * 6_000, "x@" * 6_000, "1." * 6_000]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_odd_rows(odd_docs, no_docs):
    rows = find_personal_data(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.spans == "" for r in rows)
    assert find_personal_data(no_docs).collect() == []
    assert sorted(map(str, sanitised(odd_docs).collect())) == sorted(map(str, odd_docs.collect()))
    assert sanitised(no_docs).collect() == []


def test_terms_that_disclose(spark):
    rng = random.Random(9)
    common = [f"word{i}" for i in range(40)]

    def prose(k):
        return " ".join(rng.choice(common) for _ in range(k))

    rows = [(i, prose(30)) for i in range(100)]
    rows += [(100 + i, f"{prose(9)} Zanzibar {prose(9)} mail joe@corp.example now Quixotic") for i in range(4)]
    rows += [(110, f"{prose(5)} Quixotic {prose(5)}"), (111, f"{prose(4)} 10.0.0.1 onceonly"), (112, "clean zanzibars")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = check(docs)
    text = dict(rows)
    for i in range(100, 104):
        terms = [s.split(":")[1:] for s in got[i].spans.split(",") if s.startswith("term")]
        assert {text[i][int(a) : int(b)] for a, b in terms} == {"Zanzibar", "Quixotic", "mail", "now"}
    assert got[110].spans == got[112].spans == "" and got[111].n_terms == 0
    clean = {r.doc_id: r.text for r in sanitised(docs).collect()}
    # `Quixotic` occurs elsewhere too and is generalised; the others never do and are removed.
    assert clean[100].endswith("  <EMAIL>  <TERM>") and "Zanzibar" not in clean[100]
    assert all(clean[i] == text[i] for i in (*range(100), 110, 112))
    assert clean[111] == text[111].replace("10.0.0.1", "<IP>")


def test_very_many_matches(spark):
    rng = random.Random(1)
    parts = [f"x{i}@mail.example é{' ' * rng.randint(0, 30)}" if i % 3 else f"10.0.{i % 256}.1 {'z' * rng.randint(1, 20)}" for i in range(100_000)]
    docs = spark.createDataFrame([(1, "\U0001f600 ".join(parts)), (2, "none")], "doc_id long, text string")
    got = check(docs)[1]
    assert got.n_email + got.n_ip == 100_000
    want = re.sub(r"x[0-9]+@mail\.example", "<EMAIL>", re.sub(r"10\.0\.[0-9]+\.1", "<IP>", docs.first().text))
    assert sanitised(docs).where("doc_id = 1").first().text == want


def overlapping(text, found):
    out, at = "", 0
    for start, _, end, kind in found:
        if start >= at:
            out += text[at:start] + f"<{kind.upper()}>"
        at = max(at, end)
    return out + text[at:]


def test_overlapping_spans_and_clashing_names(spark):
    rng = random.Random(4)
    signs = ["@", ".", "+", " ", "1", "25", "a", "ab.c", "é", "\U0001f600", "4111 1111 1111 1111", "+4111111111111111", "1.2.3.4"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 2000))) for _ in range(120)]
    rows = [(i, t, ["mine"], i, "s", t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, terms array<string>, gone long, _spans string, _text string")
    clean = sanitised(docs, support=10**6)
    assert clean.columns == docs.columns
    for r in clean.collect():
        text = texts[r.doc_id]
        assert r.text == overlapping(text, base(text)) and (r.terms, r.gone, r["_spans"], r["_text"]) == (["mine"], r.doc_id, "s", text)


def test_term_counts_by_brute_force(spark):
    """Which terms disclose an entity, counted over different texts in plain Python."""
    rng = random.Random(5)
    texts = []
    for i in range(150):
        body = [rng.choice(["alpha", "beta", "gamma", "delta", "rare", "seldom", "Zeta"][: rng.randint(3, 7)]) for _ in range(12)]
        if i % 4 == 0:
            body.insert(3, f"u{i % 3}@corp.example")
            body.insert(rng.randint(0, 9), f"Office{i % 3}" if rng.random() < 0.8 else "beta")
        if i % 5 == 0:
            body.append("10.0.0.7")
        texts.append(" ".join(body))
    texts += texts[:40]
    distinct = set(texts)
    terms = {t: {w.lower() for w in re.findall(r"[^\W\d_][^\W_]{2,}", t)} for t in distinct}
    holds = {t: {(k, t[s:e].lower()) for s, _, e, k in base(t)} for t in distinct}
    own = {}
    for t in distinct:
        masked = t
        for s, _, e, _ in base(t):
            masked = masked[:s] + " " * (e - s) + masked[e:]
        own[t] = {w.lower() for w in re.findall(r"[^\W\d_][^\W_]{2,}", masked)}
    n, want = len(distinct), {t: set() for t in distinct}
    for e in set().union(*holds.values()):
        having = [t for t in distinct if e in holds[t]]
        known = math.log(n / len(having))
        for w in set().union(*(own[t] for t in having)):
            both = [t for t in having if w in own[t]]
            if len(having) < 3 or len(both) < 3 or known <= 0:
                continue
            pmi = math.log(len(both) * n / (sum(w in terms[t] for t in distinct) * len(having)))
            if pmi >= 0.3 * known - 1e-9:
                for t in both:
                    want[t].add(w)
    assert any(want.values())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in find_personal_data(docs, share=0.3).collect():
        text = texts[r.doc_id]
        spans = [s.split(":") for s in r.spans.split(",") if s.startswith("term:")]
        assert {text[int(a) : int(b)].lower() for _, a, b in spans} == want[text]
