import re

import numpy as np
import pytest
from conftest_llm import read
from kinseek.llm.html_extract import EXTRA, PATH, _vectors, blocks_of, extract_text, fit, label_blocks
from kinseek.llm.toxicity import toxicity, without_toxic
from pyspark.sql import functions as F

PAGES = "page_id long, url string, html string, text string, label int"


def test_blocks():
    page = (
        "<html><head><title>t</title><script>if (a<b) '</p>'</script></head><body><!-- <p>no</p> --><nav class='top menu'><a href='x>y'>Home</a></nav>"
        "<article><h1>A &amp; B</h1><p>one<br>two\n three<p>four <b>bold</b> five</article>tail &lt;b&gt;<p"
    )
    got = [(b.path[-1], b.text) for b in blocks_of(page)]
    assert got == [("a", "Home"), ("h1", "A & B"), ("p", "one two three"), ("p", "four bold five"), ("body", "tail <b>")]
    assert blocks_of(page)[0].path == ("html", "body", "nav.top.menu", "a") and blocks_of(page)[0].linked == 4
    assert blocks_of("") == [] and blocks_of("<") == [] or blocks_of("<")[0].text == "<"


def article(page):
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)
    return inner[1] if inner else ""


def test_pages(spark, sf):
    pages = read(spark, sf, "pages")
    rows = {r.page_id: r for r in extract_text(pages).collect()}
    assert len(rows) == pages.count()
    for p in pages.collect():
        want = " ".join(re.sub(r"<[^>]*>?", " ", article(p.html)).split())
        got = " ".join(rows[p.page_id].text.split()).replace("&", "&amp;").replace('"', "&quot;")
        assert rows[p.page_id].n_chars == len(rows[p.page_id].text) and rows[p.page_id].url == p.url
        assert got.replace(" ", "")[:400] == want.replace(" ", "")[:400]
        if "</article>" in p.html:
            assert got.replace(" ", "") == want.replace(" ", "")


PROSE = "Erouor ingheea ntwhha tiing es theaea from thin erounonou, ingly theaedble nter and the rest of it."
MENU = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/x'>News</a></li></ul></nav>"
FOOT = "<footer>&copy; example.com, all rights</footer>"
# Each with the blocks of its main text.
LAYOUTS = {
    "other names": (
        f"<div class='navbar'><a href='/'>Home</a><a href='/x'>News</a></div><div class='cookie'>We use cookies.</div><main><h1>Title of it</h1><p>{PROSE}</p>"
        f"<p>{PROSE}</p><p>{PROSE}</p></main><aside><p>Read this too</p></aside><div class='comments'><p>Nice one.</p><p>I agree with it.</p></div><div class='footer'>Legal</div>",
        ["Title of it", PROSE, PROSE, PROSE],
    ),
    "no names": (
        f"<div><ul><li><a href='/'>Home</a></li><li><a href='/x'>News</a></li></ul></div><div><h1>Title of it</h1><p>{PROSE}</p><p>{PROSE}</p></div><div>&copy; example.com, all rights</div>",
        ["Title of it", PROSE, PROSE],
    ),
    "unknown name": (f"{MENU}<div class='wrap17'><h1>Title of it</h1><p>{PROSE}</p><p>{PROSE}</p></div>{FOOT}", ["Title of it", PROSE, PROSE]),
    "lists": (
        f"{MENU}<article><h1>Title of it</h1><p>{PROSE}</p><ul><li>Flour</li><li>Two eggs from the farm</li></ul><ol><li>Mix it well.</li><li>Bake</li></ol><p>{PROSE}</p></article>{FOOT}",
        ["Title of it", PROSE, "Flour", "Two eggs from the farm", "Mix it well.", "Bake", PROSE],
    ),
    "tables": (
        f"{MENU}<article><h1>Title of it</h1><p>{PROSE}</p><table><tr><th>Year</th><th>Sum</th></tr><tr><td>1990</td><td>12</td></tr></table><p>{PROSE}</p></article>{FOOT}",
        ["Title of it", PROSE, "Year", "Sum", "1990", "12", PROSE],
    ),
    "quotes": (
        f"{MENU}<article><h1>Title of it</h1><p>{PROSE}</p><blockquote><p>{PROSE}</p></blockquote><dl><dt>Term</dt><dd>Meaning of it</dd></dl>"
        f"<figure><figcaption>A picture of it</figcaption></figure><h2>More</h2><p>{PROSE}</p></article>{FOOT}",
        ["Title of it", PROSE, PROSE, "Term", "Meaning of it", "A picture of it", "More", PROSE],
    ),
    "comments inside": (
        f"{MENU}<article><h1>Title of it</h1><p>{PROSE}</p><p>{PROSE}</p><div class='comments'><p>{PROSE}</p><p>I agree with it.</p></div></article>{FOOT}",
        ["Title of it", PROSE, PROSE],
    ),
}


@pytest.fixture(scope="module")
def labeller(spark):
    return fit(sorted(r.html for r in read(spark, "/root/testdata/sf0.01", "pages").collect()))


@pytest.mark.parametrize("layout", LAYOUTS)
def test_other_layouts(labeller, layout):
    page, want = LAYOUTS[layout]
    blocks = blocks_of(f"<html><body>{page}</body></html>")
    assert [b.text for b, k in zip(blocks, label_blocks(labeller, [blocks])[0]) if k] == want


def test_boxes_of_any_name(labeller):
    page = LAYOUTS["unknown name"][0]
    random = np.random.default_rng(1)
    names = ["".join(chr(97 + c) for c in random.integers(26, size=random.integers(3, 10))) for _ in range(200)]
    pages = [blocks_of(page.replace("wrap17", n)) for n in names]
    kept = [[b.text for b, k in zip(p, keep) if k] for p, keep in zip(pages, label_blocks(labeller, pages))]
    assert np.mean([k == LAYOUTS["unknown name"][1] for k in kept]) > 0.85


def test_odd_pages(spark, sf):
    rows = [(1, "u", None, "x", 1), (2, None, "", "x", 1), (3, "u", "no markup at all", None, 0), (4, "u", "<p>" * 3000 + "deep", None, 0), (5, "u", "<article>" + "<p>word</p>" * 3000, None, 0)]
    odd = spark.createDataFrame(rows + rows[:1], PAGES)
    got = extract_text(odd.unionByName(read(spark, sf, "pages").withColumns({"text": F.lit("t"), "label": F.lit(1)}))).where("page_id <= 5").collect()
    by = {(r.page_id, r.url): r for r in got}
    assert by[1, "u"].text == by[2, None].text == "" and by[5, "u"].text.count("word") == 3000
    assert extract_text(spark.createDataFrame([], PAGES)).collect() == []
    assert [r.text for r in extract_text(spark.createDataFrame(rows[:2], PAGES)).collect()] == ["", ""]


def test_whole_blocks_are_looked_at():
    opening = "word " * 60
    one, other = (_vectors([blocks_of(f"<p>{opening}{tail}</p>")])[0] for tail in ("alpha beta gamma", "aaaaa, bb; c:, ddd"))
    assert (one[PATH:-EXTRA] != other[PATH:-EXTRA]).any() and one[-1] < other[-1]


def test_formulas_and_fallback_texts_are_blocks():
    page = "<p>As <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p><noscript><p>Plain form</p></noscript><object data='f'>A figure</object><template>t</template>"
    assert [b.text for b in blocks_of(page)] == ["As x=2 holds", "Plain form", "A figure"]


def test_training_looks_at_whole_pages():
    menu = "<nav>" + "<p>Home and more</p>" * 160 + "</nav>"
    page = menu + "<article>" + "<p>Prose that is the main text of it.</p>" * 40 + "</article>"
    assert any((a != b).any() for a, b in zip(fit([page]), fit([menu])))


def auc(score, label):
    rank = np.empty(len(score))
    order = np.argsort(score, kind="stable")
    values, number, counts = np.unique(score[order], return_inverse=True, return_counts=True)
    ends = np.cumsum(counts)
    rank[order] = ((ends - counts + 1 + ends) / 2)[number]
    n1 = label.sum()
    return (rank[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


@pytest.fixture(scope="module")
def toxic_tables(spark):
    return read(spark, "/root/testdata/sf0.01", "documents"), read(spark, "/root/testdata/sf0.01", "labels")


def test_toxicity_of_unseen_rows(spark):
    # sf0.1: the 37 confirmed toxic texts of sf0.01 are too few (there the area is about 0.81).
    docs, labels = read(spark, "/root/testdata/sf0.1", "documents"), read(spark, "/root/testdata/sf0.1", "labels")
    rows = {r.doc_id: r for r in toxicity(docs, labels).collect()}
    assert len(rows) == docs.count()
    seen = [(rows[r.doc_id], r.toxic) for r in labels.collect() if rows[r.doc_id].held_out]
    score, label = np.array([r.score for r, _ in seen]), np.array([t for _, t in seen])
    assert label.sum() >= 100 and auc(score, label) > 0.94
    assert np.mean([r.predicted == t for r, t in seen]) > 0.94
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())


def test_held_out_labels_are_not_learned(toxic_tables):
    docs, labels = toxic_tables
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = sorted(map(tuple, toxicity(docs, labels).collect()))
    assert one == sorted(map(tuple, toxicity(docs.repartition(5), turned).collect()))


def test_odd_rows_and_labels(spark, odd_docs, no_docs, toxic_tables):
    docs, labels = toxic_tables
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity(odd_docs, none).collect()} == {0.0}
    assert toxicity(no_docs, labels).collect() == [] and without_toxic(no_docs, labels).collect() == []
    both = odd_docs.select("doc_id", "text").withColumn("doc_id", F.col("doc_id") + 10_000_000).unionByName(docs.select("doc_id", "text"))
    rows = [r for r in toxicity(both, labels.unionByName(labels)).collect() if r.doc_id is None or r.doc_id > 10_000_000]
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r.score for r in rows}
    assert by[10_000_004] == by[10_000_005] == by[10_000_006]
    kept = without_toxic(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
