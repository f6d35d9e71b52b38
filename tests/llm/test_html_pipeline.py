import os
import random
import re
import subprocess
import sys
import time
from html import unescape

import pytest
from pyspark.sql import functions as F

from moodindex.llm import html

SF = "/root/testdata/sf0.01"


def article(page):
    """The blocks of the test pages' only article, by a plainer path."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = (re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]*>", " ", b))).strip() for b in re.split(r"</?(?:p|h1)>", body))
    return "\n".join(b for b in blocks if b)


def test_pages_of_the_test_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in html.main_text(pages).collect()}
    assert got == {r.page_id: article(r.html) for r in pages.collect()}


def wrap(*pages):
    out = None
    for p in pages:
        w = html.wrapper_of(html.parse(p))
        out = w if out is None else html.merge(out, w)
    return out


def test_alignment_finds_optionals_repeats_groups_and_slots():
    w = wrap("<div><h2>a</h2><p>same</p></div>", "<div><h2>b</h2><p>same</p><table></table></div>")
    assert [c[0] for c in w[3][0][3]] == ["h2", "p", "table"]
    h2, p, table = w[3][0][3]
    assert h2[3][0][4] is None and p[3][0][4] is not None and (p[1], table[1]) == (0, 1)
    ul = wrap("<ul><li>1<li>2<li>3</ul>")[3][0]
    assert [(c[0], c[2]) for c in ul[3]] == [("li", 1)]
    dl = wrap("<dl><dt>a<dd>b<dt>c<dd>d<dt>e<dd>f</dl>")[3][0]
    assert [c[0] for c in dl[3]] == ["()"] and [c[0] for c in dl[3][0][3]] == ["dt", "dd"]


def test_merge_order_does_not_change_what_is_extracted():
    pages = ["<body><div id=a><p>one</p></div><div class=post><p>%s</p><p>%s</p></div></body>" % (x * 40, x * 20) for x in "abcd"]
    pages.append("<body><div id=a><p>one</p></div><section>x</section><div class=post><p>solo text here</p></div></body>")
    a, b = html.choose(wrap(*pages)), html.choose(wrap(*pages[::-1]))
    for p in pages:
        assert html.extract(p, a) == html.extract(p, b) != ""


BOILER = """<html><head><title>T</title><script>var x="</p>";</script></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href=/>Home</a></ul></nav><aside>side</aside><div class="cookie-notice">We use cookies</div>
<article><h1>Head &amp; more</h1><p>One<br>two  <b>three<p>Four &copy <i>five</i><!-- no --><script>bad()</script> six
<form><input><button>Go</button></form><div class="ad">Buy</div><ul><li>first<li>second</ul>
<div id="comments"><p>reader says</p></div></article><footer>&copy; x</footer></body></html>"""


def test_boilerplate_is_cut():
    w = html.choose(wrap(BOILER))
    assert html.extract(BOILER, w) == "Head & more\nOne two three\nFour © five six\nfirst\nsecond"


def test_pages_without_article_use_the_slots_of_the_host():
    page = "<body><div><ul><li><a href=x>Menu</a><li><a href=y>More</a></ul></div><div><p>{0} one two</p><p>{0} three</p></div>" \
           "<div class='bottom x1'><p>Constant line</p></div></body>"
    pages = [page.format(x) for x in ("alpha", "beta", "gamma")]
    w = html.choose(wrap(*pages))
    assert html.extract(pages[0], w) == "alpha one two\nalpha three"


def test_edges(spark, monkeypatch):
    rows = [(1, "https://h.org/a", None), (2, None, "plain & text"), (3, "x", ""), (4, "https://h.org/b", BOILER),
            (4, "https://h.org/b", BOILER), (5, "https://h.org/c", "<article><p>" + "long " * 100_000), (6, "http://u@H.org:80/", "<p>a<"),
            (7, "https://k.org", "<<>><article>ok</article></p></div><"), (None, "https://h.org/d", "<article>z</article>")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("_host", F.lit(1))
    got = html.main_text(d).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    assert (text[1], text[3], text[7], text[None]) == ("", "", "ok", "z")
    assert text[5] == ("long " * 100_000).strip() and text[4].startswith("Head & more\n")
    assert html.main_text(d.limit(0)).count() == 0
    monkeypatch.setattr(html, "BROADCAST_BYTES", 0)
    assert sorted(html.main_text(d).collect(), key=str) == sorted(got, key=str)


def test_only_attributes_of_their_own_name_cut():
    for attrs in ('style="overflow:hidden"', 'data-hidden="false"', 'title="a hidden gem"', 'data-id="menu"', "title='role=menu'"):
        page = f"<article><div {attrs}><p>one <a {attrs}>two</a> three</p></div></article>"
        assert html.extract(page, html.choose(wrap(page))) == "one two three"
    for attrs in ("hidden", "HIDDEN=''", 'title="x" id="menu"', "aria-hidden = true", "role='navigation'"):
        page = f"<article><div {attrs}><p>gone</p></div><p>kept</p></article>"
        assert html.extract(page, html.choose(wrap(page))) == "kept"


def texts(*pages):
    w = html.choose(wrap(*pages))
    return [html.extract(p, w) for p in pages]


def test_every_template_of_a_host_keeps_its_text():
    a = "<body><article><p>{0} one</p><p>{0} two</p></article></body>"
    m = "<body><div class=top>Site</div><main><p>{0} three</p></main></body>"
    d = "<body><div class=top>Site</div><div class=post><p>{0} four</p><p>{0} five</p></div></body>"
    other = "<body><div class=top>Site</div><div class=entry><p>{0} seven</p></div><div class=post></div></body>"
    card = "<body><article><p>{0}</p></article><div class=post><p>{0} four and so on</p><p>{0} five</p></div></body>"
    pages = [t.format(x) for t in (a, m, d, other) for x in ("alpha", "beta", "gamma")]
    want = ["{0} one\n{0} two", "{0} three", "{0} four\n{0} five", "{0} seven"]
    assert texts(*pages, "<p>bare {0} text") == [t.format(x) for t in want for x in ("alpha", "beta", "gamma")] + ["bare {0} text"]
    got = texts(*[card.format(x) for x in ("alpha", "beta")], *pages)
    assert [g.endswith(f"{x} four and so on\n{x} five") for g, x in zip(got, ("alpha", "beta"), strict=False)] == [True, True]
    sibling = "<body><div><p>{0}</p></div><div><ul><li><a href=x>m</a></ul></div><div><p>{0} long text</p></div></body>"
    assert all(x in g for g, x in zip(texts(*[sibling.format(x) for x in "abc"]), ("a long text", "b long text", "c long text"), strict=True))


def test_pages_of_a_host_with_articles_elsewhere(spark):
    rows = [(1, "https://h.org/b", BOILER), (2, "https://h.org/c", "<article><p>" + "long " * 100), (6, "http://u@H.org:80/", "<p>a<"),
            (8, None, "<article>x y</article>"), (9, "nohost", "<body><main><p>in main</p></main>"), (10, None, "<div><p>in div</p></div>")]
    text = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert (text[6], text[8], text[9], text[10]) == ("a<", "x y", "in main", "in div")


def test_text_split_over_containers_is_kept():
    page = "<body><div class=top><p>Site</p></div><div class=lead><p>{0} lead text</p></div><h2>{0} head</h2>" \
           "<section class=story><figure><figcaption>{0} caption</figcaption></figure><center>{0} body text</center>" \
           "<details>{0} more</details></section><div class=low><p>Imprint</p></div></body>"
    want = "{0} lead text\n{0} head\n{0} caption\n{0} body text\n{0} more"
    assert texts(*[page.format(x) for x in ("alpha", "beta")]) == [want.format(x) for x in ("alpha", "beta")]
    page = "<body><div class=top><p>Site</p></div><div class=post><h1>{0}</h1><div class=body><p>%s</p></div></div></body>" % ("{0} text " * 50)
    assert texts(*[page.format(x) for x in ("alpha", "beta")])[1] == "beta\n" + ("beta text " * 50).strip()
    cells = "<body><div class=top><p>Site</p></div><div><table><tr><td>{0}</td><td>%s</td></tr></table></div></body>" % ("{0} text " * 50)
    assert texts(*[cells.format(x) for x in ("alpha", "beta")])[0].startswith("alpha\nalpha text")


def test_no_part_of_an_article_is_too_small_or_too_far_out():
    lead = "<body><div class=lead><p>{0} lead</p></div><div class=story><p>%s</p></div></body>" % ("{0} text " * 200)
    assert texts(*[lead.format(x) for x in "abc"])[1] == "b lead\n" + ("b text " * 200).strip()
    more = "<body><article><p>%s</p></article><div class=more><p>%s</p></div></body>" % ("{0} one " * 55, "{0} two " * 45)
    assert texts(*[more.format(x) for x in "abc"])[2] == ("c one " * 55).strip() + "\n" + ("c two " * 45).strip()
    assert texts(more.format("d"))[0].count("\n") == 1


def test_the_wrapper_decides_where_no_name_tells():
    page = "<body><div class=qa><p>Same slogan on each page</p></div><div class=qb><p>{0} first</p><p>{0} second</p></div>" \
           "<div class=qc><p>Same closing words</p></div></body>"
    pages = [page.format(x) for x in ("alpha", "beta")]
    assert texts(*pages) == ["alpha first\nalpha second", "beta first\nbeta second"]
    assert html.extract(pages[0], None).startswith("Same slogan") and html.extract(pages[0], None).endswith("closing words")


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = [0, *_next_row(row, x, b)]
    return row[-1]


def _next_row(row, x, b):
    left = 0
    for j, y in enumerate(b):
        left = row[j] + 1 if x == y else max(left, row[j + 1])
        yield left


def test_alignment_in_linear_space_is_a_longest_one(monkeypatch):
    rnd = random.Random(2)
    for cells in (0, 20, 250_000):
        monkeypatch.setattr(html, "TABLE_CELLS", cells)
        for _ in range(300):
            a, b = ([rnd.choice("abcd") for _ in range(rnd.randint(0, 30))] for _ in "ab")
            got = html.pairs(a, b)
            assert all(a[i] == b[j] for i, j in got)
            assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:], strict=False))
            assert len(got) == plain_lcs(a, b)


def test_pages_of_many_irregular_blocks():
    def page(seed):
        rnd = random.Random(seed)
        return "<body>" + "".join(f"<{t}>{seed} {i}</{t}>" for i in range(40_000) for t in [rnd.choice(["p", "h2", "pre", "div"])])
    began = time.perf_counter()
    a, b = page(1), page(2)
    got = texts(a, b)
    assert [len(g.split("\n")) for g in got] == [40_000, 40_000]
    assert time.perf_counter() - began < 60


def test_deep_nesting(spark):
    n = 5_000
    bodies = ["<div>" * n + "<p>deep {0}", "<blockquote>" * n + "deep {0}", "<div><section>" * n + "<p>deep {0}</p>" + "</section></div>" * n,
              "<ul><li>" * n + "deep {0}", "<div><p>a{0}</div><div>" * n + "<p>deep {0}"]
    rows = [(10 * i + j, "https://h.org/", b.format(j)) for i, b in enumerate(bodies) for j in range(3)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text.split("\n")[-1] for r in html.main_text(d).collect()} == {i: f"deep {i % 10}" for i, _, _ in rows}


def test_wrappers_are_read_back():
    w = wrap(BOILER, "<dl><dt>a<dd>b<dt>c<dd>d</dl>", "<p>x</p>")
    assert html.loads(html.dumps(w)) == w


def test_containers_of_the_page_are_not_cut_by_their_class():
    for page in ("<body class='has-sidebar'>%s</body>", "<body class=sidebar>%s</body>", "<body><div id=wrapper class=no-sidebar>%s</div></body>",
                 "<body><main class='with-comments sidebar'>%s</main></body>", "<body><article class='post category-social comments'>%s</article></body>",
                 "<body><div class=header>%s</div><div class=footer-links>Imprint</div></body>", "<body><div class=comments>%s</div></body>"):
        pages = [page % f"<p>{x} one two three</p><p>{x} four</p>" for x in ("alpha", "beta")]
        assert texts(*pages) == [f"{x} one two three\n{x} four" for x in ("alpha", "beta")]
        assert texts(pages[0])[0].startswith("alpha one two three\nalpha four")
    page = "<article><div class=article-header><h1>{0}</h1></div><p class='text alert-level'>{0} a</p><section id=related-work>{0} b</section>" \
           "<div class=comments><p>{0} reader</div><div id=comment-list><p>{0} reader</div><div class='box cookie_notice'>c</div>" \
           "<div class=sidebar-left>d</div><p>{0} <span class=ad>e</span>f <span class=share>g</article>"
    assert texts(page.format("alpha"))[0] == "alpha\nalpha a\nalpha b\nalpha\nf"


def test_a_long_sidebar_beside_an_article_is_cut():
    page = "<body><article><p>{0} short</p></article><div class=sidebar><p>{0} a longer text of the side</p></div></body>"
    assert texts(*[page.format(x) for x in ("alpha", "beta")]) == ["alpha short", "beta short"]


# -- pipeline ----------------------------------------------------------------

def test_pipeline_equals_its_operators_step_by_step(spark):
    """Each stage against a brute-force version over the rows that it was given."""
    import corpus_pipeline as C
    from tests_llm_brute import pipeline_by_hand
    kept, pieces = pipeline_by_hand(spark, SF)
    got = C.run(spark, SF).toPandas()
    assert sorted(got.doc_id.unique()) == sorted(kept)
    assert got.groupby("doc_id").length.sum().to_dict() == pieces


def test_stages_keep_the_columns(spark, make_docs):
    import corpus_pipeline as C
    assert [n for n, _ in C.STAGES] == ["quality_classifier", "quality_rules", "exact_dedup", "near_duplicates", "packing"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, stage in C.STAGES[:-1]:
        assert stage(spark, docs, "/root/testdata/sf0.001").columns == docs.columns
    empty = make_docs([])
    for _, stage in C.STAGES:
        assert stage(spark, empty, "/root/testdata/sf0.001").count() == 0


@pytest.mark.parametrize("gone", [True, False])
def test_entry_without_the_package(tmp_path, gone):
    """The entry module imports and keeps its other queries when this package is absent."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import shutil
    for n in ("__spark_entry__.py", "corpus_pipeline.py"):
        if not (gone and n == "corpus_pipeline.py"):
            shutil.copy(os.path.join(root, n), tmp_path)
    shutil.copytree(os.path.join(root, "moodindex"), tmp_path / "moodindex",
                    ignore=shutil.ignore_patterns("__pycache__", *["llm"] * gone))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, 'weak_label' in q)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-1000:]
    assert out.stdout.split()[1:] == [str(not gone), "True"]
