"""Main text of pages."""

import html
import re
import time

import pytest
from signpost.llm import extract
from signpost.llm.queries import QUERIES

TREE = extract.trained()


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<nav><a href='/'>Home</a></nav><footer>end</footer>", ""),
        ("<article>q<script>1<2</script> w <!-- c --><p>z<i>y</i><div class='AdBox'>b</div>t", "q w\n\nzy\n\nt"),
        ("<article><p>a&nbsp;&eacute;\n\t &lt;i&gt; &#x41;<br>b</p></article>", "a é <i> A b"),
        ("<article><p>x</p></article><section id='user-comments'><p>what a fine text this is, thank you all</p></section>", "x"),
        ("<header>H</header><article><header><h1>T</h1></header><p>x</p><footer>by me</footer></article>", "T\n\nx"),
        ("<article><p>x</p><form><p>mail</p></form><ul class='share'><li>y</li></ul><table><tr><td>1</td></tr></table></article>", "x\n\n1"),
        ("<article><p>cut off here <b>and <a href='x", "cut off here and"),
        ("<article><p hidden>no</p><div style='display:none'>no</div><div role='alert'>no</div><p>1 < 2</p></article>", "no\n\n1 < 2"),
        ("<body class='has-sidebar'><article><div class='article-header'><h1>T</h1></div><p>x</p></article></body>", "T\n\nx"),
        ("<main><article class='comment'><p>what a fine text this is</p></article><p>x</p></main>", "x"),
        ("<style>p{}</style><title>t</title><article><textarea>no</textarea>yes</article>", "yes"),
    ],
)
def test_main_text(page, text):
    assert extract.main_text(page, TREE) == text


def test_long_and_odd_pages():
    words = "word " * 200_000
    assert extract.main_text(f"<article><p>{words}</p></article>", TREE) == words.strip()
    assert extract.main_text("<article>" + "<div>" * 5000 + "x", TREE) == "x"
    assert extract.main_text("<article>a" + "<" * 5000, TREE).startswith("a<")


def test_labelled_pages_are_learned():
    right = total = 0
    for page, labels in extract.LABELLED:
        found = extract.blocks(page)
        marks = [c == "1" for c in labels if c in "01"]
        got = [extract.is_main(TREE, row) for row in extract.features(found)]
        right += sum(a == b for a, b in zip(got, marks))
        total += len(marks)
    assert right / total > 0.95


def test_frames(spark):
    kind = "page_id long, url string, html string, text int"
    rows = [(1, "u", "<article><p>a</p></article>", 1), (1, "u", "<article><p>a</p></article>", 1), (None, None, None, 1)]
    got = extract.extracted(spark.createDataFrame(rows, kind)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0)], key=str)
    assert extract.extracted(spark.createDataFrame([], kind)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.page_id: r for r in QUERIES["op7_extract"](spark, sf).collect()}
    for page in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", page.html, re.S).group(1)
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner).replace("<br>", " "))
        want = "\n\n".join(t for p in parts if (t := " ".join(html.unescape(p).split())))
        assert got[page.page_id].text == want and got[page.page_id].n_chars == len(want)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article class='post category-social'><p>x</p></article>", "x"),
        ("<article class='post has-comments'><h1>T</h1><p>x</p></article>", "T\n\nx"),
        ("<article class='has-comments'><p>x</p></article>", "x"),
        ("<article id='post-7' class='social'><p>x</p></article>", "x"),
        ("<div class='content with-sidebar'><p>x</p><div class='sidebar'><p>what a fine text this is</p></div></div>", "x"),
        ("<div class='content--with-sidebar'><p>x</p></div>", "x"),
        (f"<div class='content social'><p>{extract._PROSE}</p><p>{extract._MORE}</p></div>", f"{extract._PROSE}\n\n{extract._MORE}"),
        ("<article><p>x</p><div class='post-comments'><p>what a fine text this is</p></div></article>", "x"),
        ("<article><p>x</p><article class='related-post'><p>what a fine text this is</p></article></article>", "x"),
        ("<article><p>x</p><aside class='post related'><p>what a fine text this is</p></aside></article>", "x"),
    ],
)
def test_articles_with_furniture_words(page, text):
    assert extract.main_text(page, TREE) == text


@pytest.mark.parametrize("tag", sorted(extract.SKIPPED_TAGS - extract.RAW_TAGS))
def test_unclosed_skipped_elements(tag):
    assert extract.main_text(f"<{tag}><article><p>x</p></article>", TREE) == "x"
    assert extract.main_text(f"<article><p>x</p><{tag} a='b'><p>y</p></article>", TREE) == "x\n\ny"
    # Another element's end tag does not close it.
    assert extract.main_text(f"<{tag}><article><p>x</p><{tag}>no</{tag}><p>y</p></article>", TREE) == "x\n\ny"
    assert extract.main_text(f"<article><p>x<{tag}>no<{tag}>no</{tag}>no</{tag}></p><p>y</p></article>", TREE) == "x\n\ny"
    assert extract.main_text(f"<{tag}><script>'</{tag}>'</script><!-- </{tag}> --><article><p>x</p></article>", TREE) == "x"
    assert extract.main_text("<article>" + f"<{tag}>" * 20_000 + "x</article>", TREE) == "x"


def test_self_closed_elements():
    assert extract.main_text("<article><p>x <svg a='b'/> y</p><math/><p>z</p><svg>no</svg></article>", TREE) == "x y\n\nz"
    assert extract.main_text("<article><p>x</p><iframe src='u' /><p>y</p></article>", TREE) == "x\n\ny"
    assert extract.main_text("<article><p>x</p><svg><svg/>no</svg><p>y</p></article>", TREE) == "x\n\ny"
    assert extract.main_text("<article><p>x</p><script>no <p>no</p></article>", TREE) == "x"


def test_broken_pages_take_linear_time():
    tree = extract.trained()
    for unit in ("<a ", "<p \"", "<!x", "<!--", "</script ", "<script>", "<p '", "<div>", "</div>", "<div></p>", "<svg ", "<form>", "&amp", "<"):
        for tail in ("", ">", "<p>end"):
            start = time.perf_counter()
            extract.main_text("<article><p>Some words here.</p>" + unit * (1_000_000 // len(unit)) + tail, tree)
            assert time.perf_counter() - start < 20, (unit, tail)


def test_unfinished_markup():
    tree = extract.trained()
    lead = "<article><p>One plain sentence of some words.</p>"
    kept = "One plain sentence of some words."
    assert extract.main_text(lead + "<p>a < b", tree) == kept + "\n\na < b"
    assert extract.main_text(lead + "<a href='x", tree) == kept
    assert extract.main_text(lead + "<!-- gone <p>never</p>", tree) == kept
    assert extract.main_text(lead + "<!-- gone --><p>Back again.</p>", tree) == kept + "\n\nBack again."
    assert extract.main_text(lead + "<div><section></div><p>After.</p>", tree) == kept + "\n\nAfter."
