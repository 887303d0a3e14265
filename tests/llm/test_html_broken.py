"""Pages that never close what they open, and tables without any named main element."""

import time

import pytest

from vigil.llm import html_extract
from vigil.llm.html_blocks import blocks

BROKEN = ["<script " * 125_000, '<a x ' * 200_000, '<a "' * 250_000, "<!-- " * 200_000, "<a x='" * 160_000, "<" * 1_000_000, "</p " * 250_000, "<svg><" * 160_000]


@pytest.mark.parametrize("page", BROKEN, ids=[b[:8] for b in BROKEN])
def test_a_megabyte_of_anything_is_read_once(page):
    began = time.time()
    blocks("<p>before</p>" + page)
    assert time.time() - began < 5


@pytest.mark.parametrize("html,texts", [
    ("<p title='a>b'>x</p>", ["x"]), ('<p title="a>b" class=k>x<p>y', ["x", "y"]), ("<p don't>x</p><p can't>y</p>", ["x", "y"]),
    ("<p>x</p><a title='open>y", ["x"]), ("<p>a < b</p>", ["a < b"]), ("<p>x<script>if (a > b) '</p>'", ["x"]), ("<p>x<br/>y</p>", ["x y"])])
def test_markup_inside_quotes(html, texts):
    assert [b[0] for b in blocks(html)] == texts


def plain_site(i):
    """A page whose article is plain divs, so that no element names the main text."""
    story = "".join(f"<p>Sentence {i} {k} of a story that is long enough to be the text of a page by itself, as it says.</p>" for k in range(4 + i % 5))
    return (f"<body><div class='menu'><ul><li><a href=/a>Home</a></li><li><a href=/b>News {i}</a></li></ul></div><div class='col'><h2>Heading {i}</h2>{story}</div>"
            f"<div class='footer'>Copyright of site {i}, all rights reserved by the people who made this page and its pictures.</div></body>")


def test_weak_labels_by_rule():
    page = blocks(plain_site(1))
    labels = html_extract.weak_labels(page)
    assert [t for (t, _, _), k in zip(page, labels) if k] == [t for t, _, _ in page if t.startswith(("Heading", "Sentence"))]


def test_a_table_without_named_articles_still_teaches(spark):
    rows = [(i, f"http://s/{i}", plain_site(i)) for i in range(120)] + [(900, "u", None), (901, None, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extraction_report(df).collect()}
    assert got[900] == "" and got[901] == ""
    good = 0
    for i in range(120):
        want = [t for t, _, _ in blocks(plain_site(i)) if t.startswith(("Heading", "Sentence"))]
        good += got[i] == "\n\n".join(want)
    assert good >= 110


def test_long_pages_are_learnt_to_their_end():
    """Batches hold whole pages: none is cut, and only a page that is longer than a batch stands alone."""
    sizes = [5, 4000, 300, 300, 7, 9000, 20]
    pages = [(None, [0] * n) for n in sizes]
    got = [[len(p[1]) for p in b] for b in html_extract.BiLstm._batches(pages)]
    assert sorted(n for b in got for n in b) == sorted(sizes)
    assert all(len(b) == 1 or len(b) * b[0] <= html_extract.BATCH_BLOCKS for b in got)
