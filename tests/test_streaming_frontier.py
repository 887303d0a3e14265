"""Incremental ingestion (availableNow runs over a growing folder) and frontier expansion."""

import os

from vigil.operators.frontier import expand_frontier, frontier
from vigil.streaming.incremental import content_stream, first_by_content, ingest_available


def test_incremental_ingestion_skips_seen_content(spark, tmp_path):
    src, sink, ckpt = (str(tmp_path / x) for x in ("src", "sink", "ckpt"))
    os.makedirs(src)
    schema = "doc_id long, text string"

    def land(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(src, name))

    land("b1", [(1, "alpha"), (2, "beta"), (3, "alpha")])
    ingest_available(content_stream(spark, src + "/*", schema, "text"), sink, ckpt)
    assert spark.read.parquet(sink).count() == 2
    land("b2", [(4, "gamma"), (5, "beta")])
    ingest_available(content_stream(spark, src + "/*", schema, "text"), sink, ckpt)
    assert spark.read.parquet(sink).count() == 3
    ingest_available(content_stream(spark, src + "/*", schema, "text"), sink, ckpt)
    assert spark.read.parquet(sink).count() == 3
    batch = spark.createDataFrame([(1, "alpha"), (2, "beta"), (3, "alpha"), (4, "gamma"), (5, "beta")], schema)
    assert sorted(r.doc_id for r in first_by_content(batch, "doc_id", "text").collect()) == [1, 2, 4]


def _page(url, links):
    body = "".join(f'<li><a href="{h}">x</a></li>' for h in links)
    return (url, f"<html><body><nav><ul>{body}</ul></nav></body></html>")


def test_frontier_rounds(spark):
    pages = spark.createDataFrame([
        _page("http://s.example.org/a", ["/b", "/c#frag", "http://o.example.net/x"]),
        _page("http://s.example.org/b", ["/a", "/d"]),
        _page("http://s.example.org/d", ["e"]),
        _page("http://s.example.org/e", []),
    ], "url string, html string")
    reached = {r.url: r["round"] for r in
               expand_frontier(pages, spark.createDataFrame([("http://s.example.org/a",)], "url string")).collect()}
    assert reached == {"http://s.example.org/a": 0, "http://s.example.org/b": 1,
                       "http://s.example.org/c": 1, "http://o.example.net/x": 1,
                       "http://s.example.org/d": 2, "http://s.example.org/e": 3}
    f = {r.url for r in frontier(pages, pages.select("url")).collect()}
    assert f == {"http://s.example.org/c", "http://o.example.net/x"}


def test_crawl_runs_to_the_end_and_follows_what_it_should(spark):
    chain = [_page(f"http://s.example.org/{i}.aspx", [f"/{i + 1}.aspx", "/x_json.txt"]) for i in range(14)]
    pages = spark.createDataFrame(chain, "url string, html string")
    seed = spark.createDataFrame([("http://s.example.org/0.aspx",)], "url string")
    reached = {r.url: r["round"] for r in expand_frontier(pages, seed, follow=".aspx").collect()}
    assert reached == {f"http://s.example.org/{i}.aspx": i for i in range(15)}
    some = expand_frontier(pages, seed, follow=".aspx", depth=3).collect()
    assert sorted(r["round"] for r in some) == [0, 1, 2, 3]


def test_rounds_leave_no_broadcast_in_the_driver(spark, monkeypatch):
    plans, plain = [], type(spark.range(1)).checkpoint

    def checkpoint(df, *args):
        out = plain(df, *args)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(type(spark.range(1)), "checkpoint", checkpoint)
    pages = spark.createDataFrame([_page(f"http://s.example.org/{i}", [f"/{i + 1}"]) for i in range(4)], "url string, html string")
    seed = spark.createDataFrame([("http://s.example.org/0",)], "url string")
    assert expand_frontier(pages, seed).count() == 5
    rounds = [p for p in plans if "Join" in p]
    assert len(rounds) == 5 and not [p for p in rounds if "Broadcast" in p]


def test_links_as_a_browser_reads_them(spark):
    from vigil.sources.pages import page_links
    html = ("<a href='/one'>1</a><a data-href=\"/no\" class=x href=\"/two?a=1&amp;b=2\">2</a><!-- <a href=\"/comment\">c</a> -->"
            "<a title=\"x href='/title'\" href=/three>3</a><A HREF = \" /four \" >4</A><a name=x>no</a><abbr href='/no'>n</abbr><a data-href='/no'>n</a>")
    got = page_links(spark.createDataFrame([(1, "u", html)], "page_id int, url string, html string")).orderBy("link_pos")
    assert [r.href for r in got.collect()] == ["/one", "/two?a=1&b=2", "/three", "/four"]


def test_block_text_forms(spark):
    from vigil.sources.markup import block_text
    html = "<div class='x title'>own <b>B &amp; b</b><i>I</i></div><div class='other'><b>no</b></div><!-- <div class='title'>c</div> -->"
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(block_text("html", "title")).first()[0] == ["own ", "B & b", "I"]
    assert df.select(block_text("html", "title", descendants_only=True)).first()[0] == ["B & b", "I"]


def test_links_without_a_file_name_are_quarantined(spark):
    from vigil.operators.frontier import manifest_rows, unnamed_links
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("u", ["Início", "Dir"], ["/a_json.txt?fich=Abc_json.txt&Inline=true", "/b_json.txt"])],
                               "url string, crumbs array<string>, links array<string>")
    good = manifest_rows(df, "crumbs", "links", F.lit(None).cast("timestamp_ntz")).collect()
    assert [r.file_path for r in good] == ["data/dir/abc.json"]
    assert [(r.file_url, r.error_reason) for r in unnamed_links(df, "links").collect()] == [("/b_json.txt", "no file name marker")]


def test_block_links_selects_inside_class(spark):
    from vigil.sources.markup import block_links
    html = ('<div class="nav"><a href="/skip">x</a></div>'
            '<div class="archive-item big"><a title="t" href="/a.aspx">a</a><a href="/f_json.txt">f</a></div>'
            '<div class="archive-item"><a href="/b.aspx">b</a></div>')
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(block_links("html", "archive-item")).first()[0] == ["/a.aspx", "/f_json.txt", "/b.aspx"]


def test_nesting_aware_block_selection(spark):
    from vigil.sources.html_select import select_in_blocks, select_values
    html = ('<div class="ConteudoTexto"><div class="inner"><a title="Recursos" href="/r1.aspx">x</a></div>'
            '<a title="Outro" href="/o.aspx">y</a><a title="Recursos" href="/r2.aspx">z</a></div>'
            '<a title="Recursos" href="/outside.aspx">w</a>'
            '<div class="details_page_title"><span>Agenda</span> <b>Parlamentar</b></div>'
            '<div class="breadcrumb-container"><a>Início</a> &gt; <a>XV Legislatura</a></div>')
    assert select_values(html, "div", "ConteudoTexto", "href", {"title": "Recursos"}) == ["/r1.aspx", "/r2.aspx"]
    assert select_values(html, "div", "details_page_title", "text") == ["Agenda", " ", "Parlamentar"]
    assert select_values(html, "div", "breadcrumb-container", "text") == ["Início", " > ", "XV Legislatura"]
    df = spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")
    got = [(r.page_id, r.pos, r.value) for r in
           select_in_blocks(df, "div", "ConteudoTexto", "href", {"title": "Recursos"}).collect()]
    assert sorted(got) == [(1, 0, "/r1.aspx"), (1, 1, "/r2.aspx")]


def test_landed_file_stream_skips_seen_bytes(spark, tmp_path):
    from vigil.streaming.incremental import landed_file_stream
    land, sink, ckpt = tmp_path / "land", str(tmp_path / "files"), str(tmp_path / "ck")
    (land / "a").mkdir(parents=True)
    (land / "a" / "x.json").write_text('{"v": 1}')
    (land / "a" / "y.json").write_text('{"v": 2}')
    ingest_available(landed_file_stream(spark, str(land), "*.json"), sink, ckpt)
    assert spark.read.parquet(sink).count() == 2
    (land / "b").mkdir()
    (land / "b" / "x_copy.json").write_text('{"v": 1}')        # same bytes, new path
    (land / "b" / "z.json").write_text('{"v": 3}')
    ingest_available(landed_file_stream(spark, str(land), "*.json"), sink, ckpt)
    got = spark.read.parquet(sink)
    assert got.count() == 3 and got.where("path like '%x_copy.json'").count() == 0


def test_resolve_link_forms(spark):
    from vigil.functions.urls import resolve
    rows = [("https://a.example.org/x/y.html?q=1#f", "//cdn.example.net/z#k"),
            ("https://a.example.org/x/y.html?q=1#f", "/root"),
            ("https://a.example.org/x/y.html?q=1#f", "rel/p"),
            ("https://a.example.org/x/y.html?q=1#f", "mailto:someone@example.org")]
    df = spark.createDataFrame(rows, "url string, href string")
    assert [r[0] for r in df.select(resolve("href", "url")).collect()] == [
        "https://cdn.example.net/z", "https://a.example.org/root", "https://a.example.org/x/rel/p",
        "mailto:someone@example.org"]


def test_href_regex_tolerates_case_and_spacing(spark):
    from vigil.sources.pages import page_links
    html = '<A HREF="/x">x</A><a\n class="k"  href = "/y">y</a><abbr href="/no">z</abbr>'
    df = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    assert [r.href for r in page_links(df).orderBy("link_pos").collect()] == ["/x", "/y"]
