"""URL resolution against the standard library and by table."""

import random
from urllib.parse import urldefrag, urljoin

from vigil.functions import urls
from vigil.operators import frontier

BASES = ["http://a.pt/b/c/d;p?q", "http://a.pt", "https://a.pt/", "http://a.pt/b/c/", "http://a.pt?x=/y", "http://u:p@a.pt:8080/b/c"]
#: base, reference, target: what the standard library leaves as written, or takes otherwise
CASES = [
    ("HTTP://A.PT:80/X/y", "z", "http://a.pt/X/z"),
    ("https://a.pt:443", "?q", "https://a.pt/?q"),
    ("http://a.pt:/x", "", "http://a.pt/x"),
    ("http://a.pt/x?q#f", "#g", "http://a.pt/x?q"),
    ("http://a.pt/x/y?q", "?", "http://a.pt/x/y?"),
    ("http://a.pt/x/y", " \n../z\t ", "http://a.pt/z"),
    ("http://a.pt/x/y", "http:z", "http://a.pt/x/z"),
    ("http://a.pt/x/y", "https:z", "https:z"),
    ("http://a.pt/x/y", "//Me@B.pt:80", "http://Me@b.pt/"),
    ("http://a.pt/x/y", "mailto:A.b@c.pt", "mailto:A.b@c.pt"),
    ("http://a.pt/x/y", "../../../..", "http://a.pt/"),
    ("http://a.pt/x/y", "./..", "http://a.pt/"),
    ("http://a.pt/x/y/z", "a/./b/../c/.", "http://a.pt/x/y/a/c/"),
    ("http://a.pt/x", "FTP://B.pt/a/../c", "ftp://b.pt/c"),
    (None, "x", None), ("http://a.pt/", None, None),
]


def resolved(spark, pairs):
    df = spark.createDataFrame(pairs, "base string, ref string")
    return [r[0] for r in df.select(urls.resolve("ref", "base")).collect()]


def test_resolution_equals_the_standard_library(spark):
    rng = random.Random(3)
    parts = ["..", ".", "g", "h;x=1", "...", "é", "a b"]  # the library drops empty segments, which the rule keeps
    pairs = []
    for _ in range(3000):
        path = rng.choice(["", "/"]) + "/".join(rng.choice(parts) for _ in range(rng.randrange(1, 6)))
        ref = rng.choice([path, path, "//h.pt" + ("/" + path.lstrip("/") if path else ""), "http://k.pt/" + path.lstrip("/")])
        ref += rng.choice(["", "", "?y/../z", "#s/./x", "?a=b#c"])
        if not ref.startswith("//") or "h.pt" in ref:
            pairs.append((rng.choice(BASES), ref))
    got = resolved(spark, pairs)
    for (base, ref), g in zip(pairs, got):
        want = urldefrag(urljoin(base, ref.strip(" ")))[0]
        if ref.startswith("#") or ref == "":
            want = urldefrag(base)[0]
        assert g == urls_spelt(want), (base, ref)


def urls_spelt(url):
    """The library leaves an empty path, and dot segments of a whole reference, as they are."""
    head, _, rest = url.partition("://")
    cut = min((rest.find(c) for c in "/?" if c in rest), default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    path, mark, query = tail.partition("?")
    if path:
        out = []
        for seg in path.split("/")[1:]:
            if seg == "..":
                del out[-1:]
            elif seg != ".":
                out.append(seg)
        path = "/" + "/".join(out) + ("/" if path.split("/")[-1] in (".", "..") and out else "")
    return head + "://" + host + (path or "/") + mark + query


def test_resolution_by_table(spark):
    assert resolved(spark, [(b, r) for b, r, _ in CASES]) == [t for _, _, t in CASES]


def test_normalisation_is_stable(spark):
    df = spark.createDataFrame([(t,) for _, _, t in CASES], "u string")
    assert [r[0] for r in df.select(urls.normalize_url("u")).collect()] == [t for _, _, t in CASES]


def test_a_page_has_one_name_and_base_elements_count(spark):
    pages = spark.createDataFrame([
        (1, "http://A.pt:80/x/./y.html#top", "<base href='/b/c'><a href=d>1</a><a href='../d'>2</a><a href='//a.pt/d'>3</a>"),
        (2, "http://a.pt/d", "<!-- <base href='/no/'> --><a href='?p=1'>4</a><a href='#x'>5</a><a href=''>6</a>"),
        (3, None, "<a href='/z'>7</a>"), (4, "http://a.pt/e", None)], "page_id long, url string, html string")
    got = {tuple(r) for r in frontier.link_targets(pages).collect()}
    assert got == {("http://a.pt/x/y.html", "http://a.pt/b/d"), ("http://a.pt/x/y.html", "http://a.pt/d"),
                   ("http://a.pt/d", "http://a.pt/d?p=1"), ("http://a.pt/d", "http://a.pt/d")}
    seeds = spark.createDataFrame([("http://a.pt/x/y.html",)], "url string")
    reached = {r["url"]: r["round"] for r in frontier.expand_frontier(pages, seeds).collect()}
    assert reached == {"http://a.pt/x/y.html": 0, "http://a.pt/b/d": 1, "http://a.pt/d": 1, "http://a.pt/d?p=1": 2}
