"""Queries over links and markup in every shape that pages hold, not only the tidy one."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.functions import urls
from vigil.functions.text import ascii_table, fold_to_ascii, strip_html
from vigil.operators import frontier
from vigil.plans.registry import query
from vigil.plans.tables import load
from vigil.sources.markup import block_links, block_text

#: Base URLs made of a page's url ({u}) and id ({i}), and references of every shape.
BASES = ("{u}", "{u}/x/y/z.aspx?BID={i}#f", "HTTP://me:pw@H{i}.Example.PT:80", "https://h{i}.pt:443/a/./b/../c/", "https://h{i}.pt?q=/{i}/../x",
         "http://h.pt:8080/p{i}/;v=1/index.html")
REFERENCES = ("../a{i}.aspx", "./b.aspx", "?BID=2{i}", "#top", "", "//O{i}.ORG:/x/../y", "/a/./b/../../c", "http://h{i}", "HTTPS://Q.pt:443/z/..?w#e",
              "mailto:a.b@c.pt", "..", ".", "../../../../g", "g/{i}/", "g?y/./x", "g;x=1/../y", "http:g", " /sp\tace\n ", "javascript:void({i})", "é/ü?ç=ñ", "/",
              "..a/.b/...", "a//b/../c", "../?q", "?", "x#../y", "./../.", "/..//../z", "ftp://F.pt:21/a/../b", "://")


def _filled_spark(pattern: str):
    return F.replace(F.replace(F.lit(pattern), F.lit("{u}"), F.col("url")), F.lit("{i}"), F.col("page_id").cast("string"))


def _list_sql(patterns) -> str:
    quoted = ", ".join("'" + p.replace("'", "''") + "'" for p in patterns)
    return f"unnest(list_transform([{quoted}], lambda p: replace(replace(p, '{{u}}', url), '{{i}}', page_id::VARCHAR)))"


#: RFC 3986, 5.2, step by step: the reference transform, then the remove-dot-segments loop over an input and an output buffer.
_STEPS_SQL = r"""
s AS (SELECT *, trim(replace(replace(replace(ref, chr(9), ''), chr(10), ''), chr(13), '')) AS r, split_part(base, '#', 1) AS b0 FROM x),
p AS (SELECT *, regexp_extract(r, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1) AS rs, regexp_replace(regexp_replace(r, '#(?s:.*)$', ''), '^[a-zA-Z][a-zA-Z0-9+.-]*:', '') AS r1,
      lower(regexp_extract(b0, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1)) AS bs, regexp_replace(b0, '^[a-zA-Z][a-zA-Z0-9+.-]*:', '') AS b1 FROM s),
q AS (SELECT *, r1[1:2] = '//' AS ra, b1[1:2] = '//' AS ba, CASE WHEN rs = '' THEN NULL ELSE lower(rs) END AS rsl FROM p),
a AS (SELECT *, CASE WHEN ra THEN regexp_extract(r1[3:], '^[^/?]*') END AS rauth, CASE WHEN ba THEN regexp_extract(b1[3:], '^[^/?]*') END AS bauth FROM q),
t AS (SELECT *, CASE WHEN ra THEN r1[3 + length(rauth):] ELSE r1 END AS r2, CASE WHEN ba THEN b1[3 + length(bauth):] ELSE b1 END AS b2 FROM a),
w AS (SELECT *, split_part(r2, '?', 1) AS rp, CASE WHEN contains(r2, '?') THEN r2[length(split_part(r2, '?', 1)) + 2:] END AS rq,
             split_part(b2, '?', 1) AS bp, CASE WHEN contains(b2, '?') THEN b2[length(split_part(b2, '?', 1)) + 2:] END AS bq,
             CASE WHEN rsl = bs AND bs IN ('http', 'https') AND rauth IS NULL THEN NULL ELSE rsl END AS own FROM t),
m AS (SELECT *, coalesce(own, bs) AS ts, CASE WHEN own IS NOT NULL OR rauth IS NOT NULL THEN rauth ELSE bauth END AS ta,
             CASE WHEN own IS NOT NULL OR rauth IS NOT NULL OR rp LIKE '/%' THEN rp WHEN rp = '' THEN bp
                  WHEN bauth IS NOT NULL AND bp = '' THEN '/' || rp ELSE regexp_replace(bp, '[^/]*$', '') || rp END AS tp,
             CASE WHEN own IS NOT NULL OR rauth IS NOT NULL OR rp <> '' OR rq IS NOT NULL THEN rq ELSE bq END AS tq FROM w),
d(i, o, f, n) AS (SELECT tp, '', tp, 0 FROM (SELECT DISTINCT tp FROM m WHERE tp LIKE '/%') UNION ALL SELECT
        CASE WHEN i LIKE '/./%' THEN i[3:] WHEN i = '/.' THEN '/' WHEN i LIKE '/../%' THEN i[4:] WHEN i = '/..' THEN '/' ELSE i[length(regexp_extract(i, '^/[^/]*')) + 1:] END,
        CASE WHEN i LIKE '/./%' OR i = '/.' THEN o WHEN i LIKE '/../%' OR i = '/..' THEN regexp_replace(o, '/[^/]*$', '') ELSE o || regexp_extract(i, '^/[^/]*') END,
        f, n + 1 FROM d WHERE i <> ''),
e AS (SELECT m.*, coalesce(d.o, m.tp) AS ep, regexp_extract(ta, '^(.*@)?', 1) AS usr, lower(regexp_replace(ta, '^.*@', '')) AS hst FROM m LEFT JOIN d ON d.f = m.tp AND d.i = ''),
g AS (SELECT *, regexp_replace(CASE WHEN ts = 'http' THEN regexp_replace(hst, ':80$', '') WHEN ts = 'https' THEN regexp_replace(hst, ':443$', '') ELSE hst END, ':$', '') AS hp FROM e),
z AS (SELECT *, CASE WHEN ts = '' THEN '' ELSE ts || ':' END || CASE WHEN ta IS NULL THEN '' ELSE '//' || usr || hp END
             || CASE WHEN ts IN ('http', 'https') AND ta IS NOT NULL AND ep = '' THEN '/' ELSE ep END || CASE WHEN tq IS NULL THEN '' ELSE '?' || tq END AS target FROM g)"""


def resolved_sql(rows: str, result: str) -> str:
    """``result`` over ``z``: the rows of ``rows`` (with ref, base) and their ``target``."""
    return f"WITH RECURSIVE x AS ({rows}),{_STEPS_SQL}\n{result}"


@query("link_resolution", resolved_sql(
    f"SELECT page_id, base, ref FROM (SELECT page_id, url, base, {_list_sql(REFERENCES)} AS ref FROM (SELECT page_id, url, {_list_sql(BASES)} AS base FROM pages))",
    "SELECT page_id, base, ref, target FROM z"))
def q_link_resolution(spark, sf):
    """Every page's url as a base in several shapes, against references of every shape."""
    p = load(spark, sf, "pages").select("page_id", "url")
    p = p.select("page_id", "url", F.explode(F.array(*[_filled_spark(b) for b in BASES])).alias("base"))
    p = p.select("page_id", "base", F.explode(F.array(*[_filled_spark(r) for r in REFERENCES])).alias("ref"))
    return p.withColumn("target", urls.resolve("ref", "base"))


_HREFS_SQL = "unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*?href\\s*=\\s*\"([^\"]*)\"', 1))"


@query("frontier_expand", resolved_sql(
    f"SELECT url AS base, {_HREFS_SQL} AS ref FROM pages UNION ALL SELECT url, '' FROM pages",
    "SELECT DISTINCT target AS url FROM z WHERE target NOT IN (SELECT target FROM z WHERE ref = '')"))
def q_frontier_expand(spark, sf):
    """Resolved link targets not yet visited (anti-join with the page URLs)."""
    pages = load(spark, sf, "pages")
    return frontier.frontier(pages, pages.select("url"))


@query("frontier_rounds", """
WITH RECURSIVE n AS (SELECT max(c_custkey) AS top FROM customer),
r(k, round) AS (
  SELECT CAST(1 AS BIGINT), 0
  UNION ALL
  SELECT c.k2, r.round + 1 FROM r, n, LATERAL (SELECT unnest([3 * r.k - 1, 3 * r.k, 3 * r.k + 1]) AS k2) c
  WHERE r.k <= n.top AND r.k IN (SELECT c_custkey FROM customer)),
v(k, s, round) AS (SELECT k, 0, min(round) FROM r GROUP BY k UNION ALL SELECT v.k, v.s + 1, v.round + 1 FROM v WHERE v.s < 2 AND v.k IN (SELECT c_custkey FROM customer))
SELECT 'https://c.example.org/m/' || CAST(k AS VARCHAR) || '/p.aspx' || CASE WHEN s > 0 THEN '?s=' || s ELSE '' END AS url,
       CAST(min(round) AS INTEGER) AS round FROM v GROUP BY k, s""")
def q_frontier_rounds(spark, sf):
    """Crawl to the end over a page per customer and two further views of it, from one seed. Customer
    k's page links to 3k-1, 3k and 3k+1 by dot segments, host-only and upper-case references (some
    beyond the table), to its next view by a query alone, to itself by a fragment and an
    empty reference, to a download that is not followed and, commented out, to nothing. Every
    second page says by a base element what its links are relative to."""
    k, s = F.col("c_custkey").cast("bigint"), F.col("s")
    a = lambda *ref: F.concat(F.lit('<a href="'), *[x if not isinstance(x, str) else F.lit(x) for x in ref], F.lit('">x</a>'))
    t = lambda x: x.cast("string")
    rows = load(spark, sf, "customer").select("c_custkey", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("s"))
    view = F.when(s > 0, F.concat(F.lit("?s="), t(s))).otherwise("")
    onward = F.concat(a("../", t(3 * k - 1), "/./p.aspx#top"), a("../../m/x/../", t(3 * k), "/p.aspx"), a("//C.Example.org:443/m/", t(3 * k + 1), "/p.aspx"))
    body = F.concat(F.when(s == 0, onward).otherwise(""), F.when(s < 2, a("p.aspx?s=", t(s + 1))).otherwise(""),
                    F.lit("<a href='#p.aspx'>s</a><a href=''>e</a><a class='x' href='/list_json.txt'>d</a><!-- <a href=\"/none.aspx\">n</a> -->"))
    base = F.when(k % 2 == 0, F.concat(F.lit("<base target=x href='/m/"), t(k), F.lit("/q/../p.aspx"), view, F.lit("'>"))).otherwise("")
    pages = rows.select(F.concat(F.lit("https://c.example.org/m/"), t(k), F.lit("/p.aspx"), view).alias("url"), F.concat(base, body).alias("html"))
    seeds = spark.range(1).select(F.lit("HTTPS://c.example.org:443/m/./1/p.aspx#start").alias("url"))
    return frontier.expand_frontier(pages, seeds, follow=".aspx")


#: A page whose blocks nest, with {i} its page_id and {u} its url: void, self-closed, unclosed and quoted parts.
NESTED = ("<div class='x archive-item'><p title=\"a > <div>\">one {i}<br><a href=/a{i}>A</a><div>two<a href='/in{i}'>B</a><img alt='</div>'><div/></div>"
          "after {i}<!-- </div> --><script>'</div>'</script><a class=k href=\"{u}\">C</a><DIV CLASS=\"archive-item\"><a href='/twice{i}?x=1&amp;y=2'>D</a></DIV ></div>"
          "<a href=/out>no</a>out</div></div><div class=archive-items><a href=/other>no</a></div>"
          "<div data-class=archive-item><a href=/data>no</a></div><div id=z class=archive-item>tail <b>bold {i}</b><a name=q>E</a><a data-href=/d href = '/last{i}'>F</a>end")


@query("page_nested_links", """
SELECT page_id, pos::INTEGER - 1 AS pos, v[pos] AS value FROM (SELECT page_id, v, generate_subscripts(v, 1) AS pos FROM (
  SELECT page_id, ['/a' || page_id, '/in' || page_id, url, '/twice' || page_id || '?x=1&y=2', '/last' || page_id] AS v FROM pages))""")
def q_page_nested_links(spark, sf):
    """Hrefs inside blocks that nest, hold void and quoted look-alikes, or are never closed."""
    p = load(spark, sf, "pages").select("page_id", _filled_spark(NESTED).alias("html"))
    return p.select("page_id", F.posexplode(block_links("html", "archive-item")).alias("pos", "value"))


@query("page_nested_text", """
SELECT page_id, kind, pos::INTEGER - 1 AS pos, v[pos] AS value FROM (SELECT page_id, kind, v, generate_subscripts(v, 1) AS pos FROM (
  SELECT page_id, 'all' AS kind, ['one ' || page_id, 'A', 'two', 'B', 'after ' || page_id, 'C', 'D', 'tail ', 'bold ' || page_id, 'E', 'F', 'end'] AS v FROM pages UNION ALL
  SELECT page_id, 'inner', ['one ' || page_id, 'A', 'two', 'B', 'after ' || page_id, 'C', 'D', 'bold ' || page_id, 'E', 'F'] FROM pages))""")
def q_page_nested_text(spark, sf):
    """Text pieces of the same blocks: all of them, and those of the blocks' inner elements."""
    p = load(spark, sf, "pages").select("page_id", _filled_spark(NESTED).alias("html"))
    kinds = [p.select("page_id", F.lit(k).alias("kind"), F.posexplode(block_text("html", "archive-item", descendants_only=k == "inner")).alias("pos", "value"))
             for k in ("all", "inner")]
    return kinds[0].unionByName(kinds[1])


#: Markup that cutting at the first ">" gets wrong, with {i} the page_id; the last part is left open.
HARD = ('<p title="a > b" class=\'x>y\'>{i}</p><!-- <b> > -->1 < 2 &amp; 3<script>if (a > b) "</p><"</script >one<STYLE type=x>p > q {}</STYLE\n>'
        "<a href='>'>two</a><!doctype x><?php echo 1 ?><p don't>three</p><!--><br/>four<br =\"x>\" />")
OPEN = ("<!-- {i} > five", "<script>five</p> {i}", "<a title=\"five > {i}", "<a five {i}", "</", "")


@query("strip_html_hard", """
SELECT page_id, k::INTEGER AS k, page_id || ' 1 < 2 &amp; 3 one two three four' || CASE WHEN k = 6 THEN ' end' ELSE '' END AS body_text
FROM (SELECT page_id, unnest([1, 2, 3, 4, 5, 6]) AS k FROM pages)""")
def q_strip_html_hard(spark, sf):
    """Visible text of markup with quoted ">", look-alikes in scripts and comments, and open ends."""
    ends = F.array(*[F.concat(_filled_spark(HARD), _filled_spark(x), F.lit("" if x else "end")) for x in OPEN])
    p = load(spark, sf, "pages").withColumn("url", F.lit("")).select("page_id", F.posexplode(ends).alias("k", "html"))
    return p.select("page_id", (F.col("k") + 1).alias("k"), strip_html("html").alias("body_text"))


_TABLE = ascii_table()


def _table_sql() -> str:
    lit = lambda x: "'" + x.replace("'", "''") + "'"
    return f"map([{', '.join(map(lit, _TABLE))}], [{', '.join(map(lit, _TABLE.values()))}])"


#: Characters of the table that go into one document.
_PER_DOC = 12


@query("transliterate", f"""
WITH a AS (SELECT {_table_sql()} AS t, map_keys({_table_sql()}) AS k),
d AS (SELECT doc_id, t, text[1:40] || array_to_string(list_transform(range(0, {_PER_DOC}), lambda j: ' x' || k[1 + (doc_id * {_PER_DOC} + j) % len(k)] || 'y'), '') AS s FROM documents, a)
SELECT doc_id, s AS given, array_to_string(list_transform(string_split(s, ''), lambda ch: coalesce(t[ch], ch)), '') AS folded FROM d""")
def q_transliterate(spark, sf):
    """Documents with every character of the transliteration table put in, folded to ASCII."""
    chars = F.array(*[F.lit(ch) for ch in _TABLE])
    at = F.transform(F.sequence(F.lit(0), F.lit(_PER_DOC - 1)),
                     lambda j: F.concat(F.lit(" x"), F.element_at(chars, (1 + (F.col("doc_id") * _PER_DOC + j) % len(_TABLE)).cast("int")), F.lit("y")))
    d = load(spark, sf, "documents").select("doc_id", F.concat(F.substring("text", 1, 40), F.array_join(at, "")).alias("given"))
    return d.withColumn("folded", fold_to_ascii("given"))
