"""Landed HTML pages -> links, titles, breadcrumbs (no DOM library).

Selection is expressed with regular expressions over the page text, which
runs inside whole-stage codegen; pages are independent, so the work splits
by file/row group with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.text import decode_entities

COMMENT_RE = r"(?s)<!--.*?(?:-->|\z)"
# an anchor's start tag with an href attribute, its value with its quotes: other
# attributes before it are skipped whole, so that neither data-href nor an
# href= inside a quoted value is taken
ANCHOR_RE = (r"""(?i)<a(?:\s+(?!href[\s=])[^\s=>"']+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']+))?)*\s+href\s*=\s*("""
             r""""[^"]*"|'[^']*'|[^\s>"']+)""")
TITLE_RE = r"(?is)<title[^>]*>(.*?)</title>"


def hrefs(html: str | Column) -> Column:
    """The href values of all anchors of an HTML text, in document order: not
    those in comments, with double, single or no quotes, character references
    decoded and outer blanks removed."""
    c = F.col(html) if isinstance(html, str) else html
    raw = F.regexp_extract_all(F.regexp_replace(c, COMMENT_RE, ""), F.lit(ANCHOR_RE), 1)
    return F.transform(raw, lambda v: F.trim(decode_entities(F.regexp_replace(v, r"""^(["'])(.*)\1$""", "$2"))))


def page_links(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """One row per anchor href in document order: keep columns, link_pos (0-based), href."""
    return pages.select(*keep, F.posexplode(hrefs(html)).alias("link_pos", "href"))


def page_title(html: str | Column = "html") -> Column:
    c = F.col(html) if isinstance(html, str) else html
    return F.regexp_extract(c, TITLE_RE, 1)


def base_ref(html: str | Column) -> Column:
    """What the links of a page are relative to, itself relative to the page's
    URL: the first ``<base href>``, or an empty reference."""
    c = F.regexp_replace(F.col(html) if isinstance(html, str) else html, COMMENT_RE, "")
    raw = F.regexp_extract(c, ANCHOR_RE.replace("<a(", "<base("), 1)
    return decode_entities(F.regexp_replace(raw, r"""^(["'])(.*)\1$""", "$2"))
