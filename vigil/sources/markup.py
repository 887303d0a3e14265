"""Markup without a DOM library: one linear lexer pattern, and selection by nesting depth.

A page is split once into its tags and the text between them. Where the blocks of a
selector begin and end follows from running sums over the tag array: opens minus closes
of the block's tag give the depth, and a block lasts from its opening tag until the depth
falls below it, so blocks may nest others of the same tag. All of it is in-record and
JVM-side: no shuffle, no Python.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.functions.arrays import let, named, scan
from vigil.functions.text import MARKUP_RE, decode_entities

#: Elements without content.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of a start tag, references decoded; NULL if it has none. Other
    attributes are skipped whole, so nothing inside a quoted value is taken for it."""
    other = rf"""(?:[\s/]+(?!{name}[\s=/>])[^\s=>/]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']+))?)*+"""
    raw = F.regexp_extract(tag, rf"""(?is)\A<[a-z][^\s/>]*+{other}[\s/]+{name}\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", 1)
    return F.when(raw != "", decode_entities(F.regexp_replace(raw, r"""(?s)\A(["'])(.*)\1\z""", "$2")))


def _name(tag: Column) -> Column:
    return F.lower(F.regexp_extract(tag, r"\A</?([a-zA-Z][^\s/>]*)", 1))


def _self_closed(tag: Column) -> Column:
    """Ends in "/>", and the slash is not the end of an unquoted value."""
    return tag.endswith("/>") & ~tag.rlike(r"""=\s*+[^\s"'>][^\s>]*/>\z""")


def _events(tags: Column, tag: str, css_class: str | None) -> Column:
    """Per tag: what it adds to the depth of all elements (d) and of ``tag`` (t), and whether it opens
    a selected block. Comments, scripts and styles add nothing; a self-closed tag is empty."""

    def event(text: Column) -> Column:
        hit = F.lit(True) if css_class is None else F.array_contains(F.split(F.coalesce(attribute(text, "class"), F.lit("")), r"\s+"), css_class)

        def of(v: Column) -> Column:
            d = F.when((v["name"] == "") | v["name"].isin(*VOID, "script", "style") | _self_closed(text), 0).when(v["close"], -1).otherwise(1)
            own = v["name"] == tag
            return named(d=d, t=F.when(own, d).otherwise(0), hit=own & ~v["close"] & hit)

        return let(named(name=_name(text), close=text.startswith("</")), of)

    return F.transform(tags, event)


def _inside(tags: Column, tag: str, css_class: str | None) -> Column:
    """Per tag the state after it: depth of ``tag``, depth at which the current block opened (0: in none),
    level of elements inside the block, and whether the tag itself stands inside a block."""

    def step(s: Column, e: Column) -> Column:
        depth = F.greatest(s["depth"] + e["t"], F.lit(0))
        opens = (s["block"] == 0) & e["hit"] & (e["t"] > 0)
        closes = (s["block"] > 0) & (depth < s["block"])
        block = F.when(opens, depth).when(closes, 0).otherwise(s["block"])
        level = F.when((s["block"] == 0) | closes, 0).otherwise(F.greatest(s["level"] + e["d"], F.lit(0)))
        return named(depth=depth, block=block, level=level, was=s["block"] > 0)

    zero = named(depth=F.lit(0), block=F.lit(0), level=F.lit(0), was=F.lit(False))
    return scan(_events(tags, tag, css_class), zero, step)


def _lexed(html: str | Column) -> Column:
    c = _c(html)
    return named(tags=F.regexp_extract_all(c, F.lit(MARKUP_RE), 0), texts=F.split(c, MARKUP_RE, -1))


def block_links(html: str | Column, css_class: str | None, tag: str = "div", link_attrs: dict[str, str] | None = None) -> Column:
    """hrefs of the anchors inside ``<tag class="... css_class ...">`` blocks (any ``tag`` without a class),
    in document order, each once however many blocks hold it; ``link_attrs`` are attributes
    that the anchor must have. A block that is never closed lasts to the end."""

    def links(v: Column) -> Column:
        anchors = F.filter(F.arrays_zip(v["tags"].alias("tag"), _inside(v["tags"], tag, css_class).alias("at")),
                           lambda x: x["at"]["was"] & (_name(x["tag"]) == "a") & ~x["tag"].startswith("</"))
        if link_attrs:
            anchors = F.filter(anchors, lambda x: reduce(and_, [F.coalesce(attribute(x["tag"], k) == v, F.lit(False)) for k, v in link_attrs.items()]))
        return F.filter(F.transform(anchors, lambda x: F.trim(attribute(x["tag"], "href"))), lambda h: h.isNotNull())

    return let(_lexed(html), links)


def block_text(html: str | Column, css_class: str | None, tag: str = "div", descendants_only: bool = False) -> Column:
    """The text pieces inside such blocks, references decoded, in document order. With
    ``descendants_only`` the blocks' own direct text is left out."""

    def pieces(v: Column) -> Column:
        at = F.arrays_zip(F.slice(v["texts"], F.lit(2), F.size(v["tags"])).alias("text"), _inside(v["tags"], tag, css_class).alias("at"))
        kept = F.filter(at, lambda x: (x["at"]["block"] > 0) & (x["text"] != "") & ((x["at"]["level"] > 0) if descendants_only else F.lit(True)))
        return F.transform(kept, lambda x: decode_entities(x["text"]))

    return let(_lexed(html), pieces)
