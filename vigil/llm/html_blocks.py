"""Leaf blocks of an HTML page: the text between block-level tags, with its path."""

from __future__ import annotations

import html
import re

#: Elements whose start or end separates blocks of text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary "
    "table tbody td tfoot th thead title tr ul".split())
#: Elements without content.
EMPTY_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
RAW = "script|style|template|textarea|iframe|select"
#: An element that a start tag of the same kind closes, as a browser would.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}

# attributes of a tag: quotes count after "=" only; what is open reaches to the end. Every part
# takes what it has read for good (possessive), so a page of any kind is read once.
_ATTRS = r"""(?:[^>=]++|=[ \t\n\r\f]*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))?+)*+"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + RAW + r")\b" + _ATTRS + r"(?:>|\Z).*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>" + _ATTRS + r")(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)", re.S | re.I)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME = re.compile(r"[a-z]+")


def element(tag: str, attrs: str) -> tuple[str, ...]:
    """The tag and the words of its class, id and role."""
    names = []
    for m in _ATTR.finditer(attrs):
        names += _NAME.findall((m[2] or m[3] or m[4] or "").lower())
    return (tag, *("." + n for n in names))


def blocks(page: str | None) -> list[tuple[str, tuple[tuple[str, ...], ...], float]]:
    """(text, path, share of characters in links) of every leaf block, in page order.

    Character references are decoded once, white space becomes one space, blank
    blocks are left out. Null and broken pages are fine: what is open at the end
    counts as closed there. Drawings (svg) have no text; one that is not closed
    ends where a block of the page begins or ends.
    """
    out: list = []
    path: list[tuple[str, ...]] = []
    parts: list[str] = []
    linked = in_link = drawn = 0
    inner: list[str] | None = None  # open blocks of a foreignObject

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((text, tuple(path), min(1.0, linked / len(text))))
            parts.clear()
            linked = 0

    for m in _TOKEN.finditer(page or ""):
        text = m["text"]
        if drawn and m["tag"] is None:
            continue
        if text is not None:
            parts.append(text)
            if in_link:
                linked += len(text)
            continue
        if m["tag"] is None:  # comment, raw element or declaration
            continue
        tag = m["tag"].lower()
        alone = m["attrs"].endswith("/")
        if tag == "svg":
            drawn = max(0, drawn - 1) if m["end"] else drawn + (not alone)
            inner = inner if drawn else None
            continue
        if drawn:
            if tag == "foreignobject":
                inner = None if m["end"] or alone else []
                continue
            if tag not in BLOCK_TAGS or tag == "title":
                continue
            if inner is not None and not m["end"]:
                if tag not in EMPTY_TAGS and not alone:
                    inner.append(tag)
                continue
            if inner and tag in inner:
                del inner[len(inner) - 1 - inner[::-1].index(tag):]
                continue
            drawn, inner = 0, None
        if tag == "a":
            in_link = 0 if m["end"] else 1
        if tag == "br":
            parts.append(" ")
        if tag not in BLOCK_TAGS:
            continue
        flush()
        if m["end"]:
            for i in range(len(path) - 1, -1, -1):
                if path[i][0] == tag:
                    del path[i:]
                    break
        else:
            if tag in CLOSES and path and path[-1][0] in CLOSES[tag]:
                path.pop()
            elif path and path[-1][0] == "p":
                path.pop()
            if tag not in EMPTY_TAGS and not alone:
                path.append(element(tag, m["attrs"]))
    flush()
    return out
