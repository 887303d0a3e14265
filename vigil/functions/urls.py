"""URL references: splitting, normalising and resolving against a base.

A URL is held in four strings that still have their delimiters, so that
concatenating them gives it back and an absent part differs from an empty one:
``scheme`` ("https:"), ``authority`` ("//host"), ``path``, ``query`` ("?x"). Fragments are
dropped: they never name another page. Everything is native and linear in the URL's
length; path segments are folded once, and only where a dot segment occurs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.functions.arrays import let, named

#: scheme, authority, path, query of a reference (RFC 3986, appendix B), each with its delimiter.
REFERENCE_RE = r"(?s)\A([a-zA-Z][a-zA-Z0-9+.\-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?"
PARTS = ("scheme", "authority", "path", "query")
_DOT_SEGMENT = r"(?:\A|/)\.\.?(?:/|\z)"
_HTTP = ("http:", "https:")
#: White space and controls that surround a reference without belonging to it.
_OUTER = "".join(map(chr, range(0x21)))


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_reference(ref: str | Column) -> Column:
    """As a browser takes a reference from markup: without outer blanks and controls, and
    without line breaks and tabs inside."""
    return F.btrim(F.translate(_c(ref), "\t\n\r", ""), F.lit(_OUTER))


def split_url(url: str | Column) -> Column:
    """struct(scheme, authority, path, query), as written; null for null."""
    u = _c(url)
    return F.struct(*[F.regexp_extract(u, REFERENCE_RE, i + 1).alias(p) for i, p in enumerate(PARTS)])


def remove_dot_segments(path: str | Column) -> Column:
    """``path`` without "." and ".." segments: a fold over its segments that keeps the ones that
    count. ".." at the root stays there, and a final dot segment leaves a slash."""
    none = F.array().cast("array<string>")

    def fold(p: Column) -> Column:
        kept = F.aggregate(F.split(p, "/", -1), none, lambda acc, s: F.when(s == ".", acc)
                           .when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1))))
                           .otherwise(F.concat(acc, F.array(s))))
        tail = F.when(p.rlike(r"(?:\A|/)\.\.?\z"), "/").otherwise("")
        return F.when(p.rlike(_DOT_SEGMENT), F.concat(F.array_join(kept, "/"), tail)).otherwise(p)

    return let(_c(path), fold)


def _host(scheme: Column, authority: Column) -> Column:
    """Lower-case host, without an empty or the scheme's own port; user data stays as it is."""
    user = F.regexp_extract(authority, r"\A//(.*@)?", 1)
    port = F.when(scheme == "http:", ":80").when(scheme == "https:", ":443").otherwise(":")

    def spelt(v: Column) -> Column:
        host, p = v["host"], v["port"]
        bare = F.when(host.endswith(p), F.substring(host, F.lit(1), F.length(host) - F.length(p))).otherwise(F.regexp_replace(host, r":\z", ""))
        return F.concat(F.lit("//"), v["user"], bare)

    host = F.lower(F.substring(authority, F.length(user) + 3, F.length(authority)))
    return F.when(authority == "", "").otherwise(let(named(host=host, port=port, user=user), spelt))


def _spelt(scheme: Column, authority: Column, path: Column, query: Column) -> Column:
    """The parts as one string: no default port, no dot segments, "/" for an empty path."""
    parts = named(scheme=scheme, authority=authority, path=path, query=query)

    def joined(v: Column) -> Column:
        whole = F.when(v["path"].startswith("/"), remove_dot_segments(v["path"])) \
            .when(v["scheme"].isin(*_HTTP) & (v["authority"] != "") & (v["path"] == ""), "/").otherwise(v["path"])
        return F.concat(v["scheme"], _host(v["scheme"], v["authority"]), whole, v["query"])

    return let(parts, joined)


def normalize_url(url: str | Column) -> Column:
    """``url`` in one spelling: scheme and host in lower case, no default port, no dot
    segments, "/" for an empty path, no fragment. Null for null."""
    return let(split_url(clean_reference(url)), lambda p: _spelt(F.lower(p["scheme"]), p["authority"], p["path"], p["query"]))


def resolve(ref: str | Column, base: str | Column) -> Column:
    """The URL that a reference names on a page with URL ``base``, in one spelling (RFC 3986,
    5.2; see ``normalize_url``). A reference that repeats the base's http scheme but names no
    host is relative, as browsers take it. Null if either is null."""

    def found(v: Column) -> Column:
        r, b = v["r"], v["b"]
        scheme, of_base = F.lower(r["scheme"]), F.lower(b["scheme"])
        relative = (scheme == "") | ((scheme == of_base) & scheme.isin(*_HTTP) & (r["authority"] == ""))
        own = ~relative | (r["authority"] != "")  # nothing but the scheme comes from the base
        above = F.when((b["authority"] != "") & (b["path"] == ""), "/").otherwise(F.regexp_extract(b["path"], r"(?s)\A(.*/)?", 1))
        path = F.when(own | r["path"].startswith("/"), r["path"]).when(r["path"] == "", b["path"]).otherwise(F.concat(above, r["path"]))
        query = F.when(own | (r["path"] != "") | (r["query"] != ""), r["query"]).otherwise(b["query"])
        return _spelt(F.when(relative, of_base).otherwise(scheme), F.when(own, r["authority"]).otherwise(b["authority"]), path, query)

    return let(named(r=split_url(clean_reference(ref)), b=split_url(clean_reference(base))), found)
