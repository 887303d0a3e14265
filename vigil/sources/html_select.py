"""Nesting-aware selection inside HTML blocks (``tag.class a::attr(href)``,
``tag.class ::text``, ``a[attr=value]``), for pages whose blocks nest or
whose selection needs attribute filters.

Regular expressions (``sources.pages``) cover flat blocks in generated code.
This is the slow path: a small per-page helper on the standard-library HTML
parser, run batch-wise in ``mapInPandas``, so Spark still partitions the pages
and every task parses only its own pages.
"""

from __future__ import annotations

from html.parser import HTMLParser

import sys

from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from vigil.session import ship_by_value


class _BlockSelector(HTMLParser):
    def __init__(self, tag: str, css_class: str | None, want: str, link_attrs: dict | None):
        super().__init__(convert_charrefs=True)
        self.tag, self.css_class, self.want = tag, css_class, want
        self.link_attrs = link_attrs or {}
        self.depth = 0          # nesting depth of ``tag`` inside the current block
        self.out: list[str] = []

    def _opens_block(self, attrs) -> bool:
        if self.css_class is None:
            return True
        classes = (dict(attrs).get("class") or "").split()
        return self.css_class in classes

    def handle_starttag(self, tag, attrs):
        if tag == self.tag:
            if self.depth:
                self.depth += 1
            elif self._opens_block(attrs):
                self.depth = 1
        if self.depth and self.want == "href" and tag == "a":
            a = dict(attrs)
            if "href" in a and all(a.get(k) == v for k, v in self.link_attrs.items()):
                self.out.append(a["href"] or "")

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag == self.tag and self.depth:
            self.depth -= 1

    def handle_endtag(self, tag):
        if tag == self.tag and self.depth:
            self.depth -= 1

    def handle_data(self, data):
        if self.depth and self.want == "text":
            self.out.append(data)


def select_values(html: str | None, tag: str, css_class: str | None, want: str,
                  link_attrs: dict | None = None) -> list[str]:
    """Hrefs (``want='href'``) or text nodes (``want='text'``) inside the
    blocks, in document order."""
    if not html:
        return []
    p = _BlockSelector(tag, css_class, want, link_attrs)
    p.feed(html)
    p.close()
    return p.out


def select_in_blocks(pages: DataFrame, tag: str, css_class: str | None = None, want: str = "href",
                     link_attrs: dict | None = None, html: str = "html",
                     keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """One row per selected value: keep columns, ``pos`` (0-based within the
    page) and ``value``."""
    import pandas as pd

    fields = [pages.schema[k] for k in keep]
    schema = StructType(fields + [StructField("pos", IntegerType(), False),
                                  StructField("value", StringType(), True)])
    cols = list(keep)

    def run(batches):
        for pdf in batches:
            rows = {c: [] for c in cols}
            pos, vals = [], []
            for rec in pdf.itertuples(index=False):
                got = select_values(getattr(rec, html), tag, css_class, want, link_attrs)
                for i, v in enumerate(got):
                    for c in cols:
                        rows[c].append(getattr(rec, c))
                    pos.append(i)
                    vals.append(v)
            out = pd.DataFrame(rows)
            out["pos"] = pd.Series(pos, dtype="int32")
            out["value"] = pd.Series(vals, dtype=object)
            yield out

    return pages.select(*cols, html).mapInPandas(run, schema)


# the mapInPandas helper runs in Python workers: ship this module's code by value
ship_by_value(sys.modules[__name__])
