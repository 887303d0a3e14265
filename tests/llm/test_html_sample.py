"""The pages that the page model is fitted on."""

import io
import re

import numpy as np

from tests.conftest import SF_SMOKE
from vigil.llm import html_extract
from vigil.llm.common import table


def test_plain_pages_teach_nothing(spark, monkeypatch):
    monkeypatch.setattr(html_extract, "EPOCHS", 1)
    rows = [(i, r["url"], r["html"]) for i, r in enumerate(table(spark, SF_SMOKE, "pages").orderBy("page_id").limit(20).collect())]
    assert all("<article" in r[2] for r in rows)
    plain = [(100 + i, "http://plain/%d" % i, re.sub(r"<(/?)(?:article|main)\b[^>]*>", r"<\1div>", rows[i % 20][2])) for i in range(60)]
    schema = "page_id long, url string, html string"
    weights = lambda some: np.load(io.BytesIO(html_extract.fit(spark.createDataFrame(some, schema), 30)))
    alone, mixed = weights(rows), weights(rows + plain)
    assert all((alone[k] == mixed[k]).all() for k in alone.files)
