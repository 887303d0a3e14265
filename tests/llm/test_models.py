"""Language, toxicity and page extraction: held-out accuracy and hard cases."""

import random

import numpy as np
import pytest

from tests.conftest import SF_CHECK
from tests.llm import cases
from vigil.llm import html_extract, language, toxicity
from vigil.llm.common import table
from vigil.llm.html_blocks import blocks


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF_CHECK, "documents")


def test_language_held_out_accuracy(docs):
    r = language.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    n, good = r.count(), r.where("lang = lang_pred").count()
    assert n > 200 and good >= 0.98 * n
    assert r.where("score < 0 or score > 1").count() == 0


def test_language_hard_rows(spark, docs):
    rows = cases.invented() + [(9001, "Ωμέγα", *([None] * 9))]
    out = language.identify(spark.createDataFrame(rows, cases.DOC_SCHEMA), language.learn(docs)).collect()
    got = {r["doc_id"]: r["lang_pred"] for r in out}
    assert len(out) == len(rows)
    for r in rows:
        if r[0] is not None:
            assert (got[r[0]] == "und") == (not any(ch.isalpha() for ch in r[1] or ""))
    none = spark.createDataFrame([], cases.DOC_SCHEMA)
    assert language.learn(none) == [] and language.language_report(none).count() == 0
    assert {r["lang_pred"] for r in language.identify(spark.createDataFrame(rows, cases.DOC_SCHEMA), []).collect()} == {"und"}


def test_automaton_spells_exactly_the_substrings():
    rng = random.Random(0)
    text = [rng.randrange(3) for _ in range(60)]
    step = language.suffix_automaton(text)
    inside = {tuple(text[i:j]) for i in range(60) for j in range(i + 1, min(60, i + 5) + 1)}
    for a in range(3):
        for b in range(3):
            for c in range(3):
                for d in range(3):
                    s, ok = 0, True
                    for x in (a, b, c, d):
                        s = step[s].get(x)
                        if s is None:
                            ok = False
                            break
                    assert ok == ((a, b, c, d) in inside)


def test_phrases_equal_a_plain_parse(docs):
    models = language.learn(docs)
    parser = language.Parser(models)
    texts = [r["text"] for r in docs.limit(12).collect()] + ["Ωμέγα ωμ", "x"]
    codes = [language.normalise(t) for t in texts]
    fast = parser.phrases(codes)
    import zlib
    for k, (_, _, states, packed) in enumerate(models):
        step = [{} for _ in range(states)]
        for s, c, t in np.frombuffer(zlib.decompress(packed), np.int32).reshape(-1, 3).tolist():
            step[s][c] = t
        for i, c in enumerate(codes):
            n = 0
            for a in range(0, len(c), language.BLOCK):
                s = 0
                for x in c[a:a + language.BLOCK].tolist():
                    if x in step[s]:
                        s = step[s][x]
                    else:
                        n += 1
                        s = step[0].get(x, 0)
                n += s > 0
            assert fast[i, k] == n


def test_toxicity_learns_and_is_sparse(spark, docs):
    big = table(spark, SF_CHECK.replace("0.01", "0.1"), "documents")
    labels = table(spark, SF_CHECK.replace("0.01", "0.1"), "labels")
    model = toxicity.fit(big, labels)
    assert 0 < len(model["weight"]) < 20_000
    s = toxicity.score(big, model).join(labels, "doc_id").where(toxicity.held_out(toxicity.F.col("doc_id"))).toPandas()
    caught = (s.score >= toxicity.THRESHOLD)
    assert caught[s.toxic == 1].mean() > 0.75 and caught[s.toxic == 0].mean() < 0.02


def test_toxicity_hard_rows(spark, docs):
    rows = cases.invented()
    df = spark.createDataFrame(rows, cases.DOC_SCHEMA)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    out = toxicity.toxicity_report(df, labels).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in out)
    none = toxicity.toxicity_report(df, labels.where("false"))
    assert {r["score"] for r in none.collect()} == {0.5}
    assert toxicity.toxicity_report(df.where("false"), labels).count() == 0
    assert toxicity.drop_toxic(df, labels).columns == df.columns


def test_blocks_by_hand():
    page = ("<html><head><title>T &amp; t</title><style>p{}</style><script>var t='</p>';</script></head><body><!-- <p>no</p> -->"
            "<nav class='Menu top'><a href=\"/x>y\">one</a> two</nav><article id=main><p>A&nbsp;<b>b</b>\n c<br>d<p>e &amp;amp; &#233;</article><p>cut")
    assert [b[0] for b in blocks(page)] == ["T & t", "one two", "A b c d", "e &amp; é", "cut"]
    paths = [b[1] for b in blocks(page)]
    assert paths[1][-1] == ("nav", ".menu", ".top") and paths[3] == (("html",), ("body",), ("article", ".main"), ("p",))
    assert blocks(None) == blocks("") == blocks("<p></p><!-- x") == []


def _plain(page):
    return "\n\n".join(t for t, p, _ in blocks(page) if html_extract.seed_label(p))


def test_extraction_on_pages_not_fitted_on(spark):
    pages = table(spark, SF_CHECK, "pages")
    weights = html_extract.fit(table(spark, SF_CHECK.replace("0.01", "0.001"), "pages"), 120)
    wrong = [r for r, h in zip(html_extract.extract(pages, weights).orderBy("page_id").collect(), pages.orderBy("page_id").collect())
             if r["text"] != _plain(h["html"])]
    assert len(wrong) <= 0.02 * pages.count()


def test_extraction_of_other_markup(spark):
    """Pages whose article is a plain div, with side blocks that the tables do not have."""
    pages = table(spark, SF_CHECK, "pages").limit(150).collect()
    net = html_extract.BiLstm()
    rng = random.Random(1)
    some = [html_extract.disguise(blocks(p["html"]), rng) for p in pages]
    net.fit([(html_extract.vectors(d[:48]), np.array([x[3] for x in d[:48]], np.float32)) for d in some[:100] for _ in (0, 1)])
    test = some[100:]
    labels = net.label([[x[:3] for x in d] for d in test])
    right = sum(int((np.array([x[3] for x in d], bool) == lab).sum()) for d, lab in zip(test, labels))
    assert right >= 0.95 * sum(map(len, test))


def test_extraction_hard_rows(spark):
    rows = [(1, "http://a", None), (2, None, ""), (None, "u", "<p>just text"), (1, "http://a", None), (4, "u", "x" * 200_000)]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    out = html_extract.extraction_report(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"] and out.count() == 5
    assert {r["text"] for r in out.where("page_id in (1, 2)").collect()} == {""}
    assert html_extract.extraction_report(df.where("false")).count() == 0


def test_gradient_by_differences():
    rng = np.random.default_rng(0)
    net = html_extract.BiLstm(seed=1)
    x = rng.standard_normal((4, 3, html_extract.DIM)).astype(np.float32)
    lengths = np.array([4, 3, 1])
    mask = (np.arange(4)[:, None] < lengths).astype(np.float32)
    x *= mask[:, :, None]
    y = (rng.random((4, 3)) < 0.5).astype(np.float32)

    def loss():
        z = net.logits(x, lengths)
        return float((np.logaddexp(0, z) - y * z)[mask > 0].mean())

    grad = net.gradients(x, lengths, y, mask)
    for k in ("xf", "hf", "xb", "hb", "cf", "o"):
        at = np.unravel_index(np.abs(grad[k]).argmax(), grad[k].shape)
        old = net.w[k][at]
        net.w[k][at] = old + 1e-2
        up = loss()
        net.w[k][at] = old - 1e-2
        down = loss()
        net.w[k][at] = old
        assert (up - down) / 2e-2 == pytest.approx(float(grad[k][at]), rel=0.08, abs=2e-4)
