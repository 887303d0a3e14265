"""Toxic and clean rows planted into the pipeline's first stage."""

from collections import Counter

import corpus_pipeline as P
from tests.conftest import SF_CHECK
from tests.llm import cases
from vigil.llm.common import table


def test_planted_toxic_rows_go_and_clean_rows_stay(spark):
    docs = table(spark, SF_CHECK, "documents")
    known = docs.join(table(spark, SF_CHECK, "labels").select("doc_id", "toxic"), "doc_id").where("toxic is not null").collect()
    held = {True: Counter(), False: Counter()}
    for r in known:
        held[r["toxic"] == 1].update(set(cases.term_words(r["text"])))
    toxic = sorted((w for w in held[True] if not held[False][w]), key=lambda w: (-held[True][w], w))[:8]
    assert len(toxic) == 8 and held[True][toxic[-1]] > 5
    clean = [r for r in known if r["toxic"] == 0 and 30 <= len(cases.term_words(r["text"])) <= 300][:40]
    rows = [(10 ** 9 + i, r["text"], r["lang"], r["source"], r["n_chars"]) for i, r in enumerate(clean)]
    rows += [(2 * 10 ** 9 + i, r["text"] + " " + " ".join(toxic), r["lang"], r["source"], r["n_chars"]) for i, r in enumerate(clean)]
    planted = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = {r["doc_id"] for r in P.drop_toxic(spark, docs.select(planted.columns).unionByName(planted), SF_CHECK).where("doc_id >= 1000000000").collect()}
    assert len(left & {r[0] for r in rows[:40]}) == 40
    assert not left & {r[0] for r in rows[40:]}
