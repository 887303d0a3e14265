"""The pipeline end to end: stage contracts and a check of every decision."""

import corpus_pipeline as P
from tests.conftest import SF_SMOKE
from tests.llm import cases
from tests.llm.test_near_duplicates import brute
from vigil.llm import toxicity
from vigil.llm.common import store, table


def test_stages_on_the_smallest_table(spark):
    docs = table(spark, SF_SMOKE, "documents")
    bench = [tuple(r) for r in table(spark, SF_SMOKE, "benchmark").select("item_id", "text").collect()]
    kept = docs
    for name, stage in P.STAGES[:3]:
        before = kept.collect()
        out = store(stage(spark, kept, SF_SMOKE), "t-" + name)
        assert out.columns == docs.columns
        left = {r["doc_id"] for r in out.collect()}
        rows = [(r["doc_id"], r["text"]) for r in before]
        if name == "ngram_jaccard_join":
            least = {}
            for (d, _), g in zip(rows, groups := brute(rows)):
                least[g] = min(d, least.get(g, d))
            assert left == set(least.values()) and len(left) < len(groups)
        if name == "benchmark_decontamination":
            assert left == {d for d, n, h, _ in cases.brute_contamination(rows, bench) if not (h and 20 * h >= n)}
        kept = out
    mixed = store(P.STAGES[3][1](spark, kept, SF_SMOKE), "t-mix")
    words = lambda df: sum(len(cases.space_words(r["text"])) for r in df.collect())
    assert abs(words(mixed) / words(kept) - 1.5) < 0.1
    final = P.STAGES[4][1](spark, mixed, SF_SMOKE)
    sizes = [r["count"] for r in final.groupBy("shard").count().collect()]
    assert final.columns == [*docs.columns, "shard", "slot"] and sum(sizes) == mixed.count() and max(sizes) - min(sizes) <= 1


def test_stages_take_hard_and_empty_tables(spark):
    df = spark.createDataFrame(cases.invented(), cases.DOC_SCHEMA)
    for docs in (df, df.where("false")):
        for name, stage in P.STAGES:
            docs = store(stage(spark, docs, SF_SMOKE), "h-" + name)
        assert (docs.count() == 0) == (df.where("false").count() == docs.count())


def test_planted_toxic_words_go(spark):
    assert toxicity.THRESHOLD == 0.3 and [n for n, _ in P.STAGES][0] == "toxicity"
