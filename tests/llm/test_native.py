"""Decontamination, quality ledger, mixing and sharding against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import cases
from vigil.llm import decontam, mixing, quality, sharding


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(cases.invented(), cases.DOC_SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], cases.DOC_SCHEMA)


def _items():
    rows = cases.invented()
    texts = {r[0]: r[1] for r in rows if r[0] is not None}
    return [(1, texts[5]), (2, texts[9]), (10, "two words"), (3, "one"), (4, "never seen words here"), (None, texts[7]),
            (5, None), (6, "  "), (2, texts[9]), (7, texts[11].upper())]


def test_rows_of_one_id_are_cut_one_by_one(spark):
    """Equal rows, rows of one id with different texts, and rows without an id meet their target to within one document."""
    for rows in ([(7, "w " * 10, "s", 0)] * 200, [(7, "w%d " % i * 10, "s", 0) for i in range(200)], [(None, "w%d " % i * 10, "s", 0) for i in range(200)]):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
        out = mixing.mix_report(docs).collect()
        assert len(out) == 200 and {r["target"] for r in out} == {3000.0}
        assert abs(sum(r["taken"] for r in out) - 3000) <= 10 and max(r["taken"] for r in out) <= 20
        assert mixing.mix(docs).count() == sum(r["taken"] for r in out) // 10


def test_contamination_equals_brute_force(spark, docs):
    items = _items()
    got = decontam.contamination(docs, spark.createDataFrame(items, "item_id long, text string"))
    import hashlib
    want = [(d, n, h, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), h > 0 and 20 * h >= n)
            for d, n, h, ids in cases.brute_contamination([r[:2] for r in cases.invented()], items)]
    assert cases.bag(got.drop("k").collect()) == cases.bag(want)
    assert any(w[2] for w in want)


def test_decontaminate_keeps_clean_rows_and_columns(spark, docs):
    items = _items()
    out = decontam.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"))
    bad = {d for d, n, h, _ in cases.brute_contamination([r[:2] for r in cases.invented()], items) if h and 20 * h >= n}
    assert out.columns == docs.columns
    assert sorted(r[0] for r in out.collect() if r[0] is not None) == sorted(
        r[0] for r in cases.invented() if r[0] is not None and r[0] not in bad)


def test_contamination_empty_sides(spark, docs, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(empty, none).count() == 0
    assert decontam.contamination(docs, none).where("contaminated or n_hit > 0").count() == 0


def test_proximity(spark):
    d = spark.createDataFrame([(1, "x red x x green x blue"), (2, "red " + "x " * 30 + "green blue"), (3, None)], "doc_id long, text string")
    i = spark.createDataFrame([(7, "blue green red")], "item_id long, text string")
    got = decontam.proximity_matches(d, i, slop=10).collect()
    assert [tuple(r) for r in got] == [(1, 7, 1)]


def test_quality_equals_brute_force(docs, empty):
    got = {}
    for r in quality.quality_report(docs).collect():
        got.setdefault(r["doc_id"], []).append((r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]))
        fails = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == fails and not (r["kept"] and fails)
    want = {}
    for row in cases.invented():
        want.setdefault(row[0], []).append(cases.brute_quality(row[1]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert quality.ledger(empty).count() == 0


def test_ablation_counts(docs):
    rows = quality.ledger(docs)
    bits = [r["fail_bits"] for r in rows.collect()]
    for r in quality.ablation(rows, "3").collect():
        b = quality.BIT[r["rule"]]
        assert r["n_failed"] == sum(x & b > 0 for x in bits)
        assert r["n_only"] == sum(x == b for x in bits)
        assert r["n_kept_without"] == sum(x & ~b == 0 for x in bits)


def test_mix_meets_targets(docs, empty):
    rows = mixing.mix_report(docs).collect()
    assert len(rows) == len(cases.invented())
    size = {}
    by_id = {}
    for r in cases.invented():
        by_id.setdefault(r[0], []).append(r[3])
    for r in rows:
        assert r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"] + 1e-6
        size.setdefault((r["source_size"], r["target"]), []).append(r)
    for (source_size, target), group in size.items():
        assert abs(sum(r["taken"] for r in group) - target) <= max(r["size"] for r in group)
    total = sum(k[0] for k in size)
    assert sum(k[1] for k in size) == pytest.approx(1.5 * total)
    assert mixing.mix_report(empty).count() == 0
    assert cases.bag(rows) == cases.bag(mixing.mix_report(docs.repartition(5)).collect())


def test_mix_repeats_whole_rows(docs):
    taken = {}
    for r in mixing.mix_report(docs).where("size > 0").collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["taken"] // r["size"]
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r["count"] for r in out.where(F.trim(F.regexp_replace("text", r"\s+", " ")) != "").groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in taken.items() if v}


def test_targets_reshare_excess(spark):
    s = spark.createDataFrame([("a", 10), ("b", 1000), (None, 100)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(s).collect()}
    assert got["a"] == 20.0  # full: 3 of 6 shares of 1665 is far above
    assert got[None] == 200.0
    assert got["b"] == pytest.approx(1.5 * 1110 - 220)


def test_shards_are_exact_and_repeatable(docs, empty):
    out = sharding.assign_shards(docs, ["doc_id", "text"], shards=7, partition_rows=10)
    rows = out.collect()
    assert out.columns == [*docs.columns, "shard", "slot"] and len(rows) == len(cases.invented())
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(v) for v in slots.values()]
    assert len(slots) == 7 and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    again = sharding.assign_shards(docs.repartition(3), ["doc_id", "text"], shards=7, partition_rows=10).collect()
    assert cases.bag(rows) == cases.bag(again)
    assert sharding.assign_shards(empty, ["doc_id"], shards=7).count() == 0


def test_hypergeometric_has_the_right_mean_and_spread():
    rng = np.random.default_rng(1)
    x = np.array([sharding.hypergeometric(rng, 30, 70, 20) for _ in range(4000)])
    assert abs(x.mean() - 6) < 0.15 and abs(x.var() - 20 * .3 * .7 * 80 / 99) < 0.3
    assert x.min() >= 0 and x.max() <= 20
    m = sharding.communication_matrix([5, 0, 17, 9], 4, 3)
    assert m.sum(axis=1).tolist() == [5, 0, 17, 9] and m.sum(axis=0).tolist() == [8, 8, 8, 7]
    big = sharding.hypergeometric(rng, 10 ** 12, 23 * 10 ** 12, 10 ** 6)
    assert abs(big - 10 ** 6 / 24) < 2000


def test_shard_report_columns(docs):
    r = sharding.shard_report(docs)
    assert r.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    one = r.where("doc_id is null").orderBy("size").first()
    assert one["size"] == 8 and one["text_crc32"] == 0 and one["grown_shard"] is None
