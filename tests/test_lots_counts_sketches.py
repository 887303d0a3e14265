"""Batch ingestion without operator state, observed counts, mergeable distinct counts."""

import json

import pytest
from pyspark.sql import functions as F

from vigil.operators import quality
from vigil.operators.activity import split_activity, tag_activity
from vigil.operators.reconcile import Counts, unaccounted
from vigil.streaming import incremental


def test_lots_keep_each_content_once(spark, tmp_path):
    src, store = str(tmp_path / "in"), str(tmp_path / "store")
    schema = "id long, text string"
    land = lambda name, rows: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{src}/{name}")
    land("a", [(1, "x"), (2, "y"), (3, "x"), (4, None)])
    assert incremental.ingest_lot(spark, src, store, schema, "text") == 3
    assert incremental.ingest_lot(spark, src, store, schema, "text") == 0
    land("b", [(5, "y"), (6, "z")])
    assert incremental.ingest_lot(spark, src, store, schema, "text") == 1
    kept = incremental.seen(spark, store, 0).collect()
    assert sorted((r["id"], r["text"]) for r in kept if r["text"]) == [(1, "x"), (2, "y"), (6, "z")]
    assert all(r["content_md5"][:2] == r["prefix"] for r in kept if r["content_md5"])


def test_a_lot_that_breaks_off_is_read_again(spark, tmp_path, monkeypatch):
    src, store = str(tmp_path / "in"), str(tmp_path / "store")
    spark.createDataFrame([(1, "x")], "id long, text string").write.parquet(src + "/a")

    def broken(*_):
        raise RuntimeError("lost before the commit")

    with monkeypatch.context() as m:
        m.setattr(incremental, "commit_run", broken)
        with pytest.raises(RuntimeError):
            incremental.ingest_lot(spark, src, store, "id long, text string", "text")
    assert incremental.seen(spark, store, 0) is None
    assert incremental.ingest_lot(spark, src, store, "id long, text string", "text") == 1
    assert incremental.seen(spark, store, 0).count() == 1


def member(mp, acts):
    return (json.dumps({"deputado": {"depId": mp, "depNomeParlamentar": mp}, "AtividadeDeputadoList": {"pt_gov_ar_wsar_objectos_ActividadeOut": acts}}),)


def test_every_row_is_accounted_for(spark, tmp_path):
    hearing = {"actId": "1", "actTpdesc": "t", "actNr": "1", "accDtaud": "d"}
    rows = [member("m1", {"actP": {"x": [{"actId": "1"}, {"actId": "2"}]}, "cms": {"a": 1}, "intev": None, "audicoes": {"x": [hearing, {**hearing, "actAs": "what"}]}}),
            member("m2", {"nonsense": {"a": "b"}, "eventos": "text"}), ('{"deputado": {}}',), ("broken",)]
    counts = Counts()
    tag_activity(spark.createDataFrame(rows, "record string"), counts=counts).write.parquet(str(tmp_path / "t"))
    good, bad = split_activity(spark.read.parquet(str(tmp_path / "t")))
    assert counts.of("members") == {"members": 4} and counts.of("entries")["unreadable"] == 2
    assert counts.of("entries")["skipped"] == 1 and counts.of("entries")["null"] == 1
    assert unaccounted(counts, "entries", "entries", [("entries", "skipped"), ("entries", "null"), ("kept", "entries")]) == 0
    assert unaccounted(counts, "groups", "records", [("records", "activities"), ("records", "quarantined")]) == 0
    assert (good.count(), bad.count()) == (counts.of("records")["activities"], counts.of("records")["quarantined"])
    assert counts.of("records")["no_description_adt"] == 1
    assert {(r["step"], r["metric"]) for r in counts.frame(spark).collect()} >= {("members", "members"), ("records", "no_description_adc")}


def test_sketches_merge_to_the_counts_of_coarser_keys(spark):
    df = spark.range(60_000).select((F.col("id") % 7).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("b"), F.when(F.col("id") % 11 > 0, F.col("id") % 9_000).alias("v"))
    halves = (F.col("v") % 2 == 0, F.coalesce(F.col("v") % 2 != 0, F.lit(True)))
    table = quality.sketch_table(df.where(halves[0]), ["a", "b"], "v").unionByName(quality.sketch_table(df.where(halves[1]), ["a", "b"], "v"))
    for keys in (["a"], ["b"], ["a", "b"]):
        exact = {tuple(r[k] for k in keys): r["n"] for r in df.groupBy(*keys).agg(F.countDistinct("v").alias("n")).collect() if None not in [r[k] for k in keys]}
        got = {tuple(r[k] for k in keys): r["n_distinct"] for r in quality.merged_distinct(table, keys).collect()}
        assert got.keys() == exact.keys()
        assert all(abs(got[k] - n) <= max(1, n * quality.sketch_error()) for k, n in exact.items())
