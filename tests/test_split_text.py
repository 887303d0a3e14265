"""Files cut into many splits give the records of a whole-file scan."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMOKE
from vigil.plans import storage_queries
from vigil.sources import split_text
from vigil.sources.delimited import read_pipe_csv, write_pipe_csv
from vigil.sources.nested_json import read_documents, records
from vigil.sources.split_text import pieces, read_json_records, read_quoted_csv


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "701")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def rows(rng, n):
    text = lambda: "".join(rng.choice(['"', "|", "\n", "a", "b c", "é", '""', "\n\n", ",", " "]) for _ in range(rng.randrange(12))) or None
    return [(i, text(), rng.randrange(100) if rng.random() < 0.9 else None, text()) for i in range(n)]


def test_quoted_line_breaks_across_splits(spark, tmp_path, small_splits):
    schema = "id long, a string, n int, b string"
    df = spark.createDataFrame(rows(random.Random(1), 900), schema)
    out = str(tmp_path / "csv")
    write_pipe_csv(df.coalesce(2), out)
    assert pieces(spark, out, "\n").select("file", "block").distinct().count() > 10
    assert pieces(spark, out, "\n").rdd.getNumPartitions() > 10
    got, want = (sorted(map(tuple, f(spark, out, schema).collect())) for f in (read_quoted_csv, read_pipe_csv))
    assert got == want and len(got) == 900


def test_windows_line_ends_and_blank_lines(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id|a\r\n1|"x\r\ny"\r\n\r\n2|z\r\n', newline="")
    got = read_quoted_csv(spark, str(tmp_path / "x.csv"), "id int, a string").collect()
    assert sorted(map(tuple, got)) == [(1, "x\r\ny"), (2, "z")]


def value(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind < 3:
        return rng.choice(['a}b', '{"x": [', 'quote " and \\', "é\n", "", '"Rec":[{', 'tail\\"}'])
    if kind == 3:
        return rng.choice([1, None, True, 2.5])
    if kind == 4:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {f"k{i}": value(rng, depth + 1) for i in range(rng.randrange(4))}


def test_json_records_across_splits(spark, tmp_path, small_splits):
    rng = random.Random(2)
    record = lambda: {"id": rng.randrange(10 ** 6), **{f"f{i}": value(rng) for i in range(4)}}
    docs = {
        "many": {"?xml": {"@version": "1.0"}, "A": {"@x": "y", "Rec": [record() for _ in range(300)]}},
        "two": {"A": {"Other": [{"z": 1}, {"z": 2}], "Rec": [record() for _ in range(20)], "After": [{"q": {"r": 1}}, {"q": 2}]}},
        "lone": {"A": {"Rec": {**record(), "sub": {"deep": [{"a": 1}, {"b": 2}]}}}},
        "empty": {"A": {"Rec": []}},
        "wrong": {"B": {"Rec_": [record()]}},
        "one": {"A": {"Rec": [record()]}},
    }
    for name, d in docs.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(d, ensure_ascii=False, indent=rng.choice([None, 1])))
    (tmp_path / "cut.json").write_text(json.dumps(docs["many"])[:-3])
    (tmp_path / "open.json").write_text('{"A":{"Rec":[{"x":"never closed}]}}')
    got, bad = read_json_records(spark, str(tmp_path), "A.Rec")
    whole = records(read_documents(spark, str(tmp_path)), "A.Rec")
    name = F.regexp_extract("source_file", r"([a-z]+)\.json$", 1).alias("name")
    load = lambda df: sorted((r["name"], r["record_pos"], json.dumps(json.loads(r["record"]))) for r in df.select(name, "record_pos", "record").collect())
    counts = [{n: sum(1 for x in rows if x[0] == n) for n in docs} for rows in (load(got), load(whole))]
    assert counts[0] == counts[1]
    assert load(got) == load(whole)
    assert len(load(got)) == 322
    assert {r["name"]: r["error_reason"].split(":")[0] for r in bad.select(name, "error_reason").collect()} == {
        "cut": "not a JSON document", "open": "not a JSON document", "empty": "root holds no records", "wrong": "root holds no records"}


@pytest.mark.parametrize("name,files", [("csv_split_roundtrip", "*.csv"), ("json_split_scan", "whole/*.txt")])
def test_larger_tables_make_more_files_with_the_same_rows(spark, tmp_path, monkeypatch, name, files):
    run = lambda: sorted(map(repr, storage_queries.__dict__["q_" + name](spark, SF_SMOKE).collect()))
    want = run()
    monkeypatch.setattr(storage_queries, "FILE_BYTES", 20_000)
    monkeypatch.setattr(storage_queries, "scratch_path", lambda spark, _: str(tmp_path / "out"))
    assert run() == want
    written = list((tmp_path / "out").glob(files))
    assert len(written) > 5 and max(f.stat().st_size for f in written) < 60_000


def on_disk(spark):
    """Bytes under the checkpoint folder and Spark's local folders; files may go meanwhile."""
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    found = [os.path.join(d, f) for top in (spark.sparkContext.getCheckpointDir().removeprefix("file:"), *local) for d, _, fs in os.walk(top) for f in fs]
    return sum(os.path.getsize(f) for f in found if os.path.exists(f))


def test_json_records_are_neither_stored_nor_dealt_out(spark, tmp_path):
    rng = random.Random(3)
    docs = [{"id": i, "text": "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789{}\"\\", k=2000))} for i in range(4000)]
    (tmp_path / "x.json").write_text(json.dumps({"A": {"Rec": docs}}))
    size = (tmp_path / "x.json").stat().st_size
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        before = on_disk(spark)
        got, bad = read_json_records(spark, str(tmp_path), "A.Rec")
        r = got.agg(F.count("record"), F.sum(F.length(F.get_json_object("record", "$.text"))), F.sum(F.get_json_object("record", "$.id").cast("long"))).first()
        assert tuple(r) == (4000, 8_000_000, 4000 * 3999 // 2) and bad.count() == 0
        assert on_disk(spark) - before < size / 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("chunk", [1, 64, 1 << 22])
def test_json_records_read_later_under_other_settings(spark, tmp_path, monkeypatch, small_splits, chunk):
    monkeypatch.setattr(split_text, "_CHUNK", chunk)
    rng = random.Random(4)
    docs = [{"id": i, "f": value(rng), "bad": "\\" * rng.randrange(4) + '"' * rng.randrange(2)} for i in range(200)]
    (tmp_path / "x.json").write_text(json.dumps({"A": {"Rec": docs}}, ensure_ascii=False, indent=1))
    got, _ = read_json_records(spark, str(tmp_path), "A.Rec")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "977")
    assert [json.loads(r["record"]) for r in got.orderBy("record_pos").collect()] == docs


def test_json_records_replace_broken_characters_alike(spark, tmp_path, small_splits):
    docs = ",".join('{"id": %d, "t": "a\udcff}b"}' % i for i in range(300))
    (tmp_path / "x.json").write_bytes(('{"A": {"Rec": [' + docs + "]}}").encode("utf-8", "surrogateescape"))
    got = read_json_records(spark, str(tmp_path), "A.Rec")[0].orderBy("record_pos").collect()
    assert [r["record"] for r in got] == ['{"id": %d, "t": "a\ufffd}b"}' % i for i in range(300)]
