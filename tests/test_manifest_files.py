"""Manifests, landed files, pending/merge, latest run, pipe CSV round trip."""

import hashlib

from pyspark.sql import functions as F

from vigil.operators import manifest as M
from vigil.sources.delimited import read_indexed_csv, read_pipe_csv, write_pipe_csv
from vigil.sources.files import read_landed
from vigil.sources.manifest import MANIFEST_SCHEMA, read_manifests, run_id, write_manifest

HEAD7 = "crawl_time,file_path,parent_url,file_url,download_time,download_status,download_md5\n"
HEAD4 = "crawl_time,file_path,parent_url,file_url\n"


def test_runs_latest_pending_merge(spark, tmp_path):
    runs = tmp_path / "runs"
    runs.mkdir()
    landed = tmp_path / "landed"
    (landed / "data").mkdir(parents=True)
    (landed / "data" / "a.json").write_bytes(b'{"a":1}')
    (runs / "2023_01_01_00_00_00.csv").write_text(
        HEAD7 + "2023-01-01 00:00:01,data/old.json,p,u0,2023-01-01 00:01:00,200,abc\n")
    (runs / "2023_02_01_00_00_00.csv").write_text(
        HEAD4 + "2023-02-01 00:00:01,data/a.json,p,u1\n"
                "2023-02-01 00:00:02,data/b.json,p,u2\n"
                "2023-02-01 00:00:03,data/c.json,p,u3\n")
    (runs / "notes.txt").write_text("not a run")
    allruns = read_manifests(spark, str(runs))
    latest = M.latest_rows(allruns, "run_file")
    assert latest.count() == 3
    assert {r.run_file for r in latest.collect()} == {"2023_02_01_00_00_00"}
    files = read_landed(spark, str(landed))
    assert files.first().download_md5 == hashlib.md5(b'{"a":1}').hexdigest()
    on_disk = files.select(F.regexp_extract("path", r"(data/.*)$", 1).alias("file_path"))
    pend = M.pending(latest, on_disk)
    assert sorted(r.file_path for r in pend.collect()) == ["data/b.json", "data/c.json"]
    results = spark.createDataFrame(
        [("data/b.json", "2023-02-02 00:00:00", 200, "m_b"), ("data/c.json", "2023-02-02 00:00:00", 404, None)],
        "file_path string, download_time string, download_status int, download_md5 string") \
        .withColumn("download_time", F.to_timestamp_ntz("download_time"))
    merged = {r.file_path: r for r in M.merge_results(latest, results).collect()}
    assert merged["data/b.json"].download_status == 200 and merged["data/b.json"].download_md5 == "m_b"
    assert merged["data/c.json"].download_status is None       # failed download recorded nowhere
    assert merged["data/a.json"].download_status is None
    out = tmp_path / "manifests"
    write_manifest(M.merge_results(latest, results).drop("run_file"), str(out), "2023_02_02_00_00_00")
    back = spark.read.schema(MANIFEST_SCHEMA).option("header", True).csv(str(out / "run_id=2023_02_02_00_00_00"))
    assert back.count() == 3
    assert spark.range(1).select(run_id(F.to_timestamp(F.lit("2023-11-27 17:04:10")))).first()[0] \
        == "2023_11_27_17_04_10"


def test_pipe_csv_round_trip_with_awkward_text(spark, tmp_path):
    rows = [(1, 'say "hi"', "a|b", "line1\nline2", ""), (2, None, "x", " lead", "t")]
    df = spark.createDataFrame(rows, "id int, a string, b string, c string, d string")
    p = str(tmp_path / "pipe")
    write_pipe_csv(df, p)
    back = read_pipe_csv(spark, p, df.schema).orderBy("id").collect()
    assert [tuple(r) for r in back] == [(1, 'say "hi"', "a|b", "line1\nline2", None),
                                        (2, None, "x", " lead", "t")]


def test_indexed_csv_drops_index(spark, tmp_path):
    p = tmp_path / "seats.csv"
    p.write_text(",seat_nmr,party\n0,1,CH\n1,2,IL\n")
    df = read_indexed_csv(spark, str(p))
    assert df.columns == ["seat_nmr", "party"] and df.count() == 2
    typed = read_indexed_csv(spark, str(p), "seat_nmr int, party string")
    assert [tuple(r) for r in typed.orderBy("seat_nmr").collect()] == [(1, "CH"), (2, "IL")]


def test_latest_run_keeps_or_skips_empty_newest(spark, tmp_path):
    from vigil.sources.manifest import latest_run_rows
    runs = tmp_path / "runs2"
    runs.mkdir()
    (runs / "2023_11_27_17_04_10.csv").write_text(HEAD7 + "2023-11-27 17:04:23,data/x.json,p,u,,0,\n")
    (runs / "2023_11_27_17_04_55.csv").write_text(HEAD4)          # newest run, no rows
    assert latest_run_rows(spark, str(runs)).count() == 0
    kept = latest_run_rows(spark, str(runs), skip_empty=True).collect()
    assert len(kept) == 1 and kept[0].file_path == "data/x.json" and kept[0].download_status == 0


def test_pandas_na_tokens(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("id|a|b\n1|NA|x\n2|None|\n3|ok|null\n")
    df = read_pipe_csv(spark, str(p), "id int, a string, b string").orderBy("id")
    assert [tuple(r) for r in df.collect()] == [(1, None, "x"), (2, None, None), (3, "ok", None)]
    raw = read_pipe_csv(spark, str(p), "id int, a string, b string", na_tokens=False).orderBy("id")
    assert raw.first().a == "NA"


def test_latest_run_name(spark, tmp_path):
    from vigil.sources.manifest import latest_run_name
    runs = tmp_path / "runs3"
    runs.mkdir()
    (runs / "2023_01_01_00_00_00.csv").write_text(HEAD4)
    (runs / "2023_03_01_00_00_00.csv").write_text(HEAD4)
    (runs / "zzz.txt").write_text("x")
    assert latest_run_name(spark, str(runs)) == "2023_03_01_00_00_00"


def test_own_runs_are_read_back_whole(spark, tmp_path):
    from vigil.sources.manifest import latest_run_name, latest_run_rows
    out = str(tmp_path / "runs4")
    cols = "crawl_time string, file_path string, parent_url string, file_url string"
    for run, n in (("2023_01_01_00_00_00", 8), ("2023_02_01_00_00_00", 9)):
        df = spark.createDataFrame([("2023-01-01 00:00:00", f"data/{run}/{i}", "p", "u") for i in range(n)], cols)
        write_manifest(df.repartition(4), out, run)
    assert latest_run_name(spark, out) == "2023_02_01_00_00_00"
    rows = latest_run_rows(spark, out).collect()
    assert len(rows) == 9 and {r.run_file for r in rows} == {"2023_02_01_00_00_00"}


def test_merge_touches_unfinished_rows_only_and_repeats_none(spark):
    ntz = lambda s: F.to_timestamp_ntz(F.lit(s))
    m = spark.createDataFrame([("a", 200, "old"), ("b", None, None), ("b", 404, None), ("c", None, None)],
                              "file_path string, download_status int, download_md5 string")
    m = m.withColumn("download_time", F.when(F.col("file_path") == "a", ntz("2023-01-01 00:00:00")))
    r = spark.createDataFrame([("a", 200, "new", "2023-03-01 00:00:00"), ("b", 200, "b1", "2023-03-01 00:00:00"),
                               ("b", 200, "b2", "2023-03-02 00:00:00"), ("b", 503, None, "2023-03-03 00:00:00"), ("c", 404, "x", "2023-03-01 00:00:00")],
                              "file_path string, download_status int, download_md5 string, t string") \
        .withColumn("download_time", F.to_timestamp_ntz("t"))
    got = [(x.file_path, x.download_status, x.download_md5, str(x.download_time)[:10]) for x in M.merge_results(m, r).collect()]
    assert sorted(got, key=repr) == sorted([("a", 200, "old", "2023-01-01"), ("b", 200, "b2", "2023-03-02"), ("b", 200, "b2", "2023-03-02"), ("c", None, None, "None")], key=repr)
