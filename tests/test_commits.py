"""The commit protocol of manifest runs."""

import glob
import os

import pytest

from vigil.sources import manifest as S


def run(spark, *paths):
    return spark.createDataFrame([("2024-01-01 00:00:00", p, "p", "u") for p in paths], "crawl_time string, file_path string, parent_url string, file_url string")


def paths(df):
    return sorted(r["file_path"] for r in df.collect())


def test_only_committed_attempts_are_seen(spark, tmp_path):
    out = str(tmp_path / "m")
    S.write_manifest(run(spark, "a", "b"), out, "2024_01_01_00_00_00")
    staged = S.stage_run(run(spark, "c"), out, "2024_01_02_00_00_00")
    assert staged.n_rows == 1
    assert S.latest_run_name(spark, out) == "2024_01_01_00_00_00" and paths(S.latest_run_rows(spark, out)) == ["a", "b"]
    assert [(r.run_file, r.attempt) for r in S.uncommitted(spark, out).collect()] == [(staged.run, staged.attempt)]
    S.commit_run(spark, out, staged)
    assert paths(S.latest_run_rows(spark, out)) == ["c"] and S.uncommitted(spark, out).count() == 0


def test_a_repeated_run_replaces_its_rows(spark, tmp_path):
    out = str(tmp_path / "m")
    for rows in (["a", "b"], ["a", "b", "c"], ["a", "b", "c"]):
        S.write_manifest(run(spark, *rows), out, "2024_01_01_00_00_00")
    assert paths(S.read_manifests(spark, out)) == ["a", "b", "c"]
    first = S.stage_run(run(spark, "x"), out, "2024_01_01_00_00_00")
    S.write_manifest(run(spark, "y"), out, "2024_01_01_00_00_00")
    S.commit_run(spark, out, first)  # the last commit counts, whatever was staged first
    assert paths(S.read_manifests(spark, out)) == ["x"]
    assert {(r.run_file, r.n_rows) for r in S.commits(spark, out).collect()} == {("2024_01_01_00_00_00", 1)}


def test_an_empty_run_can_be_the_latest(spark, tmp_path):
    out = str(tmp_path / "m")
    S.write_manifest(run(spark, "a"), out, "2024_01_01_00_00_00")
    S.write_manifest(run(spark, "b").where("false"), out, "2024_01_02_00_00_00")
    assert S.latest_run_name(spark, out) == "2024_01_02_00_00_00" and S.latest_run_rows(spark, out).count() == 0
    assert paths(S.latest_run_rows(spark, out, skip_empty=True)) == ["a"]


def test_files_of_other_programs_count_as_complete(spark, tmp_path):
    out = tmp_path / "m"
    S.write_manifest(run(spark, "a"), str(out), "2024_01_01_00_00_00")
    (out / "2024_01_03_00_00_00.csv").write_text("crawl_time,file_path,parent_url,file_url\n2024-01-03 00:00:01,z,p,u\n")
    assert paths(S.read_manifests(spark, str(out))) == ["a", "z"] and paths(S.latest_run_rows(spark, str(out))) == ["z"]


def test_a_write_that_breaks_off_leaves_the_latest_run_as_it_was(spark, tmp_path):
    out = str(tmp_path / "m")
    S.write_manifest(run(spark, "a"), out, "2024_01_01_00_00_00")
    with pytest.raises(Exception):
        S.write_manifest(run(spark, "b").selectExpr("raise_error('lost') AS crawl_time", "file_path", "parent_url", "file_url"), out, "2024_01_02_00_00_00")
    assert paths(S.latest_run_rows(spark, out)) == ["a"]
    assert len(glob.glob(os.path.join(out, "commits", "*.json"))) == 1
