"""Crawl manifests: fixed 7-column schema, run selection, run-partitioned sink.

A manifest run is a CSV file named by its run timestamp. Times are local
wall-clock times without a zone (TIMESTAMP_NTZ). Older runs have only
the first four columns; reading every run with the full schema (missing
trailing fields become NULL) replaces the per-file widening step.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (IntegerType, StringType, StructField, StructType,
                               TimestampNTZType)

MANIFEST_SCHEMA = StructType([
    StructField("crawl_time", TimestampNTZType()),
    StructField("file_path", StringType()),
    StructField("parent_url", StringType()),
    StructField("file_url", StringType()),
    StructField("download_time", TimestampNTZType()),
    StructField("download_status", IntegerType()),
    StructField("download_md5", StringType()),
])
MANIFEST_COLUMNS = [f.name for f in MANIFEST_SCHEMA.fields]
RUN_ID_FORMAT = "yyyy_MM_dd_HH_mm_ss"


COMMIT_SCHEMA = "run_file string, attempt string, n_rows long, seq long"


class Staged(NamedTuple):
    """Rows of a run that are written but not committed."""

    run: str
    attempt: str
    n_rows: int


def _run_of(file_path) -> "F.Column":
    """A file's run: the value of its ``run_id=`` folder, or else its name."""
    folder = F.regexp_extract(file_path, r"run_id=([^/]+)/", 1)
    return F.when(folder != "", folder).otherwise(F.regexp_extract(file_path, r"([^/]+?)(\.csv)?$", 1))


def _attempt_of(file_path) -> "F.Column":
    """The attempt that wrote a file; empty for files that no attempt wrote."""
    return F.regexp_extract(file_path, r"attempt=([^/]+)/[^/]*$", 1)


def _commits_path(path: str) -> str:
    return path.rstrip("/") + "/commits"


def commits(spark: SparkSession, path: str) -> DataFrame:
    """(run_file, attempt, n_rows): the attempt that counts for every committed run."""
    from pyspark.errors import AnalysisException

    try:
        marks = spark.read.schema(COMMIT_SCHEMA).json(_commits_path(path))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        marks = spark.createDataFrame([], COMMIT_SCHEMA)
    last = F.max(F.struct("seq", "attempt", "n_rows")).alias("last")
    return marks.groupBy("run_file").agg(last).select("run_file", "last.attempt", "last.n_rows")


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """All complete runs under ``path`` (committed attempts, flat ``<run>.csv`` files and
    ``run_id=<run>`` folders) with the 7-column schema plus ``run_file`` (the run's name);
    blank fields are NULL."""
    rows = (spark.read.schema(MANIFEST_SCHEMA).option("header", True).option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.csv").csv(path)
            .withColumns({"run_file": _run_of(F.col("_metadata.file_path")), "_attempt": _attempt_of(F.col("_metadata.file_path"))}))
    done = commits(spark, path).select(F.col("run_file").alias("_run"), F.col("attempt").alias("_done"))
    landed = rows.where("_attempt = ''")
    written = rows.where("_attempt <> ''").join(done, (F.col("run_file") == F.col("_run")) & (F.col("_attempt") == F.col("_done")), "left_semi")
    return landed.unionByName(written).drop("_attempt")


def widen(df: DataFrame) -> DataFrame:
    """Give a 4-column manifest the three download columns (NULL)."""
    cols = []
    for f in MANIFEST_SCHEMA.fields:
        cols.append(F.col(f.name).cast(f.dataType) if f.name in df.columns
                    else F.lit(None).cast(f.dataType).alias(f.name))
    extra = [c for c in df.columns if c not in MANIFEST_COLUMNS]
    return df.select(*cols, *extra)


def run_id(ts_col) -> "F.Column":
    """Run name of a timestamp (``2023_11_27_17_04_10``)."""
    return F.date_format(ts_col, RUN_ID_FORMAT)


def stage_run(df: DataFrame, path: str, run: str) -> Staged:
    """Write the rows of a run (quoted CSV with header) without committing them."""
    attempt, seen = uuid.uuid4().hex, Observation()
    rows = widen(df).observe(seen, F.count(F.lit(1)).alias("n"))
    rows.write.mode("error").option("header", True).csv(f"{path.rstrip('/')}/run_id={run}/attempt={attempt}")
    return Staged(run, attempt, seen.get["n"])


def commit_run(spark: SparkSession, path: str, staged: Staged) -> None:
    """Make a staged run visible: one small file, which a task writes as a whole. A run that was
    committed before is replaced."""
    marks = _commits_path(path)
    before = commits(spark, path)
    mine = F.lit(staged.run).alias("run_file"), F.lit(staged.attempt).alias("attempt"), F.lit(staged.n_rows).cast("long").alias("n_rows")
    seq = spark.range(1).select(F.lit(0).cast("long").alias("seq"))
    if not before.isEmpty():
        seq = spark.read.schema(COMMIT_SCHEMA).json(marks).agg((F.max("seq") + 1).alias("seq"))
    seq.select(*mine, "seq").coalesce(1).write.mode("append").json(marks)


def write_manifest(df: DataFrame, path: str, run: str) -> Staged:
    """Stage and commit one run. A retry, even after a commit, replaces its own rows; a run
    never overwrites what it is read from."""
    staged = stage_run(df, path, run)
    commit_run(df.sparkSession, path, staged)
    return staged


def list_runs(spark: SparkSession, path: str) -> DataFrame:
    """(run_file, length) of every complete run, header-only and empty runs included; only
    file metadata and commit markers are read (the content column is never selected)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(path)
             .select(_run_of(F.col("path")).alias("run_file"), _attempt_of(F.col("path")).alias("attempt"), "length"))
    done = commits(spark, path).select("run_file", "attempt", F.lit(0).cast("long").alias("length"))
    sizes = files.where("attempt <> ''").join(done.select("run_file", "attempt"), ["run_file", "attempt"], "left_semi")
    return files.where("attempt = ''").unionByName(done).unionByName(sizes).groupBy("run_file").agg(F.sum("length").alias("length"))


def uncommitted(spark: SparkSession, path: str) -> DataFrame:
    """(run_file, attempt, n_files): attempts that broke off or were replaced; safe to delete
    once no run is being written."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(path)
             .select(_run_of(F.col("path")).alias("run_file"), _attempt_of(F.col("path")).alias("attempt")))
    return (files.where("attempt <> ''").groupBy("run_file", "attempt").agg(F.count(F.lit(1)).alias("n_files"))
            .join(commits(spark, path).select("run_file", "attempt"), ["run_file", "attempt"], "left_anti"))


def latest_run_name(spark: SparkSession, path: str) -> str | None:
    """Name of the newest run (greatest name), or None when there is none;
    a one-row aggregate over the file listing."""
    return list_runs(spark, path).agg(F.max("run_file")).first()[0]


def latest_run_rows(spark: SparkSession, path: str, skip_empty: bool = False) -> DataFrame:
    """Rows of the newest run (greatest name). By default the newest run
    is taken even when it holds no rows (then nothing is returned); with
    ``skip_empty`` the newest run that has rows is used."""
    rows = read_manifests(spark, path)
    if skip_empty:
        top = rows.agg(F.max("run_file").alias("_top"))
    else:
        top = list_runs(spark, path).agg(F.max("run_file").alias("_top"))
    # ``top`` is a one-row aggregate, so the broadcast is bounded by construction
    return rows.join(F.broadcast(top), rows["run_file"] == F.col("_top")).drop("_top")
