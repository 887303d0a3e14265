"""Entry points a scheduler calls: land parsed tables, update manifests,
profile activities. Each is a plain function over paths; every step is a
Spark job, nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators import coauthor, histogram, manifest, quality
from vigil.operators.activity import ACTIVITY_ROOT, split_activity, tag_activity
from vigil.operators.initiative import INITIATIVE_ROOT, split_tagged, tag_initiatives
from vigil.session import scratch_path
from vigil.operators.reconcile import Counts
from vigil.sources.files import list_landed, read_files, read_landed
from vigil.sources.manifest import latest_run_rows, write_manifest
from vigil.sources.nested_json import bad_documents, read_documents, records


def _tagged_once(tagged: DataFrame, name: str) -> DataFrame:
    """The parsed records on shared storage, so that both outcomes are written
    from one parse of the exports."""
    path = scratch_path(tagged.sparkSession, name)
    tagged.write.parquet(path)
    return tagged.sparkSession.read.parquet(path)


def _with_bad_documents(bad: DataFrame, docs: DataFrame, root: str) -> DataFrame:
    """The quarantine with the documents that hold no records at all."""
    return bad.unionByName(bad_documents(docs, root).drop("doc"), allowMissingColumns=True)


def land_activity(spark: SparkSession, paths: str | list[str], out: str, quarantine_out: str,
                  partitions: int | None = None, partition_by: tuple[str, ...] = (),
                  clean_html: bool = False) -> Counts:
    """Member-activity JSON exports -> Parquet table + quarantine table; returns the
    counts of every step, observed in the same pass.
    Records are spread after the whole-file read (over ``partitions``, or as
    many as their size asks for), so one large export file does not keep its
    records in one task. With ``partition_by`` (e.g. ``("act_type",)``) the
    table is written in directories per value, so reads filtered on it prune
    whole directories. Documents that do not parse or lack the root go to the
    quarantine as well."""
    docs = read_documents(spark, paths)
    recs = records(docs, ACTIVITY_ROOT, spread=True, partitions=partitions)
    counts = Counts()
    tagged = _tagged_once(tag_activity(recs, keep=("source_file",), clean_html=clean_html, counts=counts), "activity")
    good, bad = split_activity(tagged, keep=("source_file",))
    w = good.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(out)
    _with_bad_documents(bad, docs, ACTIVITY_ROOT).write.mode("overwrite").parquet(quarantine_out)
    return counts


def land_initiatives(spark: SparkSession, paths: str | list[str], out: str,
                     quarantine_out: str | None = None, partitions: int | None = None,
                     clean_html: bool = False) -> None:
    """Initiative JSON exports -> Parquet table (+ quarantine of records that
    lack mandatory keys and of documents without records, when
    ``quarantine_out`` is given)."""
    docs = read_documents(spark, paths)
    recs = records(docs, INITIATIVE_ROOT, spread=True, partitions=partitions)
    tagged = _tagged_once(tag_initiatives(recs, keep=("source_file",), clean_html=clean_html), "initiatives")
    good, bad = split_tagged(tagged, keep=("source_file",))
    good.write.mode("overwrite").parquet(out)
    if quarantine_out:
        _with_bad_documents(bad, docs, INITIATIVE_ROOT).write.mode("overwrite").parquet(quarantine_out)


#: Pending files that are named to the scan one by one; more are joined to the listing.
MAX_PATHS = 10_000


def update_manifest(spark: SparkSession, runs_dir: str, landed_dir: str, out_dir: str,
                    run: str) -> DataFrame:
    """Record already-landed files of the newest run as downloaded: pending rows
    whose file is on disk get status 200, the file's MD5 and the run time;
    written as a new run partition (the input run is never overwritten).
    Returns the still-pending rows (files not landed yet). Manifest file
    paths are relative to ``landed_dir``."""
    import re
    scheme = r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?"
    root = re.escape(re.sub(scheme, "", landed_dir).rstrip("/"))
    latest = latest_run_rows(spark, runs_dir).drop("run_file")
    relative = F.regexp_replace("path", "(" + scheme + ")?" + root + "/", "").alias("file_path")
    listed = list_landed(spark, landed_dir).select("path", relative)
    # only files that a pending row waits for are read and hashed
    waiting = listed.join(manifest.pending(latest, spark.createDataFrame([], "file_path string")).select("file_path"), "file_path", "left_semi")
    paths = [r["path"] for r in waiting.select("path").limit(MAX_PATHS + 1).collect()]
    if len(paths) <= MAX_PATHS:  # name the files to the scan, so that no other is opened
        files = read_files(spark, paths)
    else:
        files = read_landed(spark, landed_dir).join(waiting.select("path"), "path", "left_semi")
    results = files.select(relative, F.lit(200).alias("download_status"), "download_md5",
                           F.to_timestamp_ntz(F.lit(run), F.lit("yyyy_MM_dd_HH_mm_ss")).alias("download_time"))
    write_manifest(manifest.merge_results(latest, results), out_dir, run)
    return manifest.pending(latest, listed.select("file_path"))


def activity_report(activity: DataFrame) -> dict[str, DataFrame]:
    """The exploratory checks on a landed activity table, as DataFrames."""
    return {
        "subtype_distinct": quality.distinct_per_group(activity, ["act_type", "act_subtype"], "act_id"),
        "dup_by_member": quality.count_vs_distinct(activity, "mp_name", "act_id"),
        "dup_by_entity": quality.nonnull_count_over(
            activity, ["mp_id", "mp_name", "mp_party", "act_id"], "act_desc", 2),
        "dup_by_entity_type": quality.nonnull_count_over(
            activity, ["mp_id", "mp_name", "mp_party", "act_type", "act_id"], "act_desc", 1),
        "null_profile": quality.null_profile(activity),
        "missing_date_profile": quality.missing_profile(activity, "act_date", ["act_type", "act_subtype"]),
        "rare_subtypes": quality.rare_groups(activity, ["act_type", "act_subtype"], "act_id", 5),
        "coauthor_weight": coauthor.coauthor_weights(activity),
    }


def initiative_report(initiatives: DataFrame) -> dict[str, DataFrame]:
    base = initiatives.where(F.col("party").isNotNull())
    return {
        "authors_per_party": base.groupBy("party", "number_authors").agg(F.count("id").alias("count")),
        "author_histogram": histogram.group_histogram(initiatives, "party", "number_authors", 10),
    }
