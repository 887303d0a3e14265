"""Incremental ingestion: only new files, and only content not seen before.

Streaming form: a file-source stream over the landing folder with its own
checkpoint (which records the files already processed), an MD5 per record,
and ``dropDuplicates`` on the digest, so a content seen in any earlier run is
skipped. ``trigger(availableNow=True)`` processes what has landed and stops,
which is how a periodic scheduler runs it. The dedup state holds one entry
per distinct digest; for large states use the RocksDB state store provider.

The stream keeps the first record of a digest in arrival order (within one
micro-batch, any one of them).

Lots (``ingest_lot``) keep no operator state at all: what was seen is a table of digests on
shared storage, dealt by digest prefix, and a run is one batch job that joins the new files'
digests to it. Each lot is committed as a whole, so a run that breaks off is done again.

Batch twin: the lowest key per digest, as one partial/final ``min``
aggregate, so a digest shared by very many records is combined map-side and
never collected into one group.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from vigil.functions.text import md5_hex
from vigil.sources.manifest import Staged, commit_run, commits


def first_by_content(df: DataFrame, key: str, content: str, out: str = "content_md5") -> DataFrame:
    """(key, digest) of the lowest key per distinct content digest."""
    d = df.select(key, md5_hex(content).alias(out))
    return d.groupBy(out).agg(F.min(key).alias(key)).select(key, out)


def content_stream(spark: SparkSession, src_dir: str, schema: StructType | str,
                   content: str, fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming records of new files under ``src_dir`` with their digest,
    duplicates of earlier content dropped."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    s = r.load(src_dir).withColumn("content_md5", md5_hex(content))
    return s.dropDuplicates(["content_md5"])


def landed_file_stream(spark: SparkSession, landing_dir: str, glob: str | None = None) -> DataFrame:
    """Streaming (path, length, modificationTime, download_md5) of raw files as
    they land, one row per distinct content: a file whose bytes were seen in
    any earlier run is skipped. The file source's checkpoint remembers which
    paths were processed, so each run only reads the new files."""
    r = (spark.readStream.format("binaryFile").option("recursiveFileLookup", True)
         .schema("path string, modificationTime timestamp, length bigint, content binary"))
    if glob:
        r = r.option("pathGlobFilter", glob)
    s = r.load(landing_dir).select("path", "length", "modificationTime",
                                   F.md5("content").alias("download_md5"))
    return s.dropDuplicates(["download_md5"])


def ingest_available(stream: DataFrame, sink_dir: str, checkpoint_dir: str,
                     fmt: str = "parquet") -> StreamingQuery:
    """Process everything that has landed, append to ``sink_dir``, stop."""
    q = (stream.writeStream.format(fmt).option("path", sink_dir)
         .option("checkpointLocation", checkpoint_dir).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def _lot_paths(store: str) -> tuple[str, str]:
    return store.rstrip("/") + "/lots", store.rstrip("/") + "/files"


def seen(spark: SparkSession, store: str, part: int) -> DataFrame | None:
    """Rows of the committed lots (``part`` 0: contents, 1: names of the files read); None before the first lot."""
    path = _lot_paths(store)[part]
    done = commits(spark, store).select(F.col("run_file").alias("lot"), "attempt")
    if done.isEmpty():
        return None
    found = spark.read.option("basePath", path).parquet(path).schema
    # digits in a folder's name would be taken for numbers
    texts = StructType([StructField(f.name, StringType()) if f.name in ("lot", "attempt", "prefix") else f for f in found.fields])
    return spark.read.schema(texts).option("basePath", path).parquet(path).join(done, ["lot", "attempt"], "left_semi")


def ingest_lot(spark: SparkSession, src_dir: str, store: str, schema: StructType | str, content: str, fmt: str = "parquet",
               lot: str | None = None, prefix: int = 2) -> int:
    """Read the files under ``src_dir`` that no earlier lot has read, keep the records whose content
    no earlier record has (of equal ones in this lot the first by file and content order),
    and append them to ``store`` as one committed lot; returns how many there were.

    The digests seen so far are partitioned by their first ``prefix`` hex digits and joined on
    digit and digest, so no state is held between runs, and their number only costs storage."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*." + fmt).load(src_dir).select("path")
    before = seen(spark, store, 1)
    fresh = listed if before is None else listed.join(before.select("path"), "path", "left_anti")
    if fresh.isEmpty():
        return 0
    lots, files = _lot_paths(store)
    lot, attempt = lot or uuid.uuid4().hex, uuid.uuid4().hex
    fresh.withColumn("lot", F.lit(lot)).withColumn("attempt", F.lit(attempt)).write.mode("append").partitionBy("lot", "attempt").parquet(files)
    fresh = spark.read.parquet(f"{files}/lot={lot}/attempt={attempt}").select("path")
    rows = spark.read.schema(schema).format(fmt).option("recursiveFileLookup", True).load(src_dir).withColumn("path", F.col("_metadata.file_path"))
    # names are spelt alike in the listing and in the files' metadata but for the slashes of the scheme
    rows = rows.withColumn("path", _plain("path")).join(fresh.select(_plain("path").alias("path")), "path", "left_semi")
    cols = [c for c in rows.columns if c != "path"]
    rows = rows.withColumn("content_md5", md5_hex(content))
    one = rows.groupBy("content_md5").agg(F.min_by(F.struct(*cols), F.struct("path", *[c for c in cols if c != content])).alias("r")).select("r.*", "content_md5")
    one = one.withColumn("prefix", F.substring("content_md5", 1, prefix))
    known = seen(spark, store, 0)
    if known is not None:
        one = one.join(known.select("prefix", "content_md5"), ["prefix", "content_md5"], "left_anti")
    got = Observation()
    (one.observe(got, F.count(F.lit(1)).alias("n")).withColumn("lot", F.lit(lot)).withColumn("attempt", F.lit(attempt))
     .repartition("prefix").write.mode("append").partitionBy("lot", "attempt", "prefix").parquet(lots))
    commit_run(spark, store, Staged(lot, attempt, got.get["n"]))
    return got.get["n"]


def _plain(path: str):
    return F.regexp_replace(path, "^([a-zA-Z][a-zA-Z0-9+.-]*):/*", "$1:/")
