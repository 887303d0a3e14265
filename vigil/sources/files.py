"""Landed raw files: bytes, size and MD5 via the binaryFile source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_landed(spark: SparkSession, path: str, glob: str | None = None,
                recursive: bool = True) -> DataFrame:
    """(path, length, modificationTime, download_md5) of every file; the
    content column is dropped after hashing so it is not carried further."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(path)
    return df.select("path", "length", "modificationTime",
                     F.md5("content").alias("download_md5"))


def list_landed(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, length, modificationTime) of every file; no content is read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", "length", "modificationTime")


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """As ``read_landed``, for the named files alone."""
    if not paths:
        return spark.createDataFrame([], "path string, length bigint, modificationTime timestamp, download_md5 string")
    return spark.read.format("binaryFile").load(paths).select(
        "path", "length", "modificationTime", F.md5("content").alias("download_md5"))
