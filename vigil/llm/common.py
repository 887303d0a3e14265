"""Column helpers shared by the pipeline operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.session import scratch_path, table_path

#: White space that separates words (ASCII only), as a Java and RE2 pattern.
SPACES = r"[\x20\x09-\x0D]+"
#: Everything below U+0080 that is neither a digit nor a lower-case letter.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """The named input columns under private names, so that extra columns of
    the caller, whatever they are called, cannot clash with working columns."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for dst, src in cols.items()])


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; texts that are ASCII only take the fast
    built-in path."""
    return (F.when(F.length(text) == F.octet_length(text), F.lower(text))
            .otherwise(F.translate(text, _UPPER, _UPPER.lower())))


def space_words(text: Column) -> Column:
    """Words between ASCII white space; null and blank texts give an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def term_words(text: Column) -> Column:
    """Lower-cased runs of digits, ASCII letters and non-ASCII characters."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def shingle_hashes(words: Column, n: int) -> Column:
    """64-bit hash of every run of ``n`` words, in order; empty if there are fewer."""
    return F.when(F.size(words) >= n, F.transform(
        F.sequence(F.lit(0), F.size(words) - n),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))
    ).otherwise(F.array().cast("array<bigint>"))


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: cuts the
    lineage, survives lost executors and gives Catalyst real sizes for joins."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
