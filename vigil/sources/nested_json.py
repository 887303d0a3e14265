"""Whole-document JSON scan for XML-derived exports.

Each file is one JSON document (often one line, no newline) holding one
``ArrayOf…`` root with the records. Files are read whole (one task per file;
``wholetext``), the root path is taken with ``get_json_object`` and the
object-or-array root is normalised and exploded, so after this step records
are rows and spread over the cluster (``repartition``) before heavy parsing.
Exports too large for one task are read by ``split_text.read_json_records``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.jsonx import json_array, path


def read_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(source_file, doc) — one row per file."""
    ps = [paths] if isinstance(paths, str) else list(paths)
    return (spark.read.text(ps, wholetext=True)
            .select(F.col("_metadata.file_path").alias("source_file"),
                    F.col("value").alias("doc")))


def records(docs: DataFrame, root_path: str, doc: str = "doc",
            keep: tuple[str, ...] = ("source_file",), spread: bool = False, partitions: int | None = None) -> DataFrame:
    """One row per record under ``root_path`` as raw JSON text (``record``),
    with ``record_pos`` (0-based) inside its document. ``spread`` deals the
    records out again, over ``partitions`` or as many as adaptive execution
    finds right. Documents without records are in ``bad_documents``."""
    out = docs.select(*keep, F.posexplode(json_array(path(doc, root_path)))
                      .alias("record_pos", "record"))
    if partitions:
        return out.repartition(partitions)
    return out.repartition("source_file", "record_pos") if spread else out


def bad_documents(docs: DataFrame, root_path: str, doc: str = "doc", keep: tuple[str, ...] = ("source_file",)) -> DataFrame:
    """(keep, doc, error_reason) of the documents that give no records: those that
    do not parse, lack the root, or have something else than records there. A
    root that is an empty list is fine."""
    parses = F.from_json(F.col(doc), "map<string,string>").isNotNull() | F.from_json(F.col(doc), "array<string>").isNotNull()
    found = path(doc, root_path)
    reason = (F.when(F.col(doc).isNull() | ~parses, F.lit("not a JSON document"))
               .when(found.isNull(), F.lit("root missing: " + root_path))
               .when(json_array(found).isNull(), F.lit("root holds no records: " + root_path)))
    return docs.select(*keep, doc, reason.alias("error_reason")).where(F.col("error_reason").isNotNull())
