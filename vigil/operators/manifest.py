"""Incremental download bookkeeping on manifests, as joins.

pending  = manifest rows whose file is not landed (left_anti) and whose
           status is not a success;
merge    = manifest ⟕ download results, taking a result only where it
           succeeded (status 200);
latest   = rows of the greatest run name (one-row aggregate, broadcast — its
           size is one row by construction).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.sources.manifest import MANIFEST_COLUMNS, widen

OK = 200


def pending(manifest: DataFrame, landed: DataFrame, key: str = "file_path") -> DataFrame:
    """Rows still to download: file not landed and status != 200 (NULL as 0)."""
    m = widen(manifest)
    return (m.join(landed.select(key).distinct(), key, "left_anti")
             .where(F.coalesce(F.col("download_status"), F.lit(0)) != OK))


def merge_results(manifest: DataFrame, results: DataFrame, key: str = "file_path") -> DataFrame:
    """Fill download time/status/md5 of unfinished rows from their successful
    result; finished rows (status 200) and rows without a success keep their
    values. Of several successes for one key the latest counts, so no manifest
    row is repeated; rows that share a key are all filled."""
    m = widen(manifest)
    r = (results.where(F.col("download_status") == OK).groupBy(F.col(key).alias("_k"))
         .agg(F.max(F.struct("download_time", "download_md5")).alias("_r")))
    j = m.join(r, m[key] == r["_k"], "left")
    fill = F.col("_r").isNotNull() & (F.coalesce(F.col("download_status"), F.lit(0)) != OK)
    return j.select(
        *[c for c in MANIFEST_COLUMNS if not c.startswith("download_")],
        F.when(fill, F.col("_r.download_time")).otherwise(F.col("download_time")).alias("download_time"),
        F.when(fill, F.lit(OK)).otherwise(F.col("download_status")).alias("download_status"),
        F.when(fill, F.col("_r.download_md5")).otherwise(F.col("download_md5")).alias("download_md5"),
        *[c for c in m.columns if c not in MANIFEST_COLUMNS])


def latest_rows(df: DataFrame, run_col: str = "run_file") -> DataFrame:
    """Rows of the greatest run name among the given rows (a run without rows
    has no row to carry its name, so it is never chosen here; use
    ``sources.manifest.latest_run_rows`` to keep an empty newest run)."""
    top = df.agg(F.max(run_col).alias("_top"))  # exactly one row
    return df.join(F.broadcast(top), df[run_col] == F.col("_top")).drop("_top")
