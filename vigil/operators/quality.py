"""Data-quality profiles: duplicate keys, colliding ids, null profiles, rare
categories and basic statistics.

Every profile is one aggregate job (partial + final hash aggregate); grouping
keys that are NULL are dropped first, as a pandas ``groupby`` does (Spark
would keep a NULL group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _non_null(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df if cond is None else df.where(cond)


def distinct_per_group(df: DataFrame, keys: Sequence[str], col: str,
                       out: str = "n_distinct", approx: bool = False) -> DataFrame:
    """Distinct non-null ``col`` per group, ascending (``nunique``)."""
    agg = (F.approx_count_distinct(col) if approx else F.countDistinct(col)).alias(out)
    return (_non_null(df, keys).groupBy(*keys).agg(agg)
            .orderBy(out, *keys))


def count_vs_distinct(df: DataFrame, key: str | Sequence[str], col: str) -> DataFrame:
    """Per group: non-null count, distinct count and their difference, kept
    where the difference is positive (repeated ids), ascending by it."""
    keys = [key] if isinstance(key, str) else list(key)
    return (_non_null(df, keys).groupBy(*keys)
            .agg(F.count(col).alias("n_count"), F.countDistinct(col).alias("n_unique"))
            .withColumn("n_diff", F.col("n_count") - F.col("n_unique"))
            .where(F.col("n_diff") > 0)
            .orderBy("n_diff", *keys))


def nonnull_count_over(df: DataFrame, keys: Sequence[str], col: str,
                       more_than: int, out: str = "n_nonnull") -> DataFrame:
    """Groups whose non-null ``col`` count exceeds ``more_than`` (HAVING)."""
    return (_non_null(df, keys).groupBy(*keys)
            .agg(F.count(col).alias(out))
            .where(F.col(out) > more_than))


def rare_groups(df: DataFrame, keys: Sequence[str], col: str, less_than: int,
                out: str = "n_distinct") -> DataFrame:
    """Groups with fewer than ``less_than`` distinct non-null ``col`` values."""
    return (_non_null(df, keys).groupBy(*keys)
            .agg(F.countDistinct(col).alias(out))
            .where(F.col(out) < less_than))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, n_null, n_non_null) for every column, in one pass."""
    cols = list(cols or df.columns)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"_n{i}"), F.count(c).alias(f"_v{i}")]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', _n{i}, _v{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, n_null, n_non_null)")


def missing_profile(df: DataFrame, null_col: str, keys: Sequence[str]) -> DataFrame:
    """On the rows where ``null_col`` is NULL: non-null count of every other
    column per group (``df[df.c.isnull()].groupby(keys).count()``)."""
    others = [c for c in df.columns if c not in keys]
    return (_non_null(df.where(F.col(null_col).isNull()), keys).groupBy(*keys)
            .agg(*[F.count(c).alias(f"n_{c}") for c in others]))


def basic_stats(df: DataFrame, cols: Sequence[str], decimals: int = 6) -> DataFrame:
    """Long-form statistics per numeric column: count, nulls, min, max, mean,
    sample standard deviation — one aggregate pass over the table."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"_c{i}"), F.count_if(x.isNull()).alias(f"_z{i}"),
                 F.min(x).alias(f"_lo{i}"), F.max(x).alias(f"_hi{i}"),
                 F.avg(x).alias(f"_m{i}"), F.stddev_samp(x).alias(f"_s{i}")]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', _c{i}, _z{i}, _lo{i}, _hi{i}, _m{i}, _s{i}"
                      for i, c in enumerate(cols))
    long = wide.selectExpr(
        f"stack({len(cols)}, {pairs}) AS (column_name, n, n_null, min, max, mean, stddev)")
    return long.select("column_name", "n", "n_null", "min", "max",
                       F.round("mean", decimals).alias("mean"),
                       F.round("stddev", decimals).alias("stddev"))


def sketch_table(df: DataFrame, keys: list[str], col: str, lg_k: int = 12) -> DataFrame:
    """Mergeable distinct counts: ``keys``, ``n_rows`` and ``sketch``, a HyperLogLog sketch of ``col``
    per key. Stored, the table answers distinct counts over any subset of the keys, and new
    rows are added by a union with their own table; NULLs are not counted."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(col, F.lit(lg_k)).alias("sketch"))


def sketch_error(lg_k: int = 12, sigmas: float = 3.0) -> float:
    """Relative error of a sketch's estimate: 1.04 / sqrt(2^lg_k) is one standard deviation."""
    return sigmas * 1.04 / 2 ** (lg_k / 2)


def merged_distinct(sketches: DataFrame, keys: list[str], out: str = "n_distinct") -> DataFrame:
    """Estimated distinct counts per ``keys`` from stored sketches of finer keys; rows
    with a NULL key are left out, as in the exact counts."""
    for k in keys:
        sketches = sketches.where(F.col(k).isNotNull())
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(out))
