"""Equal-width histograms per group (the per-party author-count panels).

Semantics are those of an equal-width histogram over each group's own
min..max with ``bins`` bins: edges ``lo + i*(hi-lo)/bins`` (last edge = hi),
half-open bins except the last, which is closed; a group with lo == hi uses
the range lo-0.5..hi+0.5, so all its values land in bin bins//2 + 1.

Plan: one partial/final aggregate to (group, value, count), then min/max per
group, binning of the distinct values and a sum per (group, bin), and a
zero-fill join against ``sequence(1, bins)`` exploded per group — all on the
small aggregate. No per-group jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _edge(i: Column, lo: Column, hi: Column, bins: int) -> Column:
    return F.when(i == bins, hi).otherwise(i * ((hi - lo) / F.lit(float(bins))) + lo)


def bin_index(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """1-based bin of ``v`` in ``bins`` equal-width bins over [lo, hi].

    The first guess from the scaled offset is corrected against the actual
    edges, so the result is consistent with the edge values even where the
    floating-point guess lands one bin off."""
    v = v.cast("double")
    lo2 = F.when(lo == hi, lo - 0.5).otherwise(lo).cast("double")
    hi2 = F.when(lo == hi, hi + 0.5).otherwise(hi).cast("double")
    raw = F.least(F.greatest(F.floor((v - lo2) * (F.lit(float(bins)) / (hi2 - lo2))),
                             F.lit(0)), F.lit(bins - 1)).cast("int")
    dec = raw - F.when(v < _edge(raw, lo2, hi2, bins), 1).otherwise(0)
    inc = dec + F.when((v >= _edge(dec + 1, lo2, hi2, bins)) & (dec != bins - 1), 1).otherwise(0)
    return inc + 1


def group_histogram(df: DataFrame, group: str, value: str, bins: int = 10,
                    decimals: int = 9) -> DataFrame:
    """(group, bin, bin_lo, bin_hi, count) with empty bins zero-filled.

    The input is read once: it is first reduced to (group, value, count) —
    a map-side combined aggregate whose size is the number of distinct values
    per group — and min/max, binning and zero-filling run on that."""
    vc = (df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
            .groupBy(group, value).agg(F.count(F.lit(1)).alias("_n")))
    stats = vc.groupBy(group).agg(F.min(value).cast("double").alias("_lo"),
                                  F.max(value).cast("double").alias("_hi"))
    counts = (vc.join(stats, group)
              .select(group, bin_index(F.col(value), F.col("_lo"), F.col("_hi"), bins).alias("bin"), "_n")
              .groupBy(group, "bin").agg(F.sum("_n").alias("count")))
    lo2 = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo") - 0.5).otherwise(F.col("_lo"))
    hi2 = F.when(F.col("_lo") == F.col("_hi"), F.col("_hi") + 0.5).otherwise(F.col("_hi"))
    frame = (stats.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
             .select(group, "bin",
                     F.round(_edge(F.col("bin") - 1, lo2, hi2, bins), decimals).alias("bin_lo"),
                     F.round(_edge(F.col("bin"), lo2, hi2, bins), decimals).alias("bin_hi")))
    return (frame.join(counts, [group, "bin"], "left")
            .select(group, "bin", "bin_lo", "bin_hi",
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))
