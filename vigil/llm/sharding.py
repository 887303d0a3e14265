"""Uniform shuffle into shards of exact sizes by a hypergeometric matrix.

Rows are dealt to virtual partitions by a hash; how many rows each partition
sends to each shard is drawn exactly (a multivariate hypergeometric draw per
partition, so column sums are the shard sizes); rows are ranked at random
inside their partition, exchanged, and ranked at random again inside their
shard. Every random number is a pure function of row content and seed, so a
recomputed task repeats its choices.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of one virtual partition, about; bounds every window of the shuffle.
PARTITION_ROWS = 20_000


def hypergeometric(rng, good: int, bad: int, n: int) -> int:
    """Exact draw of how many of ``n`` picks without replacement are good.

    Walks outwards from the mode by the ratio of neighbouring probabilities, so
    it needs about one standard deviation of steps and has no upper bound on
    the population.
    """
    low, high = max(0, n - bad), min(good, n)
    if low == high:
        return low
    mode = min(high, max(low, (n + 1) * (good + 1) // (good + bad + 2)))

    def log_choose(a, b):
        return math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)

    p = math.exp(log_choose(good, mode) + log_choose(bad, n - mode) - log_choose(good + bad, n))
    left = rng.random() - p
    down, up, pd, pu = mode, mode, p, p
    while left > 0 and (down > low or up < high):
        if up < high:
            pu *= (good - up) * (n - up) / ((up + 1) * (bad - n + up + 1))
            up += 1
            left -= pu
            if left <= 0:
                return up
        if down > low:
            pd *= down * (bad - n + down) / ((good - down + 1) * (n - down + 1))
            down -= 1
            left -= pd
            if left <= 0:
                return down
    return mode


def communication_matrix(counts: list[int], shards: int, seed: int) -> np.ndarray:
    """counts[p] rows of partition p to a matrix [p, shard]; its rows sum to
    ``counts``, its columns to shard sizes that differ by one at most."""
    total = sum(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    rng = np.random.default_rng(seed)
    matrix = np.zeros((len(counts), shards), dtype=np.int64)
    for p, n in enumerate(counts):
        left, others = n, sum(room)
        for s in range(shards):
            others -= room[s]
            take = hypergeometric(rng, room[s], others, left)
            matrix[p, s] = take
            room[s] -= take
            left -= take
    return matrix


def assign_shards(docs: DataFrame, key_cols: list[str], shards: int = 24, seed: int = 9,
                  partition_rows: int = PARTITION_ROWS) -> DataFrame:
    """``docs`` with ``shard`` (0..shards-1) and ``slot`` (gapless from 0 in its shard).

    ``key_cols`` name what tells rows apart; equal rows may swap places, which
    changes nothing. Nulls count as a value. An empty table stays empty.
    The driver holds one count per (virtual partition, shard).
    """
    spark = docs.sparkSession
    keys = [F.col(f"`{c}`") for c in key_cols]
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    total = docs.count()
    parts = max(1, math.ceil(total / partition_rows))
    rows = docs.select(whole, F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(parts)).cast("int").alias("_part"),
                       F.xxhash64(F.lit(seed + 1), *keys).alias("_r1"), F.xxhash64(F.lit(seed + 2), *keys).alias("_r2"))
    found = {r["_part"]: r["count"] for r in rows.groupBy("_part").count().collect()}
    matrix = communication_matrix([found.get(p, 0) for p in range(parts)], shards, seed)
    ends = matrix.cumsum(axis=1)
    sent = spark.createDataFrame([(p, [int(x) for x in ends[p]]) for p in range(parts)],
                                 "_part int, _ends array<bigint>")
    local = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("_part").orderBy("_r1", "_r2")))
    dealt = (local.join(sent, "_part")
             .withColumn("_shard", F.size(F.filter("_ends", lambda e: e < F.col("_rank")))))
    # second permutation: a shard is cut into ranges of its random key, each ordered by itself
    column = matrix.sum(axis=0)
    ranges = max(1, math.ceil(int(column.max(initial=0)) / partition_rows))
    dealt = dealt.withColumn("_range", F.pmod(F.col("_r2"), F.lit(ranges)).cast("int")).drop("_ends", "_rank", "_part")
    sizes = dealt.groupBy("_shard", "_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(F.col("_shard").alias("_s"), F.col("_range").alias("_g"),
                           (F.sum("_n").over(Window.partitionBy("_shard").orderBy("_range")) - F.col("_n")).alias("_from"))
    inside = F.row_number().over(Window.partitionBy("_shard", "_range").orderBy("_r2", "_r1"))
    placed = (dealt.withColumn("_in", inside)
              .join(offsets, (F.col("_shard") == F.col("_s")) & (F.col("_range") == F.col("_g"))))
    return placed.select("_row", F.col("_shard").cast("int").alias("_shard"),
                         (F.col("_from") + F.col("_in") - 1).cast("bigint").alias("_slot")) \
        .select("_row.*", F.col("_shard").alias("shard"), F.col("_slot").alias("slot"))


def shard_report(docs: DataFrame, shards: int = 24, seed: int = 9) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard; null text counts as
    empty. The law is ``rows``, so ``grown_shard`` is null; equal texts are not
    held together (a shard could not keep its exact size if they were)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    light = docs.select("doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"),
                        F.crc32(F.encode(text, "UTF-8")).cast("bigint").alias("text_crc32"))
    out = assign_shards(light, ["doc_id", "text_crc32"], shards, seed)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, key_cols: list[str], shards: int = 24, seed: int = 9) -> None:
    """Write the shuffled corpus as Parquet, one folder per shard."""
    out = assign_shards(docs, key_cols, shards, seed)
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
