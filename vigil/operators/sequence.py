"""Positional numbering and run detection that do not put a whole group in
one task.

``Window.partitionBy(g).orderBy(o)`` sends every row of a group to a single
task; a group holding a third of the data would stall there. Here rows are
range-partitioned on (group, order), so a hot group is spread over many
contiguous partitions; each partition numbers its rows locally, and a small
per-(partition, group) count table carries the offsets across partition
borders. The numbered data is checkpointed to the shared checkpoint folder so
the local numbers are fixed before they are reused and survive executor loss.

Run detection (gaps and islands) numbers the rows once, cuts every group into
blocks of equally many positions, finds the changes inside each block, and
carries the last value and the number of changes across block borders in a
table of one row per block.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.session import ensure_checkpoint_dir


def ordered_index(df: DataFrame, group: Sequence[str], order: Sequence[str],
                  out: str = "seq", num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row inside its group by ``order``.

    ``order`` must be a total order inside each group (add a unique
    tiebreaker), otherwise positions of tied rows are arbitrary."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    group, order = list(group), list(order)
    keys = group + order
    # without a count adaptive execution sizes the ranges
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    numbered = (ranged.sortWithinPartitions(*keys)
                .withColumn("_mid", F.monotonically_increasing_id())
                .withColumn("_pid", F.shiftright("_mid", 33))
                .checkpoint(eager=True))
    stats = (numbered.groupBy("_pid", *group)
             .agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n")))
    w = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    s = stats.select(F.col("_pid").alias("_spid"), *[F.col(g).alias(f"_s_{g}") for g in group],
                     "_first", "_off")
    cond = reduce(lambda a, b: a & b,
                  [numbered["_pid"] == s["_spid"]]
                  + [numbered[g].eqNullSafe(s[f"_s_{g}"]) for g in group])
    j = numbered.join(s, cond)
    return (j.withColumn(out, F.col("_mid") - F.col("_first") + F.col("_off") + 1)
             .drop("_mid", "_pid", "_spid", "_first", "_off", *[f"_s_{g}" for g in group]))


#: Positions of a group that one window of the run detection holds.
RUN_BLOCK = 100_000


def runs(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str,
         extra_aggs: Sequence = (), block: int = RUN_BLOCK) -> DataFrame:
    """Maximal runs of equal consecutive ``value`` inside each group (NULL equals NULL).

    Output: group columns, ``value``, ``start_seq``, ``end_seq``, ``n_rows``
    plus ``extra_aggs``; ``start_seq``/``end_seq`` are 1-based positions in
    the group's order, so runs tile each group exactly. One range sort numbers
    the rows; the windows run over ``block`` positions, and over one row per block."""
    group, order = list(group), list(order)
    rows = ordered_index(df, group, order, "_g").withColumn("_block", F.floor((F.col("_g") - 1) / block))
    inside = Window.partitionBy(*group, "_block").orderBy("_g")
    change = (F.row_number().over(inside) > 1) & ~F.col(value).eqNullSafe(F.lag(value).over(inside))
    rows = rows.withColumn("_change", change.cast("long")).withColumn("_local", F.sum("_change").over(inside))
    blocks = rows.groupBy(*group, "_block").agg(
        F.min_by(value, "_g").alias("_first"), F.max_by(value, "_g").alias("_last"), F.sum("_change").alias("_changes"))
    across = Window.partitionBy(*group).orderBy("_block")
    border = (F.row_number().over(across) > 1) & ~F.col("_first").eqNullSafe(F.lag("_last").over(across))
    blocks = blocks.withColumn("_border", border.cast("long"))
    blocks = blocks.select(*[F.col(g).alias(f"_s_{g}") for g in group], F.col("_block").alias("_sblock"),
                           (F.sum(F.col("_border") + F.col("_changes")).over(across) - F.col("_changes")).alias("_offset"))
    cond = reduce(lambda a, b: a & b, [rows["_block"] == blocks["_sblock"]]
                  + [rows[g].eqNullSafe(blocks[f"_s_{g}"]) for g in group])
    return (rows.join(blocks, cond).withColumn("_run", F.col("_local") + F.col("_offset"))
             .groupBy(*group, value, "_run")
             .agg(F.min("_g").alias("start_seq"), F.max("_g").alias("end_seq"),
                  F.count(F.lit(1)).alias("n_rows"), *extra_aggs)
             .drop("_run"))
