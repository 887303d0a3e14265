"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import store


def _star(e: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u, v) with u > v: every node points its greater
    (large) or smaller (small) neighbours at the least node it knows."""
    if large:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        out = e.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge; the component is its
    least node. Loops and repeated edges are fine, nulls are ignored.

    Runs until every node points straight at a root; every round is written to shared storage, so
    its lineage is one round long.
    """
    e = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))) \
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e = store(e, "cc-edges")

    def unfinished(x):
        """Nodes with two targets, or pointing at a node that points on."""
        twice = x.groupBy("u").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("u")
        return twice.union(x.join(x.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u"))

    while not unfinished(e).isEmpty():
        e = store(_star(_star(e, True), False), "cc-round")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def joined(comp: DataFrame, edges: DataFrame) -> DataFrame:
    """(c, component) after further ``edges`` (a, b) between nodes: ``comp`` (c, component) holds the
    components so far, nodes that it lacks stand alone. Only the edges between different
    components are followed, so a large component costs nothing again."""
    mine = comp.select(F.col("c").alias("node"), F.col("component").alias("label"))
    ends = edges.select("a", "b").distinct()
    for k in ("a", "b"):
        ends = ends.join(mine.select(F.col("node").alias(f"n{k}"), F.col("label").alias(f"l{k}")), F.col(k) == F.col(f"n{k}"), "left")
    ends = store(ends.select("a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb")).where("la <> lb"), "cc-between")
    if ends.isEmpty():
        return comp
    merged = store(components(ends.select(F.col("la").alias("a"), F.col("lb").alias("b"))), "cc-merged")
    known = comp.join(merged.select("node", F.col("component").alias("new")), F.col("component") == F.col("node"), "left") \
        .select("c", F.coalesce("new", "component").alias("component"))
    alone = ends.select(F.col("a").alias("c"), F.col("la").alias("label")).union(ends.select("b", "lb")).where("c = label").distinct() \
        .join(comp.select("c"), "c", "left_anti").join(merged.select("node", "component"), F.col("c") == F.col("node")).select("c", "component")
    return store(known.unionByName(alone), "components")
