"""Load the driver tables and derive the record shapes the queries run on.

``activity_rows`` (ACT) maps the star schema onto the member-activity table:
one row per lineitem, with a member (supplier), a party (nation), an activity
id (part), type/subtype (return flag / line status) and injected NULLs so the
null rules are exercised. ``initiative_rows`` (INI) maps orders onto the
initiative table with an author count per order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import table_path

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def activity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ACT: lineitem ⋈ supplier ⋈ nation ⋈ part, with NULLs injected.

    Dimension sides are not hinted: supplier and part grow with the scale
    factor, so AQE picks broadcast or shuffle from runtime sizes.
    """
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate")
    su = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    na = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    pa = load(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = (li.join(su, li.l_suppkey == su.s_suppkey)
           .join(na, su.s_nationkey == na.n_nationkey)
           .join(pa, li.l_partkey == pa.p_partkey))
    return j.select(
        F.col("l_suppkey").alias("mp_id"),
        F.col("s_name").alias("mp_name"),
        F.col("n_name").alias("mp_party"),
        F.col("l_partkey").alias("act_id"),
        F.col("l_returnflag").alias("act_type"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
         .otherwise(F.col("l_linestatus")).alias("act_subtype"),
        F.concat_ws("/", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("act_dar"),
        F.when(F.col("l_linenumber") == 1, F.lit(None).cast("string"))
         .otherwise(F.to_date("l_shipdate").cast("string")).alias("act_date"),
        F.when(F.col("l_quantity") < 5, F.lit(None).cast("string"))
         .otherwise(F.col("p_name")).alias("act_desc"),
    )


ACT_SQL = """(
  SELECT l.l_suppkey AS mp_id, s.s_name AS mp_name, n.n_name AS mp_party,
         l.l_partkey AS act_id, l.l_returnflag AS act_type,
         CASE WHEN l.l_linenumber = 7 THEN NULL ELSE l.l_linestatus END AS act_subtype,
         CAST(l.l_orderkey AS VARCHAR) || '/' || CAST(l.l_linenumber AS VARCHAR) AS act_dar,
         CASE WHEN l.l_linenumber = 1 THEN NULL
              ELSE CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) END AS act_date,
         CASE WHEN l.l_quantity < 5 THEN NULL ELSE p.p_name END AS act_desc
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""


def initiative_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INI: one row per order; party = market segment; authors = lineitems.

    Lineitems are pre-aggregated per order (map-side partial count) before the
    join, so the shuffle carries one row per order, not per lineitem.
    """
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    n_li = (load(spark, sf_dir, "lineitem").groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("n_li")))
    return (o.join(c, o.o_custkey == c.c_custkey)
             .join(n_li, o.o_orderkey == n_li.l_orderkey, "left")
             .select(F.col("o_orderkey").alias("id"),
                     F.col("c_mktsegment").alias("party"),
                     F.coalesce(F.col("n_li"), F.lit(0)).cast("int").alias("number_authors")))


INI_SQL = """(
  SELECT o.o_orderkey AS id, c.c_mktsegment AS party,
         CAST(coalesce(li.n_li, 0) AS INTEGER) AS number_authors
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS n_li FROM lineitem GROUP BY l_orderkey) li
    ON o.o_orderkey = li.l_orderkey
)"""
