"""Null rules of the flat-table analyses."""

from pyspark.sql import functions as F

from vigil.operators import quality
from vigil.operators.coauthor import coauthor_counts, coauthor_pair_counts


def _acts(spark):
    rows = [(1, "A", "P", 10, "t", None), (2, "B", "P", 10, "t", None), (3, "C", None, 10, "t", "s"),
            (4, None, "P", 10, "t", None), (1, "A", "P", None, "t", "s"), (2, "B", "P", None, "t", "s")]
    return spark.createDataFrame(rows, "mp_id long, mp_name string, mp_party string, act_id long, "
                                       "act_type string, act_subtype string")


def test_null_keys_match_null_keys_and_null_groups_drop(spark):
    df = _acts(spark)
    n = {(r.mp_name, r.act_id): r.n_coauthors for r in coauthor_counts(df).collect()}
    # (t, NULL, 10) is shared by A and B (NULL subtype matches NULL); C holds (t, s, 10);
    # NULL member is never a co-author; NULL ids form no group
    assert n == {("A", 10): 2, ("B", 10): 2, ("C", 10): 1}
    pairs = {r.act_type: (r.n_pair_rows, r.n_member_pairs) for r in coauthor_pair_counts(df).collect()}
    # keys: (t,NULL,10): 3 rows, members A,B -> 9, 4; (t,s,10): 1,1; (t,s,NULL): 2 rows A,B -> 4, 4
    assert pairs == {"t": (9 + 1 + 4, 4 + 1 + 4)}
    g = {(r.act_type, r.act_subtype): r.n_distinct for r in
         quality.distinct_per_group(df, ["act_type", "act_subtype"], "act_id").collect()}
    assert g == {("t", "s"): 1}                       # NULL subtype group dropped, NULL id not counted


def test_void_typed_key_column(spark):
    df = _acts(spark).withColumn("act_subtype", F.lit(None))   # VOID type, all NULL
    n = {(r.mp_name, r.act_id): r.n_coauthors for r in coauthor_counts(df).collect()}
    # all subtypes NULL: (t, NULL, 10) is one key shared by A, B and C
    assert n == {("A", 10): 3, ("B", 10): 3, ("C", 10): 3}


def test_profiles_count_nulls(spark):
    df = _acts(spark)
    prof = {r.column_name: (r.n_null, r.n_non_null) for r in quality.null_profile(df).collect()}
    assert prof["act_subtype"] == (3, 3) and prof["mp_name"] == (1, 5)
    miss = quality.missing_profile(df.withColumnRenamed("act_subtype", "act_date"), "act_date",
                                   ["act_type"]).collect()
    assert miss[0].n_mp_name == 2 and miss[0].n_act_id == 3


def test_approx_distinct_option_close_to_exact(spark):
    df = spark.range(0, 20000).select((F.col("id") % 3).cast("string").alias("g"),
                                      (F.col("id") % 5000).alias("v"))
    exact = {r.g: r.n_distinct for r in quality.distinct_per_group(df, ["g"], "v").collect()}
    approx = {r.g: r.n_distinct for r in quality.distinct_per_group(df, ["g"], "v", approx=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - exact[k]) <= 0.1 * exact[k] for k in exact)
