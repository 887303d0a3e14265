"""Mix sources to target weights by Pareto order sampling.

Targets are solved first (``targets``), then every document gets its whole
certain copies, and one more copy goes to a fixed-size sample: documents are
ranked by their random odds over their inclusion odds, and the sample is the
front of that order. The front is found by two rounds of bucket sums and one
tiny exact round, so no source, however hot, is ever ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import pick, space_words, store
from vigil.operators.sequence import ordered_index

#: Buckets per level of the search for a source's cut.
LEVEL = 4096


def random_unit(key: Column, seed: str) -> Column:
    """Uniform in (0, 1), a pure function of the key: reruns and retried tasks agree."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(2 ** 52))


def document_unit(doc_id: Column, text: Column, seed: str) -> Column:
    """The random number of a document: of its id and text, so that rows that share an
    id, or have none, are drawn one by one; equal rows have equal numbers."""
    return random_unit(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))), seed)


def pareto_rank(u: Column, p: Column) -> Column:
    """The Pareto order key odds(u) / odds(p), mapped monotonically to (0, 1)."""
    key = (u / (1 - u)) / (p / (1 - p))
    return key / (1 + key)


def targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``sizes`` (source, source_size) to source, source_size, target.

    Sources in code-point order, null last, take the weights in turn and split
    ``share`` of all sizes by weight; a target stops at ``cap`` times its
    source's size and the excess is shared again by weight until none is above.
    In closed form: sources are full in the order of cap over weight, and the
    others get one common amount per unit of weight. The windows run over one
    row per source. An empty table gives an empty table.
    """
    whole = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))).cast("int") + 1)
    full = F.lit(float(cap)) * F.col("source_size")
    upto = Window.orderBy("ratio").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    budget = F.lit(float(share)) * F.sum("source_size").over(whole)
    t = (sizes.withColumn("weight", w).withColumn("full", full)
         .withColumn("ratio", F.col("full") / F.col("weight"))
         .withColumn("budget", budget)
         .withColumn("full_before", F.sum("full").over(upto))
         .withColumn("weight_after", F.sum("weight").over(whole) - F.sum("weight").over(upto))
         .withColumn("stops", F.col("full_before") + F.col("ratio") * F.col("weight_after") <= F.col("budget")))
    left = F.max("budget").over(whole) - F.coalesce(F.sum(F.when(F.col("stops"), F.col("full"))).over(whole), F.lit(0.0))
    unit = left / F.sum(F.when(~F.col("stops"), F.col("weight"))).over(whole)
    return t.withColumn("unit", unit).select(
        "source", "source_size",
        F.when(F.col("stops"), F.col("full")).otherwise(F.col("unit") * F.col("weight")).alias("target"))


def _cut(parts: DataFrame, bucket: str) -> DataFrame:
    """The bucket of each source in which its sample ends: source, bucket, what
    the sample still needs from it. ``parts``: source, bucket, part, need."""
    w = Window.partitionBy("source").orderBy(bucket)
    before = F.sum("part").over(w) - F.col("part")
    return (parts.withColumn("before", before)
            .where((F.col("before") <= F.col("need")) & (F.col("before") + F.col("part") > F.col("need")))
            .select("source", F.col(bucket), (F.col("need") - F.col("before")).alias("need")))


def sample_cuts(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source: copies (certain, whole), chance (of one more) and cut, the
    greatest Pareto rank in the sample.

    ``rows``: source, size, u. ``goals``: source, source_size, target. The
    sample's size is the target less the certain copies, in words, met to
    within half the document at the cut (which is in if that comes nearer).
    Equal rank have only rows that are equal in doc_id and text; at the cut as many
    of them are in (``cut_rows``) as comes nearest to the target.
    """
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goals = (goals.withColumn("copies", F.floor(rate).cast("bigint")).withColumn("chance", rate - F.floor(rate))
             .withColumn("need", F.col("target") - F.col("copies") * F.col("source_size")))
    goals = store(goals, "mix-goals")
    chance = goals.where("chance > 0").select(F.col("source").alias("s"), "chance", "need")
    ranked = (rows.join(chance, F.col("source").eqNullSafe(F.col("s")))
              .withColumn("rank", pareto_rank(F.col("u"), F.col("chance")))
              .withColumn("b1", F.floor(F.col("rank") * LEVEL).cast("int"))
              .withColumn("b2", F.floor(F.col("rank") * LEVEL * LEVEL).cast("bigint"))
              .drop("s", "chance"))
    one = _cut(ranked.groupBy("source", "b1").agg(F.sum("size").alias("part"), F.first("need").alias("need")), "b1")
    one = store(one, "mix-cut1").select(F.col("source").alias("s1"), F.col("b1").alias("c1"), F.col("need").alias("n1"))
    inner = (ranked.drop("need").join(one, F.col("source").eqNullSafe(F.col("s1")) & (F.col("b1") == F.col("c1")))
             .withColumnRenamed("n1", "need"))
    two = _cut(inner.groupBy("source", "b2").agg(F.sum("size").alias("part"), F.first("need").alias("need")), "b2")
    two = store(two, "mix-cut2").select(F.col("source").alias("s2"), F.col("b2").alias("c2"), F.col("need").alias("n2"))
    last = (ranked.drop("need").join(two, F.col("source").eqNullSafe(F.col("s2")) & (F.col("b2") == F.col("c2")))
            .groupBy("source", "rank").agg(F.sum("size").alias("part"), F.max("size").alias("each"), F.first("n2").alias("need")))
    w = Window.partitionBy("source").orderBy("rank")
    cut = (last.withColumn("after", F.sum("part").over(w)).withColumn("before", F.col("after") - F.col("part"))
           .where((F.col("before") <= F.col("need")) & (F.col("after") > F.col("need")))
           .select(F.col("source").alias("s"), F.col("rank").alias("cut"),
                   F.ceil((F.col("need") - F.col("before")) / F.col("each") - 0.5).cast("bigint").alias("cut_rows")))
    return (goals.join(cut, F.col("source").eqNullSafe(F.col("s")), "left")
            .select("source", "source_size", "target", "copies", "chance", "cut", F.coalesce("cut_rows", F.lit(0)).alias("cut_rows")))


def _light(docs: DataFrame, seed: str, id_col: str, text_col: str, source_col: str) -> DataFrame:
    d = pick(docs, doc_id=id_col, text=text_col, source=source_col)
    return d.select("doc_id", F.col("source"), F.size(space_words(F.col("text"))).cast("bigint").alias("size"),
                    document_unit(F.col("doc_id"), F.col("text"), seed).alias("u"))


def mix_plan(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: str = "mix",
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"):
    """(rows, cuts): the one reading of the texts, and one row per source.

    Null text has size 0 and is always in the sample at no cost of words; null
    source is a source of its own; rows without a doc_id are drawn by their texts.
    """
    rows = store(_light(docs, seed, id_col, text_col, source_col), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    return rows, store(sample_cuts(rows, targets(sizes, weights, share, cap)), "mix-cuts")


def _copies(rows: DataFrame, cuts: DataFrame, source: str, u: str) -> DataFrame:
    """``rows`` with ``_copies``. Rows at a source's cut are equal ones; they are numbered (over all
    tasks, however many they are) and the first ``cut_rows`` have one more copy."""
    c = cuts.select(F.col("source").alias("_cs"), *[F.col(x).alias("_c_" + x) for x in cuts.columns if x != "source"])
    d = rows.join(c, F.col(source).eqNullSafe(F.col("_cs")), "left").withColumn(
        "_rank", F.when(F.col("_c_chance") > 0, pareto_rank(F.col(u), F.col("_c_chance"))))
    at_cut = F.coalesce(F.col("_rank") == F.col("_c_cut"), F.lit(False))
    more = (F.col("_c_chance") > 0) & (F.col("_c_cut").isNull() | (F.col("_rank") < F.col("_c_cut")))
    plain = d.where(~at_cut).withColumn("_copies", F.col("_c_copies") + more.cast("bigint"))
    tied = ordered_index(d.where(at_cut), ["_cs"], [u], "_nth").withColumn("_copies", F.col("_c_copies") + (F.col("_nth") <= F.col("_c_cut_rows")).cast("bigint"))
    return plain.unionByName(tied.drop("_nth")).drop("_rank")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per input row."""
    rows, cuts = mix_plan(docs, **options)
    return _copies(rows, cuts, "source", "u").select(
        "doc_id", "size", F.col("_c_source_size").alias("source_size"), F.col("_c_target").alias("target"),
        (F.col("_copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: str = "mix",
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixture itself: the rows of ``docs``, each as often as it is taken."""
    _, cuts = mix_plan(docs, weights, share, cap, seed, id_col, text_col, source_col)
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*names).alias("_row"), F.col(f"`{source_col}`").alias("_source"),
                       document_unit(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), seed).alias("_u"))
    taken = _copies(rows, cuts, "_source", "_u").where("_copies > 0")
    return taken.select("_row", F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int")))).select("_row.*")


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
         (('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT + 0.5::DOUBLE)
           / 4503599627370496::DOUBLE AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
        2.0::DOUBLE * source_size AS full_size FROM s),
r AS (SELECT *, full_size / weight AS ratio, 1.5::DOUBLE * (SELECT sum(source_size) FROM s)::DOUBLE AS budget FROM w),
f AS (SELECT a.source, a.source_size, a.weight, a.full_size, a.budget,
        (SELECT sum(least(b.full_size, a.ratio * b.weight)) FROM r b) <= a.budget AS stops FROM r a),
g AS (SELECT source, source_size,
        CASE WHEN stops THEN full_size ELSE
          ((SELECT max(budget) FROM f) - coalesce((SELECT sum(full_size) FROM f WHERE stops), 0))
          / (SELECT sum(weight) FROM f WHERE NOT stops) * weight END AS target FROM f),
p AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM g),
q AS (SELECT d.doc_id, d.size, d.u, p.source, p.source_size, p.target, floor(p.rate)::BIGINT AS copies,
        p.rate - floor(p.rate) AS chance FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
o AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY u)::DOUBLE AS after,
        sum(size) OVER (PARTITION BY source, u)::DOUBLE AS part, target - copies * source_size AS need FROM q)
SELECT doc_id, size, source_size, target,
  (copies + CASE WHEN chance <= 0 THEN 0 WHEN after <= need THEN 1
                 WHEN after - part > need THEN 0
                 WHEN row_number() OVER (PARTITION BY source, u ORDER BY doc_id) <= ceil((need - (after - part)) / size - 0.5) THEN 1 ELSE 0 END)::BIGINT * size AS taken
FROM o"""
