"""Queries over stored files: large files, each read by many tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.operators import quality
from vigil.operators.activity import split_activity, tag_activity
from vigil.operators.reconcile import Counts
from vigil.plans import derived
from vigil.plans.registry import query
from vigil.plans.tables import ACT_SQL, activity_rows, load
from vigil.session import scratch_path
from vigil.sources import delimited, split_text
from vigil.streaming import incremental

#: Copies of the documents, so that a file has several splits.
COPIES = 2
#: Text in one file, about: a task writes it, several read it.
FILE_BYTES = 1 << 28


def _copied(spark, sf):
    return load(spark, sf, "documents").select(F.explode(F.sequence(F.lit(1), F.lit(COPIES))).alias("k"), "doc_id", "lang", "text")


def _files(rows, column: str) -> int:
    """Files that ``rows`` make; the text of each is about ``FILE_BYTES``, so no task writes more as tables grow."""
    return -(-(rows.agg(F.sum(F.octet_length(column))).first()[0] or 1) // FILE_BYTES)


@query("csv_split_roundtrip", f"""
SELECT k::INTEGER AS k, doc_id, lang, chr(10) || '"' || text || '|' || chr(10) || doc_id AS text FROM documents, (SELECT unnest(range(1, {COPIES + 1})) AS k)""")
def q_csv_split_roundtrip(spark, sf):
    """Documents, with further line breaks, quotes and separators, written as pipe CSV files (one
    for each 256 MB), and each read back by several tasks."""
    d = _copied(spark, sf).withColumn("text", F.concat(F.lit("\n\""), "text", F.lit("|\n"), F.col("doc_id").cast("string")))
    path = scratch_path(spark, "csv-one-file")
    delimited.write_pipe_csv(d.repartition(_files(d, "text")), path)
    return split_text.read_quoted_csv(spark, path, "k int, doc_id long, lang string, text string", na_tokens=False)


@query("json_split_scan", f"""
SELECT 'record' AS part, k::INTEGER AS k, doc_id, lang, '"}}]' || text || chr(92) AS text FROM documents, (SELECT unnest(range(1, {COPIES + 1})) AS k)
UNION ALL SELECT 'bad', NULL, NULL, 'not a JSON document', NULL""")
def q_json_split_scan(spark, sf):
    """Exports of all documents, each in a single line (one for each 256 MB), and as many as a third of them
    takes that are cut off, each read by several tasks; the texts hold braces, quotes and backslashes."""
    path = scratch_path(spark, "json-one-file")
    docs = load(spark, sf, "documents").select(F.lit(1).alias("o"), "doc_id", "lang", F.concat(F.lit('"}]'), "text", F.lit("\\")).alias("text"))

    def lines(d):  # as many records of a document as it has copies; the ends of an export as they are
        one = F.to_json(F.struct("k", "doc_id", F.struct("lang", "text").alias("body")))
        k = F.when(F.col("o") == 1, F.sequence(F.lit(1), F.lit(COPIES))).otherwise(F.array(F.lit(0)))
        return d.select("*", F.explode(k).alias("k")).select(F.when(F.col("o") == 1, F.concat(F.lit(","), one)).otherwise(F.col("text")).alias("value"))

    def write(d, name, last=None):
        n = _files(lines(d), "value")
        ends = lambda o, text: spark.range(n).select(F.lit(o).alias("o"), F.lit(0).cast("long").alias("doc_id"), F.lit("").alias("lang"),
                                                     F.lit(text).alias("text"), F.col("id").cast("int").alias("part"))
        # documents are dealt out before they are copied
        whole = d.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int")) \
            .unionByName(ends(0, '{"?xml":{"@version":"1.0"},"ArrayOfText":{"Text":[{"k":0,"doc_id":-1,"body":{}}'))
        whole = (whole if last is None else whole.unionByName(ends(2, last))).repartitionById(n, F.col("part"))
        lines(whole.sortWithinPartitions("o", "doc_id")).write.option("lineSep", " ").text(path + name)
        return n

    write(docs, "/whole", "]}}")
    cut = write(docs.where("doc_id % 3 = 0"), "/cut")
    records, bad = split_text.read_json_records(spark, [path + "/whole", path + "/cut"], "ArrayOfText.Text")
    r = records.select(F.from_json("record", "k int, doc_id long, body struct<lang: string, text: string>").alias("r")).select("r.k", "r.doc_id", "r.body.*").where("doc_id >= 0")
    bad = bad.groupBy("error_reason").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == cut)  # what all cut exports are refused for
    none = F.lit(None)
    return r.select(F.lit("record").alias("part"), "*").unionByName(
        bad.select(F.lit("bad").alias("part"), none.cast("int").alias("k"), none.cast("long").alias("doc_id"), F.col("error_reason").alias("lang"), none.cast("string").alias("text")))


#: Lots that the documents land in; some contents land again with a later lot.
LOTS = 4


@query("lot_ingest", f"""
WITH d AS (SELECT doc_id, text, doc_id % {LOTS} AS lot FROM documents),
f AS (SELECT md5(text) AS content_md5, min(lot) AS lot FROM d GROUP BY 1)
SELECT 'content' AS part, content_md5, lot::INTEGER AS lot, NULL::BIGINT AS n FROM f
UNION ALL SELECT 'lot', NULL, l.lot::INTEGER, count(f.lot) FROM (SELECT unnest(range({LOTS})) AS lot) l LEFT JOIN f ON f.lot = l.lot GROUP BY l.lot
UNION ALL SELECT 'again', NULL, NULL, 0""")
def q_lot_ingest(spark, sf):
    """Documents landed in four lots, each ingested by a batch job without operator state, and a
    last run that finds nothing new: every content once, from the lot that had it first."""
    base = scratch_path(spark, "lots")
    d = load(spark, sf, "documents").select("doc_id", "text")
    landed = []
    for lot in range(LOTS):
        d.where(F.col("doc_id") % LOTS == lot).write.parquet(f"{base}/landing/{lot}")
        landed.append(incremental.ingest_lot(spark, base + "/landing", base + "/store", "doc_id bigint, text string", "text", lot=f"l{lot}", prefix=1))
    again = incremental.ingest_lot(spark, base + "/landing", base + "/store", "doc_id bigint, text string", "text")
    counts = spark.createDataFrame([("lot", None, i, n) for i, n in enumerate(landed)] + [("again", None, None, again)], "part string, content_md5 string, lot int, n long")
    kept = incremental.seen(spark, base + "/store", 0)
    return counts.unionByName(kept.select(F.lit("content").alias("part"), "content_md5", F.substring("lot", 2, 9).cast("int").alias("lot"), F.lit(None).cast("long").alias("n")))


@query("distinct_sketches", f"""
WITH act AS {ACT_SQL},
e AS (SELECT 'type' AS level, act_type, NULL AS act_subtype, count(DISTINCT act_id) AS n FROM act WHERE act_type IS NOT NULL GROUP BY act_type
      UNION ALL SELECT 'subtype', act_type, act_subtype, count(DISTINCT act_id) FROM act WHERE act_type IS NOT NULL AND act_subtype IS NOT NULL GROUP BY act_type, act_subtype
      UNION ALL SELECT 'party', mp_party, NULL, count(DISTINCT act_id) FROM act WHERE mp_party IS NOT NULL GROUP BY mp_party)
SELECT level, act_type AS key, act_subtype AS subkey, n::BIGINT AS n_exact, TRUE AS within_bound FROM e""")
def q_distinct_sketches(spark, sf):
    """Distinct activities per type, per type and subtype and per party, all merged from one stored
    table of sketches per party, type and subtype, against the exact counts: within the
    stated error (three standard deviations)."""
    act = activity_rows(spark, sf)
    path = scratch_path(spark, "sketches")
    half = F.col("mp_id") % 2 == 0  # two loads, each with sketches of its own
    for part in (half, ~half | half.isNull()):
        quality.sketch_table(act.where(part), ["mp_party", "act_type", "act_subtype"], "act_id").write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    out = None
    for level, keys in (("type", ["act_type"]), ("subtype", ["act_type", "act_subtype"]), ("party", ["mp_party"])):
        exact = quality.distinct_per_group(act, keys, "act_id")
        name = [c for c in exact.columns if c not in keys][0]
        both = exact.withColumnRenamed(name, "n_exact").join(quality.merged_distinct(stored, keys, "n_estimated"), keys, "left")
        near = F.abs(F.col("n_estimated") - F.col("n_exact")) <= F.greatest(F.lit(1.0), F.col("n_exact") * quality.sketch_error())
        sub = F.col(keys[1]) if len(keys) > 1 else F.lit(None).cast("string")
        one = both.select(F.lit(level).alias("level"), F.col(keys[0]).alias("key"), sub.alias("subkey"), F.col("n_exact").cast("long").alias("n_exact"),
                          F.coalesce(near, F.lit(False)).alias("within_bound"))
        out = one if out is None else out.unionByName(one)
    return out


@query("activity_reconcile", """
WITH l AS (SELECT l_orderkey AS o, CAST((l_orderkey + l_linenumber) % 12 AS INTEGER) AS kind FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
t AS (SELECT count(*) AS n, count(DISTINCT o) AS members FROM l)
SELECT 'records' AS step, 'records' AS metric, n FROM t UNION ALL SELECT 'records', 'activities', n FROM t UNION ALL SELECT 'records', 'quarantined', 0 FROM t
UNION ALL SELECT 'groups', 'records', n FROM t UNION ALL SELECT 'members', 'members', members FROM t
UNION ALL SELECT 'table', 'activities', n FROM t UNION ALL SELECT 'table', 'quarantined', 0 FROM t
UNION ALL SELECT 'left over', 'entries', 0 UNION ALL SELECT 'left over', 'records', 0 UNION ALL SELECT 'left over', 'judged', 0""")
def q_activity_reconcile(spark, sf):
    """Counts observed while all activity codes are flattened, beside the rows of the two tables that the
    job leaves, and what no count accounts for."""
    counts = Counts()
    path = scratch_path(spark, "reconcile")
    tag_activity(derived.all_code_records(spark, sf), counts=counts).write.parquet(path)
    good, bad = split_activity(spark.read.parquet(path))
    n = lambda df, m: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit("table").alias("step"), F.lit(m).alias("metric"), "n")
    e, g, r = counts.of("entries"), counts.of("groups"), counts.of("records")
    left = [("left over", "entries", e["entries"] - e["skipped"] - e["null"] - counts.of("kept")["entries"]),
            ("left over", "records", g["records"] - r["records"]), ("left over", "judged", r["records"] - r["activities"] - r["quarantined"])]
    wanted = F.concat_ws(".", "step", "metric").isin("records.records", "records.activities", "records.quarantined", "groups.records", "members.members")
    return counts.frame(spark).where(wanted).unionByName(spark.createDataFrame(left, "step string, metric string, n long")) \
        .unionByName(n(good, "activities")).unionByName(n(bad, "quarantined"))
