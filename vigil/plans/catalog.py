"""Query catalogue: one Spark builder per operator family and its DuckDB oracle.

Every builder takes (spark, sf_dir) and reads the whole driver tables (or data
Spark derives from them). Oracle SQL runs on DuckDB views of the same parquet
files; column names and types are aligned so results compare as bags.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from vigil.functions import arrays as A
from vigil.functions import jsonx as J
from vigil.functions import text as T
from vigil.operators import coauthor, frontier, histogram, layout, manifest, quality
from vigil.operators.activity import flatten_activity
from vigil.operators.initiative import flatten_initiatives, split_initiatives
from vigil.operators.lookup import map_with_default
from vigil.operators.sequence import runs
from vigil.plans import derived
from vigil.plans.registry import ORACLE, QUERIES, query
from vigil.plans.tables import ACT_SQL, INI_SQL, activity_rows, initiative_rows, load
from vigil.session import scratch_path
from vigil.sources import delimited
from vigil.sources import manifest as manifest_source
from vigil.sources.files import read_landed
from vigil.sources.markup import block_links, block_text
from vigil.sources.nested_json import bad_documents, read_documents, records
from vigil.sources.pages import page_links, page_title
from vigil.streaming import incremental

_CRAWL_TS = "2024-01-01 00:00:00"
_DOWNLOAD_TS = "2024-01-02 00:00:00"


def _act_sql(body: str) -> str:
    return f"WITH act AS {ACT_SQL}\n{body}"


def _ini_sql(body: str) -> str:
    return f"WITH ini AS {INI_SQL}\n{body}"


_WS_TRIM = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _trim_sql(x: str) -> str:
    return _WS_TRIM.format(x=x)


# --------------------------------------------------------------- co-authors
_COAUTHOR_N_SQL = """
m AS (SELECT a.mp_name, a.act_id, b.mp_name AS mp_name_co FROM act a JOIN act b
      ON a.act_type IS NOT DISTINCT FROM b.act_type
     AND a.act_subtype IS NOT DISTINCT FROM b.act_subtype
     AND a.act_id IS NOT DISTINCT FROM b.act_id),
na AS (SELECT mp_name, act_id, CAST(count(DISTINCT mp_name_co) AS BIGINT) AS n_coauthors
       FROM m WHERE mp_name IS NOT NULL AND act_id IS NOT NULL GROUP BY mp_name, act_id)"""


@query("coauthor_weight", _act_sql(f""", {_COAUTHOR_N_SQL},
d AS (SELECT DISTINCT a.mp_id, a.mp_name, a.mp_party, a.act_id, a.act_type, a.act_subtype,
             1.0::DOUBLE / na.n_coauthors AS act_weight
      FROM act a JOIN na ON a.mp_name = na.mp_name AND a.act_id = na.act_id)
SELECT mp_party, mp_name, round(sum(act_weight), 6) AS act_weight
FROM d WHERE mp_party IS NOT NULL GROUP BY mp_party, mp_name"""))
def q_coauthor_weight(spark, sf):
    """Co-author-weighted activity score per (party, member) on ACT, ascending."""
    return coauthor.coauthor_weights(activity_rows(spark, sf))


@query("coauthor_count", _act_sql(f""", {_COAUTHOR_N_SQL}
SELECT mp_name, act_id, n_coauthors FROM na"""))
def q_coauthor_count(spark, sf):
    """Distinct co-authors (member included) per (member, activity id) on ACT."""
    return coauthor.coauthor_counts(activity_rows(spark, sf))


@query("coauthor_pairs", _act_sql(""",
j AS (SELECT a.act_type, a.act_subtype, a.act_id, a.mp_name AS m1, b.mp_name AS m2
      FROM act a JOIN act b ON a.act_type = b.act_type
       AND a.act_subtype IS NOT DISTINCT FROM b.act_subtype
       AND a.act_id IS NOT DISTINCT FROM b.act_id),
r AS (SELECT act_type, CAST(count(*) AS BIGINT) AS n_pair_rows FROM j GROUP BY act_type),
p AS (SELECT act_type, CAST(count(*) AS BIGINT) AS n_member_pairs FROM
        (SELECT DISTINCT act_type, act_subtype, act_id, m1, m2 FROM j
         WHERE m1 IS NOT NULL AND m2 IS NOT NULL) GROUP BY act_type)
SELECT r.act_type, r.n_pair_rows, coalesce(p.n_member_pairs, 0) AS n_member_pairs
FROM r LEFT JOIN p ON r.act_type = p.act_type"""))
def q_coauthor_pairs(spark, sf):
    """Size of the activity-key self-join per type (row pairs, member pairs), without building it."""
    return coauthor.coauthor_pair_counts(activity_rows(spark, sf))


_EVENTS_ACT_SQL = """(SELECT user_id AS mp_id, 'U' || CAST(user_id AS VARCHAR) AS mp_name, event_type AS mp_party,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS act_id, event_type AS act_type,
        CASE WHEN value > 25 THEN 'high' ELSE 'low' END AS act_subtype FROM events)"""


@query("coauthor_weight_events", f"""WITH act AS {_EVENTS_ACT_SQL}, {_COAUTHOR_N_SQL},
d AS (SELECT DISTINCT a.mp_id, a.mp_name, a.mp_party, a.act_id, a.act_type, a.act_subtype,
             1.0::DOUBLE / na.n_coauthors AS act_weight
      FROM act a JOIN na ON a.mp_name = na.mp_name AND a.act_id = na.act_id)
SELECT mp_party, mp_name, round(sum(act_weight), 6) AS act_weight
FROM d WHERE mp_party IS NOT NULL GROUP BY mp_party, mp_name""")
def q_coauthor_weight_events(spark, sf):
    """Co-author weights on events: every (type, k) key is shared by many
    users, the dense-key case where a pairwise self-join grows quadratically."""
    ev = load(spark, sf, "events")
    act = ev.select(F.col("user_id").alias("mp_id"),
                    F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("mp_name"),
                    F.col("event_type").alias("mp_party"),
                    J.path("props", "$.k").cast("long").alias("act_id"),
                    F.col("event_type").alias("act_type"),
                    F.when(F.col("value") > 25, F.lit("high")).otherwise(F.lit("low")).alias("act_subtype"))
    return coauthor.coauthor_weights(act)


_WIDE_ACT_SQL = """(SELECT l_suppkey AS mp_id, 'S' || l_suppkey AS mp_name, l_linestatus AS mp_party, l_linenumber AS act_id, l_returnflag AS act_type,
        CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE CAST(l_partkey % 89 AS VARCHAR) END AS act_subtype FROM lineitem)"""


@query("coauthor_wide", f"""WITH act AS {_WIDE_ACT_SQL}, {_COAUTHOR_N_SQL}
SELECT mp_name, act_id, n_coauthors FROM na""")
def q_coauthor_wide(spark, sf):
    """Co-authors where an id has few keys to itself: every supplier holds a key set of
    its own, of up to 267 keys, on each of seven ids that all suppliers share."""
    n = F.col("l_partkey") % 89
    return coauthor.coauthor_counts(load(spark, sf, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("mp_name"), F.col("l_linenumber").alias("act_id"),
        F.col("l_returnflag").alias("act_type"), F.when(n != 0, n.cast("string")).alias("act_subtype")))


# ------------------------------------------------------------- data quality
@query("subtype_distinct", _act_sql("""
SELECT act_type, act_subtype, CAST(count(DISTINCT act_id) AS BIGINT) AS n_act_id FROM act
WHERE act_type IS NOT NULL AND act_subtype IS NOT NULL GROUP BY act_type, act_subtype"""))
def q_subtype_distinct(spark, sf):
    """Distinct activity ids per (type, subtype); NULL groups dropped."""
    return quality.distinct_per_group(activity_rows(spark, sf), ["act_type", "act_subtype"],
                                      "act_id", out="n_act_id")


@query("dup_by_member", _act_sql("""
SELECT mp_name, CAST(count(act_id) AS BIGINT) AS n_count,
       CAST(count(DISTINCT act_id) AS BIGINT) AS n_unique,
       CAST(count(act_id) - count(DISTINCT act_id) AS BIGINT) AS n_diff
FROM act WHERE mp_name IS NOT NULL GROUP BY mp_name
HAVING count(act_id) - count(DISTINCT act_id) > 0"""))
def q_dup_by_member(spark, sf):
    """Members whose activity ids repeat: count, distinct count, difference > 0."""
    return quality.count_vs_distinct(activity_rows(spark, sf), "mp_name", "act_id")


@query("dup_by_entity", _act_sql("""
SELECT mp_id, mp_name, mp_party, act_id, CAST(count(act_desc) AS BIGINT) AS n_desc FROM act
WHERE mp_id IS NOT NULL AND mp_name IS NOT NULL AND mp_party IS NOT NULL AND act_id IS NOT NULL
GROUP BY mp_id, mp_name, mp_party, act_id HAVING count(act_desc) > 2"""))
def q_dup_by_entity(spark, sf):
    """(member, party, id) groups with more than two non-null descriptions."""
    return quality.nonnull_count_over(activity_rows(spark, sf),
                                      ["mp_id", "mp_name", "mp_party", "act_id"], "act_desc", 2,
                                      out="n_desc")


@query("dup_by_entity_type", _act_sql("""
SELECT mp_id, mp_name, mp_party, act_type, act_id, CAST(count(act_desc) AS BIGINT) AS n_desc
FROM act WHERE mp_id IS NOT NULL AND mp_name IS NOT NULL AND mp_party IS NOT NULL
  AND act_type IS NOT NULL AND act_id IS NOT NULL
GROUP BY mp_id, mp_name, mp_party, act_type, act_id HAVING count(act_desc) > 1"""))
def q_dup_by_entity_type(spark, sf):
    """(member, party, type, id) groups with more than one non-null description."""
    return quality.nonnull_count_over(activity_rows(spark, sf),
                                      ["mp_id", "mp_name", "mp_party", "act_type", "act_id"],
                                      "act_desc", 1, out="n_desc")


RARE_THRESHOLD = 10


@query("rare_subtypes", f"""
SELECT event_type, user_id,
       CAST(count(DISTINCT CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS n_distinct_k
FROM events WHERE event_type IS NOT NULL AND user_id IS NOT NULL
GROUP BY event_type, user_id
HAVING count(DISTINCT CAST(json_extract_string(props, '$.k') AS BIGINT)) < {RARE_THRESHOLD}""")
def q_rare_subtypes(spark, sf):
    """(event type, user) groups with fewer than RARE_THRESHOLD distinct props.k values."""
    ev = load(spark, sf, "events").select("event_type", "user_id",
                                          J.path("props", "$.k").cast("long").alias("k"))
    return quality.rare_groups(ev, ["event_type", "user_id"], "k", RARE_THRESHOLD,
                               out="n_distinct_k")


_ACT_COLS = ["mp_id", "mp_name", "mp_party", "act_id", "act_type", "act_subtype", "act_dar",
             "act_date", "act_desc"]


@query("null_profile", _act_sql("\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS n_null, "
    f"CAST(count({c}) AS BIGINT) AS n_non_null FROM act" for c in _ACT_COLS)))
def q_null_profile(spark, sf):
    """NULL and non-NULL counts of every ACT column, in one pass."""
    return quality.null_profile(activity_rows(spark, sf).select(*_ACT_COLS))


_MISSING_OTHERS = [c for c in _ACT_COLS if c not in ("act_type", "act_subtype")]


@query("missing_date_profile", _act_sql(
    "\nSELECT act_type, act_subtype, "
    + ", ".join(f"CAST(count({c}) AS BIGINT) AS n_{c}" for c in _MISSING_OTHERS)
    + "\nFROM act WHERE act_date IS NULL AND act_type IS NOT NULL AND act_subtype IS NOT NULL"
      "\nGROUP BY act_type, act_subtype"))
def q_missing_date_profile(spark, sf):
    """Non-null counts per (type, subtype) over the rows without a date."""
    return quality.missing_profile(activity_rows(spark, sf).select(*_ACT_COLS), "act_date",
                                   ["act_type", "act_subtype"])


_ACT_SELECT = ", ".join(_ACT_COLS)


@query("filter_eq_string", _act_sql(f"\nSELECT {_ACT_SELECT} FROM act WHERE act_desc = 'red widget'"))
def q_filter_eq_string(spark, sf):
    """String equality filter on the description."""
    return activity_rows(spark, sf).where(F.col("act_desc") == "red widget")


@query("filter_conjunction", _act_sql(
    f"\nSELECT {_ACT_SELECT} FROM act WHERE act_subtype = 'F' AND act_type = 'R'"))
def q_filter_conjunction(spark, sf):
    """Conjunction of two equality filters."""
    return activity_rows(spark, sf).where((F.col("act_subtype") == "F") & (F.col("act_type") == "R"))


@query("filter_eq_numeric", _act_sql(f"\nSELECT {_ACT_SELECT} FROM act WHERE act_id = 1234"))
def q_filter_eq_numeric(spark, sf):
    """Numeric equality filter on the activity id (pushed into the scans)."""
    return activity_rows(spark, sf).where(F.col("act_id") == F.lit(1234).cast("long"))


@query("missing_date_rows", _act_sql(f"\nSELECT {_ACT_SELECT} FROM act WHERE act_date IS NULL"))
def q_missing_date_rows(spark, sf):
    """Rows whose date is NULL."""
    return activity_rows(spark, sf).where(F.col("act_date").isNull())


_STAT_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("basic_stats", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS n, "
    f"CAST(count(*) - count({c}) AS BIGINT) AS n_null, CAST(min({c}) AS DOUBLE) AS min, "
    f"CAST(max({c}) AS DOUBLE) AS max, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS stddev FROM lineitem" for c in _STAT_COLS))
def q_basic_stats(spark, sf):
    """Count, NULLs, min, max, mean, stddev of the numeric lineitem columns."""
    return quality.basic_stats(load(spark, sf, "lineitem"), _STAT_COLS)


# ------------------------------------------------------ initiatives (authors)
@query("authors_per_party", _ini_sql("""
SELECT party, number_authors, CAST(count(id) AS BIGINT) AS count FROM ini
WHERE party IS NOT NULL AND number_authors IS NOT NULL GROUP BY party, number_authors"""))
def q_authors_per_party(spark, sf):
    """Initiatives per (party, number of authors)."""
    ini = initiative_rows(spark, sf)
    return (ini.where(F.col("party").isNotNull() & F.col("number_authors").isNotNull())
            .groupBy("party", "number_authors").agg(F.count("id").alias("count")))


@query("authors_one_party", _ini_sql("""
SELECT number_authors, CAST(count(id) AS BIGINT) AS count FROM ini
WHERE party = 'BUILDING' AND number_authors IS NOT NULL GROUP BY party, number_authors"""))
def q_authors_one_party(spark, sf):
    """Initiatives per number of authors for one party."""
    return q_authors_per_party(spark, sf).where(F.col("party") == "BUILDING") \
        .select("number_authors", "count")


@query("author_histogram", _ini_sql("""
, st AS (SELECT party, CAST(min(number_authors) AS DOUBLE) AS lo0, CAST(max(number_authors) AS DOUBLE) AS hi0
         FROM ini WHERE party IS NOT NULL AND number_authors IS NOT NULL GROUP BY party),
s AS (SELECT party, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
                    CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM st),
e AS (SELECT s.party, s.lo, s.hi, b.bin,
             CASE WHEN b.bin - 1 = 10 THEN s.hi ELSE (b.bin - 1) * ((s.hi - s.lo) / 10.0) + s.lo END AS e_lo,
             CASE WHEN b.bin = 10 THEN s.hi ELSE b.bin * ((s.hi - s.lo) / 10.0) + s.lo END AS e_hi
      FROM s CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 11)) b),
v AS (SELECT i.party, CAST(i.number_authors AS DOUBLE) AS x FROM ini i
      WHERE i.party IS NOT NULL AND i.number_authors IS NOT NULL),
c AS (SELECT e.party, e.bin, count(v.x) AS n FROM e LEFT JOIN v ON e.party = v.party
        AND v.x >= e.e_lo AND (v.x < e.e_hi OR (e.bin = 10 AND v.x <= e.e_hi))
      GROUP BY e.party, e.bin)
SELECT e.party, e.bin, round(e.e_lo, 9) AS bin_lo, round(e.e_hi, 9) AS bin_hi,
       CAST(c.n AS BIGINT) AS count
FROM e JOIN c ON e.party = c.party AND e.bin = c.bin"""))
def q_author_histogram(spark, sf):
    """10-bin equal-width histogram of authors per party, zero-filled."""
    return histogram.group_histogram(initiative_rows(spark, sf), "party", "number_authors", 10)


# ------------------------------------------------------------------- JSON
@query("json_field", """
SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       CAST(count(*) AS BIGINT) AS n_events, CAST(count(DISTINCT user_id) AS BIGINT) AS n_users
FROM events GROUP BY 1""")
def q_json_field(spark, sf):
    """Events grouped by a JSON path value (props.k)."""
    ev = load(spark, sf, "events")
    return (ev.groupBy(J.path("props", "$.k").cast("long").alias("k"))
            .agg(F.count(F.lit(1)).alias("n_events"), F.countDistinct("user_id").alias("n_users")))


_ITEM = StructType([StructField("l_linenumber", IntegerType()), StructField("l_partkey", LongType()),
                    StructField("l_suppkey", LongType()), StructField("l_quantity", DoubleType()),
                    StructField("l_returnflag", StringType())])


@query("json_polymorphic_explode", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag FROM lineitem""")
def q_json_polymorphic_explode(spark, sf):
    """Order documents with object-or-array items, flattened back to lineitems."""
    docs = derived.order_item_documents(spark, sf)
    items = docs.select(J.path("doc", "$.order").cast("long").alias("l_orderkey"),
                        F.explode(J.record_array(J.path("doc", "$.items.Item"), _ITEM)).alias("it"))
    return items.select("l_orderkey", "it.*")


@query("json_map_flatten", """
SELECT CAST(o.o_orderkey AS VARCHAR) AS mp_id, 'Cust#' || CAST(o.o_custkey AS VARCHAR) AS mp_name,
       o.o_orderpriority AS mp_party, o.o_orderstatus AS mp_status,
       CAST(l.l_partkey AS VARCHAR) AS act_id,
       CASE l.l_returnflag WHEN 'A' THEN 'par' WHEN 'N' THEN 'req' ELSE 'rin' END AS act_type,
       l.l_linestatus AS act_subtype,
       CASE WHEN l.l_returnflag = 'N'
            THEN CAST(l.l_linenumber AS VARCHAR) || '/' || CAST(l.l_suppkey AS VARCHAR) || '/'
                 || CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR)
            ELSE CAST(l.l_linenumber AS VARCHAR) || '/' || CAST(l.l_suppkey AS VARCHAR) END AS act_dar,
       CASE WHEN l.l_returnflag = 'R' THEN '' ELSE CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) END AS act_date,
       p.p_name AS act_desc
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey""")
def q_json_map_flatten(spark, sf):
    """Member-activity records (type map as data, wrappers, reporters) flattened."""
    good, _bad = flatten_activity(derived.member_activity_records(spark, sf))
    return good.select("mp_id", "mp_name", "mp_party", "mp_status", "act_id", "act_type",
                       "act_subtype", "act_dar", "act_date", "act_desc")


@query("activity_all_codes", """
WITH l AS (SELECT l.*, p.p_name, CAST((l_orderkey + l_linenumber) % 12 AS INTEGER) AS kind, CAST(l_linenumber AS VARCHAR) AS a,
                  CAST(l_suppkey AS VARCHAR) AS b, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS c,
                  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
SELECT CAST(l_orderkey AS VARCHAR) AS mp_id, CAST(l_partkey AS VARCHAR) AS act_id,
       ['par', 'adt', 'adc', 'tra', 'eve', 'int', 'ini', 'req', 'rin', 'rpe', 'rie', 'rcp'][kind + 1] AS act_type,
       CASE kind WHEN 9 THEN 'relatores peticoes' WHEN 10 THEN 'relatores iniciativas europeias'
                 WHEN 11 THEN 'relatores contas publicas' ELSE l_linestatus END AS act_subtype,
       CASE WHEN kind IN (5, 6) THEN a || '/' || b || '/' || c || '/x' WHEN kind IN (7, 9) THEN a || '/' || b || '/' || c
            WHEN kind IN (1, 10) THEN a WHEN kind = 11 THEN '' ELSE a || '/' || b END AS act_dar,
       CASE WHEN kind IN (6, 8, 9, 11) THEN '' ELSE day END AS act_date, p_name AS act_desc
FROM l""")
def q_activity_all_codes(spark, sf):
    """All twelve activity codes, four reporter sub-keys and seven skipped keys."""
    good, _bad = flatten_activity(derived.all_code_records(spark, sf))
    return good.select("mp_id", "act_id", "act_type", "act_subtype", "act_dar", "act_date", "act_desc")


_INI_ORDER = "l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_shipdate DESC"


@query("initiative_flatten", f"""
WITH li AS (SELECT l.*, o.o_orderstatus, o.o_orderpriority, CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) AS day
            FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
base AS (SELECT l_orderkey, o_orderstatus, o_orderpriority,
                string_agg(DISTINCT l_returnflag, ' ' ORDER BY l_returnflag) AS party,
                string_agg('S' || CAST(l_suppkey AS VARCHAR), ', '
                           ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate) AS authors,
                CAST(count(*) AS INTEGER) AS number_authors
         FROM li GROUP BY l_orderkey, o_orderstatus, o_orderpriority),
entry AS (SELECT l_orderkey, day AS entry_date FROM (
            SELECT l_orderkey, day, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_INI_ORDER}) AS rn
            FROM li WHERE l_linestatus = 'O') WHERE rn = 1),
pub AS (SELECT l_orderkey,
               CASE WHEN l_quantity > 25 THEN day || ' ' || day ELSE day END AS publication_date,
               CASE WHEN l_quantity > 10 THEN CAST(l_partkey AS VARCHAR) || '/' ELSE '' END
                 || CAST(l_linenumber AS VARCHAR) || '/II-' || l_returnflag || '/XV/1'
                 || CASE WHEN l_quantity > 25 THEN ' ' || CAST(l_partkey AS VARCHAR) || '/I série/XV/2' ELSE '' END
                 AS dar_ref
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_INI_ORDER}) AS rn
              FROM li WHERE l_linestatus = 'F' AND l_returnflag <> 'N') WHERE rn = 1)
SELECT CAST(b.l_orderkey AS VARCHAR) || '/' || b.o_orderstatus || '/XV/1' AS id, b.party,
       replace(replace({_trim_sql("'  ' || b.o_orderpriority || '\\nOrder' || chr(10) || 'text  '")}, '\\n', ' '),
               chr(10), ' ') AS title,
       'https://files.example.org/ini/' || CAST(b.l_orderkey AS VARCHAR) AS text_url,
       e.entry_date, p.publication_date, p.dar_ref, b.authors, b.number_authors
FROM base b LEFT JOIN entry e ON b.l_orderkey = e.l_orderkey LEFT JOIN pub p ON b.l_orderkey = p.l_orderkey""")
def q_initiative_flatten(spark, sf):
    """Initiative records (parties, authors, events, publications) flattened."""
    return flatten_initiatives(derived.initiative_records(spark, sf))


@query("initiative_quarantine", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, 'missing keys: iniTitulo' AS error_reason FROM orders
WHERE o_orderstatus = 'P' AND o_orderkey IN (SELECT l_orderkey FROM lineitem)""")
def q_initiative_quarantine(spark, sf):
    """Records without a mandatory key go to the quarantine, not the table."""
    _good, bad = split_initiatives(derived.initiative_records(spark, sf, untitled_status="P"))
    return bad.select(J.path("record", "$.iniNr").alias("id"), "error_reason")


@query("activity_quarantine", """
SELECT CAST(l.l_orderkey AS VARCHAR) AS mp_id, 'actP' AS src_key, 'missing keys: actAs' AS error_reason
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
WHERE l.l_returnflag = 'A' AND l.l_linestatus = 'O'""")
def q_activity_quarantine(spark, sf):
    """Activities without a mandatory key go to the quarantine, not the table."""
    _good, bad = flatten_activity(derived.member_activity_records(spark, sf, no_desc_status="O"))
    return bad.select("mp_id", "src_key", "error_reason")


@query("latest_status", """
SELECT conv_id, role AS last_role FROM (
  SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn
  FROM conversations) WHERE rn = 1""")
def q_latest_status(spark, sf):
    """Last role per conversation (last element by turn)."""
    c = load(spark, sf, "conversations")
    return c.groupBy("conv_id").agg(F.max_by("role", "turn").alias("last_role"))


@query("json_unwrap", "SELECT p_partkey, p_name, p_brand FROM part")
def q_json_unwrap(spark, sf):
    """Records under one to six single-key wrappers, unwrapped."""
    recs = derived.wrapped_part_records(spark, sf)
    inner = J.unwrap_single_key("record")
    m = J.json_map(inner)
    return recs.select(F.element_at(m, F.lit("p_partkey")).cast("long").alias("p_partkey"),
                       F.element_at(m, F.lit("p_name")).alias("p_name"),
                       F.element_at(m, F.lit("p_brand")).alias("p_brand"))


@query("first_existing", """
SELECT p_partkey, CASE WHEN p_size < 20 THEN p_name WHEN p_size < 40 THEN p_brand ELSE '' END AS act_desc
FROM part""")
def q_first_existing(spark, sf):
    """First present key among two optional ones, '' when neither."""
    recs = derived.optional_key_records(spark, sf)
    return recs.select("p_partkey",
                       J.first_existing(J.json_map("record"), ["actAs", "nomeEntidadeExterna"])
                       .alias("act_desc"))


@query("nested_collect", """
SELECT conv_id, CAST(count(*) AS INTEGER) AS n_turns, string_agg(role, ', ' ORDER BY turn) AS roles
FROM conversations GROUP BY conv_id""")
def q_nested_collect(spark, sf):
    """Turns per conversation and their roles joined in turn order."""
    c = load(spark, sf, "conversations")
    g = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("turns"))
    return g.select("conv_id", F.size("turns").alias("n_turns"),
                    A.join_field("turns", "role", ", ").alias("roles"))


@query("last_matching_event", """
WITH u AS (SELECT DISTINCT user_id FROM events),
p AS (SELECT user_id, ts, value FROM (
        SELECT user_id, ts, value,
               row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events WHERE event_type = 'purchase') WHERE rn = 1)
SELECT u.user_id, p.ts AS last_purchase_ts, p.value AS last_purchase_value
FROM u LEFT JOIN p ON u.user_id = p.user_id""")
def q_last_matching_event(spark, sf):
    """Per user, time and value of the last purchase (last match wins)."""
    ev = load(spark, sf, "events")
    ordk = F.when(F.col("event_type") == "purchase", F.struct("ts", "event_id"))
    return ev.groupBy("user_id").agg(F.max_by("ts", ordk).alias("last_purchase_ts"),
                                     F.max_by("value", ordk).alias("last_purchase_value"))


# ------------------------------------------------------------------- text
@query("slugify", f"""
SELECT doc_id, lower(replace(replace(replace({_trim_sql("strip_accents(replace(text, 'ß', 'ss'))")},
       '/', ''), '  ', '_'), ' ', '_')) AS slug FROM documents""")
def q_slugify(spark, sf):
    """Directory-name slug of every whole document text."""
    return load(spark, sf, "documents").select("doc_id", T.clean_string("text").alias("slug"))


def _dq_raw_spark():
    return (F.when(F.col("p_size") < 10, F.concat(F.lit('"'), F.col("p_name"), F.lit('"')))
            .when(F.col("p_size") < 20, F.concat(F.lit("  '"), F.col("p_name"), F.lit("'  ")))
            .when(F.col("p_size") < 30, F.concat(F.lit('"'), F.col("p_name")))
            .when(F.col("p_size") < 40, F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")))
            .when(F.col("p_size") < 45, F.lit('"'))
            .otherwise(F.concat(F.lit("'"), F.col("p_name"), F.lit('"'))))
_DQ_RAW_SQL = """CASE WHEN p_size < 10 THEN '"' || p_name || '"'
     WHEN p_size < 20 THEN '  ''' || p_name || '''  '
     WHEN p_size < 30 THEN '"' || p_name
     WHEN p_size < 40 THEN ' ' || p_name || ' '
     WHEN p_size < 45 THEN '"'
     ELSE '''' || p_name || '"' END"""


@query("dequote", f"""
WITH r AS (SELECT p_partkey, {_DQ_RAW_SQL} AS raw FROM part),
s AS (SELECT p_partkey, raw, {_trim_sql("raw")} AS s FROM r)
SELECT p_partkey, raw, CASE WHEN length(s) >= 2 AND left(s, 1) = right(s, 1) AND left(s, 1) IN ('''', '"')
       THEN {_trim_sql("substr(s, 2, length(s) - 2)")} ELSE s END AS dequoted FROM s""")
def q_dequote(spark, sf):
    """Strip and remove one pair of matching surrounding quotes."""
    p = load(spark, sf, "part").select("p_partkey", _dq_raw_spark().alias("raw"))
    return p.select("p_partkey", "raw", T.dequote("raw").alias("dequoted"))


@query("title_clean", f"""
SELECT doc_id, replace(replace({_trim_sql("text")}, '\\n', ' '), chr(10), ' ') AS title FROM documents""")
def q_title_clean(spark, sf):
    """Strip, then literal backslash-n and newlines to spaces, on whole texts."""
    return load(spark, sf, "documents").select("doc_id", T.title_clean("text").alias("title"))


@query("regex_sub", """
SELECT o_orderkey, regexp_replace(regexp_replace('DAR ' || o_orderpriority || ' série ' || o_orderstatus,
       'DAR ', '', 'g'), ' série ', '-', 'g') AS dar_cat FROM orders""")
def q_regex_sub(spark, sf):
    """Publication series 'DAR II série A' -> 'II-A' by regex substitution."""
    o = load(spark, sf, "orders")
    raw = F.concat(F.lit("DAR "), F.col("o_orderpriority"), F.lit(" série "), F.col("o_orderstatus"))
    return o.select("o_orderkey", T.dar_category(raw).alias("dar_cat"))


@query("split_first", """
SELECT o_orderkey, split_part(trim('  ' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')), ' ', 1) AS req_date
FROM orders""")
def q_split_first(spark, sf):
    """First whitespace-separated token of a padded timestamp text."""
    o = load(spark, sf, "orders")
    raw = F.concat(F.lit("  "), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return o.select("o_orderkey", T.first_token(raw).alias("req_date"))


@query("composite_id", """
SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) || '/' || o_orderstatus || '/' || o_orderpriority || '/'
       || CAST(o_custkey AS VARCHAR) AS id FROM orders""")
def q_composite_id(spark, sf):
    """Formatted id from four order fields."""
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", T.format_id("o_orderkey", "o_orderstatus", "o_orderpriority",
                                              "o_custkey").alias("id"))


_TAGS_SQL = ("regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, "
             "'(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g'), "
             "'<[^>]*>', ' ', 'g'), '[ \\t\\n\\r\\f]+', ' ', 'g'), '^ | \\z', '', 'g')")


@query("strip_html", f"SELECT page_id, {_TAGS_SQL} AS body_text FROM pages")
def q_strip_html(spark, sf):
    """Visible text of each page (scripts, styles, comments, tags removed)."""
    return load(spark, sf, "pages").select("page_id", T.strip_html("html").alias("body_text"))


# the oracle's own references: those that the pages hold, ampersand last
_PAGE_REFS = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", "\u00a0"), ("&copy;", "©"),
              ("&middot;", "·"), ("&amp;", "&")]


def _entities_sql(x: str) -> str:
    for k, v in _PAGE_REFS:
        x = f"replace({x}, '{k}', '{v.replace(chr(39), chr(39) * 2)}')"
    return x


def _numeric_refs_sql(x: str) -> str:
    """Numeric character references decoded in DuckDB SQL (split around the
    references, code point -> chr, zip back)."""
    pat = "&#[0-9]+;|&#[xX][0-9a-fA-F]+;"
    cp = ("(CASE WHEN lower(substr(r, 3, 1)) = 'x' "
          "THEN CAST(('0x' || regexp_extract(r, '&#[xX]([0-9a-fA-F]+);', 1)) AS HUGEINT) "
          "ELSE CAST(regexp_extract(r, '&#([0-9]+);', 1) AS HUGEINT) END)")
    ch = (f"(CASE WHEN {cp} > 0 AND {cp} <= 1114111 AND NOT ({cp} BETWEEN 55296 AND 57343) "
          f"THEN chr(CAST({cp} AS INTEGER)) ELSE chr(65533) END)")
    return (f"CASE WHEN contains({x}, '&#') THEN "
            f"array_to_string(list_transform(range(1, len(regexp_extract_all({x}, '{pat}')) + 1), "
            f"lambda i: string_split_regex({x}, '{pat}')[i] || "
            f"list_transform([regexp_extract_all({x}, '{pat}')[i]], lambda r: {ch})[1]), '') "
            f"|| string_split_regex({x}, '{pat}')[-1] ELSE {x} END")


@query("decode_entities", f"""
WITH s AS (SELECT page_id, {_TAGS_SQL} AS x FROM pages),
n AS (SELECT page_id, {_numeric_refs_sql("x")} AS x FROM s)
SELECT page_id, {_entities_sql("x")} AS body_text FROM n""")
def q_decode_entities(spark, sf):
    """Visible page text with character references decoded."""
    return load(spark, sf, "pages").select(
        "page_id", T.decode_entities(T.strip_html("html")).alias("body_text"))


@query("content_md5", "SELECT doc_id, md5(text) AS content_md5 FROM documents")
def q_content_md5(spark, sf):
    """MD5 of every document text."""
    return load(spark, sf, "documents").select("doc_id", T.md5_hex("text").alias("content_md5"))


@query("dedup_by_content", """
SELECT min(doc_id) AS doc_id, md5(text) AS content_md5 FROM documents GROUP BY md5(text)""")
def q_dedup_by_content(spark, sf):
    """Lowest document id per distinct content digest."""
    from vigil.streaming.incremental import first_by_content
    return first_by_content(load(spark, sf, "documents"), "doc_id", "text")


# ------------------------------------------------------------- links/pages
@query("page_links", """
SELECT page_id, url, CAST(i - 1 AS INTEGER) AS link_pos, hs[i] AS href FROM (
  SELECT page_id, url, hs, generate_subscripts(hs, 1) AS i FROM (
    SELECT page_id, url, regexp_extract_all(html, '(?i)<a\\s[^>]*?href\\s*=\\s*"([^"]*)"', 1) AS hs FROM pages))""")
def q_page_links(spark, sf):
    """Anchor hrefs of every page in document order."""
    return page_links(load(spark, sf, "pages"))


@query("page_link_classify", """
SELECT page_id, CAST(i - 1 AS INTEGER) AS link_pos, hs[i] AS href,
       contains(hs[i], '.') AS to_follow, contains(hs[i], ',') AS to_download FROM (
  SELECT page_id, hs, generate_subscripts(hs, 1) AS i FROM (
    SELECT page_id, regexp_extract_all(html, '(?i)<a\\s[^>]*?href\\s*=\\s*"([^"]*)"', 1) AS hs FROM pages))""")
def q_page_link_classify(spark, sf):
    """Links flagged to follow / to download by substring."""
    links = page_links(load(spark, sf, "pages"), keep=("page_id",))
    return frontier.classify_links(links, follow=".", download=",")


@query("filter_eq_nonascii", """
SELECT page_id, url, CAST(i - 1 AS INTEGER) AS link_pos, hs[i] AS href FROM (
  SELECT page_id, url, hs, generate_subscripts(hs, 1) AS i FROM (
    SELECT page_id, url, regexp_extract_all(html, '(?i)<a\\s[^>]*?href\\s*=\\s*"([^"]*)"', 1) AS hs FROM pages))
WHERE hs[i] = '/èê'""")
def q_filter_eq_nonascii(spark, sf):
    """String equality with a non-ASCII literal (the accented-subtype filter)."""
    return page_links(load(spark, sf, "pages")).where(F.col("href") == "/èê")


@query("page_block_links", """
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, hs[i] AS value FROM (
  SELECT page_id, hs, generate_subscripts(hs, 1) AS i FROM (
    SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1),
                                       '(?i)<a\\s[^>]*?href\\s*=\\s*"([^"]*)"', 1) AS hs FROM pages))""")
def q_page_block_links(spark, sf):
    """Hrefs inside each page's nav block."""
    return load(spark, sf, "pages").select("page_id", F.posexplode(block_links("html", None, "nav")).alias("pos", "value"))


@query("page_block_text", """
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, ts[i] AS value FROM (
  SELECT page_id, ts, generate_subscripts(ts, 1) AS i FROM (
    SELECT page_id, list_filter(regexp_extract_all(html, '(?s)<div class="ad">(.*?)</div>', 1),
                                lambda x: x <> '') AS ts FROM pages))""")
def q_page_block_text(spark, sf):
    """Text pieces inside div.ad blocks."""
    return load(spark, sf, "pages").select("page_id", F.posexplode(block_text("html", "ad")).alias("pos", "value"))


_FICH_SPARK = lambda: F.concat(
    F.lit("https://files.example.org/webutils/docs/doc.txt?path=p"), F.col("page_id").cast("string"),
    F.lit("&fich="), F.regexp_replace(F.regexp_extract("url", r"^https?://([^/?#]+)", 1), r"\.", "_"),
    F.lit("%c3%ba"), F.upper(F.regexp_extract("url", r"^https?://[^/]+/([a-z]{2})/", 1)),
    F.when(F.col("url").startswith("https"), F.lit("_json.txt")).otherwise(F.lit(".json.txt")),
    F.lit("&Inline=true"))
_FICH_SQL = """'https://files.example.org/webutils/docs/doc.txt?path=p' || CAST(page_id AS VARCHAR) || '&fich='
  || regexp_replace(regexp_extract(url, '^https?://([^/?#]+)', 1), '\\.', '_', 'g') || '%c3%ba'
  || upper(regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1))
  || CASE WHEN starts_with(url, 'https') THEN '_json.txt' ELSE '.json.txt' END || '&Inline=true'"""


@query("file_name_extract", f"""
SELECT page_id, lower(replace(replace(replace(regexp_extract({_FICH_SQL}, 'fich=(.*?)&Inline=true', 1),
       '_json.txt', '.json'), '.json.txt', '.json'), '%c3%ba', 'u')) AS file_name FROM pages""")
def q_file_name_extract(spark, sf):
    """File name between the fich= and &Inline=true markers, normalised."""
    p = load(spark, sf, "pages").select("page_id", _FICH_SPARK().alias("file_url"))
    return p.select("page_id", T.normalize_file_name(
        T.extract_between("file_url", "fich=", "&Inline=true")).alias("file_name"))


def _crumbs_spark():
    host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
    lang = F.regexp_extract("url", r"^https?://[^/]+/([a-z]{2})/", 1)
    title = F.array(page_title("html"))
    crumbs = F.array(F.lit(" Início "), F.lit(">"), F.regexp_replace(host, r"\.", " "), F.lit(" > "),
                     F.concat(F.lit("XV  Legislatura "), F.upper(lang)), F.lit(" > "),
                     F.concat(F.lit("Número "), F.col("page_id").cast("string")))
    return F.concat(title, crumbs)


_CLEAN_SQL = ("lower(replace(replace(replace(" + _trim_sql("strip_accents(replace({x}, 'ß', 'ss'))")
              + ", '/', ''), '  ', '_'), ' ', '_'))")


@query("breadcrumb_path", f"""
WITH a AS (SELECT page_id, list_concat([regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)],
                  [' Início ', '>', regexp_replace(regexp_extract(url, '^https?://([^/?#]+)', 1), '\\.', ' ', 'g'),
                  ' > ', 'XV  Legislatura ' || upper(regexp_extract(url, '^https?://[^/]+/([a-z]{{2}})/', 1)),
                  ' > ', 'Número ' || CAST(page_id AS VARCHAR)]) AS arr FROM pages),
c AS (SELECT page_id, list_transform(list_filter(arr, lambda x: {_trim_sql("replace(x, '>', '')")} <> ''),
                                     lambda x: {_CLEAN_SQL.format(x="x")}) AS c FROM a),
r AS (SELECT page_id, CASE WHEN list_position(c, 'inicio') IS NULL THEN c
             ELSE list_concat(c[1:list_position(c, 'inicio') - 1], c[list_position(c, 'inicio') + 1:]) END AS r
      FROM c),
d AS (SELECT page_id, CASE WHEN starts_with(r[-1], 'numero') THEN r[1:len(r) - 1] ELSE r END AS d FROM r)
SELECT page_id, array_to_string(d, '/') AS dir_path FROM d""")
def q_breadcrumb_path(spark, sf):
    """Directory path from page title + breadcrumb trail."""
    p = load(spark, sf, "pages").select("page_id", _crumbs_spark().alias("crumbs"))  # title + trail
    return p.select("page_id", A.path_join(A.breadcrumb_dirs("crumbs")).alias("dir_path"))


@query("crawl_manifest", f"""
WITH a AS (SELECT page_id, url, list_concat([regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)],
                  [' Início ', '>', regexp_replace(regexp_extract(url, '^https?://([^/?#]+)', 1), '\\.', ' ', 'g'),
                  ' > ', 'XV  Legislatura ' || upper(regexp_extract(url, '^https?://[^/]+/([a-z]{{2}})/', 1)),
                  ' > ', 'Número ' || CAST(page_id AS VARCHAR)]) AS arr,
                  {_FICH_SQL} AS file_url FROM pages),
c AS (SELECT page_id, url, file_url, list_transform(list_filter(arr, lambda x: {_trim_sql("replace(x, '>', '')")} <> ''),
                                     lambda x: {_CLEAN_SQL.format(x="x")}) AS c FROM a),
r AS (SELECT page_id, url, file_url, CASE WHEN list_position(c, 'inicio') IS NULL THEN c
             ELSE list_concat(c[1:list_position(c, 'inicio') - 1], c[list_position(c, 'inicio') + 1:]) END AS r
      FROM c),
d AS (SELECT page_id, url, file_url, CASE WHEN starts_with(r[-1], 'numero') THEN r[1:len(r) - 1] ELSE r END AS d FROM r)
SELECT TIMESTAMP '{_CRAWL_TS}' AS crawl_time,
       'data/' || array_to_string(d, '/') || '/' || lower(replace(replace(replace(
           regexp_extract(file_url, 'fich=(.*?)&Inline=true', 1), '_json.txt', '.json'), '.json.txt', '.json'),
           '%c3%ba', 'u')) AS file_path,
       url AS parent_url, file_url
FROM d""")
def q_crawl_manifest(spark, sf):
    """Manifest rows of the crawl: breadcrumb directory + file name per download link."""
    p = load(spark, sf, "pages").select("url", _crumbs_spark().alias("crumbs"),
                                        F.array(_FICH_SPARK()).alias("links"))
    return frontier.manifest_rows(p, "crumbs", "links", F.to_timestamp_ntz(F.lit(_CRAWL_TS)))


# --------------------------------------------------------------- manifests


def _manifest_spark(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", "source", "text", "lang")
    lab = load(spark, sf, "labels").select(F.col("doc_id").alias("_lid"))
    m = d.join(lab, d.doc_id == lab._lid, "left")
    done = F.col("_lid").isNotNull()
    return m.select(
        "doc_id", "text", "lang",
        F.to_timestamp_ntz(F.lit(_CRAWL_TS)).alias("crawl_time"),
        F.concat(F.lit("data/"), F.col("doc_id").cast("string"), F.lit(".json")).alias("file_path"),
        F.concat(F.lit("https://files.example.org/"), F.col("source")).alias("parent_url"),
        F.concat(F.lit("https://files.example.org/doc.txt?fich="), F.col("doc_id").cast("string"),
                 F.lit("_json.txt&Inline=true")).alias("file_url"),
        F.when(done, F.to_timestamp_ntz(F.lit(_CRAWL_TS))).alias("download_time"),
        F.when(done, F.lit(200)).cast("int").alias("download_status"),
        F.when(done, T.md5_hex("text")).alias("download_md5"))


_MANIFEST_SQL = f"""m AS (SELECT d.doc_id, d.text, d.lang, TIMESTAMP '{_CRAWL_TS}' AS crawl_time,
       'data/' || CAST(d.doc_id AS VARCHAR) || '.json' AS file_path,
       'https://files.example.org/' || d.source AS parent_url,
       'https://files.example.org/doc.txt?fich=' || CAST(d.doc_id AS VARCHAR) || '_json.txt&Inline=true' AS file_url,
       CASE WHEN l.doc_id IS NOT NULL THEN TIMESTAMP '{_CRAWL_TS}' END AS download_time,
       CAST(CASE WHEN l.doc_id IS NOT NULL THEN 200 END AS INTEGER) AS download_status,
       CASE WHEN l.doc_id IS NOT NULL THEN md5(d.text) END AS download_md5
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
landed AS (SELECT 'data/' || CAST(page_id AS VARCHAR) || '.json' AS file_path FROM pages),
p AS (SELECT * FROM m WHERE file_path NOT IN (SELECT file_path FROM landed)
      AND coalesce(download_status, 0) <> 200)"""


def _landed(spark, sf):
    return load(spark, sf, "pages").select(
        F.concat(F.lit("data/"), F.col("page_id").cast("string"), F.lit(".json")).alias("file_path"))


@query("manifest_pending", f"""WITH {_MANIFEST_SQL}
SELECT file_path, file_url, download_status FROM p""")
def q_manifest_pending(spark, sf):
    """Manifest rows whose file is not landed and not yet downloaded."""
    m = _manifest_spark(spark, sf)
    return manifest.pending(m, _landed(spark, sf)).select("file_path", "file_url", "download_status")


@query("manifest_merge", f"""WITH {_MANIFEST_SQL},
r AS (SELECT file_path, TIMESTAMP '{_DOWNLOAD_TS}' AS download_time,
             CAST(CASE WHEN lang <> 'de' THEN 200 ELSE 503 END AS INTEGER) AS download_status,
             md5(text) AS download_md5 FROM p)
SELECT m.crawl_time, m.file_path, m.parent_url, m.file_url,
       CASE WHEN r.download_status = 200 THEN r.download_time ELSE m.download_time END AS download_time,
       CASE WHEN r.download_status = 200 THEN r.download_status ELSE m.download_status END AS download_status,
       CASE WHEN r.download_status = 200 THEN r.download_md5 ELSE m.download_md5 END AS download_md5
FROM m LEFT JOIN r ON m.file_path = r.file_path""")
def q_manifest_merge(spark, sf):
    """Manifest updated with successful download results only."""
    m = _manifest_spark(spark, sf)
    p = manifest.pending(m, _landed(spark, sf))
    results = p.select("file_path", F.to_timestamp_ntz(F.lit(_DOWNLOAD_TS)).alias("download_time"),
                       F.when(F.col("lang") != "de", F.lit(200)).otherwise(F.lit(503))
                        .cast("int").alias("download_status"),
                       T.md5_hex("text").alias("download_md5"))
    return manifest.merge_results(m.drop("doc_id", "text", "lang"), results)


@query("latest_run", """
SELECT doc_id, source FROM documents WHERE source = (SELECT max(source) FROM documents)""")
def q_latest_run(spark, sf):
    """Rows of the greatest run name."""
    d = load(spark, sf, "documents").select("doc_id", "source")
    return manifest.latest_rows(d, "source")


# ------------------------------------------------------------ lookup/layout
SEGMENT_COLORS = {"AUTOMOBILE": "#F74B71", "BUILDING": "#F28C26", "FURNITURE": "#202056",
                  "MACHINERY": "#00AFF1"}


@query("lookup_default", "SELECT c_custkey, c_mktsegment, CASE c_mktsegment " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENT_COLORS.items()) + " END AS color FROM customer")
def q_lookup_default(spark, sf):
    """Segment colour from a fixed map; unknown segments get NULL."""
    c = load(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return c.withColumn("color", map_with_default("c_mktsegment", SEGMENT_COLORS))


def _rings_values_sql() -> str:
    rows = ", ".join(f"({r}, {n}, {d}, {list(c)})" for r, n, d, c in layout.RINGS)
    return f"(VALUES {rows}) AS rg(ring, n_seats, distance, corridors)"


_TEMPLATE_SQL = f"""rg AS (SELECT ring, n_seats, CAST(distance AS DOUBLE) AS distance, corridors,
              coalesce(sum(n_seats) OVER (ORDER BY ring ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
       FROM {_rings_values_sql()}),
pos AS (SELECT rg.*, CAST(g.range AS INTEGER) AS position, n_seats + len(corridors) AS slots
        FROM rg, LATERAL range(1, n_seats + len(corridors) + 1) g
        WHERE NOT list_contains(corridors, CAST(g.range AS INTEGER))),
tpl AS (SELECT ring, CAST(before + row_number() OVER (PARTITION BY ring ORDER BY position) AS INTEGER) AS seat_nmr,
               distance * cos(((pi() - 2 * (pi() / 20)) / (1 + slots)) * position + pi() / 20) AS seat_x,
               distance * sin(((pi() - 2 * (pi() / 20)) / (1 + slots)) * position + pi() / 20) AS seat_y
        FROM pos)"""


@query("ring_layout", f"""WITH {_TEMPLATE_SQL},
c AS (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn
      FROM customer)
SELECT c.c_nationkey, c.c_custkey, CAST((c.rn - 1) // 230 AS BIGINT) AS block, tpl.seat_nmr, tpl.ring,
       round(tpl.seat_x, 9) AS seat_x, round(tpl.seat_y, 9) AS seat_y
FROM c JOIN tpl ON tpl.seat_nmr = CAST((c.rn - 1) % 230 + 1 AS INTEGER)""")
def q_ring_layout(spark, sf):
    """Customers seated per nation on the 230-seat ring layout."""
    tpl = layout.ring_seats(layout.rings_frame(spark))
    cust = load(spark, sf, "customer").select("c_nationkey", "c_custkey")
    seated = layout.assign_seats(cust, tpl, ["c_nationkey"], ["c_custkey"])
    return seated.select("c_nationkey", "c_custkey", "block", "seat_nmr", "ring",
                         F.round("seat_x", 9).alias("seat_x"), F.round("seat_y", 9).alias("seat_y"))


@query("run_islands", """
WITH s AS (SELECT user_id, event_type, ts,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g,
                  row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS v
           FROM events)
SELECT user_id, event_type, min(g) AS start_seq, max(g) AS end_seq, CAST(count(*) AS BIGINT) AS n_rows,
       min(ts) AS start_ts, max(ts) AS end_ts
FROM s GROUP BY user_id, event_type, g - v""")
def q_run_islands(spark, sf):
    """Runs of consecutive same-type events per user (skew-safe numbering)."""
    ev = load(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")
    return runs(ev, ["user_id"], ["ts", "event_id"], "event_type",
                extra_aggs=[F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts")])


@query("seat_party_runs", """
WITH s AS (SELECT c_nationkey, c_mktsegment,
                  row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS g,
                  row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS v
           FROM customer)
SELECT c_nationkey, c_mktsegment, min(g) AS start_seq, max(g) AS end_seq, CAST(count(*) AS BIGINT) AS n_rows
FROM s GROUP BY c_nationkey, c_mktsegment, g - v""")
def q_seat_party_runs(spark, sf):
    """Seats in customer-key order per nation, 'party' = market segment:
    consecutive same-party seats as runs (the last seat is its own run when
    the party changes there)."""
    cust = load(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_mktsegment")
    return layout.party_runs(cust, ["c_nationkey"], ["c_custkey"], "c_mktsegment")


# ------------------------------------------------------------------ sinks
@query("csv_pipe_roundtrip", "SELECT * FROM part")
def q_csv_pipe_roundtrip(spark, sf):
    """Part written as pipe CSV under the checkpoint folder and read back."""
    p = load(spark, sf, "part")
    out = scratch_path(spark, "pipe-csv")
    delimited.write_pipe_csv(p, out)
    return delimited.read_pipe_csv(spark, out, p.schema)


# ------------------------------------------------- sources and sinks, there and back
_RECORDS_PER_DOC = 100


@query("json_document_scan", f"""
WITH d AS (SELECT c_custkey // {_RECORDS_PER_DOC} AS doc, count(*) AS n FROM customer GROUP BY 1)
SELECT CAST(doc AS BIGINT) AS doc, CASE WHEN doc % 5 IN (3, 4) THEN 0 ELSE n END AS n_records,
       CASE doc % 5 WHEN 3 THEN 'not a JSON document' WHEN 4 THEN 'root missing: ArrayOfCustomer.Customer' END AS error_reason
FROM d""")
def q_json_document_scan(spark, sf):
    """Customers exported as one JSON document per hundred keys (some cut off, some
    under another root), scanned whole: records per document, and why there are none."""
    one = F.to_json(F.struct("c_custkey", "c_name"))
    docs = (load(spark, sf, "customer").groupBy((F.col("c_custkey").cast("bigint") / _RECORDS_PER_DOC).cast("bigint").alias("doc"))
            .agg(derived.obj_or_array(F.collect_list(one)).alias("items")))
    good = F.concat(F.lit('{"ArrayOfCustomer":{"Customer":'), "items", F.lit("}}"))
    text = (F.when(F.col("doc") % 5 == 3, F.expr("substr(items, 1, length(items) - 2)"))
            .when(F.col("doc") % 5 == 4, F.concat(F.lit('{"Other":'), "items", F.lit("}"))).otherwise(good))
    path = scratch_path(spark, "json-exports")
    docs.select("doc", text.alias("value")).write.partitionBy("doc").text(path)
    read = read_documents(spark, path).withColumn("doc_key", F.regexp_extract("source_file", "doc=([0-9]+)/", 1).cast("bigint"))
    n = records(read, "ArrayOfCustomer.Customer", keep=("doc_key",)).groupBy("doc_key").agg(F.count(F.lit(1)).alias("n_records"))
    bad = bad_documents(read, "ArrayOfCustomer.Customer", keep=("doc_key",)).select(F.col("doc_key").alias("bad_key"), "error_reason")
    return (read.select("doc_key").join(n, "doc_key", "left").join(bad, F.col("doc_key") == F.col("bad_key"), "left")
            .select(F.col("doc_key").alias("doc"), F.coalesce("n_records", F.lit(0)).cast("bigint").alias("n_records"), "error_reason"))


_RUNS = ("2024_01_01_00_00_00", "2024_01_03_00_00_00", "2024_01_04_10_20_30")


@query("manifest_runs", f"""
SELECT 'data/' || CAST(doc_id AS VARCHAR) || '.json' AS file_path, '{_RUNS[2]}' AS run_file,
       CASE WHEN lang <> 'de' THEN 200 END AS download_status, CASE WHEN lang <> 'de' THEN md5(text) END AS download_md5,
       CASE WHEN lang <> 'de' THEN TIMESTAMP '{_DOWNLOAD_TS}' END AS download_time
FROM documents WHERE lang <> 'en'""")
def q_manifest_runs(spark, sf):
    """Two manifest runs written, the newer with the four columns of old crawls;
    the latest is read, widened and merged with results (some keys repeat, some
    fail), written as a third run, and the latest run is read back."""
    path = scratch_path(spark, "manifest-runs")
    m = _manifest_spark(spark, sf)
    manifest_source.write_manifest(m.drop("doc_id", "text", "lang"), path, _RUNS[0])
    old = m.where("lang <> 'en'").select("crawl_time", "file_path", "parent_url", "file_url")
    old.withColumn("run_id", F.lit(_RUNS[1])).write.mode("append").partitionBy("run_id").option("header", True).csv(path)
    results = m.where("lang <> 'en'").select(
        "file_path", F.explode(F.array(F.lit("2024-01-01 12:00:00"), F.lit(_DOWNLOAD_TS))).alias("t"),
        F.when(F.col("lang") != "de", F.lit(200)).otherwise(F.lit(503)).cast("int").alias("download_status"),
        T.md5_hex("text").alias("download_md5")).withColumn("download_time", F.to_timestamp_ntz("t")).drop("t")
    run = spark.range(1).select(manifest_source.run_id(F.to_timestamp(F.lit("2024-01-04 10:20:30")))).first()[0]
    manifest_source.write_manifest(manifest.merge_results(manifest_source.latest_run_rows(spark, path).drop("run_file"), results), path, run)
    return manifest_source.latest_run_rows(spark, path).select("file_path", "run_file", "download_status", "download_md5", "download_time")


@query("manifest_commits", f"""
WITH k AS (SELECT 'data/' || CAST(doc_id AS VARCHAR) || '.json' AS file_path, doc_id, lang FROM documents)
SELECT 'latest' AS part, '{_RUNS[1]}' AS run_file, file_path, CAST(NULL AS BIGINT) AS n_rows FROM k WHERE lang <> 'en'
UNION ALL SELECT 'run', '{_RUNS[0]}', NULL, count(*) FROM k
UNION ALL SELECT 'run', '{_RUNS[1]}', NULL, count(*) FROM k WHERE lang <> 'en'
UNION ALL SELECT 'left', '{_RUNS[1]}', NULL, 1 UNION ALL SELECT 'left', '{_RUNS[2]}', NULL, 1""")
def q_manifest_commits(spark, sf):
    """A run committed, a second one committed and then repeated with other rows, and a newer
    one that breaks off before its commit: the latest rows, the rows of each run, and
    what broke off or was replaced."""
    path = scratch_path(spark, "manifest-commits")
    m = _manifest_spark(spark, sf)
    cols = ["crawl_time", "file_path", "parent_url", "file_url"]
    manifest_source.write_manifest(m.select(*cols), path, _RUNS[0])
    manifest_source.write_manifest(m.where("lang = 'en'").select(*cols), path, _RUNS[1])
    manifest_source.write_manifest(m.where("lang <> 'en'").select(*cols), path, _RUNS[1])
    manifest_source.stage_run(m.select(*cols), path, _RUNS[2])
    none = F.lit(None).cast("string").alias("file_path")
    latest = manifest_source.latest_run_rows(spark, path).select(F.lit("latest").alias("part"), "run_file", "file_path", F.lit(None).cast("long").alias("n_rows"))
    every = manifest_source.read_manifests(spark, path).groupBy("run_file").agg(F.count(F.lit(1)).alias("n_rows"))
    left = manifest_source.uncommitted(spark, path).groupBy("run_file").agg(F.count(F.lit(1)).alias("n_rows"))
    return latest.unionByName(every.select(F.lit("run").alias("part"), "run_file", none, "n_rows")) \
        .unionByName(left.select(F.lit("left").alias("part"), "run_file", none, "n_rows"))


@query("indexed_csv_scan", "SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_name, CAST(p_size AS INTEGER) AS p_size FROM part")
def q_indexed_csv_scan(spark, sf):
    """Parts written as comma CSV behind an index column, read back without it."""
    path = scratch_path(spark, "indexed-csv")
    load(spark, sf, "part").select((F.col("p_partkey") * 7).alias("_c0"), "p_partkey", "p_name", "p_size") \
        .write.option("header", True).csv(path)
    return delimited.read_indexed_csv(spark, path, "p_partkey bigint, p_name string, p_size int")


@query("pipe_csv_na_tokens", """
SELECT CAST(p_partkey AS BIGINT) AS p_partkey, CASE WHEN p_size % 5 IN (0, 1, 2) THEN NULL ELSE p_name END AS p_name,
       'x|"' || p_brand || '"' AS p_brand FROM part""")
def q_pipe_csv_na_tokens(spark, sf):
    """Pipe CSV whose missing names are written as tokens, read back as NULL."""
    token = F.when(F.col("p_size") % 5 == 0, F.lit("NA")).when(F.col("p_size") % 5 == 1, F.lit("NaN")) \
        .when(F.col("p_size") % 5 == 2, F.lit("None")).otherwise(F.col("p_name"))
    path = scratch_path(spark, "pipe-na")
    delimited.write_pipe_csv(load(spark, sf, "part").select(
        F.col("p_partkey").cast("bigint").alias("p_partkey"), token.alias("p_name"),
        F.concat(F.lit('x|"'), "p_brand", F.lit('"')).alias("p_brand")), path)
    return delimited.read_pipe_csv(spark, path, "p_partkey bigint, p_name string, p_brand string")


#: Small files that one task writes, about.
FILES_PER_TASK = 500


@query("landed_files", """
SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, md5(s_name || chr(10)) AS download_md5,
       CAST(strlen(s_name) + 1 AS BIGINT) AS length FROM supplier""")
def q_landed_files(spark, sf):
    """Files landed one per supplier: size and digest of their bytes. A file costs a task far more than
    its bytes do, so tasks are dealt by files, and each moves its own into place."""
    path = scratch_path(spark, "landed")
    rows = load(spark, sf, "supplier").select("s_suppkey", "s_name")
    rows.repartition(1 + rows.count() // FILES_PER_TASK, "s_suppkey").write.partitionBy("s_suppkey") \
        .option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
    files = read_landed(spark, path, glob="*.txt")
    return files.select(F.regexp_extract("path", "s_suppkey=([0-9]+)/", 1).cast("bigint").alias("s_suppkey"), "download_md5", "length")


@query("seat_map", f"""WITH {_TEMPLATE_SQL}
SELECT c.c_custkey AS seat_nmr, c.c_mktsegment AS party, CASE c.c_mktsegment """ + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENT_COLORS.items()) + """ END AS color,
       round(tpl.seat_x, 9) AS seat_x, round(tpl.seat_y, 9) AS seat_y
FROM (SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_mktsegment FROM customer) c LEFT JOIN tpl ON tpl.seat_nmr = c.c_custkey""")
def q_seat_map(spark, sf):
    """Seat table rewritten with colour and coordinates; no seat, no coordinates."""
    seats = load(spark, sf, "customer").select(F.col("c_custkey").cast("int").alias("seat_nmr"), F.col("c_mktsegment").alias("party"))
    return layout.seat_map(seats, layout.rings_frame(spark), colors=SEGMENT_COLORS).select(
        "seat_nmr", "party", "color", F.round("seat_x", 9).alias("seat_x"), F.round("seat_y", 9).alias("seat_y"))


@query("incremental_ingest", "SELECT DISTINCT md5(text) AS content_md5 FROM documents")
def q_incremental_ingest(spark, sf):
    """Documents landed in two lots and ingested by two runs of one stream: every
    content once, also where both lots hold it."""
    base = scratch_path(spark, "ingest")
    src, sink, state = (f"{base}/{x}" for x in ("landing", "sink", "state"))
    d = load(spark, sf, "documents").select("doc_id", "text")
    for lot in (0, 1):
        d.where(F.col("doc_id") % 2 == lot).write.parquet(f"{src}/lot{lot}")
        incremental.ingest_available(incremental.content_stream(spark, src + "/*", "doc_id bigint, text string", "text"), sink, state)
    return spark.read.parquet(sink).select("content_md5")


from vigil.plans import storage_queries, web_queries  # noqa: E402,F401 - registers its queries
