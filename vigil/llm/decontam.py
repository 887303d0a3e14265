"""Benchmark decontamination with a positional inverted index.

Only the terms that can decide anything are indexed: corpus frequencies of all
benchmark terms pick the rarest terms of every benchmark window, and the
positions of those terms in the training texts are stored as postings. A
posting at position p of the term at item position q is adjusted to p - q; a
window can only occur where the adjusted lists of all its rarest terms meet.
What meets is confirmed word by word in the text, so the result is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import pick, store, term_words

WINDOW = 13
#: Terms of a window whose lists are intersected, rarest first.
RARE = 3


def _terms(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """k, doc_id, words. ``k`` hashes id and text; it only joins candidates to
    texts, and every candidate is confirmed, so a collision cannot matter."""
    return _keyed(docs, id_col, text_col).select("k", "doc_id", term_words(F.col("text")).alias("words"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return pick(docs, doc_id=id_col, text=text_col).select(F.xxhash64("doc_id", "text").alias("k"), "doc_id", "text")


def read_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """ik, item_id, words of every benchmark row that has words."""
    i = pick(items, item_id=id_col, text=text_col)
    i = i.select("item_id", term_words(F.col("text")).alias("words")).where(F.size("words") > 0).distinct()
    return store(i.withColumn("ik", F.monotonically_increasing_id()), "decontam-items")


def term_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """term, n over the whole corpus, for the terms of the vocabulary."""
    return (docs.select(F.explode("words").alias("term")).join(vocabulary, "term")
            .groupBy("term").agg(F.count(F.lit(1)).alias("n")))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The index: term, k, pos for every occurrence of the given terms."""
    return store(docs.select("k", F.posexplode("words").alias("pos", "term")).join(terms, "term")
                 .select("term", "k", "pos"), "decontam-postings")


def windows(items: DataFrame, counts: DataFrame, window: int = WINDOW, rare: int = RARE) -> DataFrame:
    """ik, start, len, need: the windows that can occur at all, with their rarest
    terms as (n, q, term); q is the position in the item."""
    w = items.select("ik", "words", F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))).alias("start"))
    w = w.withColumn("len", F.least(F.size("words"), F.lit(window)))
    t = w.select("ik", "start", "len", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("len") - 1)).alias("q"),
                 F.col("words")).select("ik", "start", "len", "q", F.get("words", F.col("q")).alias("term"))
    t = t.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    g = t.groupBy("ik", "start", "len").agg(F.min("n").alias("least"), F.slice(F.array_sort(F.collect_list(
        F.struct("n", "q", "term"))), 1, rare).alias("need"))
    return g.where("least > 0").drop("least")


def find_phrases(docs: DataFrame, items: DataFrame, window: int = WINDOW, rare: int = RARE, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, words, spans: all exact occurrences of benchmark windows, as
    array<struct<item_id, start, len>> in word positions; one row per input row.

    A window is ``window`` consecutive words of an item; a shorter item is one
    window, an item without words none. Null text has no words, null ids are
    values like others; repeated rows are each reported; empty tables on either
    side give no spans.
    """
    d = _terms(docs, id_col, text_col)
    it = read_items(items, item_col, item_text_col)
    vocabulary = store(it.select(F.explode("words").alias("term")).distinct(), "decontam-terms")
    counts = store(term_counts(d, vocabulary), "decontam-counts")
    win = store(windows(it, counts, window, rare), "decontam-windows")
    need = (win.select("ik", F.explode("need").alias("t"), F.size("need").alias("n_need"))
            .groupBy("ik", F.col("t.q").alias("q"), F.col("t.term").alias("term")).agg(F.min("n_need").alias("n_need")))
    least = need.groupBy("ik").agg(F.min("n_need").alias("least"))
    need = store(need.drop("n_need").join(least, "ik"), "decontam-need")
    index = postings(d, need.select("term").distinct())
    met = (index.join(need, "term").select("k", "ik", (F.col("pos") - F.col("q")).alias("diag"), "q", "least")
           .groupBy("k", "ik", "diag").agg(F.collect_set("q").alias("qs"), F.first("least").alias("least"))
           .where(F.size("qs") >= F.col("least")))
    per_item = (win.groupBy("ik").agg(F.collect_list(F.struct(
        "start", "len", F.transform("need", lambda t: t["q"]).alias("qs"))).alias("wins")).join(it, "ik"))
    per_item = store(per_item, "decontam-per-item")
    cands = met.join(per_item, "ik").withColumn("wins", F.filter("wins", lambda w: (F.size(F.array_except(w["qs"], F.col("qs"))) == 0)
                                                                  & (F.col("diag") + w["start"] >= 0)))
    cands = (cands.where(F.size("wins") > 0)
             .select(F.col("k").alias("ck"), F.struct("item_id", F.col("words").alias("item_words"), "diag", F.transform(
                 "wins", lambda w: F.struct(w["start"].alias("start"), w["len"].alias("len"))).alias("wins")).alias("c"))
             .groupBy("ck").agg(F.collect_list("c").alias("cands")))
    found = F.flatten(F.transform("cands", lambda c: F.transform(
        F.filter(c["wins"], lambda w: F.slice(F.col("words"), c["diag"] + w["start"] + 1, w["len"])
                 == F.slice(c["item_words"], w["start"] + 1, w["len"])),
        lambda w: F.struct(c["item_id"].alias("item_id"), (c["diag"] + w["start"]).alias("start"), w["len"].alias("len")))))
    # the text moves, not its words; they are split after the join, behind an
    # explode, so that no later projection splits the text once per candidate
    out = _keyed(docs, id_col, text_col).join(cands, F.col("k") == F.col("ck"), "left")
    out = out.select("k", "doc_id", "cands", F.explode(F.array(term_words(F.col("text")))).alias("words"))
    return out.select("k", "doc_id", "words", F.coalesce(F.array_distinct(found), F.array()).alias("spans"))


def proximity_matches(docs: DataFrame, items: DataFrame, slop: int = 20, rare: int = RARE, id_col: str = "doc_id",
                      text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, start: places where the item's ``rare`` rarest distinct terms
    all lie within ``slop`` words, in any order; ``start`` is the first of them.

    Postings meet in blocks of ``slop`` positions, each posting in its own block
    and the one before, so a group never exceeds two blocks of one text.
    """
    d = _terms(docs, id_col, text_col)
    it = read_items(items, item_col, item_text_col)
    terms = it.select("ik", "item_id", F.explode(F.array_distinct("words")).alias("term"))
    counts = store(term_counts(d, store(terms.select("term").distinct(), "near-terms")), "near-counts")
    ranked = (terms.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0))).groupBy("ik", "item_id")
              .agg(F.slice(F.array_sort(F.collect_list(F.struct("n", "term"))), 1, rare).alias("need")))
    need = store(ranked.where(F.get("need", F.lit(0))["n"] > 0)
                 .select("ik", "item_id", F.size("need").alias("n_need"), F.explode("need").alias("t"))
                 .select("ik", "item_id", "n_need", F.col("t.term").alias("term")), "near-need")
    hits = postings(d, need.select("term").distinct()).join(need, "term")
    block = F.floor(F.col("pos") / slop)
    placed = hits.withColumn("block", F.explode(F.array(block, block - 1))).groupBy("k", "ik", "item_id", "n_need", "block") \
        .agg(F.collect_set(F.struct("pos", "term")).alias("at"))
    starts = F.transform(F.filter("at", lambda a: (F.floor(a["pos"] / slop) == F.col("block")) & (F.size(F.array_distinct(F.transform(
        F.filter("at", lambda b: (b["pos"] >= a["pos"]) & (b["pos"] < a["pos"] + slop)), lambda b: b["term"]))) == F.col("n_need"))),
        lambda a: a["pos"])
    found = placed.select("k", "item_id", F.explode(F.array_distinct(starts)).alias("start")).distinct()
    return found.join(d.select("k", "doc_id"), "k").select("doc_id", "item_id", "start")


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per input row.

    A word is hit if it lies in any occurrence; a document is contaminated if at
    least a twentieth of its words are. Items without an id hit words but are
    not listed.
    """
    f = find_phrases(docs, items)
    ids = F.array_sort(F.array_distinct(F.array_compact(F.transform("spans", lambda s: s["item_id"].cast("string")))))
    hit = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1)))))
    r = f.select("k", "doc_id", F.size("words").cast("bigint").alias("n_words"), hit.cast("bigint").alias("n_hit"), ids.alias("ids"))
    return r.select("k", "doc_id", "n_words", "n_hit", F.size("ids").cast("bigint").alias("n_items"),
                    F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"),
                    ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents; all columns kept."""
    bad = contamination(docs, items).where("contaminated").select(F.col("k").alias("_bad")).distinct()
    return docs.join(bad, F.xxhash64(F.col("doc_id"), F.col("text")) == F.col("_bad"), "left_anti")


DECONTAM_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM benchmark),
w AS (SELECT item_id, least(len(words), 13) AS n, array_to_string(words[i:i + least(len(words), 13) - 1], ' ') AS s
      FROM (SELECT *, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM b WHERE len(words) > 0)),
n AS (SELECT DISTINCT n FROM w),
p AS (SELECT rid, n, i, array_to_string(words[i:i + n - 1], ' ') AS s
      FROM (SELECT rid, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, n WHERE len(words) >= n)),
o AS (SELECT DISTINCT p.rid, p.i, p.n, w.item_id FROM p JOIN w USING (n, s)),
h AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS j FROM o) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS x FROM o) GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(words), FALSE) AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN t USING (rid)"""
