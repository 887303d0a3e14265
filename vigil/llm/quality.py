"""Quality rules as a bitmask ledger.

``ledger`` measures every document once and stores the measurements and one
failure bit per rule. Policies are versioned masks over those bits, so a
policy is applied, changed or ablated without touching a text again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import SPACES, pick, shingle_hashes, space_words

#: Rule name and its failure condition over the measurements; the bit is the position.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 10 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    ("short_words", "word_chars < 3 * n_words"),
    ("long_words", "word_chars > 10 * n_words"),
    ("capitals", "100 * n_capitals > 40 * word_chars"),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}

#: Policy versions: the rules that a kept document must not fail.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "2": ("few_words", "repeated_words", "symbols", "repeated_lines"),
    "3": tuple(BIT),
}


def mask(policy: str) -> int:
    return sum(BIT[r] for r in POLICIES[policy])


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the measurements and fail_bits; one row per input row.

    Null text measures as empty: all counts 0, and it fails ``few_words``.
    ``n_repeat_words`` counts the words inside a three-word window that occurs
    twice or more: only where windows repeat at all are (hash, position) pairs
    sorted, the repeated positions kept and the union of their windows counted.
    """
    d = pick(docs, doc_id=id_col, text=text_col)
    text = F.coalesce(F.col("text"), F.lit(""))
    m = d.select("doc_id", text.alias("text")).select("doc_id", "text", space_words(F.col("text")).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    m = m.select(
        "doc_id", F.size("words").cast("bigint").alias("n_words"),
        F.length(F.regexp_replace("text", SPACES, "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        F.length(F.regexp_replace("text", r"[^A-Z]+", "")).cast("bigint").alias("n_capitals"),
        lines.alias("lines"), shingle_hashes(F.col("words"), 3).alias("hashes"))
    m = m.withColumn("pairs", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), F.sort_array(F.transform(
        "hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    m = m.withColumn("at", F.when(F.col("pairs").isNotNull(), F.sort_array(F.transform(F.filter(
        "pairs", lambda p, k: (p["h"] == F.get("pairs", k - 1)["h"]) | (p["h"] == F.get("pairs", k + 1)["h"])),
        lambda p: p["i"]))))
    steps = F.transform("at", lambda i, k: F.least(F.lit(3), F.coalesce(F.get("at", k + 1) - i, F.lit(3))))
    m = m.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_capitals", F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(F.aggregate(steps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("bigint").alias("n_repeat_words"))
    bits = F.lit(0).cast("bigint")
    for name, fails in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(BIT[name])).otherwise(F.lit(0)).cast("bigint"))
    return m.withColumn("fail_bits", bits)


def fails(policy: str) -> Column:
    """True for ledger rows that the policy rejects."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy))) != 0


def ablation(rows: DataFrame, policy: str = "3") -> DataFrame:
    """rule, n_failed, n_only, n_kept_without: for every rule of the policy how many
    documents fail it, fail nothing else, and would be kept without it.

    The ledger is first reduced to one row per failure pattern (at most two to
    the number of rules), so the rules cost nothing per document.
    """
    wanted = F.lit(mask(policy))
    patterns = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("bigint").alias("bit"))
                                for r in POLICIES[policy]])).alias("r")
    e = patterns.select("n", F.col("fail_bits").bitwiseAND(wanted).alias("bits"), rules)
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("bigint")
    return e.groupBy(F.col("r.rule").alias("rule")).agg(
        count(F.col("bits").bitwiseAND(F.col("r.bit")) != 0).alias("n_failed"),
        count(F.col("bits") == F.col("r.bit")).alias("n_only"),
        count((F.col("bits") == 0) | (F.col("bits") == F.col("r.bit"))).alias("n_kept_without"))


def quality_report(docs: DataFrame, policy: str = "3") -> DataFrame:
    """The ledger under one policy: base_failed by the base rules, kept by the policy."""
    return ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        fails("base").alias("base_failed"), (~fails("base") & ~fails(policy)).alias("kept"), "fail_bits")


QUALITY_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
p AS (SELECT rid, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3),
g AS (SELECT p.rid, p.i, words[p.i] || ' ' || words[p.i + 1] || ' ' || words[p.i + 2] AS s FROM p JOIN w USING (rid)),
t AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS c FROM g) WHERE c >= 2),
r AS (SELECT rid, count(DISTINCT i + k) AS n FROM t CROSS JOIN (VALUES (0), (1), (2)) AS o(k) GROUP BY rid),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals, len(lines)::BIGINT AS n_lines,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN r USING (rid)),
b AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 8 ELSE 0 END
        + CASE WHEN word_chars < 3 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 10 * n_words THEN 32 ELSE 0 END
        + CASE WHEN 100 * n_capitals > 40 * word_chars THEN 64 ELSE 0 END)::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 AS base_failed,
       fail_bits = 0 AS kept, fail_bits FROM b"""
