"""Removal of word passages that an earlier document already has.

A sparse suffix structure: of every window of ``window`` words the least
``GRAM``-word gram is its prefix key, so equal windows meet under one key, and
consecutive windows of one key travel as one suffix text. Keys that only one
text has are dropped before any words move. The suffixes of a group are ranked
by prefix doubling to depth ``window``; equal ranks are the deep internal nodes
of its suffix tree, that is the repeats, and a node's least document keeps its
words. Groups are packed into memory-sized portions; a key with too many words
is split by document, and the parts are merged node by node.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import pick, space_words, store
from vigil.session import ship_by_value

WINDOW = 50
GRAM = 8
#: Words of one key in one task, about; more are split by document.
PART_WORDS = 300_000
#: Words that a task ranks at once.
PORTION_WORDS = 1_000_000
#: Rows of a list up to which it is broadcast.
BROADCAST_ROWS = 1_000_000

_M = np.uint64(0xD1342543DE82EF95)


def runs(h: np.ndarray, ends: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """Maximal runs of window starts with one least gram: (text, first, last, key).

    ``h``: word hashes of all texts in a row; ``ends``: where each text ends.
    """
    n, starts = len(h), np.concatenate(([0], ends[:-1]))
    if n < window:
        return [np.zeros(0, np.int64)] * 4
    w = h.view(np.uint64)
    g = np.zeros(n - gram + 1, np.uint64)
    for j in range(gram):
        g = g * _M + w[j:n - gram + 1 + j]
    g ^= g >> np.uint64(32)
    g *= _M
    need, width, m = window - gram + 1, 1, g
    while width * 2 <= need:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    if width < need:
        m = np.minimum(m[:len(m) - (need - width)], m[need - width:])
    text = np.repeat(np.arange(len(ends)), np.diff(np.concatenate(([0], ends))))[:len(m)]
    at = np.flatnonzero(np.arange(len(m)) + window <= ends[text])
    if not len(at):
        return [np.zeros(0, np.int64)] * 4
    text, key = text[at], m[at]
    new = np.ones(len(at), bool)
    new[1:] = (text[1:] != text[:-1]) | (key[1:] != key[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return text[first], at[first] - starts[text[first]], at[last] - starts[text[first]], key[first].view(np.int64)


def deep_nodes(words: np.ndarray, ends: np.ndarray, depth: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(position, rank) of every suffix of at least ``depth`` words; two suffixes
    have one rank if and only if their first ``depth`` words are equal."""
    n = len(words)
    _, rank = np.unique(words, return_inverse=True)
    rank = rank.astype(np.int64)
    width = 1
    while width < depth:
        step = min(width, depth - width)  # the last step overlaps
        if n <= step:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pair = rank[:len(rank) - step] * np.int64(n + 1) + rank[step:]
        _, rank = np.unique(pair, return_inverse=True)
        width += step
    text_end = np.repeat(ends, np.diff(np.concatenate(([0], ends))))
    at = np.flatnonzero(np.arange(len(rank)) + depth <= text_end[:len(rank)])
    return at, rank[at]


def _pack(h: np.ndarray) -> np.ndarray:
    """Words as 48-bit hashes, six bytes each."""
    return np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :6]


def _unpack(raw: bytes) -> np.ndarray:
    x = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    out = np.zeros((len(x), 8), np.uint8)
    out[:, :6] = x
    return out.reshape(-1).view(np.int64)


def _flat(col) -> tuple[np.ndarray, np.ndarray]:
    lists = [np.asarray(x, dtype=np.int64) for x in col]
    return np.concatenate(lists), np.cumsum([len(x) for x in lists], dtype=np.int64)


def _find_runs(batches):
    for b in batches:
        for part in _portions(b):
            h, ends = _flat(part["words"])
            text, first, last, key = runs(h, ends)
            cut = np.searchsorted(text, np.arange(len(part) + 1))
            yield pd.DataFrame({"u": part["u"].to_numpy(), "r": part["r"].to_numpy(), **{
                name: [x[cut[i]:cut[i + 1]] for i in range(len(part))] for name, x in (("keys", key), ("firsts", first), ("lasts", last))}})


def _portions(b: pd.DataFrame):
    """Slices of the batch of about PORTION_WORDS words."""
    sizes = b["words"].map(len).to_numpy()
    part = (np.cumsum(sizes) - sizes) // PORTION_WORDS
    for p in np.unique(part):
        yield b[part == p]


def _cut_suffixes(batches):
    for b in batches:
        rows = []
        for u, r, words, segs in zip(b["u"], b["r"], b["words"], b["segs"]):
            packed = _pack(np.asarray(words, dtype=np.int64))
            for x in segs:
                rows.append((x["key"], int(u) % int(x["parts"]), x["parts"] > 1, u, r, x["first"],
                             packed[x["first"]:x["last"] + WINDOW].tobytes()))
        yield pd.DataFrame(rows, columns=["key", "part", "split", "u", "r", "first", "words"])


def _repeats(d: pd.DataFrame) -> pd.DataFrame:
    """Repeats inside whole groups: (u, start, end) intervals to remove, and for
    split keys one row per node and occurrence in the part's least document."""
    words = [_unpack(x) for x in d["words"]]
    ends = np.cumsum([len(x) for x in words], dtype=np.int64)
    flat = np.concatenate(words)
    at, node = deep_nodes(flat, ends)
    seg = np.searchsorted(ends, at, side="right")
    r, u = d["r"].to_numpy()[seg], d["u"].to_numpy()[seg]
    pos = at - np.concatenate(([0], ends[:-1]))[seg] + d["first"].to_numpy()[seg]
    least = np.full(int(node.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, node, r)
    later = r > least[node]
    s, p = seg[later], pos[later]
    new = np.ones(len(p), bool)
    new[1:] = (s[1:] != s[:-1]) | (p[1:] != p[:-1] + 1)
    a = np.flatnonzero(new)
    z = np.append(a[1:], len(p)) - 1
    gone = pd.DataFrame({"u": u[later][a], "r": 0, "start": p[a], "end": p[z] + WINDOW, "d1": 0, "d2": 0, "open": False})
    keep = ~later & d["split"].to_numpy(dtype=bool)[seg]
    if not keep.any():
        return gone
    w, k = flat.view(np.uint64), at[keep]
    d1, d2 = np.zeros(len(k), np.uint64), np.zeros(len(k), np.uint64)
    for j in range(WINDOW):  # a node's words, digested to 128 bits
        d1 = d1 * _M + w[k + j]
        d2 = (d2 ^ w[k + j]) * np.uint64(0x9E3779B97F4A7C15)
        d2 ^= d2 >> np.uint64(29)
    still = pd.DataFrame({"u": u[keep], "r": r[keep], "start": pos[keep], "end": pos[keep] + WINDOW,
                          "d1": d1.view(np.int64), "d2": d2.view(np.int64), "open": True})
    return pd.concat([gone, still])


def _find_repeats(batches):
    held: list[pd.DataFrame] = []
    size = 0
    for b in batches:
        held.append(b)
        size += int(b["words"].map(len).sum()) // 6
        if size < PORTION_WORDS:
            continue
        d = pd.concat(held, ignore_index=True)
        cut = int(np.flatnonzero(d["key"].to_numpy() != d["key"].iloc[-1])[-1]) + 1 if (d["key"] != d["key"].iloc[-1]).any() else 0
        if cut:  # the last key may go on in the next batch
            for part in _groups(d[:cut]):
                yield _repeats(part)
        held = [d[cut:]]
        size = int(held[0]["words"].map(len).sum()) // 6
    if held and sum(map(len, held)):
        for part in _groups(pd.concat(held, ignore_index=True)):
            yield _repeats(part)


def _groups(d: pd.DataFrame):
    """Portions of whole keys of about PORTION_WORDS words (rows are sorted by key)."""
    key = d["key"].to_numpy()
    size = np.cumsum(d["words"].map(len).to_numpy()) // 6
    first = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1))
    portion = size[first] // PORTION_WORDS
    cuts = [*first[np.concatenate(([0], np.flatnonzero(np.diff(portion)) + 1))], len(d)]
    for a, z in zip(cuts[:-1], cuts[1:]):
        yield d[a:z]


def _join(big: DataFrame, few: DataFrame, on, how: str = "inner", rows: int | None = None) -> DataFrame:
    short = (few.count() if rows is None else rows) <= BROADCAST_ROWS
    return big.join(F.broadcast(few) if short else few, on, how)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(light, spans): light has doc_id, t (text digest), r (rank of the id), rep (least
    r with this text) and n of every row; spans has t, spans: sorted disjoint
    word intervals [start, end) to remove from the text where r equals rep.

    Null ids rank after all others; null text has no words.
    """
    d = pick(docs, doc_id=id_col, text=text_col)
    digest = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit(""))))
    rank = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(9223372036854775807))
    light = store(d.select("doc_id", digest.alias("t"), rank.alias("r"), F.size(space_words(F.col("text"))).alias("n")), "passage-rows")
    copied = store(light.groupBy("t").agg(F.min("r").alias("rep"), F.max("r").alias("top")).where("rep < top")
                   .select(F.col("t").alias("ct"), "rep"), "passage-copies")
    light = _join(light, copied, F.col("t") == F.col("ct"), "left").withColumn("rep", F.coalesce("rep", "r")).drop("ct")
    texts = _join(d.withColumn("t", digest).withColumn("r", rank), copied, F.col("t") == F.col("ct"), "left")
    texts = texts.where(F.col("rep").isNull() | (F.col("rep") == F.col("r")))
    u = F.xxhash64("t", "r").alias("u")
    hashed = F.transform(space_words(F.col("text")), lambda w: F.xxhash64(w)).alias("words")
    words = texts.select(u, "r", hashed)
    found = store(words.mapInPandas(_find_runs, "u bigint, r bigint, keys array<bigint>, firsts array<int>, lasts array<int>"), "passage-runs")
    each = found.select("u", "r", F.explode(F.arrays_zip("keys", "firsts", "lasts")).alias("x")) \
        .select("u", "r", F.col("x.keys").alias("key"), F.col("x.firsts").alias("first"), F.col("x.lasts").alias("last"))
    shared = each.groupBy("key").agg(F.min("r").alias("r0"), F.max("r").alias("r1"), F.sum(F.col("last") - F.col("first") + WINDOW).alias("m")) \
        .where("r0 < r1").select(F.col("key").alias("sk"), F.ceil(F.col("m") / PART_WORDS).cast("int").alias("parts"))
    shared = store(shared, "passage-keys")
    segs = _join(each, shared, F.col("key") == F.col("sk")).groupBy("u").agg(
        F.collect_list(F.struct("key", "parts", "first", "last")).alias("segs"), F.count(F.lit(1)).alias("k"))
    segs = store(segs.withColumnRenamed("u", "su"), "passage-segments")
    entries = segs.agg(F.coalesce(F.sum("k"), F.lit(0))).first()[0]
    cut = _join(texts.withColumn("u", F.xxhash64("t", "r")), segs.drop("k"), F.col("u") == F.col("su"), rows=entries // 2)
    cut = cut.select("u", "r", hashed, "segs").mapInPandas(
        _cut_suffixes, "key bigint, part int, split boolean, u bigint, r bigint, first int, words binary")
    cut = cut.repartition("key", "part").sortWithinPartitions("key", "part")
    gone = store(cut.mapInPandas(_find_repeats, "u bigint, r bigint, start int, end int, d1 bigint, d2 bigint, open boolean"), "passage-repeats")
    # parts of a split key: a node's least document over all parts
    nodes = gone.where("open")
    least = nodes.groupBy("d1", "d2").agg(F.min("r").alias("least"))
    late = nodes.join(least, ["d1", "d2"]).where("r > least").select("u", "start", "end")
    spans = gone.where("not open").select("u", "start", "end").union(late)
    w = Window.partitionBy("u").orderBy("start", "end")
    spans = spans.withColumn("reach", F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    spans = spans.withColumn("island", F.sum(F.when(F.col("start") <= F.col("reach"), 0).otherwise(1)).over(w))
    merged = spans.groupBy("u", "island").agg(F.min("start").alias("start"), F.max("end").alias("end")) \
        .groupBy("u").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    return light, store(merged, "passage-spans")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept (the remaining words joined by one space);
    one row per input row. An empty table gives an empty result."""
    light, spans = repeated_passages(docs, id_col, text_col)
    copies = store(light.where("r > rep and n >= " + str(WINDOW)).groupBy("t").agg(F.min("rep").alias("rep")), "passage-full")
    d = pick(docs, doc_id=id_col, text=text_col)
    d = d.select("doc_id", F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")))).alias("t"),
                 F.coalesce(F.col("doc_id").cast("bigint"), F.lit(9223372036854775807)).alias("r"), "text")
    d = _join(d, copies.select(F.col("t").alias("ct"), "rep"), F.col("t") == F.col("ct"), "left")
    d = d.withColumn("copy", F.coalesce(F.col("r") > F.col("rep"), F.lit(False))).withColumn("u", F.xxhash64("t", "r"))
    d = _join(d, spans.withColumnRenamed("u", "su"), F.col("u") == F.col("su"), "left")
    d = d.select("doc_id", "copy", space_words(F.col("text")).alias("words"), F.coalesce("spans", F.array()).alias("spans"))
    n = F.size("words")
    rest = F.flatten(F.transform(F.sequence(F.lit(0), F.size("spans")), lambda k: F.slice(
        "words", F.coalesce(F.get("spans", k - 1)["end"], F.lit(0)) + 1,
        F.coalesce(F.get("spans", k)["start"], n) - F.coalesce(F.get("spans", k - 1)["end"], F.lit(0)))))
    kept = F.when(F.col("copy"), F.array().cast("array<string>")).when(F.size("spans") == 0, F.col("words")).otherwise(rest)
    out = d.select("doc_id", n.cast("bigint").alias("n_words"), kept.alias("kept"))
    return out.select("doc_id", "n_words", (F.col("n_words") - F.size("kept")).alias("n_removed"), F.array_join("kept", " ").alias("kept"))


def repeats_report(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SUBSTRING_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT rid, doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
f AS (SELECT rid, i, doc_id > min(doc_id) OVER (PARTITION BY s) AS gone FROM p),
c AS (SELECT DISTINCT rid, unnest(range(i, i + 50)) AS j FROM f WHERE gone),
k AS (SELECT rid, list(j) AS js FROM c GROUP BY rid),
r AS (SELECT d.rid, d.doc_id, len(w) AS n, coalesce(len(js), 0) AS g FROM d LEFT JOIN k USING (rid)),
e AS (SELECT rid, unnest(w) AS x, generate_subscripts(w, 1) AS j FROM d),
t AS (SELECT e.rid, string_agg(x, ' ' ORDER BY e.j) AS kept FROM e LEFT JOIN c ON e.rid = c.rid AND e.j = c.j WHERE c.j IS NULL GROUP BY e.rid)
SELECT doc_id, n::BIGINT AS n_words, g::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM r LEFT JOIN t USING (rid)"""

ship_by_value(sys.modules[__name__])
