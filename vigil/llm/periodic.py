"""Periodic runs of words by online dyadic square catching.

Words are appended one after another. Whenever a block of 2^k words is complete,
a catcher is set on it. A square of period p, 2^(k+1) - 1 <= p <= 2^(k+2) - 2,
holds such a block in its first half and the same words again p further on. So
every appended word closes, for each k, one window of 2^k words, which is compared
with the two catchers whose distance is in that range. Where they agree, the
suffixes before both places and the words after them are compared as far as they
match: that is the maximal stretch with period p, a run if it has a square. A
window inside a known run whose period is at most half the block, that the block
lies in as well, brings nothing new and is skipped; runs found with a multiple
of their period merge into the one with the smallest.

The comparisons that all words of a portion of texts make at one k are done at
once in numpy, over 64-bit fingerprints of the windows; every run is confirmed on
the words themselves before it is reported.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vigil.llm.common import pick, space_words
from vigil.session import ship_by_value

#: A run has at least so many words, and at least two periods.
MIN_WORDS = 12
#: Words of texts that are searched at once, about (a longer text is a portion of its own).
PORTION_WORDS = 200_000
#: Catchers times words of one comparison step: bounds what one step holds.
STEP = 1 << 20
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Fingerprint of two windows side by side."""
    x = left * _ODD[0] + right * _ODD[1]
    return (x ^ (x >> np.uint64(29))) * _ODD[0]


class Catchers:
    """Fingerprints of all windows of 2^k words, for the k that matter.

    ``ids``: word fingerprints, texts one after another with the longest first and
    one unique mark after each; ``sizes``: words of each text. Windows of
    level k are kept for the texts that are long enough for its periods only.
    """

    def __init__(self, ids: np.ndarray, sizes: np.ndarray):
        upto = np.cumsum(sizes + 1)
        self.levels = [ids]
        size = 1
        while len(sizes):
            size *= 2
            long = int(np.searchsorted(-sizes, -(4 * size - 2), side="right"))
            if long == 0:
                break
            prev = self.levels[-1][:upto[long - 1]]
            half = size // 2
            self.levels.append(_joined(prev[:-half], prev[half:]))

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on (i < j)."""
        n = np.zeros(len(i), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            h, step = self.levels[k], 1 << k
            at = np.flatnonzero(j + n < len(h))
            while len(at):
                at = at[j[at] + n[at] < len(h)]
                at = at[h[i[at] + n[at]] == h[j[at] + n[at]]]
                n[at] += step
        return n

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i equal those before j (i < j)."""
        n = np.zeros(len(i), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            h, step = self.levels[k], 1 << k
            at = np.arange(len(i))
            while len(at):
                at = at[(i[at] - n[at] >= step) & (j[at] - n[at] - step < len(h))]
                at = at[h[i[at] - n[at] - step] == h[j[at] - n[at] - step]]
                n[at] += step
        return n

    def runs(self) -> np.ndarray:
        """Rows (start, end, period) over the joined texts, by start and period."""
        found = np.zeros((0, 3), dtype=np.int64)
        for k, h in enumerate(self.levels):
            size = 1 << k
            known = found[found[:, 2] * 2 <= size]
            reach = _Reach(known)
            caught = [found]
            for lo in range(0, len(h), STEP):
                for near in (2 * size - 1, 3 * size - 1):  # the two catchers of a window, by their least distance
                    e = np.arange(max(lo, near), min(len(h), lo + STEP))
                    c = (e - near) // size * size
                    hit = np.flatnonzero(h[c] == h[e])
                    c, e = c[hit], e[hit]
                    new = np.flatnonzero(reach.end(c) < e + size)
                    c, e = c[new], e[new]
                    if len(c) == 0:
                        continue
                    p = e - c
                    start = c - self.behind(c, e)
                    end = e + size + self.ahead(c + size, e + size)
                    run = end - start >= np.maximum(MIN_WORDS, 2 * p)
                    caught.append(_merged(np.stack([start[run], end[run], p[run]], axis=1)))
            found = _merged(np.concatenate(caught))
        return found[np.lexsort((found[:, 2], found[:, 0]))]


class _Reach:
    """For a block, the end of the known run that holds its first word and reaches furthest."""

    def __init__(self, runs: np.ndarray):
        runs = runs[np.argsort(runs[:, 0], kind="stable")]
        self.starts, self.ends = runs[:, 0], np.maximum.accumulate(runs[:, 1]) if len(runs) else runs[:, 1]

    def end(self, at: np.ndarray) -> np.ndarray:
        k = np.searchsorted(self.starts, at, side="right")
        return np.where(k > 0, self.ends[np.maximum(k, 1) - 1], 0) if len(self.ends) else np.zeros(len(at), np.int64)


def _merged(runs: np.ndarray) -> np.ndarray:
    """One row per stretch, with its smallest period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), dtype=bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[first]


def find_runs(texts: list[list], exact: bool = False) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each text, a list of words, by start and period.

    ``exact`` numbers the words instead of hashing them; it is taken if a run that the
    fingerprints found does not stand the comparison of its words."""
    order = sorted(range(len(texts)), key=lambda t: -len(texts[t]))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    order = [t for t in order if len(texts[t]) >= MIN_WORDS]
    if not order:
        return out
    sizes = np.array([len(texts[t]) for t in order], dtype=np.int64)
    first = np.cumsum(sizes + 1) - sizes - 1
    ids = np.empty(int(first[-1] + sizes[-1]) + 1, dtype=np.uint64)
    number: dict = {}
    marks = np.random.default_rng(len(order)).integers(1 << 63, size=len(order), dtype=np.uint64) | np.uint64(1 << 63)
    for t, at, n, mark in zip(order, first.tolist(), sizes.tolist(), marks):
        w = texts[t]
        ids[at:at + n] = np.fromiter((number.setdefault(x, len(number)) for x in w) if exact else map(hash, w), dtype=np.int64, count=n).view(np.uint64)
        ids[at + n] = mark
    runs = Catchers(ids, sizes).runs()
    owner = np.searchsorted(first, runs[:, 0], side="right") - 1
    for (start, end, p), o in zip(runs.tolist(), owner.tolist()):
        w, at = texts[order[o]], int(first[o])
        s, e = start - at, end - at
        if e > len(w) or w[s:e - p] != w[s + p:e]:
            if exact:
                raise ValueError("window fingerprints collide")
            return find_runs(texts, exact=True)
        out[order[o]].append((s, e - s, p))
    return out


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run repeats: of every run its first period stays."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for s, n, p in runs:
        edge[s + p] += 1
        edge[s + n] -= 1
    keep = np.cumsum(edge[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist()) if k]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _searched(ids: pa.Array, texts: list) -> pa.RecordBatch:
    words = [t.split() if t else [] for t in texts]  # bytes.split() parts at ASCII white space only
    runs = find_runs(words)
    flat = np.array([r for x in runs for r in x], dtype=np.int64).reshape(-1, 3)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in runs])]).astype(np.int32)
    spans = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(flat[:, j]) for j in range(3)], fields=list(_RUN)))
    kept = pa.array([b" ".join(collapse(w, r)) for w, r in zip(words, runs)], pa.binary())
    return pa.RecordBatch.from_arrays([ids, pa.array([len(w) for w in words], pa.int64()), spans, kept], names=["id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period, by start and period)
    and collapsed (the words that stay, joined by one space) of every row.

    Words stand between ASCII white space. A null, empty or blank text has no words,
    no runs and an empty collapsed text. Rows are judged one by one: repeated rows, null ids
    and other columns change nothing, and an empty table gives an empty table.
    """
    d = pick(docs, id=id_col, text=text_col)
    kind = d.schema["id"].dataType
    d = d.select("id", F.col("text").cast("binary").alias("text"))
    id_type = to_arrow_type(kind)

    def search(batches):
        for b in batches:
            ids, texts = b.column(0).cast(id_type), b.column(1)
            size = np.array([0 if x is None else x for x in pa.compute.binary_length(texts).to_pylist()], dtype=np.int64)
            portion = np.cumsum(size) // (PORTION_WORDS * 6)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(portion)) + 1, [len(size)]])
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if hi > lo:
                    yield _searched(ids.slice(lo, hi - lo), texts.slice(lo, hi - lo).to_pylist())

    out = d.mapInArrow(search, f"id {kind.simpleString()}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary")
    return out.select(F.col("id").alias("doc_id"), "n_words", "runs", F.decode("collapsed", "UTF-8").alias("collapsed"))


def with_period(docs: DataFrame) -> DataFrame:
    """doc_id, text of ``docs``; texts whose unsigned crc32 h of the decimal doc_id ends
    in 0 repeat a stretch of their words: with g = floor(h / 10) and n words, word i from
    a = g % n on becomes word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)).
    Null ids and texts without words stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    d = pick(docs, doc_id="doc_id", text="text").withColumn("g", F.when(h % 10 == 0, F.floor(h / 10).cast("bigint")))
    d = d.withColumn("w", F.when(F.col("g").isNotNull(), space_words(F.col("text"))))
    n = F.size("w")
    d = d.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, F.pmod(F.col("g"), F.col("n")).cast("int")))
    d = d.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.pmod(F.col("g"), F.lit(8))))).cast("int"))

    def source(i: Column) -> Column:
        return F.when(i < F.col("a"), i).otherwise(F.col("a") + F.pmod(i - F.col("a"), F.col("p")))

    cyclic = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("w", source(i))), " ")
    return d.select("doc_id", F.when(F.col("a").isNotNull(), cyclic).otherwise(F.col("text")).alias("text"))


def runs_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period; null if
    there is none), runs_sha256 of all `start,length,period` lines and collapsed_sha256
    of the text without repeats: one row per input row, over the texts of ``with_period``."""
    r = periodic_runs(with_period(docs))
    best = F.array_max(F.transform("runs", lambda x: F.struct(x["length"], -x["start"], -x["period"])))
    r = r.withColumn("best", best)
    lines = F.array_join(F.transform("runs", lambda x: F.concat_ws(",", x["start"].cast("string"), x["length"].cast("string"), x["period"].cast("string"))), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    return r.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.col2")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.col3")).alias("period"), F.floor(F.col("best.length") * 1000 / (-F.col("best.col3"))).cast("bigint").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


ship_by_value(sys.modules[__name__])
