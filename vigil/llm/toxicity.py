"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams.

Features are the distinct hashed unigrams, bigrams and skip-grams (two words
with one or two between) of a text. FTRL keeps one learning rate per coordinate
and L1 sets most weights to exactly zero, so the model that is broadcast is a
short list of (bucket, weight).
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import pick, store, term_words
from vigil.session import ship_by_value

#: Hash buckets (weights) of the model: the bound of everything that is broadcast.
BITS = 20
#: Labelled rows that the model is fitted on, at most: those of least hash.
TRAIN_ROWS = 20_000
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 4.0, 0.1
THRESHOLD = 0.3
#: Words that a task turns into features at once.
STEP_WORDS = 500_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    """The rows that no label is learnt from; a null id counts as held out."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(True))


def features(flat: np.ndarray, ends: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each text: (buckets, row of each bucket).

    ``flat`` holds the word hashes of all texts in a row, ``ends`` where each
    text ends. Every gram kind has its own multiplier.
    """
    w = flat.view(np.uint64)
    n = len(w)
    row = np.repeat(np.arange(len(ends), dtype=np.int64), np.diff(np.concatenate(([0], ends))))
    parts, rows = [w * _MIX], [row]
    for gap in (1, 2, 3):
        if n > gap:
            same = row[gap:] == row[:-gap]
            gram = (w[:-gap] * np.uint64(2 * gap + 1) + (w[gap:] ^ (w[gap:] >> np.uint64(29)))) * _MIX
            parts.append(gram[same])
            rows.append(row[:-gap][same])
    bucket = np.concatenate(parts) >> np.uint64(64 - bits)
    at = np.unique((np.concatenate(rows).astype(np.uint64) << np.uint64(bits)) | bucket)
    return (at & np.uint64((1 << bits) - 1)).astype(np.int64), (at >> np.uint64(bits)).astype(np.int64)


class Ftrl:
    """FTRL-proximal state; weights follow from (z, n) and are zero inside L1."""

    def __init__(self, size: int, alpha=ALPHA, beta=BETA, l1=L1, l2=L2):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        w[np.abs(z) <= self.l1] = 0.0
        return w

    def step(self, at: np.ndarray, label: float) -> None:
        w = self.weights(at)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        if g == 0.0:
            return
        root = np.sqrt(self.n[at])
        more = (np.sqrt(self.n[at] + g * g) - root) / self.alpha
        self.z[at] += g - more * w
        self.n[at] += g * g


def _arrays(words: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    lists = [np.asarray(x, dtype=np.int64) for x in words]
    flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
    return flat, np.cumsum([len(x) for x in lists], dtype=np.int64)


def _portions(b: pd.DataFrame):
    """Slices of the batch of about STEP_WORDS words."""
    sizes = b["words"].map(len).to_numpy()
    part = (np.cumsum(sizes) - sizes) // STEP_WORDS
    for p in np.unique(part):
        yield b[part == p]


def hashed_words(text: Column) -> Column:
    return F.transform(term_words(text), lambda w: F.xxhash64(w))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, bits: int = BITS, epochs: int = EPOCHS) -> dict:
    """Fit on at most ``rows`` labelled rows that are not held out; returns
    {"bias", "bucket", "weight"} with the non-zero weights in bucket order.

    The rows are the first by a hash of doc_id; a label of null is left out,
    and of repeated labels of one doc_id the greatest counts. Without any label
    the model is empty and scores everything alike. One task fits the model:
    its input is bounded by ``rows``.
    """
    lab = labels.select(F.col("doc_id").alias("lid"), F.col("toxic").alias("y")).where("y is not null and lid is not null") \
        .where(~held_out(F.col("lid"))).groupBy("lid").agg(F.max("y").alias("y"))
    chosen = store(lab.orderBy(F.xxhash64(F.lit(3), "lid"), "lid").limit(rows), "tox-train-ids")
    d = pick(docs, doc_id="doc_id", text="text").where("doc_id is not null")
    rank = F.xxhash64(F.lit(3), "lid")
    train = d.join(F.broadcast(chosen), F.col("doc_id") == F.col("lid")).select(
        rank.alias("r"), "lid", F.col("y").cast("double").alias("y"), hashed_words(F.col("text")).alias("words"))

    def run(batches):
        got = [(r, i, y, *_flat(w, bits)) for b in batches for r, i, y, w in zip(b["r"], b["lid"], b["y"], b["words"])]
        got.sort(key=lambda x: (x[0], x[1], x[2], len(x[3])))
        model = Ftrl((1 << bits) + 1)
        for _ in range(epochs):
            for _, _, y, at in got:
                model.step(at, y)
        w = model.weights(np.arange(len(model.z)))
        keep = np.flatnonzero(w[:-1])
        yield pd.DataFrame({"bucket": np.append(keep, 1 << bits), "weight": np.append(w[keep], w[-1])})

    def _flat(words, bits):
        x = np.asarray(words, dtype=np.int64)
        at, _ = features(x, np.array([len(x)]), bits)
        return (np.append(at, 1 << bits).astype(np.int32),)  # the last coordinate is the bias

    model = train.repartition(1).mapInPandas(run, "bucket bigint, weight double").orderBy("bucket").toPandas()
    return {"bits": bits, "bias": float(model["weight"].iloc[-1]) if len(model) else 0.0,
            "bucket": model["bucket"].to_numpy()[:-1].copy(), "weight": model["weight"].to_numpy()[:-1].copy()}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score in (0, 1) of every row; null and wordless texts get the bias alone."""
    d = pick(docs, doc_id=id_col, text=text_col).select("doc_id", hashed_words(F.col("text")).alias("words"))
    kind = d.schema["doc_id"].dataType.simpleString()
    shared = d.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        dense = np.zeros(1 << m["bits"])
        dense[m["bucket"]] = m["weight"]
        for b in batches:
            for part in _portions(b):
                flat, ends = _arrays(part["words"])
                at, row = features(flat, ends, m["bits"])
                total = m["bias"] + np.bincount(row, weights=dense[at], minlength=len(ends))
                yield pd.DataFrame({"doc_id": part["doc_id"], "score": 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))})

    return d.mapInPandas(run, f"doc_id {kind}, score double")


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per input row."""
    s = score(docs, fit(docs, labels))
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns kept. Every row is
    judged by its own text, also where rows repeat a doc_id or have none."""
    key = F.xxhash64(F.col("doc_id"), F.col("text"))
    scored = score(docs.select(key.alias("_k"), "text"), fit(docs, labels), id_col="_k")
    bad = scored.where(F.col("score") >= THRESHOLD).select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, key == F.col("_bad"), "left_anti")


ship_by_value(sys.modules[__name__])
