"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text per language answers how far the rest of a
text can be read as one phrase of that language's text. Reading a text phrase
by phrase, always as far as possible, gives a phrase count per language; the
count times the bits of a phrase (the logarithm of the language's text length),
over the text's length, estimates the cross entropy. The least one wins.
"""

from __future__ import annotations

import math
import sys
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import pick, store
from vigil.llm.toxicity import held_out
from vigil.session import ship_by_value

#: Labelled documents per language and characters of them that are learnt, at most.
TRAIN_DOCS, TRAIN_CHARS = 96, 60_000
#: The parse starts afresh after so many characters, so that long texts are read in parallel.
BLOCK = 256
#: Characters that one step of a task holds as arrays.
STEP_CHARS = 1_000_000
_SALTS = 16

_LETTER: list[np.ndarray] = []


def _is_letter(codes: np.ndarray) -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x32000)), dtype=bool, count=0x32000))
    return _LETTER[0][np.minimum(codes, 0x31FFF)] & (codes < 0x32000)


def normalise(text: str) -> np.ndarray:
    """Code points of the lower-cased text with every run of other characters than
    letters as one space, none at the ends; empty if there is no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    if not len(codes):
        return codes
    letter = _is_letter(codes)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    out = np.where(letter, codes, 32)[keep]
    return out[:-1] if len(out) and out[-1] == 32 else out


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton: a path from state 0 spells a word if
    and only if the word occurs in ``symbols``."""
    step, link, size = [{}], [-1], [0]
    last = 0
    for c in symbols:
        cur = len(step)
        step.append({})
        link.append(0)
        size.append(size[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if size[q] == size[p] + 1:
                link[cur] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                size.append(size[p] + 1)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return step


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    """One language: its code points as learnt, and its automaton as packed edges."""
    rows = rows.sort_values(["r", "text"])
    texts = [codes for codes in map(normalise, rows["text"]) if len(codes)]
    if not texts:
        return pd.DataFrame({"lang": [], "n": [], "states": [], "edges": []})
    # equal shares; what short texts leave over goes to longer ones
    share, left = [0] * len(texts), TRAIN_CHARS
    for k, i in enumerate(sorted(range(len(texts)), key=lambda i: len(texts[i]))):
        share[i] = min(len(texts[i]) + 1, left // (len(texts) - k))
        left -= share[i]
    codes = np.concatenate([np.append(t[:n - 1], np.uint32(32)) for t, n in zip(texts, share) if n])
    step = suffix_automaton(codes.tolist())
    edges = np.array([(s, c, t) for s, d in enumerate(step) for c, t in d.items()], dtype=np.int32)
    return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "n": [len(codes)], "states": [len(step)],
                         "edges": [zlib.compress(edges.tobytes())]})


def learn(docs: DataFrame) -> list[tuple[str, int, int, bytes]]:
    """One automaton per language, each from at most TRAIN_CHARS characters of at
    most TRAIN_DOCS documents that are not held out, first by a hash of doc_id;
    every document has an equal share, as far as it has the characters.
    Rows without lang, text or doc_id teach nothing."""
    d = pick(docs, doc_id="doc_id", lang="lang").where("lang is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    r = F.xxhash64(F.lit(2), "doc_id")
    salted = d.select("doc_id", "lang", r.alias("r")).withColumn("salt", F.pmod("r", F.lit(_SALTS)))
    first = F.row_number().over(Window.partitionBy("lang", "salt").orderBy("r", "doc_id"))
    chosen = salted.withColumn("k", first).where(F.col("k") <= TRAIN_DOCS // _SALTS).select(
        F.col("doc_id").alias("tid"), F.col("lang").alias("tlang"), "r").distinct()
    chosen = store(chosen, "lang-train-ids")
    text = pick(docs, doc_id="doc_id", text="text", lang="lang").where("text is not null")
    train = text.join(F.broadcast(chosen), (F.col("doc_id") == F.col("tid")) & (F.col("lang") == F.col("tlang"))).select("lang", "r", "text")
    built = train.groupBy("lang").applyInPandas(_build, "lang string, n long, states long, edges binary")
    return sorted((m["lang"], m["n"], m["states"], bytes(m["edges"])) for m in built.collect())


class Parser:
    """Dense transition tables of all languages over one alphabet."""

    def __init__(self, models):
        unpacked = [np.frombuffer(zlib.decompress(e), dtype=np.int32).reshape(-1, 3) for _, _, _, e in models]
        alphabet = np.unique(np.concatenate([u[:, 1] for u in unpacked])) if unpacked else np.zeros(0, np.int32)
        self.langs = [m[0] for m in models]
        self.bits = [max(1.0, math.log2(m[1])) for m in models]
        self.width = len(alphabet) + 1
        self.symbol = np.zeros(0x32001, dtype=np.int32)  # 0: a character that no language was learnt with
        self.symbol[alphabet] = np.arange(1, len(alphabet) + 1)
        self.tables = []
        for (_, _, states, _), u in zip(models, unpacked):
            t = np.full(states * self.width, -1, dtype=np.int32)
            t[u[:, 0] * self.width + self.symbol[u[:, 1]]] = u[:, 2] * self.width
            self.tables.append(t)

    def phrases(self, codes: list[np.ndarray]) -> np.ndarray:
        """Phrase counts [text, language]; the texts are not empty."""
        lengths = np.array([len(c) for c in codes])
        blocks = -(-lengths // BLOCK)
        owner = np.repeat(np.arange(len(codes)), blocks)
        flat = self.symbol[np.minimum(np.concatenate(codes), 0x32000)]
        first = np.repeat(np.cumsum(lengths) - lengths, blocks)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = first + inside * BLOCK
        size = np.minimum(BLOCK, np.repeat(lengths, blocks) - inside * BLOCK)
        order = np.argsort(-size, kind="stable")
        start, size, owner = start[order], size[order], owner[order]
        out = np.zeros((len(codes), len(self.tables)), dtype=np.int64)
        alive = np.searchsorted(-size, -np.arange(BLOCK), side="left")  # blocks longer than t
        for k, table in enumerate(self.tables):
            state = np.zeros(len(start), dtype=np.int32)
            count = np.zeros(len(start), dtype=np.int64)
            root = np.maximum(table[:self.width], 0)
            for t in range(BLOCK):
                m = alive[t]
                if m == 0:
                    break
                sym = flat[start[:m] + t]
                new = table[state[:m] + sym]
                stop = new < 0
                count[:m] += stop
                state[:m] = np.where(stop, root[sym], new)
            out[:, k] = np.bincount(owner, weights=count + (state > 0), minlength=len(codes)).astype(np.int64)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; ties go to the first language by name."""
        langs, scores = ["und"] * len(texts), np.zeros(len(texts))
        if not self.tables:
            return langs, scores
        at: list[int] = []
        codes: list[np.ndarray] = []

        def flush():
            h = self.phrases(codes) * np.array(self.bits)
            h = np.maximum(h, 1e-9)
            best = h.argmin(axis=1)
            least = h[np.arange(len(at)), best]
            rest = h.copy()
            rest[np.arange(len(at)), best] = np.inf
            second = rest.min(axis=1)
            for j, i in enumerate(at):
                langs[i] = self.langs[best[j]]
                scores[i] = 1.0 if math.isinf(second[j]) else 1.0 - least[j] / second[j]
            at.clear()
            codes.clear()

        total = 0
        for i, text in enumerate(texts):
            c = normalise(text) if text else np.zeros(0, np.uint32)
            if len(c):
                at.append(i)
                codes.append(c)
                total += len(c)
            if total >= STEP_CHARS:
                flush()
                total = 0
        if at:
            flush()
        return langs, scores


def identify(docs: DataFrame, models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row from its whole text alone.

    ``und`` with score 0 if the text is null or has no letter. The score is the
    entropy that the winner saves against the second, as a share.
    """
    d = pick(docs, doc_id=id_col, text=text_col)
    kind = d.schema["doc_id"].dataType.simpleString()
    shared = d.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        parser = Parser(shared.value)
        for b in batches:
            lang, score = parser.predict(b["text"].tolist())
            yield pd.DataFrame({"doc_id": b["doc_id"], "lang_pred": pd.Series(lang, dtype=object, index=b.index),
                                "score": pd.Series(score, index=b.index)})

    return d.mapInPandas(run, f"doc_id {kind}, lang_pred string, score double")


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per input row."""
    return identify(docs, learn(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


ship_by_value(sys.modules[__name__])
