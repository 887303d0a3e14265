"""Main text of web pages by a recurrent block labeller.

A page is the sequence of its leaf blocks. Each block is a vector of its hashed
tag path, its hashed words and a few shapes; a bidirectional LSTM in numpy
reads the sequence both ways, so every block is classified with the whole page
in view. The network is fitted on a bounded sample of pages whose semantic
tags give away what is what, in several disguises of each page: containers
renamed to the class names that other sites use, semantic tags taken away,
side blocks and comments moved in.
"""

from __future__ import annotations

import io
import random
import sys
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm import html_blocks
from vigil.llm.html_blocks import blocks
from vigil.llm.common import pick, store
from vigil.session import ship_by_value

#: Pages fitted on, at most (those of least hash, each whole), and disguises of each.
TRAIN_PAGES, DISGUISES = 300, 4
#: Pages of a training batch, and the blocks it holds if its pages were all as long as its longest (a longer page is a batch of its own).
EPOCHS, BATCH, BATCH_BLOCKS, RATE, HIDDEN = 6, 48, 4096, 0.01, 24
PATH_DIM, WORD_DIM, SHAPES = 96, 32, 6
DIM = PATH_DIM + WORD_DIM + SHAPES
#: Blocks that a task labels at once.
STEP_BLOCKS = 20_000

#: Names of containers, by what they hold.
MAIN = "article main content post entry story body text".split()
SIDE = {"nav": "nav menu navbar breadcrumb toc navigation".split(), "header": "header masthead banner topbar".split(),
        "footer": "footer copyright colophon bottom".split(), "aside": "aside sidebar related widget promo".split(),
        "ad": "ad ads advert sponsor promo".split(), "comments": "comments comment reply discussion".split(),
        "notice": "notice cookie alert consent popup".split(), "form": "form newsletter subscribe login search".split()}
_SIDE_NAMES = frozenset(n for names in SIDE.values() for n in names)


#: Pages that can have a block with a label: the tag, or the word in a class, id or role.
SEMANTIC = r"(?i)<(?:article|main)(?![a-z0-9:-])|<[a-z][^<>]*\s(?:class|id|role)\s*=[^<>]*(?<![a-z])(?:article|main)(?![a-z])"


def seed_label(path) -> int:
    """1 for a block inside article or main and inside nothing that is a side block by name."""
    names = {n.lstrip(".") for e in path for n in e}
    return int(bool(names & {"article", "main"}) and not names & _SIDE_NAMES and "title" not in names)


def weak_labels(page) -> list[int]:
    """Labels of a page that names no main element, by fixed rules: paragraphs of at least
    ``WEAK_CHARS`` characters with few links outside side containers are main text, and so is
    any short block, such as a heading, between or right before them in the same container."""
    side = [bool({n.lstrip(".") for e in path for n in e} & _SIDE_NAMES) or links > 0.3 for _, path, links in page]
    long = [not s and len(text) >= WEAK_CHARS for s, (text, _, _) in zip(side, page)]
    out = [int(x) for x in long]
    for i in range(len(page) - 2, -1, -1):
        if out[i + 1] and not side[i] and page[i][1][:-1] == page[i + 1][1][:-1]:
            out[i] = 1
    return out


#: Characters of a block that is main text by itself under ``weak_labels``.
WEAK_CHARS = 80


def disguise(page, rng: random.Random):
    """A page as another site might mark it up: [(text, path, links, label)]."""
    renamed: dict = {}

    def rename(element):
        if element not in renamed:
            names = {n.lstrip(".") for n in element}
            new = element
            if names & {"article", "main"}:
                new = rng.choice([element, ("div", "." + rng.choice(MAIN)), ("section", "." + rng.choice(MAIN)), ("main",), ("div",)])
            else:
                for kind in SIDE.values():
                    if names & set(kind):
                        new = rng.choice([element, ("div", "." + rng.choice(kind)), ("section", "." + rng.choice(kind)), element])
            renamed[element] = new
        return renamed[element]

    out = [(t, tuple(rename(e) for e in p), a, seed_label(p)) for t, p, a in page]
    body = [x for x in out if x[3]]
    base = next((p[:2] for _, p, _, _ in out if len(p) > 2), (("html",), ("body",)))
    for kind, names in SIDE.items():
        if body and rng.random() < 0.35:
            box = (rng.choice([(kind if kind in ("nav", "header", "footer", "aside", "form") else "div",), ("div", "." + rng.choice(names)),
                               ("section", "." + rng.choice(names))]))
            if box == ("div",):
                box = ("div", "." + names[0])
            where = rng.choice(["before", "after", "inside"])
            inner = body[-1][1][:-1] if where == "inside" else base
            some = [(rng.choice(body)[0][:rng.randrange(20, 200)], (*inner, box, (rng.choice(["p", "li", "div"]),)), 0.0, 0)
                    for _ in range(rng.randrange(1, 5))]
            at = [i for i, x in enumerate(out) if x[3]]
            i = at[0] if where == "before" else at[-1] + 1 if where == "after" else rng.choice(at)
            out[i:i] = some
    return out


_PATHS: dict = {}
_WORDS: dict = {}


def _path_buckets(path):
    got = _PATHS.get(path)
    if got is None:
        if len(_PATHS) > 50_000:
            _PATHS.clear()
        near = [f"{depth}{n}" for depth, e in enumerate(reversed(path[-2:])) for n in e]
        got = _PATHS[path] = [zlib.crc32(n.encode()) % PATH_DIM for n in [n for e in path for n in e] + near]
    return got


def _word_bucket(word):
    got = _WORDS.get(word)
    if got is None:
        if len(_WORDS) > 200_000:
            _WORDS.clear()
        got = _WORDS[word] = zlib.crc32(word.lower().encode()) % WORD_DIM
    return got


def vectors(rows) -> np.ndarray:
    """[block, DIM] of (text, path, links, ...) rows."""
    at, value = [], []
    shape = np.zeros((len(rows), SHAPES), np.float32)
    for i, (text, path, links, *_) in enumerate(rows):
        base = i * DIM
        for b in _path_buckets(path):
            at.append(base + b)
            value.append(1.0)
        words = text.split(" ")
        one = 1.0 / len(words)
        for w in words:
            at.append(base + PATH_DIM + _word_bucket(w))
            value.append(one)
        shape[i] = (np.log1p(len(text)) / 8, np.log1p(len(words)) / 6, links, text[-1] in ".!?:;", len(path) / 8, 1.0)
    x = np.bincount(np.array(at, np.int64), weights=np.array(value), minlength=len(rows) * DIM).reshape(-1, DIM).astype(np.float32)
    x[:, -SHAPES:] = shape
    return np.minimum(x, 2.0)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-x))


class BiLstm:
    """Bidirectional LSTM with a logistic output per step."""

    def __init__(self, weights: dict | None = None, seed: int = 0):
        if weights is None:
            rng = np.random.default_rng(seed)
            weights = {}
            for d in "fb":
                weights["x" + d] = (rng.standard_normal((DIM, 4 * HIDDEN)) * 0.1).astype(np.float32)
                weights["h" + d] = (rng.standard_normal((HIDDEN, 4 * HIDDEN)) * 0.2).astype(np.float32)
                bias = np.zeros(4 * HIDDEN, np.float32)
                bias[HIDDEN:2 * HIDDEN] = 1.0
                weights["c" + d] = bias
            weights["o"] = (rng.standard_normal(2 * HIDDEN) * 0.2).astype(np.float32)
            weights["q"] = np.zeros(1, np.float32)
        self.w = weights

    def _run(self, z, d, lengths, keep=None):
        """States [time, page, HIDDEN] from inputs z [time, page, 4 * HIDDEN]; the
        pages are ordered by length, longest first, and none reads past its end."""
        steps, n, _ = z.shape
        h = np.zeros((n, HIDDEN), np.float32)
        c = np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((steps, n, HIDDEN), np.float32)
        alive = np.searchsorted(-lengths, -np.arange(steps), side="left")
        for t in (range(steps) if d == "f" else range(steps - 1, -1, -1)):
            m = alive[t]
            g = z[t, :m] + h[:m] @ self.w["h" + d]
            i, f, o = (_sigmoid(g[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            u = np.tanh(g[:, 3 * HIDDEN:])
            old_c, old_h = c[:m].copy(), h[:m].copy()
            c[:m] = f * old_c + i * u
            tc = np.tanh(c[:m])
            h[:m] = o * tc
            out[t, :m] = h[:m]
            if keep is not None:
                keep.append((t, m, i, f, o, u, old_c, old_h, tc))
        return out

    def logits(self, x, lengths):
        """x [time, page, DIM] to logits [time, page]."""
        f = self._run(x @ self.w["xf"] + self.w["cf"], "f", lengths)
        b = self._run(x @ self.w["xb"] + self.w["cb"], "b", lengths)
        return np.concatenate([f, b], axis=2) @ self.w["o"] + self.w["q"][0]

    def gradients(self, x, lengths, y, mask):
        """Gradients of the mean logistic loss, by back-propagation through time."""
        keeps, hs = {}, {}
        for d in "fb":
            keeps[d] = []
            hs[d] = self._run(x @ self.w["x" + d] + self.w["c" + d], d, lengths, keeps[d])
        both = np.concatenate([hs["f"], hs["b"]], axis=2)
        e = (_sigmoid(both @ self.w["o"] + self.w["q"][0]) - y) * mask / max(1.0, mask.sum())
        grad = {"o": np.einsum("tn,tnh->h", e, both), "q": np.array([e.sum()])}
        for k, d in enumerate("fb"):
            wo = self.w["o"][k * HIDDEN:(k + 1) * HIDDEN]
            dz = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            dwh = np.zeros_like(self.w["h" + d])
            dh = np.zeros((x.shape[1], HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            for t, m, i, f, o, u, old_c, old_h, tc in reversed(keeps[d]):
                top = dh[:m] + e[t, :m, None] * wo
                cell = dc[:m] + top * o * (1 - tc * tc)
                g = np.concatenate([cell * u * i * (1 - i), cell * old_c * f * (1 - f), top * tc * o * (1 - o), cell * i * (1 - u * u)], axis=1)
                dz[t, :m] = g
                dwh += old_h.T @ g
                dh[:m] = g @ self.w["h" + d].T
                dc[:m] = cell * f
            grad["x" + d] = np.tensordot(x, dz, axes=([0, 1], [0, 1]))
            grad["h" + d] = dwh
            grad["c" + d] = dz.sum(axis=(0, 1))
        return grad

    @staticmethod
    def _batches(pages):
        """Consecutive pages as batches, each with its longest page first."""
        batch, longest = [], 0
        for p in pages:
            if batch and (len(batch) == BATCH or (len(batch) + 1) * max(longest, len(p[1])) > BATCH_BLOCKS):
                yield sorted(batch, key=lambda p: -len(p[1]))
                batch, longest = [], 0
            batch.append(p)
            longest = max(longest, len(p[1]))
        if batch:
            yield sorted(batch, key=lambda p: -len(p[1]))

    def fit(self, pages, seed: int = 0):
        """pages: [(vectors, labels)]; Adam over shuffled batches."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(w) for k, w in self.w.items()}
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(pages))
            for some in self._batches([pages[i] for i in order]):
                lengths = np.array([len(p[1]) for p in some])
                x = np.zeros((lengths[0], len(some), DIM), np.float32)
                y = np.zeros(x.shape[:2], np.float32)
                mask = np.zeros(x.shape[:2], np.float32)
                for j, (vec, lab) in enumerate(some):
                    x[:len(lab), j], y[:len(lab), j], mask[:len(lab), j] = vec, lab, 1
                grad = self.gradients(x, lengths, y, mask)
                step += 1
                for k, g in grad.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.w[k] = (self.w[k] - RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)

    def label(self, pages) -> list[np.ndarray]:
        """A boolean per block of each page; ``pages``: lists of block rows."""
        out: list = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: -len(pages[i]))
        a = 0
        while a < len(order):
            wide = max(1, STEP_BLOCKS // len(pages[order[a]]))
            some = order[a:a + wide]
            lengths = np.array([len(pages[i]) for i in some])
            flat = vectors([r for i in some for r in pages[i]])
            x = np.zeros((lengths[0], len(some), DIM), np.float32)
            at = 0
            for j, n in enumerate(lengths):
                x[:n, j] = flat[at:at + n]
                at += n
            z = self.logits(x, lengths)
            for j, i in enumerate(some):
                out[i] = z[:lengths[j], j] > 0
            a += wide
        return out


def _fit_task(batches):
    rows = pd.concat(list(batches), ignore_index=True).sort_values(["r", "html"])
    named, weak = [], []
    for html in rows["html"]:
        page = blocks(html)
        if any(seed_label(b[1]) for b in page):
            named.append((vectors(page), np.array([seed_label(b[1]) for b in page], np.float32)))
            for k in range(1, DISGUISES):
                d = disguise(page, random.Random(f"{zlib.crc32(html.encode())}-{k}"))
                if d:
                    named.append((vectors(d), np.array([x[3] for x in d], np.float32)))
        elif page:
            weak.append((vectors(page), np.array(weak_labels(page), np.float32)))
    net = BiLstm()
    net.fit(named or weak)
    raw = io.BytesIO()
    np.savez(raw, **net.w)
    yield pd.DataFrame({"weights": [raw.getvalue()]})


def _sample(p: DataFrame, rows: int) -> DataFrame | None:
    """The ``rows`` pages of least hash, once each; None if there are no pages."""
    r = F.xxhash64("url", "html")
    cut = store(p.select(r.alias("r")).orderBy("r").limit(rows).agg(F.max("r").alias("top")), "html-train-cut").first()[0]
    return None if cut is None else p.select("html", r.alias("r")).where(F.col("r") <= cut).distinct().orderBy("r").limit(rows)


def fit(pages: DataFrame, rows: int = TRAIN_PAGES) -> bytes:
    """The weights, fitted in one task on at most ``rows`` whole pages that name an article
    or main element, the first by a hash of url and html. Where no page names one,
    pages are taken all the same and labelled by ``weak_labels``. Pages without html or
    blocks teach nothing; a table without any leaves the network untrained."""
    p = pick(pages, url="url", html="html")
    train = _sample(p.where(F.col("html").rlike(SEMANTIC)), rows) or _sample(p.where(F.col("html").contains("<") | (F.length("html") > 0)), rows)
    if train is None:
        raw = io.BytesIO()
        np.savez(raw, **BiLstm().w)
        return raw.getvalue()
    return bytes(train.repartition(1).mapInPandas(_fit_task, "weights binary").first()[0])


def extract(pages: DataFrame, weights: bytes, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text: main blocks in page order, joined by two newlines; one
    row per input row. Null or blockless html gives an empty text."""
    p = pick(pages, page_id=id_col, url=url_col, html=html_col)
    kind = p.schema["page_id"].dataType.simpleString()
    shared = p.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        net = BiLstm(dict(np.load(io.BytesIO(shared.value))))
        for b in batches:
            found = [blocks(h) for h in b["html"]]
            text = ["\n\n".join(r[0] for r, k in zip(page, keep) if k) for page, keep in zip(found, net.label(found))]
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": pd.Series(text, dtype=object, index=b.index)})

    return p.mapInPandas(run, f"page_id {kind}, url string, text string")


def extraction_report(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per input row, repeated ids included; null or blockless
    html gives an empty text, an empty table an empty table. Other columns change nothing."""
    return extract(pages, fit(pages)).withColumn("n_chars", F.length("text").cast("bigint"))


ship_by_value(html_blocks)
ship_by_value(sys.modules[__name__])
