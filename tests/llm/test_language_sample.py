"""The learnt sample of a language."""

import zlib

import numpy as np
import pandas as pd

from vigil.llm import language


def test_a_long_document_leaves_every_other_one_its_share():
    words = ["".join(chr(97 + (i * p) % 26) for p in (1, 3, 7)) + "q" for i in range(20)]
    texts = ["lorem ipsum " * 20_000] + [w * 60 for w in words] + ["", "12 34"]
    rows = pd.DataFrame({"lang": "la", "r": range(len(texts)), "text": texts})
    got = language._build(rows).iloc[0]
    edges = np.frombuffer(zlib.decompress(got["edges"]), dtype=np.int32).reshape(-1, 3)
    step = {(s, c): t for s, c, t in edges.tolist()}

    def spelt(word):
        at = 0
        for ch in word:
            at = step.get((at, ord(ch)))
            if at is None:
                return False
        return True

    assert all(spelt(w * 60) for w in words) and spelt("lorem ipsum lorem")
    assert language.TRAIN_CHARS - len(texts) <= got["n"] <= language.TRAIN_CHARS
