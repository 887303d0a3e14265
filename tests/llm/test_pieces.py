import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from tests.conftest import SF_SMOKE
from tests.llm import cases
from vigil.llm import pieces
from vigil.llm.common import table

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def coder():
    return pieces.Encoder(pieces.load(PATH))


def strange_text(rng):
    parts = ["  ", " ", "\n", "a", "the", "▁", "▁▁", "é", "é", "中文", "梦", "🎉", "\x00", "ing", "==", "----", "\t", "ﬁ", "<s>", "</s>", "<0x0A>", "﻿"]
    pick = lambda: chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x370, 0x2000), rng.randrange(0x3000, 0xD7FF), rng.randrange(0x10000, 0x1FFFF)]))
    return "".join(rng.choice(parts) if rng.random() < 0.7 else pick() for _ in range(rng.randrange(30)))


def test_encoding_and_decoding_equal_the_library(library, coder):
    rng = random.Random(2)
    for text in ["", " ", "▁", "\n", "a" * 5000, " " * 4000, "ab" * 3000 + "  " + "中" * 300] + [strange_text(rng) for _ in range(4000)]:
        ids = library.encode(text)
        assert coder.encode(text) == ids
        assert coder.decode(ids) == library.decode(ids)
        assert coder.decode(ids) == text.replace("▁", " ")  # the round trip


def test_decoding_of_any_ids(library, coder):
    rng = random.Random(3)
    for _ in range(4000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), 0, 1, 2, 259, 28705]) for _ in range(rng.randrange(12))]
        assert coder.decode(ids) == library.decode(ids)


def test_pairs_are_compatible_if_merging_leaves_them(coder):
    rng = random.Random(4)
    tokens = sorted(coder.made)
    near = [t for t in tokens if set(coder.text[t]) <= set("▁thein")]
    for some in (tokens, near):
        for _ in range(6000):
            a, b = rng.choice(some), rng.choice(some)
            assert coder.compatible(a, b) == (coder.merge(coder.text[a] + coder.text[b]) == [coder.text[a], coder.text[b]])


def test_every_prefix_has_its_last_token(coder):
    text = "▁▁▁internationalisations"
    last = coder.last_tokens(text)
    for i in range(1, len(text) + 1):
        assert coder.merge(text[:i])[-1] == coder.text[last[i]]


def small(pieces_, **more):
    scores = [-float(i) for i in range(len(pieces_))]
    return pieces.Encoder(pieces.Vocabulary(["<unk>", "</s>"] + ["<0x%02X>" % b for b in range(256)] + pieces_, [0.0] * 258 + scores,
                                            bytes([1, 2] + [3] * 256 + [0] * len(pieces_)), 1))


def test_other_vocabularies():
    # a mark inside a piece, a piece that merges never reach, characters that only occur inside pieces
    coder = small(["a▁b", "▁b", "ab", "abc", "bc", "xy", "a", "b", "c", "▁"])
    rng = random.Random(5)
    for _ in range(2000):
        text = "".join(rng.choice("aabbc xyé") for _ in range(rng.randrange(1, 14)))
        want = [i for p in coder.merge("▁" + text.replace(" ", "▁")) for i in ([coder.number[p]] if p in coder.number else coder._bytes(p))]
        assert coder.encode(text) == want
        assert coder.decode(want) == text


def test_memory_is_bounded_and_changes_nothing(monkeypatch, coder):
    monkeypatch.setattr(pieces, "MEMORY", 5)
    other = pieces.Encoder(coder.vocabulary)
    text = "one two three four five six seven eight nine ten eleven " * 3
    assert other.encode(text) == coder.encode(text) and len(other.known) <= 5 and len(other.fits) <= 5


def test_models_of_other_kinds_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto
    model = proto.ModelProto()
    with open(PATH, "rb") as f:
        model.ParseFromString(f.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        pieces.load(str(tmp_path / "m"))


def test_report_equals_the_library(spark, library):
    rows = cases.invented() + [(7000 + i, t, None, None, 0, "x", 1, "y", 2, 3, 4) for i, t in enumerate(["▁ a", "\x00", "🎉 \n"])]
    docs = spark.createDataFrame(rows, cases.DOC_SCHEMA)
    some = [(r[0], r[1]) for r in rows]
    some += [tuple(r) for r in table(spark, SF_SMOKE, "documents").select("doc_id", "text").collect()]
    docs = docs.select("doc_id", "text").union(table(spark, SF_SMOKE, "documents").select("doc_id", "text"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for doc, text in some:
        ids = library.encode(text or "", add_eos=True)
        want.append((doc, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))))
    out = pieces.encoding_report(docs)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert cases.bag(out.collect()) == cases.bag(want)
    assert cases.bag(pieces.encoding_report(spark.createDataFrame(rows, cases.DOC_SCHEMA)).collect()) == cases.bag(want[:len(rows)])


def test_empty_table(spark):
    assert pieces.encoding_report(spark.createDataFrame([], "doc_id string, text string")).collect() == []
