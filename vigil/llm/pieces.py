"""SentencePiece encoding and decoding with a prefix table.

A vocabulary of scored pieces defines the encoding: the characters of a text are
merged pair by pair, always the adjacent pair that makes the piece of the best score
(ties: the leftmost), until no pair makes a piece; characters without a piece fall back
to their UTF-8 bytes. No merge looks beyond the tokens it makes, hence

- the encoding of every prefix of a text ends in one certain last token, and
- a token may follow another exactly if the two encode to themselves side by side.

So one pass over the text suffices: an automaton names the tokens that end at a
position, longest first; the one that is compatible with the last token of the
prefix before it is stored. The ids are recovered from the end. Compatibility of a
pair is found once per pair: the merges that make the two tokens are played in the order of
their scores, watching whether the two symbols at the border would merge first.

No piece holds a space mark after another character (if the vocabulary is so), nor
a character that only stands alone: the text falls apart there, and a part that
was met before is looked up.
"""

from __future__ import annotations

import codecs
import re
import sys
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vigil.llm.common import pick
from vigil.session import ship_by_value

#: What stands for a space inside pieces.
MARK = "▁"
#: Characters of texts that are encoded before a batch of results is handed on.
PORTION_CHARS = 1 << 20
#: Parts and pairs that a task remembers; beyond it starts anew (parts of over LONG characters are not kept).
MEMORY = 400_000
LONG = 64
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = range(4)
_NEVER = float("-inf")


class Vocabulary(NamedTuple):
    """What encoding needs to know of a model; a few hundred kilobytes."""

    pieces: list[str]
    scores: list[float]
    kinds: bytes
    eos: int


def load(path: str) -> Vocabulary:
    """The vocabulary of a SentencePiece BPE model with byte fallback, a dummy prefix, marked
    spaces and identity normalisation; others are refused."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    spec, norm, kind = model.trainer_spec, model.normalizer_spec, proto.ModelProto.SentencePiece
    names = {kind.NORMAL: _NORMAL, kind.UNKNOWN: _UNKNOWN, kind.CONTROL: _CONTROL, kind.BYTE: _BYTE}
    plain = norm.add_dummy_prefix and norm.escape_whitespaces and not (norm.remove_extra_whitespaces or norm.precompiled_charsmap)
    if spec.model_type != proto.TrainerSpec.BPE or not spec.byte_fallback or spec.treat_whitespace_as_suffix or not plain \
            or any(p.type not in names for p in model.pieces):
        raise ValueError("not a byte-fallback BPE model with identity normalisation: " + path)
    eos = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString()).eos_id()
    return Vocabulary([p.piece for p in model.pieces], [p.score for p in model.pieces], bytes(names[p.type] for p in model.pieces), eos)


class Encoder:
    """Encodes and decodes by a vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        pieces, kinds = vocabulary.pieces, vocabulary.kinds
        self.number = {p: i for i, p in enumerate(pieces) if kinds[i] == _NORMAL}
        self.score = {p: vocabulary.scores[i] for p, i in self.number.items()}
        self.byte = {int(pieces[i][1:-1], 16): i for i in range(len(pieces)) if kinds[i] == _BYTE}
        inner = sorted({ch for p in self.number if len(p) > 1 for ch in p})
        #: token number to its text; characters that only occur inside pieces get numbers after the ids
        self.text = list(pieces) + [ch for ch in inner if ch not in self.number]
        self.tokens = {t: i for i, t in enumerate(self.text) if i >= len(pieces) or kinds[i] == _NORMAL}
        self.automaton = ahocorasick.Automaton()
        self.whole = {}
        #: token number to the merges that make it: score, then the first and the last symbol at that time
        self.made: dict[int, list[tuple[float, str, str]]] = {}
        for t, i in self.tokens.items():
            steps: list[tuple[float, str, str]] = []
            if self.merge(t, steps) == [t]:  # a piece that no merges lead to is never used
                self.whole[t] = (i,)
                self.made[i] = steps
                self.automaton.add_word(t, (i, len(t)))
        self.automaton.make_automaton()
        chars = "".join(re.escape(ch) for ch in inner if ch != MARK)
        if any(MARK in p.lstrip(MARK) for p in self.number) or MARK not in inner:
            mark = re.escape(MARK) if MARK in inner else ""
            parts = f"[{mark}{chars}]+|" if mark + chars else ""
        else:
            parts = f"{MARK}+[{chars}]*|[{chars}]+|" if chars else f"{MARK}+|"
        self.parts = re.compile(parts + ".", re.DOTALL)
        self.fits: dict[int, bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.shown = [self._shown(i) for i in range(len(pieces))]

    def _shown(self, i: int) -> str:
        kind, piece = self.vocabulary.kinds[i], self.vocabulary.pieces[i]
        if kind == _BYTE:
            return bytes([int(piece[1:-1], 16)]).decode("utf-8", "surrogateescape")
        return "" if kind == _CONTROL else " ⁇ " if kind == _UNKNOWN else piece.replace(MARK, " ")

    def merge(self, text: str, steps: list | None = None) -> list[str]:
        """The definition: merges of a short text, best score first, then leftmost. ``steps``
        gets the score of every merge, and the first and the last symbol just before it."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            if steps is not None:
                steps.append((best, parts[0], parts[-1]))
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, encode to themselves."""
        one, two, score = self.made[left], self.made[right], self.score
        i = j = 0
        while True:
            s1, _, end = one[i] if i < len(one) else (_NEVER, "", self.text[left])
            s2, start, _ = two[j] if j < len(two) else (_NEVER, self.text[right], "")
            cross = score.get(end + start)
            if cross is not None and cross > s1 and cross >= s2:  # of equal scores the leftmost pair merges
                return False
            if s1 == _NEVER and s2 == _NEVER:
                return True
            if s1 >= s2:
                i += 1
            else:
                j += 1

    def last_tokens(self, part: str) -> list[int]:
        """The last token of the encoding of every prefix of ``part``; -1 for the empty one."""
        last = [-1] * (len(part) + 1)
        width, fits = len(self.text), self.fits
        for end, (token, size) in self.automaton.iter(part):
            if last[end + 1] >= 0:
                continue  # a longer match was the one
            before = last[end + 1 - size]
            if size == end + 1:
                last[end + 1] = token
                continue
            key = before * width + token
            ok = fits.get(key)
            if ok is None:
                if len(fits) >= MEMORY:
                    fits.clear()
                ok = fits[key] = self.compatible(before, token)
            if ok:
                last[end + 1] = token
        return last

    def _encode_part(self, part: str) -> tuple[int, ...]:
        tokens = self.whole.get(part)
        if tokens is None and len(part) == 1 and part not in self.tokens:
            return self._bytes(part)
        if tokens is None:
            last, i, back = self.last_tokens(part), len(part), []
            while i:
                back.append(last[i])
                i -= len(self.text[last[i]])
            tokens = tuple(reversed(back))
        ids = len(self.vocabulary.pieces)
        if max(tokens) >= ids:
            tokens = tuple(x for t in tokens for x in ((t,) if t < ids else self._bytes(self.text[t])))
        return tokens

    def _bytes(self, ch: str) -> tuple[int, ...]:
        return tuple(self.byte[b] for b in ch.encode())

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text, without an end id; an empty text has none."""
        out: list[int] = []
        if not text:
            return out
        known = self.known
        for part in self.parts.findall(MARK + text.replace(" ", MARK)):
            ids = known.get(part)
            if ids is None:
                ids = self._encode_part(part)
                if len(part) <= LONG:
                    if len(known) >= MEMORY:
                        known.clear()
                    known[part] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of any ids: marks become spaces, the one of the dummy prefix goes, control ids
        are silent, and bytes that are not UTF-8 become U+FFFD one by one."""
        kinds, pieces, shown = self.vocabulary.kinds, self.vocabulary.pieces, self.shown
        out, spoken, lo = [], False, 0
        for hi in [k for k, i in enumerate(ids) if kinds[i] == _CONTROL] + [len(ids)]:
            if hi > lo:  # bytes of one character do not reach across a control id
                text = "".join(map(shown.__getitem__, ids[lo:hi]))
                if not spoken and kinds[ids[lo]] == _NORMAL and pieces[ids[lo]].startswith(MARK):
                    text = text[1:]
                out.append(text if text.isascii() else text.encode("utf-8", "surrogateescape").decode("utf-8", "vigil-one-byte"))
                spoken = True
            lo = hi + 1
        return "".join(out)


def _one_byte(e: UnicodeDecodeError):
    return "�", e.start + 1


def _encoded(coder: Encoder, ids: pa.Array, texts: list) -> pa.RecordBatch:
    rows = [coder.encode(t or "") for t in texts]
    decoded = [coder.decode(r) for r in rows]
    for r in rows:
        r.append(coder.vocabulary.eos)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate([np.array(r, dtype=np.int32) for r in rows])
    return pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(decoded, pa.string())], names=["id", "ids", "decoded"])


def encode_texts(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (with the end id) and decoded, the text that the ids decode to, of every row.

    A null text is empty: the end id alone, decoded to an empty text. Rows are judged one by
    one: repeated rows, null ids and other columns change nothing, an empty table gives an
    empty table, and a text of any length is encoded whole, in time linear in it.
    """
    d = pick(docs, id=id_col, text=text_col)
    kind = d.schema["id"].dataType
    id_type = to_arrow_type(kind)

    def run(batches):
        codecs.register_error("vigil-one-byte", _one_byte)
        coder = Encoder(vocabulary)
        for b in batches:
            ids, texts = b.column(0).cast(id_type), b.column(1)
            size = np.array([0 if x is None else x for x in pa.compute.binary_length(texts).to_pylist()], dtype=np.int64)
            portion = np.cumsum(size) // PORTION_CHARS
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(portion)) + 1, [len(size)]])
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if hi > lo:
                    yield _encoded(coder, ids.slice(lo, hi - lo), texts.slice(lo, hi - lo).to_pylist())

    return d.mapInArrow(run, f"id {kind.simpleString()}, ids array<int>, decoded string").withColumnRenamed("id", "doc_id")


def encoding_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: one row per input row. ``path``: the
    model, by default the public 32k one."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("piece_bpe_32k.model")
    e = encode_texts(docs, load(path))
    ids = F.array_join(F.transform("ids", lambda x: x.cast("string")), " ")
    return e.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
                    F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


codecs.register_error("vigil-one-byte", _one_byte)
ship_by_value(sys.modules[__name__])
