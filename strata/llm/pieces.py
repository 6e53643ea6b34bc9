"""SentencePiece encoding and decoding by Viterbi over an Aho-Corasick automaton.

The pieces and scores of a model file are read on the driver and broadcast (a
vocabulary, so of bounded size). A text gets a leading space and its pieces are
the segmentation with the greatest sum of scores: the automaton reads each
character once and, following its output links, relaxes the best score at that
position for every piece that ends there, the longest first; a later piece
wins only if it scores more. A character that is no piece is spelled with byte
pieces at a penalty below every score. The word mark U+2581 inside a text is
spelled too, so that decoding gives exactly the text.

Texts are cut between every two characters that stand side by side in no piece:
no piece can cross there, so the best pieces of each part are found alone, and
parts seen before are looked up (a bounded memory that a worker keeps from task
to task).

Null text gives null ids, empty text no ids. Decoding is total: ids outside the
vocabulary and control pieces give nothing, invalid UTF-8 the replacement
character.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from strata.llm.columns import rows_to_struct, text_column

MARK = "▁"


@dataclass
class Model:
    """Pieces with U+2581 as a space; ``spell``: the ids of the 256 byte pieces."""

    pieces: list[tuple[str, float, int]]
    spell: list[int]
    bytes_of: list[bytes]

    @property
    def penalty(self) -> float:
        return min((s for _, s, _ in self.pieces), default=0.0) - 10.0


def load_model(path: str) -> Model:
    """Reads a SentencePiece model file with byte pieces (on the driver)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, spell, bytes_of = [], [-1] * 256, []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            bytes_of.append(b"")
        elif sp.is_byte(i):
            value = int(piece[3:-1], 16)
            spell[value] = i
            bytes_of.append(bytes([value]))
        else:
            plain = piece.replace(MARK, " ")
            pieces.append((plain, sp.get_score(i), i))
            bytes_of.append(plain.encode())
    if min(spell) < 0:
        raise ValueError("the model has no byte pieces")
    return Model(pieces, spell, bytes_of)


class Encoder:
    """Best pieces of texts, with a bounded memory of parts seen."""

    def __init__(self, model: Model, remember: int = 1 << 18, cut: bool = True):
        import ahocorasick

        self.machine = ahocorasick.Automaton()
        for piece, score, i in model.pieces:
            self.machine.add_word(piece, (len(piece) - 1, score, i))
        self.machine.make_automaton()
        self.single = {p for p, _, _ in model.pieces if len(p) == 1}
        self.model, self.penalty, self.remember, self.cut = model, model.penalty, remember, cut
        self.memo: dict[str, bytes] = {}
        # characters of longer pieces get a class; joined: the pairs that stand side by side in one
        longer = [p for p, _, _ in model.pieces if len(p) > 1]
        chars = sorted(set("".join(longer)))
        self.kind = np.zeros(0x110000, np.uint16)
        self.kind[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.joined = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        kinds = [self._kinds(p) for p in longer]
        self.joined[np.concatenate([k[:-1] for k in kinds] or [np.zeros(0, int)]),
                    np.concatenate([k[1:] for k in kinds] or [np.zeros(0, int)])] = True

    def _kinds(self, text: str) -> np.ndarray:
        return self.kind[np.frombuffer(text.encode("utf-32-le"), np.uint32)]

    def parts(self, text: str) -> list[str]:
        if not self.cut:
            return [text]
        k = self._kinds(text)
        at = [0, *(np.flatnonzero(~self.joined[k[:-1], k[1:]]) + 1).tolist(), len(text)]
        return [text[a:b] for a, b in zip(at, at[1:])]

    def best(self, part: str) -> bytes:
        """The ids of one part, as int32 bytes."""
        n = len(part)
        low = float("-inf")
        score, start, piece = [0.0] + [low] * n, [0] * (n + 1), [-1] * (n + 1)
        spelled = not self.single.issuperset(part)
        at = 0
        for last, (less, gain, i) in self.machine.iter(part):
            if spelled and at < last:
                at = self._spell(part, score, start, at, last)
            value = score[last - less] + gain
            if value > score[last + 1]:
                score[last + 1], start[last + 1], piece[last + 1] = value, last - less, i
        if spelled:
            self._spell(part, score, start, at, n)
        ids: list[int] = []
        while n:
            before, i = start[n], piece[n]
            if i >= 0:
                ids.append(i)
            else:
                ids.extend(self.model.spell[b] for b in reversed(part[before:n].encode()))
            n = before
        return np.array(ids[::-1], np.int32).tobytes()

    def _spell(self, part: str, score: list, start: list, at: int, stop: int) -> int:
        """Characters up to ``stop`` without a piece of their own."""
        while at < stop:
            at += 1
            if part[at - 1] not in self.single and score[at - 1] + self.penalty > score[at]:
                score[at], start[at] = score[at - 1] + self.penalty, at - 1
        return at

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        parts = self.parts(" " + text)
        found = list(map(self.memo.get, parts))
        if None in found:
            for k, x in enumerate(found):
                if x is None:
                    part = parts[k]
                    x = self.memo.get(part)
                    if x is None:
                        x = self.best(part)
                        if len(part) <= 64:
                            if len(self.memo) >= self.remember:
                                self.memo.clear()
                            self.memo[part] = x
                    found[k] = x
        return b"".join(found)


#: the encoder of the last model used by this worker, by its name
_KEPT: dict[str, Encoder] = {}


def _encoder(shared) -> Encoder:
    if shared.name not in _KEPT:
        _KEPT.clear()
        _KEPT[shared.name] = Encoder(shared.model)
    return _KEPT[shared.name]


@dataclass
class _Shared:
    """A model under a name of its own."""

    name: str
    model: Model


def _share(spark: SparkSession, model: Model):
    return spark.sparkContext.broadcast(_Shared(uuid.uuid4().hex, model))


def _list_array(parts: list[bytes | None]) -> pa.Array:
    sizes = np.array([len(p) // 4 if p is not None else 0 for p in parts], np.int64)
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    values = np.frombuffer(b"".join(p for p in parts if p), np.int32)
    mask = pa.array([p is None for p in parts], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()), mask=mask)


def ids_column(spark: SparkSession, text: Column, model: Model) -> Column:
    """array<int> of piece ids."""
    shared = _share(spark, model)

    def make():
        encoder = _encoder(shared.value)
        return lambda column: _list_array(
            [encoder.encode(t.as_py()) if t.is_valid else None for t in column])

    return text_column(text, "array<int>", make)


def decode_bytes(bytes_of: list[bytes], ids: list[int]) -> str:
    n = len(bytes_of)
    if ids and (min(ids) < 0 or max(ids) >= n):
        ids = [i for i in ids if 0 <= i < n]
    flat = b"".join(map(bytes_of.__getitem__, ids))
    return flat.decode("utf-8", "replace").removeprefix(" ")


def text_of_ids(spark: SparkSession, ids: Column, model: Model) -> Column:
    """The text that piece ids stand for."""
    shared = spark.sparkContext.broadcast(model.bytes_of)

    def make():
        bytes_of = shared.value

        def one(column: pa.Array) -> pa.Array:
            if not len(column):
                return pa.array([], pa.string())
            flat, cut = column.values.to_numpy(zero_copy_only=False), column.offsets.to_pylist()
            valid = column.is_valid().to_pylist()
            return pa.array([decode_bytes(bytes_of, flat[a:b].tolist()) if v else None
                             for a, b, v in zip(cut, cut[1:], valid)], pa.string())

        return one

    return text_column(ids, "string", make)


_CODED = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def coded_column(spark: SparkSession, text: Column, model: Model) -> Column:
    """Struct (ids, decoded): a text's ids and the text decoded from them, in one worker."""
    shared = _share(spark, model)

    def make():
        encoder, bytes_of = _encoder(shared.value), shared.value.model.bytes_of

        def one(column: pa.Array) -> pa.Array:
            ids, decoded = [], []
            for t in column:
                packed = encoder.encode(t.as_py()) if t.is_valid else None
                ids.append(packed)
                decoded.append(None if packed is None else
                               decode_bytes(bytes_of, np.frombuffer(packed, np.int32).tolist()))
            return rows_to_struct(_CODED, {"ids": _list_array(ids), "decoded": decoded})

        return one

    return text_column(text, "struct<ids: array<int>, decoded: string>", make)


def encode_decode(docs, model: Model, id_col: str = "doc_id", text_col: str = "text"):
    """(doc_id, ids, n_tokens, decoded) per row of ``docs``; no tokens for null."""
    coded = docs.select(F.col(id_col), coded_column(docs.sparkSession, F.col(text_col), model).alias("x"))
    return coded.select(F.col(id_col), F.col("x.ids").alias("ids"),
                        F.coalesce(F.array_size("x.ids"), F.lit(0)).cast("long").alias("n_tokens"),
                        F.col("x.decoded").alias("decoded"))
