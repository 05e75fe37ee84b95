"""Byte-level BPE through a sentencepiece model that is written straight from a vocabulary.

Every byte is mapped to one letter (U+0100 + byte), every token to the string of its bytes'
letters. The pieces' score is the token's negative rank, normalisation is the identity and no
space is added or escaped, so the model's merges (best score first, then leftmost) are those
of the ranks. Each match of the pre-token pattern is encoded by itself: a token of the
vocabulary as it is, anything else by the model. Decoding maps pieces back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .text import map_arrow

#: The first of 256 letters that stand for the bytes; none is white space or U+2581.
LETTER = 0x100
_UNKNOWN = "⁇"
#: Pre-tokens a worker remembers with their ids, at most; beyond it the memory starts anew.
REMEMBERED = 200_000


def read_ranks(spark: SparkSession, path: str) -> list[bytes]:
    """Tokens by rank, from a file of base64 tokens and ranks.

    ``path`` lies on the driver (a vocabulary has a fixed size); Spark reads any other scheme.
    """
    if "://" in path:
        lines = [r[0] for r in spark.read.text(path).collect()]
    else:
        with open(path, encoding="ascii") as f:
            lines = f.read().splitlines()
    ranks = {int(n): base64.b64decode(t) for t, n in (x.split() for x in lines if x.strip())}
    if sorted(ranks) != list(range(len(ranks))) or len(set(ranks.values())) != len(ranks):
        raise ValueError("ranks have to be 0, 1, ... for tokens that differ")
    if any(bytes([b]) not in set(ranks.values()) for b in range(256)):
        raise ValueError("a byte-level vocabulary holds all 256 bytes")
    return [ranks[i] for i in range(len(ranks))]


def letters(token: bytes) -> str:
    return token.decode("latin-1").translate({b: LETTER + b for b in range(256)})


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """One field of a protocol buffer message: bytes, float or whole number."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialise(tokens: list[bytes]) -> bytes:
    """The model: pieces (field 1: text 1, score 2, type 3), trainer (2) and normaliser (3).

    Piece ``i`` is token ``i``; the unknown piece, which every model must have, comes last.
    """
    pieces = b"".join(_field(1, _field(1, letters(t).encode()) + _field(2, -float(rank)))
                      for rank, t in enumerate(tokens))
    pieces += _field(1, _field(1, _UNKNOWN.encode()) + _field(2, -float(len(tokens)))
                     + _field(3, 2))
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens))
    trainer += _field(41, (1 << 64) - 1) + _field(42, (1 << 64) - 1) + _field(43, (1 << 64) - 1)
    trainer += _field(45, _UNKNOWN.encode())
    plain = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return pieces + _field(2, trainer) + _field(3, plain)


class Coder:
    """Encodes and decodes texts with a serialised model."""

    def __init__(self, model: bytes, pattern: str):
        import regex
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self._model.get_piece_size() - 1
        back = {LETTER + b: b for b in range(256)}
        self.tokens = [self._model.id_to_piece(i).translate(back).encode("latin-1")
                       for i in range(n)]
        self._split = regex.compile(pattern).findall
        self._there = {t: i for i, t in enumerate(self.tokens)}
        self._to_letters = {b: LETTER + b for b in range(256)}
        self._known: dict[str, tuple[int, ...]] = {}

    def _new(self, pieces: list[str]) -> None:
        """Encodes pre-tokens not met before, all in one call."""
        known, rest = self._known, []
        if len(known) + len(pieces) > REMEMBERED:
            known.clear()
        for p in pieces:
            raw = p.encode()
            if (i := self._there.get(raw)) is not None:
                known[p] = (i,)
            else:
                rest.append((p, raw.decode("latin-1").translate(self._to_letters)))
        if rest:
            found = self._model.encode([m for _, m in rest], num_threads=1)
            known.update((p, tuple(ids)) for (p, _), ids in zip(rest, found, strict=True))

    def encode(self, text: str) -> list[int]:
        parts = self._split(text)
        known = self._known
        new = set(parts).difference(known)
        if new:
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = set(parts)
            self._new(list(new))
        return [i for p in parts for i in known[p]]

    def decode(self, ids: list[int]) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])


def encode(docs: DataFrame, tokens: list[bytes], pattern: str, text: str = "text",
           key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Per row: key, n_tokens, ids_sha256, decoded_sha256 and, if asked, the ids themselves.

    A null text is empty; an empty text has no ids. Rows with one key stay apart. One narrow
    pass: nothing is shuffled, and a task holds one text's ids at a time.
    """
    model = serialise(tokens)
    schema = f"{key} long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (
        ", ids array<int>" if with_ids else "")
    coder: list[Coder] = []

    def run(batch: pa.RecordBatch):
        if not coder:
            coder.append(Coder(model, pattern))
        size, named, back, every = [], [], [], []
        for x in batch.column(1):
            ids = coder[0].encode(x.as_py() or "")
            size.append(len(ids))
            named.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
            back.append(hashlib.sha256(coder[0].decode(ids)).hexdigest())
            if with_ids:
                every.append(ids)
        yield [batch.column(0), size, named, back] + ([every] if with_ids else [])

    return map_arrow(docs.select(docs[key].cast("long").alias(key), docs[text].alias("text")),
                     run, schema)
