"""Serialise a sentencepiece model from its pieces, field by field in protocol-buffer wire format."""

from __future__ import annotations

import struct
from collections.abc import Iterable

# Fixed values of the public model format: field numbers, piece types and model types.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, TYPE = 1, 2, 3
MODEL_TYPE, BYTE_FALLBACK, UNK_ID, BOS_ID, EOS_ID, PAD_ID = 3, 35, 40, 41, 42, 43
NAME, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE_SPACES = 1, 3, 4, 5
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNIGRAM, BPE = 1, 2


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def serialise(
    pieces: Iterable[tuple[str, float, int]], model_type: int, byte_fallback: bool, dummy_prefix: bool, escape: bool
) -> bytes:
    """A model of (piece, score, type) with identity normalisation; ids are positions."""
    out, unknown = [], 0
    for number, (piece, score, kind) in enumerate(pieces):
        if kind == UNKNOWN:
            unknown = number
        body = _bytes(PIECE, piece.encode()) + _varint(SCORE << 3 | 5) + struct.pack("<f", score) + _number(TYPE, kind)
        out.append(_bytes(PIECES, body))
    absent = b"".join(_number(f, -1) for f in (BOS_ID, EOS_ID, PAD_ID))
    trainer = _number(MODEL_TYPE, model_type) + _number(BYTE_FALLBACK, byte_fallback) + _number(UNK_ID, unknown) + absent
    normalizer = (
        _bytes(NAME, b"identity") + _number(DUMMY_PREFIX, dummy_prefix) + _number(EXTRA_SPACES, 0)
        + _number(ESCAPE_SPACES, escape)
    )
    return b"".join(out) + _bytes(TRAINER, trainer) + _bytes(NORMALIZER, normalizer)
