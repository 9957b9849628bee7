"""Byte-level BPE by a sentencepiece model serialised straight from a rank vocabulary.

Every byte stands for one character, so each token of the vocabulary is a piece; its score is its
negative rank, which makes sentencepiece merge in rank order, leftmost first. Texts are cut by the
vocabulary's pattern and every match is encoded by itself; decoding maps the pieces of the ids back
to bytes. A match that is a token as it stands is that token. No special tokens are made.

Null texts are empty and have no tokens. Extra columns stay; columns named like a result are
replaced.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from spendcast.llm import sentencepiece_model as model

#: Bytes are written as the 256 characters from here, none of which the library treats specially.
FIRST = 0x100
_SHIFT = {FIRST + b: b for b in range(256)}

#: White space and the run after it. No match of the pattern goes on past such a run, and what a run
#: is cut into doesn't depend on its neighbours, so runs are encoded once. Control characters 0x1c to
#: 0x1f are white space to Python but not to the pattern.
RUN = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank. Ranks have to be 0, 1, 2 and so on, and every single byte a token."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))) or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("ranks must be gapless and hold every byte")
    return tokens


def mapped(data: bytes) -> str:
    """The characters that stand for the bytes."""
    return data.decode("latin-1").translate(_TO_CHARS)


_TO_CHARS = {b: FIRST + b for b in range(256)}


def build_model(tokens: list[bytes]) -> bytes:
    pieces = [(mapped(t), -float(rank), model.NORMAL) for rank, t in enumerate(tokens)]
    return model.serialise([*pieces, ("<unk>", 0.0, model.UNKNOWN)], model.BPE, False, False, False)


class ByteBpe:
    """Encoder and decoder of one process. Encoded runs are kept, up to ``limit`` of them."""

    def __init__(self, path: str, pattern: str, limit: int = 300_000, long_run: int = 200):
        import regex

        self.tokens = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.whole = {t: i for i, t in enumerate(self.tokens)}
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=build_model(self.tokens))
        self.known: dict[str, bytes] = {}
        self.limit, self.long_run = limit, long_run

    def _encode(self, run: str) -> bytes:
        ids: list[int] = []
        for match in self.pattern.findall(run):
            data = match.encode()
            whole = self.whole.get(data)
            ids += self.pieces.encode(mapped(data)) if whole is None else [whole]
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        known, runs = self.known, RUN.findall(text)
        try:
            return b"".join(map(known.__getitem__, runs))
        except KeyError:
            pass
        if len(known) > self.limit:
            known.clear()
        out = []
        for run in runs:
            ids = known.get(run)
            if ids is None:
                ids = self._encode(run)
                if len(run) <= self.long_run:
                    known[run] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODERS: dict[tuple[str, str], ByteBpe] = {}


def _coder(path: str, pattern: str) -> ByteBpe:
    return _CODERS.get((path, pattern)) or _CODERS.setdefault((path, pattern), ByteBpe(path, pattern))


def _map(df: DataFrame, source: str, into: str, path: str, pattern: str, method: str) -> DataFrame:
    df = df.drop(into)
    position = df.columns.index(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = getattr(_coder(path, pattern), method)
        empty = "" if method == "encode" else b""
        for batch in batches:
            made = pa.array([function(x or empty) for x in batch.column(position).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, into])

    return df.mapInArrow(run, df.limit(0).schema.add(into, "binary"))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", into: str = "ids") -> DataFrame:
    """Add the packed ids of ``text``."""
    return _map(df, text, into, path, pattern, "encode")


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the bytes that packed ids stand for."""
    return _map(df, ids, into, path, pattern, "decode")
