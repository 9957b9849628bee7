"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

Terms of a text are short runs of character classes (letters by case, digits, white space, every
other sign by itself) and marks for words and lines that repeat; TF-IDF vectors of a labelled sample
are reduced by a truncated singular value decomposition. The labelled vectors, at most about
``SAMPLE`` of ``RANK`` numbers, are broadcast. Every document's cosines with all of them are exact
matrix products over blocks of documents; the ``NEIGHBOURS`` nearest vote with their similarity.
The sample holds both classes evenly, so votes are weighed by the classes' shares among all labels.

Texts of at most ``LONGEST`` characters are learnt from; whole texts are scored. A null or empty text
has no terms and no neighbour: it scores the share of good labels, as every text does without labels.
Of equally near vectors those earlier in the sample vote. Extra columns are ignored.
"""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from spendcast.llm.common import labelled_sample, score_texts

SAMPLE, LONGEST, FOLDS, ASIDE = 5000, 50_000, 3, 1
TERMS, RANK, NEIGHBOURS, BLOCK = 4096, 48, 25, 256
_HASHED = 1 << 15

_CLASSES: list[np.ndarray] = []


def _classes() -> np.ndarray:
    """A small number for every code point: its class, or itself for signs below 128."""
    if not _CLASSES:
        table = np.full(sys.maxunicode + 1, 1, np.uint32)
        for point in range(sys.maxunicode + 1):
            kind = unicodedata.category(chr(point))
            if kind[0] == "L":
                table[point] = 2 if kind == "Lu" else 3
            elif kind[0] == "N":
                table[point] = 4
            elif point == 10:
                table[point] = 5
            elif kind == "Zs" or point in (9, 13):
                table[point] = 6
            elif point < 128:
                table[point] = 32 + point
        _CLASSES.append(table)
    return _CLASSES[0]


def terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed terms of a text and their counts."""
    text = text or ""
    c = _classes()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    found = []
    for length in (2, 4, 6):
        if len(c) >= length:
            code = np.zeros(len(c) - length + 1, np.uint32)
            for i in range(length):
                code = code * np.uint32(0x01000193) + c[i : len(c) - length + 1 + i]
            found.append((code * np.uint32(0x9E3779B1)) >> np.uint32(17))
    words = text.split()
    lines = [x for x in text.split("\n") if x]
    marks = [
        sum(a == b for a, b in zip(words, words[1:])), sum(a == b for a, b in zip(words, words[2:])),
        len(lines) - len(set(lines)), len(words) - len(set(words)), len(words), sum(w.isupper() for w in words),
    ]
    codes, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.int64),) * 2
    more = np.flatnonzero(marks)
    return np.r_[codes.astype(np.int64), _HASHED + more], np.r_[counts, np.array(marks)[more]].astype(float)


@dataclass
class Model:
    place: np.ndarray  # column of each hashed term, -1 if it has none
    idf: np.ndarray
    basis: np.ndarray  # terms x rank
    vectors: np.ndarray  # labelled rows x rank, of length one
    weights: np.ndarray  # vote of each labelled row for its label
    labels: np.ndarray
    share: float

    def latent(self, texts: list[str | None]) -> np.ndarray:
        """Latent vectors of length one; zero for texts without known terms."""
        x = np.zeros((len(texts), len(self.idf)), np.float32)
        for i, text in enumerate(texts):
            codes, counts = terms(text)
            at = self.place[codes]
            known = at >= 0
            x[i, at[known]] = np.log1p(counts[known])
        x *= self.idf
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        y = (x / np.maximum(norm, 1e-12)) @ self.basis
        return y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not len(self.vectors):
            return np.full(len(texts), self.share)
        out = []
        for start in range(0, len(texts), BLOCK):
            own = self.latent(texts[start : start + BLOCK])
            cosine = own @ self.vectors.T
            k = min(NEIGHBOURS, cosine.shape[1])
            near = np.argsort(-cosine, axis=1, kind="stable")[:, :k] if k == cosine.shape[1] else _nearest(cosine, k)
            vote = np.maximum(np.take_along_axis(cosine, near, 1), 0.0) * self.weights[near]
            total = vote.sum(axis=1)
            good = (vote * self.labels[near]).sum(axis=1)
            out.append(np.where(total > 0, good / np.where(total > 0, total, 1), self.share))
        return np.concatenate(out) if out else np.zeros(0)


def _nearest(cosine: np.ndarray, k: int) -> np.ndarray:
    """The k largest of each row; rows with a tie at the edge are sorted in full."""
    near = np.argpartition(-cosine, k, axis=1)[:, : k + 1]
    values = np.take_along_axis(cosine, near, 1)
    near = np.take_along_axis(near, np.argsort(-values, axis=1, kind="stable"), 1)
    edge = np.take_along_axis(cosine, near[:, k - 1 : k + 1], 1)
    for i in np.flatnonzero(edge[:, 0] == edge[:, 1]):
        near[i, :k] = np.argsort(-cosine[i], kind="stable")[:k]
    return near[:, :k]


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Model:
    rows, share = labelled_sample(docs, labels, "quality", size, FOLDS, ASIDE, LONGEST)
    found = [terms(t) for _, t, _ in rows]
    df = np.zeros(_HASHED + 8, np.int64)
    for codes, _ in found:
        df[codes] += 1
    # Terms of at least two texts, the most common first: rare ones can't bring texts near each other.
    chosen = np.argsort(-df, kind="stable")[:TERMS]
    chosen = chosen[df[chosen] >= 2]
    if not len(rows) or not len(chosen):
        none = np.zeros((0, 0), np.float32)
        return Model(np.full(len(df), -1), np.zeros(0), none, none, np.zeros(0), np.zeros(0), share)
    place = np.full(len(df), -1)
    place[chosen] = np.arange(len(chosen))
    idf = (np.log((1 + len(rows)) / (1 + df[chosen])) + 1).astype(np.float32)
    y = np.array([r[0] for r in rows])
    positive = y.mean()
    weights = np.where(y == 1, share / max(positive, 1e-9), (1 - share) / max(1 - positive, 1e-9))
    model = Model(place, idf, np.eye(len(chosen), dtype=np.float32), np.zeros((0, 0)), weights, y.astype(float), share)
    texts = [r[1] for r in rows]
    x = np.concatenate([model.latent(texts[i : i + BLOCK]) for i in range(0, len(texts), BLOCK)])
    # Right singular vectors from the terms' own products: TERMS x TERMS numbers, whatever the corpus.
    _, basis = np.linalg.eigh(x.T @ x)
    model.basis = np.ascontiguousarray(basis[:, ::-1][:, :RANK])
    y = x @ model.basis
    model.vectors = y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)
    return model


def score(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """The named columns and ``score``: the neighbours' weighed vote for good quality."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by SAMPLE, TERMS and RANK
    return score_texts(docs, lambda: sent.value.score, columns)
