"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Texts are lower-cased, everything that is no letter becomes one space, and n-grams of one to three
characters are hashed to ``DIMENSIONS`` numbers. A weight is the n-gram's share of the text times its
inverse document frequency; document frequencies are counted over all rows that may be learnt from.
The model is fitted by follow-the-regularised-leader with an elastic-net penalty on at most
``SAMPLE`` rows, evenly over languages and chosen by a hash of doc_id; a temperature fitted on a part
of the sample set aside calibrates its probabilities.

Null texts and texts without a letter get ``und`` and score 0. With nothing to learn from every
document does. Rows with a null doc_id are scored but not learnt from. Whole texts are scored. Equal
scores go to the language that sorts first. Extra columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spendcast.llm.common import fold, handing_back, set_aside

DIMENSIONS, SAMPLE, FOLDS, UNKNOWN = 1 << 16, 4000, 5, "und"
SCALE = 40.0  # brings the small shares near one, where the step sizes work

_FOLDED: list[np.ndarray] = []


def _folded() -> np.ndarray:
    """For every code point: its lower case if it is a letter, else a space."""
    if not _FOLDED:
        table = np.full(sys.maxunicode + 1, 32, np.uint32)
        for point in range(sys.maxunicode + 1):
            char = chr(point)
            if char.isalpha():
                low = char.lower()
                table[point] = ord(low[0])
        _FOLDED.append(table)
    return _FOLDED[0]


def ngrams(text: str | None) -> np.ndarray:
    """Hashed n-grams of a text, repeats included; empty if it has no letter."""
    points = _folded()[np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)]
    letter = points != 32
    if not letter.any():
        return np.zeros(0, np.int64)
    points = np.r_[np.uint32(32), points[letter | np.r_[True, letter[:-1]]], np.uint32(32)]
    a, b, c = (np.uint32(x) for x in (0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F))
    one = points * a
    two = one[:-1] + points[1:] * b
    three = two[:-1] + points[2:] * c
    return (np.concatenate([one, two + np.uint32(1), three + np.uint32(2)]) * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (dimensions, languages): inverse document frequency times coefficient over temperature

    def predict(self, text: str | None) -> tuple[str, float]:
        codes = ngrams(text)
        if not len(codes) or not self.languages:
            return UNKNOWN, 0.0
        logits = self.weights[codes].sum(axis=0, dtype=np.float64) * (SCALE / len(codes))
        p = np.exp(logits - logits.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def learnable(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", FOLDS) != 0))


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Documents that hold each hashed n-gram; at the end, documents counted. Adds up to DIMENSIONS rows a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMENSIONS + 1, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen = np.zeros(DIMENSIONS, bool)
                seen[ngrams(text)] = True
                total[:-1] += seen
                total[-1] += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["code", "n"])

    sums = docs.select("text").mapInArrow(handing_back(run), "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(DIMENSIONS + 1, np.int64)
    out[sums["code"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return out


def sample(docs: DataFrame, size: int = SAMPLE) -> tuple[list[str], list[tuple[int, np.ndarray, np.ndarray, float]]]:
    """Languages, and about ``size`` rows of them: language number, n-gram codes, counts, a hash in [0, 1)."""
    totals = {r[0]: r[1] for r in docs.groupBy("lang").count().collect()}  # one row per language
    if not totals:
        return [], []
    languages = sorted(totals)
    part = {x: min(1.0, size / len(languages) / totals[x]) for x in languages}
    rates = docs.sparkSession.createDataFrame(list(part.items()), "name string, rate double")
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(ngrams(t), return_counts=True) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([x.astype(np.int32).tobytes() for x, _ in found], pa.binary()),
                    pa.array([n.astype(np.int32).tobytes() for _, n in found], pa.binary()),
                    batch.column(2),
                ],
                names=["lang", "codes", "counts", "place"],
            )

    chosen = (
        docs.join(F.broadcast(rates), F.col("lang") == F.col("name")).withColumn("place", place)
        .filter(F.col("place") < F.col("rate"))
        .select("lang", "text", (F.col("place") / F.col("rate")).alias("place"))
    )
    rows = chosen.mapInArrow(handing_back(run), "lang string, codes binary, counts binary, place double").collect()
    number = {x: i for i, x in enumerate(languages)}
    made = [(number[r[0]], np.frombuffer(r[1], np.int32), np.frombuffer(r[2], np.int32), r[3]) for r in rows]
    return languages, sorted((m for m in made if len(m[1])), key=lambda m: m[3])


def follow_the_leader(rows, classes: int, idf: np.ndarray, alpha=0.5, beta=1.0, l1=0.02, l2=0.02, epochs=4) -> np.ndarray:
    """FTRL-proximal with a step size for every coefficient; L1 leaves most of them at exactly zero."""
    z, n = np.zeros((len(idf), classes)), np.zeros((len(idf), classes))

    def coefficients(z, n):
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            label, codes, counts, _ = rows[i]
            x = counts * (SCALE / counts.sum()) * idf[codes]
            old_n = n[codes]
            w = coefficients(z[codes], old_n)
            logits = x @ w
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1.0
            g = x[:, None] * p
            new_n = old_n + g * g
            z[codes] += g - (np.sqrt(new_n) - np.sqrt(old_n)) / alpha * w
            n[codes] = new_n
    return coefficients(z, n)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by golden section over its logarithm.

    Labels count as right in (n + 1) of (n + 2) cases, so a sample without errors gives no certainty.
    """
    n, classes = logits.shape
    if not n or classes < 2:
        return 1.0
    target = np.full(logits.shape, 1.0 / (n + 2) / (classes - 1))
    target[np.arange(n), labels] = (n + 1.0) / (n + 2.0)

    def loss(log_t):
        x = logits / np.exp(log_t)
        x = x - x.max(axis=1, keepdims=True)
        return np.mean((target * (np.log(np.exp(x).sum(axis=1, keepdims=True)) - x)).sum(axis=1))

    low, high, ratio = -3.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(docs: DataFrame, size: int = SAMPLE) -> Model:
    own = learnable(docs).select("doc_id", "text", "lang")
    languages, rows = sample(own, size)
    if not rows:
        return Model([], np.zeros((DIMENSIONS, 0), np.float32))
    counts = document_frequencies(own)
    idf = np.log((1.0 + counts[-1]) / (1.0 + counts[:-1])) + 1.0
    aside = [r for i, r in enumerate(rows) if i % 5 == 0]
    w = follow_the_leader([r for i, r in enumerate(rows) if i % 5] or rows, len(languages), idf)
    logits = np.array([(c * (SCALE / c.sum()) * idf[x]) @ w[x] for _, x, c, _ in aside]).reshape(-1, len(languages))
    t = temperature(logits, np.array([r[0] for r in aside], int))
    return Model(languages, (idf[:, None] * w / t).astype(np.float32))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` with ``lang_pred`` and ``score``; columns of those names are replaced."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)  # DIMENSIONS x languages numbers, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            found = [own.predict(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            at = [i for i, n in enumerate(batch.schema.names) if n in kept]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in at), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=[*(batch.schema.names[i] for i in at), "lang_pred", "score"],
            )

    docs = docs.drop("lang_pred", "score")
    kept = set(docs.columns)
    schema = docs.limit(0).schema.add("lang_pred", "string").add("score", "double")
    return docs.mapInArrow(handing_back(run), schema)


def confident(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a language of at least this score; the model is fitted on them.

    All columns stay, whatever their names.
    """
    scored = identify(set_aside(docs, ("doc_id", "text", "lang")), fit(docs))
    kept = scored.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).drop("lang_pred", "score")
    return kept.toDF(*docs.columns)
