"""Toxicity by compression distance: two zstandard dictionaries and calibrated thresholds.

A dictionary is trained on ordinary text (trained dictionaries for both classes find far fewer toxic
texts, see the README). The toxic one holds the same and, in front, words of toxic
texts, chosen so that a few of them cover many toxic words by long common parts that ordinary texts
lack; the ordinary one has zeros there, so both reach the shared part alike. Texts are lower-cased and cut into overlapping windows; how many bytes fewer a window takes
with the toxic dictionary is its distance. The largest distances of a text and the numbers of its
windows beyond several thresholds make up the score, by a logistic calibration on sample rows that
the dictionaries have not seen. How rare a part of toxic words may be is chosen by the same rows.

Fitted on about ``SAMPLE`` labelled texts of at most ``LONGEST`` characters. Every window of every
text is scored. Null and empty texts have no window beyond a threshold and score lowest. Without
labels of both classes every score is the share of toxic labels. Repeated rows score alike; extra
columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from spendcast.llm.common import labelled_sample, logistic_regression, score_texts

SAMPLE, LONGEST, FOLDS, ASIDE = 6000, 50_000, 3, 1
WINDOW, STEP, LEVEL, MATCH = 96, 80, 6, 3
ORDINARY_BYTES = 4096
PARTS = (4, 5, 6)  # lengths of the common parts of words, in bytes
THRESHOLDS = (2, 3, 4, 5, 6, 8)  # bytes saved
LEVELS = (0.0, 0.003, 0.005, 0.01, 0.02, 0.04, 0.08)  # occurrences of a part a toxic text, to choose from

_WORD = re.compile(rb"[^\s]+")
_EDGE = b".,!?;:*#$%&|\"'()"


def windows(text: bytes, size: int = WINDOW, step: int = STEP) -> list[bytes]:
    return [text[i : i + size] for i in range(0, max(1, len(text) - size + step), step)]


def _words(text: bytes) -> set[bytes]:
    return {w.strip(_EDGE) for w in _WORD.findall(text)} - {b""}


def toxic_words(toxic: list[bytes], ordinary: list[bytes], levels: tuple[float, ...] = LEVELS) -> list[list[bytes]]:
    """Words for the toxic dictionary, best first, for each of ``levels``.

    Greedy cover: take the part (of 4 to 6 bytes) that saves most over the toxic words not covered
    yet, and the most frequent word that has it. Parts that ordinary texts have are left out, and so
    are those with fewer occurrences a toxic text than the level; at zero every word is covered that
    has a part left.
    """
    inside, outside = Counter(), Counter()
    for texts, into in ((toxic, inside), (ordinary, outside)):
        for text in texts:
            into.update(_words(text))
    parts_of = lambda w: {w[i : i + k] for k in PARTS for i in range(len(w) - k + 1)}
    common: Counter = Counter()
    for word, n in outside.items():
        for part in parts_of(word):
            common[part] += n
    # Word shares, smoothed by half a text, at least e**2 times as high in toxic texts.
    telling = {
        w: parts_of(w) for w, n in inside.items()
        if n > 1 and (n + 0.5) / (len(toxic) + 1) > 7.4 * (outside[w] + 0.5) / (len(ordinary) + 1)
    }
    holders, gain = defaultdict(set), Counter()
    for word, parts in telling.items():
        for part in parts:
            holders[part].add(word)
            gain[part] += inside[word]
    for part in list(gain):
        if (common[part] + 0.5) / len(ordinary) > 0.1 * (gain[part] + 0.5) / len(toxic):
            del gain[part]

    def cover(least: float) -> list[bytes]:
        chosen, left, now = [], set(telling), dict(gain)
        heap = [(-n * len(part), part) for part, n in now.items()]
        heapq.heapify(heap)
        while heap:
            value, part = heapq.heappop(heap)
            if now[part] <= 0 or now[part] < least:
                continue
            if now[part] * len(part) < -value:  # fewer than when it was put in
                heapq.heappush(heap, (-now[part] * len(part), part))
                continue
            covered = holders[part] & left
            chosen.append(max(covered, key=lambda w: (inside[w], w)))
            left -= covered
            for word in covered:
                for other in telling[word]:
                    if other in now:
                        now[other] -= inside[word]
        return chosen

    return [cover(level * len(toxic)) for level in levels]


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    coefficients: np.ndarray | None
    share: float
    _pair: list = field(default_factory=list, repr=False)

    def __getstate__(self):
        return (self.ordinary, self.toxic, self.coefficients, self.share)

    def __setstate__(self, state):
        self.ordinary, self.toxic, self.coefficients, self.share = state
        self._pair = []

    def _compressors(self):
        if not self._pair:
            # The window reaches over the whole dictionary.
            reach = max(16, (len(self.toxic) + WINDOW).bit_length())
            parameters = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, window_log=reach, min_match=MATCH, write_content_size=False, write_checksum=False, write_dict_id=False
            )
            for content in (self.ordinary, self.toxic):
                known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                self._pair.append(zstandard.ZstdCompressor(compression_params=parameters, dict_data=known).compress)
        return self._pair

    def features(self, text: str | None) -> np.ndarray:
        plain, toxic = self._compressors()
        cut = windows((text or "").lower().encode("utf-8", "replace"))
        saved = np.array([len(plain(w)) - len(toxic(w)) for w in cut])
        top = -np.sort(-np.r_[saved, 0, 0, 0, 0])[:4]
        beyond = np.array([(saved >= t).sum() for t in THRESHOLDS])
        return np.r_[top / 4, top.mean() / 4, np.log1p(beyond), beyond / len(cut) * 4, np.log(len(cut))]

    def score(self, texts: list[str | None]) -> list[float]:
        if self.coefficients is None:
            return [self.share] * len(texts)
        x = np.array([self.features(t) for t in texts]).reshape(len(texts), -1)
        return (1 / (1 + np.exp(-np.clip(x @ self.coefficients[:-1] + self.coefficients[-1], -30, 30)))).tolist()


def _crossed_loss(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Log loss of the calibration, of each fifth by the others; classes are spread evenly."""
    part = np.empty(len(y), int)
    part[np.argsort(y, kind="stable")] = np.arange(len(y)) % 5
    loss = 0.0
    for k in range(5):
        own = part == k
        c = logistic_regression(x[~own], y[~own], weight[~own])
        z = np.clip(x[own] @ c[:-1] + c[-1], -30, 30)
        loss += (weight[own] * np.log1p(np.exp(np.where(y[own] == 1, -z, z)))).sum()
    return loss


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Model:
    rows, share = labelled_sample(docs, labels, "toxic", size, FOLDS, ASIDE, LONGEST)
    learn = [(y, t.lower().encode("utf-8", "replace")) for y, t, place in rows if place < 0.6]
    check = [(y, t) for y, t, place in rows if place >= 0.6]
    toxic, ordinary = [t for y, t in learn if y], [t for y, t in learn if not y]
    if not toxic or not ordinary or len({y for y, _ in check}) < 2:
        return Model(b"", b"", None, share)
    samples = [w for t in ordinary for w in windows(t, 256, 256)]
    samples = [samples[i] for i in np.random.default_rng(5).permutation(len(samples))[:20_000]]
    try:
        base = zstandard.train_dictionary(ORDINARY_BYTES, samples).as_bytes()[-(ORDINARY_BYTES - 600) :]
    except zstandard.ZstdError:  # too little text to train on: the text itself
        base = b"".join(samples)[-ORDINARY_BYTES:]
    y = np.array([y for y, _ in check], float)
    # The sample is even; weights bring the classes back to their shares among all labels.
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    best, least, tried = None, np.inf, set()
    for chosen in toxic_words(toxic, ordinary):
        words = b" %s " % b" ".join(chosen[::-1])
        if words in tried:
            continue
        tried.add(words)
        model = Model(bytes(len(words)) + base, words + base, None, share)
        x = np.array([model.features(t) for _, t in check])
        loss = _crossed_loss(x, y, weight)
        if loss < least:
            model.coefficients, best, least = logistic_regression(x, y, weight), model, loss
    return best


def score(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """The named columns and ``score``: how likely the text is to be labelled toxic."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of a few kilobytes
    return score_texts(docs, lambda: sent.value.score, columns)
