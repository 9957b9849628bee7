"""Count-only Viterbi for a unigram vocabulary.

An Aho-Corasick automaton enumerates the pieces that end at every character; dynamic programming
carries the best score and the number of pieces of the best cut, never the cut itself. Rules are the
ones of the sentencepiece library: a later cut has to be better and not just equal (so of equal cuts
the one whose last piece starts first wins), a character that is no piece costs ten more than the
worst piece and falls back to its bytes. Scores are multiples of 1/64, so double-precision sums are
exact for texts of any length and what a word adds never depends on the words before it.

Null and empty texts have no tokens. Whole texts are counted. Rows, their order and any extra
columns stay as they are.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from spendcast.llm import sentencepiece_model as model

SPACE, UNKNOWN_PENALTY = "▁", 10.0


def rank_scores(pieces: list[str]) -> list[float]:
    """Log-probabilities of pieces that are listed by frequency, by Zipf's law, in steps of 1/64."""
    total = math.log(sum(1.0 / (rank + 2.7) for rank in range(len(pieces))))
    return [-round((math.log(rank + 2.7) + total) * 64) / 64 for rank in range(len(pieces))]


def read_pieces(path: str) -> list[str]:
    """Ordinary pieces of a sentencepiece file in its order; control, byte and unknown pieces left out."""
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=path)
    numbers = range(own.get_piece_size())
    return [own.id_to_piece(i) for i in numbers if not (own.is_control(i) or own.is_byte(i) or own.is_unknown(i))]


def unigram_model(pieces: list[str], scores: list[float]) -> bytes:
    """The same vocabulary for the sentencepiece library, to compare with."""
    special = [("<unk>", 0.0, model.UNKNOWN), *((f"<0x{b:02X}>", 0.0, model.BYTE) for b in range(256))]
    own = [(p, s, model.NORMAL) for p, s in zip(pieces, scores)]
    return model.serialise([*special, *own], model.UNIGRAM, True, True, True)


class PieceCounter:
    """Counts pieces; results of words are kept, up to ``limit`` of them."""

    def __init__(self, pieces: list[str], scores: list[float], limit: int = 400_000, long_word: int = 200):
        self.automaton = ahocorasick.Automaton()
        for piece, score in zip(pieces, scores):
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p in pieces if len(p) == 1}
        self.unknown = min(scores) - UNKNOWN_PENALTY
        # Words start at a space mark; a vocabulary with pieces across a word's end keeps texts whole.
        across = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        self.words = re.compile("(?s).+" if across else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.known: dict[str, tuple[float, int]] = {}
        self.limit, self.long_word = limit, long_word

    def best(self, word: str) -> tuple[float, int]:
        """Score and number of pieces of the best cut."""
        n = len(word)
        score, count = [0.0] + [-math.inf] * n, [0] * (n + 1)
        single, unknown, done = self.single, self.unknown, 0

        def fall_back(upto: int) -> None:
            """Characters that are no piece by themselves, after all matches that end with them."""
            nonlocal done
            while done < upto:
                char = word[done]
                if char not in single and score[done] + unknown > score[done + 1]:
                    score[done + 1] = score[done] + unknown
                    count[done + 1] = count[done] + len(char.encode("utf-8", "replace"))
                done += 1

        for last, (length, own) in self.automaton.iter(word):  # at each end the longest comes first
            if done < last:
                fall_back(last)
            start = last + 1 - length
            found = score[start] + own
            if found > score[last + 1]:
                score[last + 1], count[last + 1] = found, count[start] + 1
        fall_back(n)
        return score[n], count[n]

    def count(self, text: str | None) -> tuple[int, float]:
        """Number of pieces of the best cut, and its score."""
        if not text:
            return 0, 0.0
        total, pieces, known = 0.0, 0, self.known
        if len(known) > self.limit:
            known.clear()
        for word in self.words.findall(SPACE + text.replace(" ", SPACE)):
            found = known.get(word)
            if found is None:
                found = self.best(word)
                if len(word) <= self.long_word:
                    known[word] = found
            total += found[0]
            pieces += found[1]
        return pieces, total


_COUNTERS: dict[str, PieceCounter] = {}


def _counter(path: str) -> PieceCounter:
    if path not in _COUNTERS:
        pieces = read_pieces(path)
        _COUNTERS[path] = PieceCounter(pieces, rank_scores(pieces))
    return _COUNTERS[path]


def count_tokens(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add ``n_tokens`` and ``token_score``; columns of those names are replaced."""
    df = df.drop("n_tokens", "token_score")
    position = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _counter(path)
        for batch in batches:
            found = [own.count(t) for t in batch.column(position).to_pylist()]
            added = [pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())]
            names = [*batch.schema.names, "n_tokens", "token_score"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=names)

    return df.mapInArrow(run, df.limit(0).schema.add("n_tokens", "long").add("token_score", "double"))
