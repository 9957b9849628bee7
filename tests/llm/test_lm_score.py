"""Context-tree weighting against a plain recursion over all positions."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendcast.llm import context_tree, lm_score
from tests.llm.test_operators import awkward, docs, empty, lower  # noqa: F401


class PlainTree:
    """Weighted probabilities by the definition: every context, decision by decision, from dictionaries."""

    def __init__(self, texts, depth):
        self.depth, self.counts = depth, {}
        for text in texts:
            for context, symbol in self.positions(text):
                for node, bit in self.decisions(symbol):
                    for d in range(depth + 1):
                        self.counts.setdefault((context[depth - d :], node), [0, 0])[bit] += 1
        self.children = {}
        for context, node in self.counts:
            if context:
                self.children.setdefault((context[1:], node), []).append((context, node))
        self.known = {}

    def positions(self, text):
        padded = b"\n" * self.depth + text
        for i in range(len(text)):
            yield padded[i : i + self.depth], padded[i + self.depth]

    @staticmethod
    def decisions(symbol):
        node = 1
        for k in range(7, -1, -1):
            yield node, symbol >> k & 1
            node = node << 1 | symbol >> k & 1

    def own(self, key):
        zeros, ones = self.counts[key]
        return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)

    def weighted(self, key):
        if key not in self.known:
            own = self.own(key)
            if len(key[0]) < self.depth:
                below = sum(self.weighted(c) for c in self.children[key])
                top = max(own, below)
                own = top + math.log(math.exp(own - top) + math.exp(below - top)) - math.log(2)
            self.known[key] = own
        return self.known[key]

    def one(self, context, node):
        """Probability of a one after ``context``, of which only the last bytes are used so far."""
        key = (context, node)
        zeros, ones = self.counts.get(key, (0, 0))
        kt = (ones + 0.5) / (zeros + ones + 1)
        return kt, math.exp(self.own(key) - self.weighted(key)) / 2 if key in self.counts else 1.0

    def score(self, text):
        total = 0.0
        for context, symbol in self.positions(text):
            for node, bit in self.decisions(symbol):
                p = 0.5
                path = [context[self.depth - d :] for d in range(self.depth + 1)]
                seen = [c for c in path if (c, node) in self.counts]
                for c in reversed(seen):
                    kt, weight = self.one(c, node)
                    p = kt if c == seen[-1] else weight * kt + (1 - weight) * p
                total += math.log10(p if bit else 1 - p)
        return total


def table_scores(train, texts, depth, cut):
    pieces = lambda ts: [(b"\n" * depth, t) for t in ts]
    grams = np.concatenate([context_tree.grams(pieces(ts), depth) for ts in (train, texts)])
    counts = np.r_[np.ones(sum(map(len, train)), int), np.zeros(sum(map(len, texts)), int)]
    gram, place = np.unique(grams, return_inverse=True)
    n = np.bincount(place, counts, len(gram)).astype(int)
    ranges = [context_tree.Range(gram[i : i + cut], n[i : i + cut], depth) for i in range(0, len(gram), cut)]
    known = context_tree.merge([e for r in ranges for e in r.edges()], depth)
    value = np.concatenate([r.code_lengths(known) for r in ranges])
    return [value[np.searchsorted(gram, context_tree.grams(pieces([t]), depth))].sum() for t in texts]


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_context_tree_equals_its_definition(depth):
    rng = random.Random(depth)
    some = [bytes(rng.choices(b"ab \xc3\xff\n", [9, 5, 3, 1, 1, 1], k=rng.randint(1, 60))) for _ in range(20)]
    for train in (some[:14], []):
        plain = PlainTree(train, depth)
        for cut in (1, 7, 10_000):
            assert table_scores(train, some, depth, cut) == pytest.approx([plain.score(t) for t in some], abs=1e-9)


def test_bytes_after_a_context_have_probability_one_in_all():
    text = b"the theme of the thesis "
    every = [text[:k] + bytes([b]) for k in (0, 3, 10) for b in range(256)]
    scores = np.array(table_scores([text], [*every, b"", text[:3], text[:10]], 3, 50))
    for i, prefix in enumerate(scores[-3:]):
        assert (10 ** (scores[256 * i : 256 * i + 256] - prefix)).sum() == pytest.approx(1)


def normal(text):
    return [w for w in "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in lower(text)).split(" ") if w]


def test_scores_equal_plain_models(docs, empty):  # noqa: F811
    depth, learn = 2, (F.col("doc_id") % 2 == 0)
    rows = [(r[0], normal(r[1])) for r in awkward()]
    train = [w for i, w in rows if i is not None and i % 2 == 0]
    tree = PlainTree([" ".join(w).encode() + b"\n" for w in train], depth)
    counts = Counter(x for w in train for x in [*w, "\n"])
    total, distinct = sum(counts.values()), len(counts)
    wanted = sorted(
        (str(i), len(w) + 1, sum(x in counts for x in [*w, "\n"]), total, sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in [*w, "\n"]), tree.score(" ".join(w).encode() + b"\n"))
        for i, w in rows
    )
    for block in (1, 4000, lm_score.BLOCK):
        got = lm_score.score(docs.repartition(3), learn, depth, block).collect()
        found = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
        assert [r[:4] for r in found] == [r[:4] for r in wanted]
        for r, w in zip(found, wanted):
            assert r[4:] == pytest.approx(w[4:], abs=1e-7)
    assert lm_score.score(empty, learn).collect() == []
    nothing = lm_score.score(docs, F.lit(None).cast("boolean"), depth).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.bits_per_byte == pytest.approx(8) for r in nothing)


def test_long_texts_are_read_in_pieces(monkeypatch):
    rng = random.Random(1)
    texts = [bytes(rng.choices(b"abc ", k=k)) for k in (0, 1, 40, 5, 100, 3)]
    whole = context_tree.grams([(b"\n" * 3, t) for t in texts], 3)
    monkeypatch.setattr(lm_score, "STEP", 7)
    cut = [(owners, context_tree.grams(pieces, 3), [len(p[1]) for p in pieces]) for owners, pieces in lm_score.steps(texts, 3)]
    assert np.concatenate([c[1] for c in cut]).tolist() == whole.tolist()
    assert np.concatenate([np.repeat(c[0], c[2]) for c in cut]).tolist() == [i for i, t in enumerate(texts) for _ in t]


def test_held_out_texts_cost_less_than_by_the_word_model(spark):
    """Each word mostly tells the next, which only the context tree can learn."""
    rng = random.Random(4)
    words = "walk talk jump ran sat cut sing read".split()

    def text():
        at = rng.randrange(8)
        for _ in range(60):
            yield words[at]
            at = (at + 1) % 8 if rng.random() < 0.8 else rng.randrange(8)

    table = spark.createDataFrame([(i, " ".join(text())) for i in range(200)], "doc_id long, text string")
    got = lm_score.score(table, F.col("doc_id") % 5 != 0, 5).filter("doc_id % 5 = 0").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > 0.7 * got[1]
