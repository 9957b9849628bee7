"""Importance resampling against plain counting."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from spendcast.llm import importance
from tests.llm.test_operators import awkward, docs, empty, lower  # noqa: F401

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_buckets(text, longest, buckets):
    words = WORD.findall(lower(text))
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]


def plain(rows, target, longest, buckets, least, percent):
    own = [plain_buckets(t, longest, buckets) for _, t in rows]
    s, t = Counter(b for _, o in own for b in o), Counter(b for x in target for b in plain_buckets(x, longest, buckets)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    found = []
    for (i, _), (words, o) in zip(rows, own):
        weight = sum(map(gain, o)) // len(o) if o else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        found.append((i, len(o), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words >= least))
    open_rows = sorted((r for r in found if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = open_rows[: percent * len(open_rows) // 100]
    return sorted(map(repr, [(*r[:4], k + 1) for k, r in enumerate(drawn)] + [(*r[:4], None) for r in open_rows[len(drawn) :] + [r for r in found if not r[4]]]))


def test_resampling_equals_its_definition(spark, docs, empty):  # noqa: F811
    rows = [(r[0], r[1]) for r in awkward()]
    target = [rows[9][1], None, "", "river rivera-rivera É"]
    for longest, buckets, least, percent in ((1, 10_000, 20, 10), (3, 50, 1, 60), (2, 1000, 0, 100), (1, 10_000, 10**9, 10)):
        aim = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
        got = importance.resample(docs.repartition(3), aim, buckets=buckets, longest=longest, least_words=least, percent=percent)
        assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert sorted(repr(tuple(r)) for r in got.collect()) == plain(rows, target, longest, buckets, least, percent)
    assert importance.resample(empty, empty).collect() == []
    assert importance.resample(docs, empty).count() == len(rows)


def test_composed_payloads_equal_crc32_of_runs():
    rng, powers = random.Random(2), importance.crc_tables()
    for _ in range(200):
        a, b = rng.randbytes(rng.randint(0, 40)), rng.randbytes(rng.choice([0, 1, 7, 300, 70_000]))
        joined = importance.joined_crc(np.array([zlib.crc32(a)]), np.array([zlib.crc32(b)]), np.array([len(b)]), powers)
        assert joined[0] == zlib.crc32(a + b)
    words = [bytes(rng.choices(b"abcxyz\xc3", k=rng.randint(1, 9))) for _ in range(30)]
    got = importance.composed(np.array([zlib.crc32(w) for w in words]), np.array([len(w) for w in words]), 4)
    wanted = [zlib.crc32(b" ".join(words[i : i + n])) for n in range(1, 5) for i in range(len(words) - n + 1)]
    assert got.tolist() == wanted


def test_scans_emit_whole_words_in_order():
    texts = [" a ab abc ab a ", "  ", " bc  abcd ", " "]
    found = importance.scanner(texts)
    for text in texts:
        crc, length = importance.payloads(found, text)
        assert crc.tolist() == [zlib.crc32(w.encode()) for w in text.split()] and length.tolist() == [len(w) for w in text.split()]
