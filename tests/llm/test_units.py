"""The operators' own algorithms against plain definitions, without Spark."""

import os
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from spendcast.llm import byte_bpe, exact_dedup, language, neighbours, ngram_join, packing, quality, suffix_dedup, token_count
from spendcast.llm.suffix_array import suffix_array

os.environ["TOKENIZERS_PARALLELISM"] = "false"
PIECES = [
    " ", "  ", "\n", "\t", "a", "é", "É", "İ", "Σ", "ς", "你", "好", "😀", "'s", "'LL", "'", "1", "½", "²", "!", "ab", "THE",
    "<|endoftext|>", "<|", "\x1c", "\x1f", "\x85", "\xa0", "▁", "　", "tion", "é", "ß", "Ⅷ", "\x00",
]


def texts(n, seed=1, longest=40):
    rng = random.Random(seed)
    return ["", " ", "a" * 3000, " " * 500, *("".join(rng.choices(PIECES, k=rng.randint(0, longest))) for _ in range(n))]


def test_suffix_array_equals_sorting():
    rng = random.Random(0)
    for case in range(3000):
        x = [rng.randint(1, rng.choice([1, 2, 3, 10])) for _ in range(rng.randint(0, 40))]
        x = (x[: rng.randint(1, 6)] * 20)[: len(x)] if case % 3 == 0 and x else x
        x.append(0)
        assert suffix_array(x) == sorted(range(len(x)), key=lambda i: x[i:])


@pytest.mark.parametrize("alphabet", [b"ab", b"abcdefgh", b"a"])
def test_segments_cover_every_string_once(alphabet):
    rng = random.Random(3)
    for size in (0, 9, 10, 11, 60, 300):
        data = bytes(rng.choices(alphabet, k=size))
        first, last, place, value = suffix_dedup.segments(data, 10, 4)
        assert [p for a, b in zip(first, last) for p in range(a, b + 1)] == list(range(max(0, size - 9)))
        grams = {}
        for a, b, p, v in zip(first, last, place, value):
            assert b <= p <= a + 6
            assert grams.setdefault(data[p : p + 4], v) == v


def test_repeated_starts_equal_counting():
    rng = random.Random(4)
    for alphabet, n in ((b"ab", 30), (b"abcd", 300), (b"a", 12)):
        base = bytes(rng.choices(alphabet, k=n))
        texts = [base[rng.randint(0, n // 2) :] + bytes(rng.choices(alphabet, k=n // 2)) for _ in range(12)]
        strings = [t[i : i + 10] for t in texts for i in range(len(t) - 9)]
        buckets = {}
        for k, text in enumerate(texts):
            for first, last, place, value in zip(*suffix_dedup.segments(text, 10, 4)):
                buckets.setdefault(value, {}).setdefault((text[first : last + 10], int(place - first)), []).append((k, int(first)))
        got = set()
        for own in buckets.values():
            for (data, _), at in own.items():
                if len(at) > 1:
                    got |= {(k, first + i) for k, first in at for i in range(len(data) - 9)}
        several = {v: own for v, own in buckets.items() if len(own) > 1}
        members = [[(data, len(data) - 9) for data, _ in own] for own in several.values()]
        for own, each in zip(several.values(), suffix_dedup.repeated_starts(members, list(several), 10, 4)):
            for at, starts in zip(own.values(), each):
                got |= {(k, first + i) for k, first in at for i in starts}
        assert got == {(k, i) for k, t in enumerate(texts) for i in range(len(t) - 9) if strings.count(t[i : i + 10]) > 1}


def test_counting_quotient_filters_lose_nothing():
    rng = np.random.default_rng(0)
    for bits in (4, 9, 20, 63):
        parts = [rng.integers(0, 1 << bits, n, np.uint64) for n in (0, 1, 50, 400)]
        made = []
        for part in parts:
            own = exact_dedup.CountingQuotientFilter.build(*np.unique(part, return_counts=True), bits)
            made.append(exact_dedup.CountingQuotientFilter.from_bytes(own.to_bytes()))
        prints, counts = exact_dedup.CountingQuotientFilter.merge(made).items()
        wanted = np.unique(np.concatenate(parts), return_counts=True)
        assert np.array_equal(prints, wanted[0]) and np.array_equal(counts, wanted[1])


def test_divide_skip_equals_counting():
    rng = random.Random(2)
    for _ in range(500):
        docs = rng.randint(1, 12)
        lists = [sorted(rng.sample(range(docs), rng.randint(0, docs))) for _ in range(rng.randint(0, 40))]
        least = [rng.randint(1, 30) for _ in range(docs)]
        counts = [sum(d in x for x in lists) for d in range(docs)]
        assert sorted(ngram_join.divide_skip(lists, least)) == [d for d in range(docs) if counts[d] >= least[d]]


def test_shingles():
    assert len(ngram_join.shingles(None)) == len(ngram_join.shingles(" \t\n")) == 0
    assert np.array_equal(ngram_join.shingles("A b"), ngram_join.shingles("a\x0bB"))
    assert not np.array_equal(ngram_join.shingles("É"), ngram_join.shingles("é"))  # A-Z only
    assert len(ngram_join.shingles("a b\xa0c")) == 1 and len(ngram_join.shingles("a " * 50)) == 1
    assert len(ngram_join.shingles("1 2 3 4 5 6 7")) == 3


def test_byte_bpe_equals_tiktoken():
    coder = byte_bpe.ByteBpe(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, limit=200)
    ranks = {t: i for i, t in enumerate(coder.tokens)}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in texts(3000):
        ids = coder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == other.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_byte_bpe_merges_reach_every_token():
    coder = byte_bpe.ByteBpe(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert all(coder.pieces.encode(byte_bpe.mapped(t)) == [i] for i, t in enumerate(coder.tokens))


def test_token_counts_equal_sentencepiece():
    pieces = token_count.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    scores = token_count.rank_scores(pieces)
    own = token_count.PieceCounter(pieces, scores, limit=300)
    other = sentencepiece.SentencePieceProcessor(model_proto=token_count.unigram_model(pieces, scores))
    for text in [*texts(2000), "".join(texts(3000, longest=80))]:
        if "\x00" not in text:
            assert own.count(text)[0] == len(other.encode(text)), text


def test_token_counts_break_ties_like_sentencepiece():
    rng = random.Random(5)
    pieces = ["▁", "a", "b", "ab", "ba", "aa", "bb", "aba", "bab", "▁a", "▁ab"]
    scores = [-float(rng.randint(1, 3)) for _ in pieces]
    own = token_count.PieceCounter(pieces, scores)
    other = sentencepiece.SentencePieceProcessor(model_proto=token_count.unigram_model(pieces, scores))
    for _ in range(500):
        text = "".join(rng.choices("ab c", k=rng.randint(0, 20)))
        assert own.count(text)[0] == len(other.encode(text)), text


def test_packing_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    own, other = packing.ChunkEncoder(path, limit=200), Tokenizer.from_file(path)
    for text in [*texts(2500), "".join(map(chr, range(33, 0x250))), " ".join(map(chr, range(33, 0x250)))]:
        assert np.frombuffer(own.encode(text), own.kind).tolist() == other.encode(text, add_special_tokens=False).ids


def test_language_features():
    assert len(language.ngrams(None)) == len(language.ngrams("12 .!")) == 0
    assert np.array_equal(language.ngrams("Ab, c"), language.ngrams("aB 7 C"))
    assert language.temperature(np.zeros((0, 2)), np.zeros(0, int)) == 1.0


def test_quality_neighbours_break_ties_by_place():
    cosine = np.array([[0.1, 0.5, 0.5, 0.5, 0.9, 0.5]])
    assert quality._nearest(cosine, 3).tolist() == [[4, 1, 2]]


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(8, 16)) * 4
    x = neighbours._unit(centres[rng.integers(0, 8, 800)] + rng.normal(size=(800, 16)))
    graph = neighbours.neighbour_graph(x, 5)
    label = neighbours.balanced_parts(x, graph, 8)
    assert np.bincount(label, minlength=8).max() <= 106
    assert (label[graph] == label[:, None]).mean() > 0.6


def test_new_runs_beside_odd_ones():
    """Runs that hold odd characters or a special token are told apart wherever they stand among new runs."""
    path = public_tokenizers.path("word_bpe_49k.json")
    own = packing.ChunkEncoder(path)
    special = own.special[0] if own.special else "<x>"
    for text in (f"{special} a b", f"a b{special}", f"\u65e5 a\u65e5b c \u65e5", "a\x1cb don't \u0130x \u0131 q", "x", "", "a\0b c"):
        own.forget()
        assert own.encode(text) == own._encode(text).tobytes()
