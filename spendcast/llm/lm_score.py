"""Language-model scores by context-tree weighting over bytes, beside an add-one word model.

What is modelled is the text's words (runs without white space), A-Z lower-cased, joined by single
spaces and closed by a line end, which no word contains. Context trees of ``depth`` bytes are learnt
from all rows marked ``learn`` (``context_tree`` has the arithmetic) and give each byte of each text a
probability; the score is the log10 probability of the whole text, its code length per byte follows.

How it is spread: rows are cut to blocks of about ``BLOCK`` bytes (a longer text is a block of its
own). A block lists its distinct grams and words with their training counts, so a passage that a
third of all texts share counts once a block. Lists are cut to ranges of grams (quantiles of marks
that the lists carry) and of word hashes; a range gets one packet from each block, adds up the counts
and sends a packet of values back. Contexts that reach over a range's ends are merged in between: per
range and depth two contexts, which is all that meets on the driver besides a few totals.

Null texts are empty and consist of the end alone, as do texts of white space. Rows repeated with one
doc_id are learnt as often as they occur and scored each. A null doc_id is neither learnt nor held
out. Texts of any length are read whole, in pieces. Without any row to learn from, all bits have
probability one half and the word model gives 1. An empty table gives no rows. Equal texts have equal
scores. Other columns of ``docs`` are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from spendcast.llm import context_tree
from spendcast.llm.common import LOWER, UPPER, drop_table, partitions
from spendcast.session import materialize

#: Bytes of context. A gram and the number of its text have to fit 64 bits, so at most five.
DEPTH = 5
#: Bytes of text in a block, and in a step of counting inside it.
BLOCK, STEP = 32 << 20, 1 << 20
#: Listed grams that a range gets from all blocks, about.
RANGE_GRAMS = 500_000
#: Grams of a range that are weighed together, and marks that a list carries to place the ranges.
WEIGHED, MARKS = 250_000, 128

END = b"\n"
FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


def normal_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def as_bytes(words: list[bytes]) -> bytes:
    return b" ".join(words) + END


def steps(texts: list[bytes], depth: int) -> Iterator[tuple[np.ndarray, list[tuple[bytes, bytes]]]]:
    """Pieces of texts, each with the bytes before it, in steps of about STEP bytes, and the texts' numbers."""
    owners, pieces, size = [], [], 0
    for number, text in enumerate(texts):
        for start in range(0, len(text), STEP):
            before = text[max(0, start - depth) : start]
            pieces.append((END * (depth - len(before)) + before, text[start : start + STEP]))
            owners.append(number)
            size += len(pieces[-1][1]) + depth
            if size >= STEP or len(pieces) == 1 << 16:
                yield np.array(owners), pieces
                owners, pieces, size = [], [], 0
    if pieces:
        yield np.array(owners), pieces


def squeezed(data: bytes | np.ndarray, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(data if isinstance(data, bytes) else data.tobytes())


def opened(data: bytes, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def packed_keys(keys, kind: str) -> bytes:
    """Words joined by spaces, sorted grams as their differences, compressed."""
    return squeezed(b" ".join(keys) if kind == "word" else np.diff(keys, prepend=0))


def unpacked(keys: bytes, kind: str):
    return opened(keys, np.uint8).tobytes().split(b" ") if kind == "word" else np.cumsum(opened(keys))


class Block:
    """Rows of a block, packed, and its distinct words and grams with their counts in the rows to learn from."""

    def __init__(self, number: int, depth: int):
        self.number, self.depth, self.size = number, depth, 0
        self.words: Counter = Counter()
        self.other_words: set[bytes] = set()
        self.ids: list = []
        self.texts: dict[bool, list[bytes]] = {True: [], False: []}
        self.waiting, self.found = 0, []

    def add(self, doc_id, words: list[bytes], text: bytes, learn: bool) -> None:
        if learn:
            self.words.update(words)
            self.words[END] += 1
        else:
            self.other_words.update(words)
            self.other_words.add(END)
        self.texts[learn].append(text)
        self.ids.append((learn, doc_id))
        self.size += len(text)
        self.waiting += len(text)

    def pack(self) -> tuple[list, list[int], bytes]:
        """The rows that wait: ids, lengths and compressed texts. Their grams are counted on the way."""
        for learn, texts in self.texts.items():
            for _, pieces in steps(texts, self.depth):
                gram, n = np.unique(context_tree.grams(pieces, self.depth), return_counts=True)
                self.found.append((gram, n * learn))
        if sum(len(f[0]) for f in self.found) > 1 << 20:
            self.found = [_summed(self.found)]
        both = self.texts[True] + self.texts[False]
        ids = [i for wanted in (True, False) for learn, i in self.ids if learn == wanted]
        packed = squeezed(b"".join(both), 3)
        self.ids, self.texts, self.waiting = [], {True: [], False: []}, 0
        return ids, list(map(len, both)), packed

    def lists(self) -> list[tuple[str, bytes, bytes, int, list[int]]]:
        """(kind, keys, counts, number of keys, marks): words in the order of their crc32, grams sorted."""
        words = sorted((zlib.crc32(w), w) for w in self.other_words | self.words.keys())
        counts = np.array([self.words.get(w, 0) for _, w in words], np.int64)
        gram, n = _summed(self.found)
        places = np.linspace(0, len(gram) - 1, MARKS).astype(int)
        return [
            ("word", packed_keys([w for _, w in words], "word"), squeezed(counts), len(words), []),
            ("gram", packed_keys(gram, "gram"), squeezed(n), len(gram), gram[places].tolist()),
        ]


def _summed(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(lists) == 1:
        return lists[0]
    gram, place = np.unique(np.concatenate([x[0] for x in lists]), return_inverse=True)
    return gram, np.bincount(place, np.concatenate([x[1] for x in lists]), len(gram)).astype(np.int64)


def _blocks(docs: DataFrame, learn: Column, depth: int, size: int) -> DataFrame:
    """One written table of packed rows (kind null) and of the lists of every block."""
    id_kind = dict(docs.dtypes)["doc_id"]
    schema = f"block long, ids array<{id_kind}>, lengths array<long>, texts binary, kind string, keys binary, counts binary, n long, marks array<long>"
    names = ["block", "ids", "lengths", "texts", "kind", "keys", "counts", "n", "marks"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(TaskContext.get().partitionId() << 32, depth)
        kinds = None

        def row(**values) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([values.get(n)], kinds[n]) for n in names], names=names)

        def packed() -> pa.RecordBatch:
            ids, lengths, texts = block.pack()
            return row(block=block.number, ids=ids, lengths=lengths, texts=texts)

        def ended() -> Iterator[pa.RecordBatch]:
            if block.waiting:
                yield packed()
            for kind, keys, counts, n, marks in block.lists():
                yield row(block=block.number, kind=kind, keys=keys, counts=counts, n=n, marks=marks)

        for batch in batches:
            kinds = kinds or {
                "block": pa.int64(), "ids": pa.list_(batch.column(0).type), "lengths": pa.list_(pa.int64()), "texts": pa.binary(), "kind": pa.string(),
                "keys": pa.binary(), "counts": pa.binary(), "n": pa.int64(), "marks": pa.list_(pa.int64()),
            }
            for doc_id, text, learnt in zip(*(c.to_pylist() for c in batch.columns)):
                words = normal_words(text)
                text = as_bytes(words)
                if block.size and block.size + len(text) > size:
                    yield from ended()
                    block = Block(block.number + 1, depth)
                block.add(doc_id, words, text, learnt)
                if block.waiting >= STEP:
                    yield packed()
        if block.size:
            yield from ended()

    rows = docs.select("doc_id", F.col("text").cast("binary"), F.coalesce(learn, F.lit(False)))
    return materialize(rows.mapInArrow(run, schema))


def _asked(lists: DataFrame, kind: str, place) -> DataFrame:
    """Packets (block, part, keys, counts): ``place(keys)`` gives the part of each key, which never falls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"block": [], "part": [], "keys": [], "counts": []}
            for block, packed, counted in zip(*(c.to_pylist() for c in batch.columns)):
                keys, counts = unpacked(packed, kind), opened(counted)
                part = place(keys)
                starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
                for a, b in zip(starts, np.r_[starts[1:], len(part)]):
                    out["block"].append(block)
                    out["part"].append(int(part[a]))
                    out["keys"].append(packed_keys(keys[a:b], kind))
                    out["counts"].append(squeezed(counts[a:b]))
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))

    own = lists.filter(F.col("kind") == kind).select("block", "keys", "counts")
    return own.mapInArrow(run, "block long, part long, keys binary, counts binary")


def _answers(table: pa.Table, kind: str, values_of) -> pa.Table:
    """Packets back to the blocks: the keys as they were sent, and the values that ``values_of`` finds for them."""
    blocks, sent = table["block"].to_pylist(), table["keys"].to_pylist()
    counts = [opened(c) for c in table["counts"].to_pylist()]
    values, total = values_of([unpacked(k, kind) for k in sent], counts)
    packed = [squeezed(v) for v in values]
    extra = [] if total is None else [(None, b"", squeezed(np.array([total], float)))]
    rows = [*zip(blocks, sent, packed), *extra]
    columns = list(zip(*rows))
    kinds = (pa.int64(), pa.binary(), pa.binary())
    return pa.table([pa.array([kind] * len(rows)), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["kind", "block", "keys", "values"])


ANSWER = "kind string, block long, keys binary, values binary"


def _word_values(keys: list[list[bytes]], counts: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """Each word's count over all blocks, and how many words of this range were learnt."""
    total: dict[bytes, int] = {}
    for words, n in zip(keys, counts):
        for word, k in zip(words, n.tolist()):
            total[word] = total.get(word, 0) + k
    values = [np.fromiter((total[w] for w in words), float, len(words)) for words in keys]
    return values, sum(n > 0 for n in total.values())


def _ranges(keys: list[np.ndarray], counts: list[np.ndarray], depth: int) -> list[context_tree.Range]:
    gram, n = _summed(list(zip(keys, counts)))
    return [context_tree.Range(gram[i : i + WEIGHED], n[i : i + WEIGHED], depth) for i in range(0, len(gram), WEIGHED)]


def _shared_nodes(asked: DataFrame, depth: int) -> list[list[dict[str, np.ndarray]]]:
    """Merged nodes of contexts that reach a range's end: at most two contexts per range and depth."""

    def run(table: pa.Table) -> pa.Table:
        keys, counts = [unpacked(k, "gram") for k in table["keys"].to_pylist()], [opened(c) for c in table["counts"].to_pylist()]
        rows = [e for r in _ranges(keys, counts, depth) for e in r.edges() if len(e[1])]
        columns = [[r[0] for r in rows], *([r[i].tobytes() for r in rows] for i in range(1, 5))]
        kinds = (pa.int32(), *[pa.binary()] * 4)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["depth", "key", "zeros", "ones", "below"])

    edges = asked.groupBy("part").applyInArrow(run, "depth int, key binary, zeros binary, ones binary, below binary")
    pieces = []
    for r in edges.collect():
        numbers = [np.frombuffer(r[i], float) for i in range(2, 5)]
        pieces.append((r[0], np.frombuffer(r[1], np.int64), *numbers))
    # Sums of fractions depend on their order in the last digits.
    pieces.sort(key=lambda p: (p[0], p[1].tobytes(), p[2].tobytes(), p[3].tobytes()))
    return context_tree.merge(pieces, depth)


def _score_block(depth: int, learnt: float, distinct: float):
    """Scores of a block's texts from the values of its grams and words."""

    def run(packs: pa.Table, answers: pa.Table) -> pa.Table:
        own = []
        for lengths, packed in zip(packs["lengths"].to_pylist(), packs["texts"].to_pylist()):
            data, ends = opened(packed, np.uint8).tobytes(), np.cumsum(lengths).tolist()
            own += [data[a:b] for a, b in zip([0, *ends], ends)]
        ids = pa.chunked_array([c.flatten() for c in packs["ids"].chunks], packs["ids"].type.value_type)
        packets = sorted(zip(answers["kind"].to_pylist(), answers["keys"].to_pylist(), answers["values"].to_pylist()), key=lambda p: p[0])
        grams = [(unpacked(k, kind), opened(v, float)) for kind, k, v in packets if kind == "gram"]
        gram, value = (np.concatenate([g[i] for g in grams]) for i in (0, 1))
        order = np.argsort(gram)
        gram, value = gram[order], value[order]
        score = np.zeros(len(own))
        for owners, pieces in steps(own, depth):
            lengths = np.fromiter((len(p[1]) for p in pieces), np.int64, len(pieces))
            number = np.repeat(np.arange(len(pieces), dtype=np.uint64), lengths)
            both = np.sort(context_tree.grams(pieces, depth).astype(np.uint64) << np.uint64(16) | number)
            starts = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
            times = np.diff(np.r_[starts, len(both)])
            both = both[starts]
            found = value[np.searchsorted(gram, (both >> np.uint64(16)).astype(np.int64))]
            piece = (both & np.uint64(0xFFFF)).astype(np.int64)
            score += np.bincount(owners[piece], found * times, len(own))
        index: dict[bytes, int] = {}
        counts = []
        for kind, keys, values in packets:
            if kind == "word":
                for word in unpacked(keys, kind):
                    index[word] = len(index)
                counts.append(opened(values, float))
        count = np.concatenate(counts)
        cost = np.log10((count + 1) / (learnt + distinct + 1))
        known = count > 0
        tokens, n_known, base = [], [], []
        for text in own:
            words = [*text.split(), END]
            place = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
            tokens.append(len(words))
            n_known.append(int(known[place].sum()))
            base.append(float(cost[place].sum()))
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        bits = -score / np.log10(2) / sizes
        columns = [ids, *(pa.array(c, pa.int64()) for c in (tokens, n_known)), *(pa.array(c, pa.float64()) for c in (base, score, bits))]
        return pa.table(columns, names=["doc_id", "n_tokens", "n_known", "base_score", "score", "bits_per_byte"])

    return run


def score(docs: DataFrame, learn: Column, depth: int = DEPTH, block: int = BLOCK) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text); the models are learnt from the rows where ``learn`` holds.

    Rows (doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte): tokens are the
    words and the end; ``base_score`` is the add-one word model's log10 probability, ``score`` that of
    the context trees, ``bits_per_byte`` the code length of the normal form.
    """
    if not 1 <= depth <= 5:
        raise ValueError("depth is from 1 to 5")
    spark = docs.sparkSession
    table = _blocks(docs, learn, depth, block)
    lists = table.filter(F.col("kind").isNotNull())
    listed = lists.filter("kind = 'gram'").agg(F.sum("n")).first()[0] or 0
    parts = max(partitions(spark), -(-listed // RANGE_GRAMS))

    def word_place(words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) * parts >> 32

    words = _asked(lists, "word", word_place)
    answered = [words.groupBy("part").applyInArrow(lambda t: _answers(t, "word", _word_values), ANSWER)]
    marks = lists.select(F.explode("marks").alias("mark"))
    wanted = [i / parts for i in range(1, parts)]
    splits = marks.agg(F.percentile_approx("mark", wanted, max(10_000, 20 * parts))).first()[0] if wanted else []
    limits = np.unique(np.array(splits or [], np.int64))
    asked = materialize(_asked(lists, "gram", lambda keys: np.searchsorted(limits, keys, "right")))
    shared = _shared_nodes(asked, depth)

    def gram_values(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], None]:
        ranges = _ranges(keys, counts, depth)
        gram = np.concatenate([r.gram for r in ranges])
        value = np.concatenate([r.code_lengths(shared) for r in ranges])
        return [value[np.searchsorted(gram, k)] for k in keys], None

    answered.append(asked.groupBy("part").applyInArrow(lambda t: _answers(t, "gram", gram_values), ANSWER))
    answers = materialize(answered[0].unionByName(answered[1]))
    drop_table(asked)
    counted = lists.filter("kind = 'word'").select("counts").mapInArrow(_count_sums, "total long")
    learnt = counted.agg(F.sum("total")).first()[0] or 0
    distinct = answers.filter("block is null").select("values").mapInArrow(_value_sums, "total double").agg(F.sum("total")).first()[0] or 0
    own = table.filter(F.col("kind").isNull()).select("block", "ids", "lengths", "texts")
    kind = dict(docs.dtypes)["doc_id"]
    scored = own.groupBy("block").cogroup(answers.filter("block is not null").groupBy("block")).applyInArrow(
        _score_block(depth, float(learnt), float(distinct)),
        f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double, bits_per_byte double",
    )
    return scored.select(
        "doc_id", "n_tokens", "n_known", F.lit(learnt).cast("long").alias("train_tokens"), "base_score", "score", "bits_per_byte"
    )


def _count_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals = [int(opened(c).sum()) for c in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(totals, pa.int64())], names=["total"])


def _value_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals = [float(opened(c, float).sum()) for c in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(totals, pa.float64())], names=["total"])
