"""Importance resampling of documents towards a target corpus, on hashed word features.

Features are all runs of 1 to ``longest`` consecutive words, joined by one space; a feature's bucket is
the crc32 of its bytes modulo ``buckets``. A bucket's gain is the log ratio of its smoothed shares in
the target and in the documents; a document's weight is the floored mean of its features' gains.
Weights get one Gumbel number per document, and the highest are drawn without replacement.

The distinct words of a batch, bounded by delimiters on both sides, go into an Aho-Corasick automaton,
each with its crc32 and its length as payload. A scan of a text emits the payloads of its words in
order (neighbours share a delimiter, and no pattern contains one, so matches are exactly the words).
Runs of words are composed from payloads alone: the crc32 of two strings follows from theirs and the
length of the second. Buckets are written once; counting and scoring read them.

Null texts have no words. Rows repeated with one doc_id count as often as they occur, have equal
scores and follow each other in rank. A null doc_id has the hash of an empty id and comes last among
equal scores. Texts of any length are scanned whole. Empty tables: without documents no rows; without
target features the gains compare with a uniform target. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from spendcast.llm.common import LOWER, UPPER, running_total
from spendcast.session import materialize

BUCKETS, LONGEST, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024

WORD_BYTES = bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
#: A-Z lower-cased, all bytes outside words as spaces.
SPACED = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in WORD_BYTES else 0x20 for b in range(256))


def crc_tables() -> np.ndarray:
    """For each power of two, what that many zero bytes appended make of each byte of a crc: [power, byte, value]."""
    # Inverting at the start and the end cancels out when the crcs of zero bytes and of the value are combined.
    one = np.zeros((4, 256), np.int64)
    for place in range(4):
        for value in range(256):
            crc = value << (8 * place)
            for _ in range(8):
                crc = crc >> 1 ^ (0xEDB88320 if crc & 1 else 0)
            one[place, value] = crc
    powers = [one]
    for _ in range(39):
        last = powers[-1]
        powers.append(_through(last, last))
    return np.array(powers)


def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24 & 255]


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """crc32 of two strings, one after the other, from their crc32 and the length of the second."""
    out, left, bit = first.copy(), length.copy(), 0
    while left.any():
        chosen = (left & 1).astype(bool)
        out[chosen] = _through(powers[bit], out[chosen])
        left, bit = left >> 1, bit + 1
    return out ^ second


def composed(crc: np.ndarray, length: np.ndarray, longest: int, powers: np.ndarray | None = None) -> np.ndarray:
    """crc32 of all runs of 1 to ``longest`` words, from the words' own."""
    found = [crc]
    if longest > 1:
        powers = crc_tables() if powers is None else powers
        spaced = joined_crc(np.full(len(crc), zlib.crc32(b" ")), crc, length, powers)
        run = crc
        for n in range(2, longest + 1):
            run = joined_crc(run[:-1], spaced[n - 1 :], length[n - 1 :] + 1, powers) if len(run) else run
            found.append(run)
    return np.concatenate(found)


def scanner(texts: list[str]):
    """The automaton of the words of spaced texts (a space before and after each)."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for word in set().union(*(t.split(" ") for t in texts)) - {""}:
        data = word.encode("latin-1")
        found.add_word(f" {word} ", zlib.crc32(data) << 31 | len(data))
    found.make_automaton()
    return found if len(found) else None


def payloads(automaton, text: str) -> tuple[np.ndarray, np.ndarray]:
    """crc32 and length of the words of a spaced text, in order."""
    found = np.fromiter((v for _, v in automaton.iter(text)), np.int64) if automaton else np.zeros(0, np.int64)
    return found >> 31, found & (1 << 31) - 1


#: Texts that share an automaton have about so many bytes.
SCANNED = 16 << 20


def featured(rows: DataFrame, key: str | None, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """Rows (row, key, n_words, n_features, features): the buckets of the text's features, packed as 32-bit integers.

    ``row`` numbers the rows; it is only stable once written.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, powers = TaskContext.get().partitionId() << 36, crc_tables() if longest > 1 else None
        for batch in batches:
            size = 0
            cuts = [0]
            lengths = batch.column(0).to_pylist()
            for i, n in enumerate(lengths):
                size += n
                if size >= SCANNED:
                    cuts.append(i + 1)
                    size = 0
            for a, b in zip(cuts, [*cuts[1:], batch.num_rows]):
                if a == b:
                    continue
                texts = [f" {(t or b'').translate(SPACED).decode('latin-1')} " for t in batch.column(1).slice(a, b - a).to_pylist()]
                automaton = scanner(texts)
                words, counts, packed = [], [], []
                for text in texts:
                    crc, length = payloads(automaton, text)
                    own = composed(crc, length, longest, powers) % buckets
                    words.append(len(crc))
                    counts.append(len(own))
                    packed.append(own.astype("<i4").tobytes())
                columns = [pa.array(np.arange(row, row + b - a)), batch.column(2).slice(a, b - a), pa.array(words, pa.int64()), pa.array(counts, pa.int64()), pa.array(packed, pa.binary())]
                row += b - a
                yield pa.RecordBatch.from_arrays(columns, names=["row", "key", "n_words", "n_features", "features"])

    text = F.coalesce("text", F.lit("")).cast("binary")
    own = F.col(key) if key else F.lit(0)
    kind = dict(rows.dtypes)[key] if key else "int"
    chosen = rows.select(F.octet_length(text), text, own)
    return chosen.mapInArrow(run, f"row long, key {kind}, n_words long, n_features long, features binary")


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs: added up in every task, then over tasks; ``buckets`` numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            data = b"".join(batch.column(0).to_pylist())
            total += np.bincount(np.frombuffer(data, "<i4"), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    counted = features.select("features").mapInArrow(run, "bucket long, n long")
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of the ratio of smoothed shares, per bucket."""
    buckets = len(target)
    up = (target + 1.0) * (int(source.sum()) + buckets)
    down = (source + 1.0) * (int(target.sum()) + buckets)
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def weighted(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """Rows (row, key, n_words, n_features, weight)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(x, "<i4") for x in batch.column(4).to_pylist()]
            weight = pa.array([int(gain[x].sum()) // len(x) if len(x) else 0 for x in own], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], weight], names=[*batch.schema.names[:4], "weight"])

    columns = ["row", "key", "n_words", "n_features", "features"]
    kind = dict(features.dtypes)["key"]
    return features.select(*columns).mapInArrow(run, f"row long, key {kind}, n_words long, n_features long, weight long")


def gumbel(key: Column, seed: int) -> Column:
    """Thousandths of a Gumbel number that follows from the seed and the key alone."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", buckets: int = BUCKETS, longest: int = LONGEST,
    least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """Rows (key, n_features, weight, score, rank): rank is null for documents that are not drawn.

    Of the documents with at least ``least_words`` words the best ``percent`` in a hundred are drawn.
    Counts per score (a few ten thousand whole numbers at most) show from which score on rows can be
    drawn; only those are ordered, by ranges, so that equal scores and ids are spread too.
    """
    features = materialize(featured(docs, key, buckets, longest))
    aim = bucket_counts(featured(target, None, buckets, longest), buckets)
    scored = materialize(
        weighted(features, gains(aim, bucket_counts(features, buckets)))
        .withColumn("score", F.col("weight") + gumbel(F.col("key"), seed))
        .withColumn("open", F.col("n_words") >= least_words)
    )
    counts = sorted(((r["score"], r["n"]) for r in scored.filter("open").groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    wanted = percent * sum(n for _, n in counts) // 100
    lowest, reached = None, 0
    for value, n in counts:
        if reached >= wanted:
            break
        lowest, reached = value, reached + n
    chosen = F.col("open") & (F.col("score") >= lowest) if lowest is not None else F.lit(False)
    columns = [F.col("key").alias(key), "n_features", "weight", "score"]
    rest = scored.filter(~chosen).select(*columns, F.lit(None).cast("long").alias("rank"))
    order = scored.filter(chosen).select(
        (-F.col("score")).alias("down"), F.col("key").isNull().alias("nameless"), "key", "row", "n_features", "weight", "score", F.lit(1).alias("one")
    )
    placed = running_total(order, ["down", "nameless", "key", "row"], "one", "before")
    rank = F.when(F.col("before") < wanted, F.col("before") + 1).cast("long")
    return rest.unionByName(placed.select(*columns, rank.alias("rank")))
