"""Exact deduplication: counting quotient filters per partition, merged by sorted remainders.

Every task puts the 64-bit fingerprints of its normalised texts into counting quotient filters, one
for each range of fingerprints. A filter keeps a fingerprint whole: the leading bits as the number
of its home slot (the quotient), the rest as the remainder in a slot, a second slot for a count above
one. Filters of a range are merged by walking their sorted remainders, which loses nothing.
Fingerprints with a count above one route their documents to a comparison of all bytes, so documents
whose fingerprints merely collide stay apart.

Texts are equal when identical after lower-casing A-Z only; null counts as empty. Of equal rows the
one with the largest doc_id stays, of rows repeated with that doc_id one of them; a null doc_id is
smaller than any other. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from spendcast.llm.common import ascii_lower, checked_broadcast, partitions, set_aside, text_of
from spendcast.session import materialize

#: Fingerprints that one merged filter should hold, and distinct routed ones that are broadcast (16 MB).
RANGE_ITEMS, BROADCAST_ITEMS = 1_000_000, 1_000_000
#: Groups of copies that are broadcast, with the hexadecimal digest of their text (about 20 MB).
BROADCAST_GROUPS = 100_000


class CountingQuotientFilter:
    """Fingerprints of ``bits`` bits with counts, in slots ordered by quotient and remainder."""

    def __init__(self, bits: int, quotient_bits: int, occupied, run_end, counter, slots):
        self.bits, self.quotient_bits = bits, quotient_bits
        self.occupied, self.run_end, self.counter, self.slots = occupied, run_end, counter, slots

    @classmethod
    def build(cls, prints: np.ndarray, counts: np.ndarray, bits: int) -> CountingQuotientFilter:
        """From distinct ascending fingerprints below 2**bits. The home slots are about half full."""
        quotient_bits = min(bits, max(1, int(len(prints)).bit_length()))
        remainder_bits = np.uint64(bits - quotient_bits)
        quotient = (prints >> remainder_bits).astype(np.int64)
        remainder = prints & ((np.uint64(1) << remainder_bits) - np.uint64(1))
        many = counts > 1
        width = 1 + many.astype(np.int64)
        ahead = np.cumsum(width) - width
        # A fingerprint sits in its home slot, or right after the one before it.
        place = ahead + np.maximum.accumulate(quotient - ahead) if len(prints) else ahead
        size = max(1 << quotient_bits, int(place[-1] + width[-1]) if len(prints) else 0)
        occupied, run_end, counter = np.zeros(1 << quotient_bits, bool), np.zeros(size, bool), np.zeros(size, bool)
        slots = np.zeros(size, np.uint64)
        occupied[quotient] = True
        slots[place] = remainder
        slots[place[many] + 1] = counts[many].astype(np.uint64)
        counter[place[many] + 1] = True
        last = np.flatnonzero(np.r_[quotient[1:] != quotient[:-1], True]) if len(prints) else np.zeros(0, int)
        run_end[place[last] + width[last] - 1] = True
        return cls(bits, quotient_bits, occupied, run_end, counter, slots)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """Ascending fingerprints and their counts. The k-th run end closes the run of the k-th occupied home."""
        homes, ends = np.flatnonzero(self.occupied), np.flatnonzero(self.run_end)
        starts = np.maximum(homes, np.r_[-1, ends[:-1]] + 1) if len(ends) else ends
        lengths = ends - starts + 1
        skipped = np.cumsum(lengths) - lengths
        places = np.arange(lengths.sum()) - np.repeat(skipped - starts, lengths)
        quotient, is_count = np.repeat(homes, lengths), self.counter[places]
        keys = ~is_count
        remainder_bits = np.uint64(self.bits - self.quotient_bits)
        prints = (quotient[keys].astype(np.uint64) << remainder_bits) | self.slots[places[keys]]
        followed = np.r_[is_count[1:], False][keys] if len(places) else keys
        counts = np.ones(len(prints), np.int64)
        counts[followed] = self.slots[places[is_count]].astype(np.int64)
        return prints, counts

    def to_bytes(self) -> bytes:
        width = -(-max(self.bits - self.quotient_bits, 1) // 8)
        plain = np.where(self.counter, 0, self.slots).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        flags = [np.packbits(x).tobytes() for x in (self.occupied, self.run_end, self.counter)]
        head = np.array([self.bits, self.quotient_bits, len(self.slots), self.counter.sum()], "<i8").tobytes()
        return b"".join([head, *flags, self.slots[self.counter].astype("<u8").tobytes(), plain.tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        bits, quotient_bits, size, counted = (int(x) for x in np.frombuffer(data, "<i8", 4))
        at, flags = 32, []
        for n in (1 << quotient_bits, size, size):
            flags.append(np.unpackbits(np.frombuffer(data, np.uint8, -(-n // 8), at), count=n).astype(bool))
            at += -(-n // 8)
        counts = np.frombuffer(data, "<u8", counted, at)
        width = -(-max(bits - quotient_bits, 1) // 8)
        slots = np.zeros((size, 8), np.uint8)
        slots[:, :width] = np.frombuffer(data, np.uint8, size * width, at + 8 * counted).reshape(size, width)
        slots = slots.view("<u8").reshape(-1).copy()
        slots[flags[2]] = counts
        return cls(bits, quotient_bits, *flags, slots)

    @classmethod
    def merge(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """Counts of equal fingerprints add up. Each part is ascending already, so the stable sort merges runs."""
        parts = [f.items() for f in filters]
        prints, counts = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        order = np.argsort(prints, kind="stable")
        prints, counts = prints[order], counts[order]
        first = np.flatnonzero(np.r_[True, prints[1:] != prints[:-1]]) if len(prints) else np.zeros(0, int)
        total = np.add.reduceat(counts, first) if len(first) else counts
        return cls.build(prints[first], total, filters[0].bits)


def fingerprint(text: Column, bits: int = 64) -> Column:
    """The leading ``bits`` bits of xxhash64, as a long; ``bits`` below 64 makes collisions for tests."""
    return F.shiftrightunsigned(F.xxhash64(text), 64 - bits) if bits < 64 else F.xxhash64(text)


def repeated_fingerprints(prints: DataFrame, bits: int = 64, items: int | None = None) -> DataFrame:
    """Fingerprints (column ``print``) that occur more than once, with their counts, from merged filters."""
    spark = prints.sparkSession
    items = prints.count() if items is None else items
    ranges = max(partitions(spark), -(-items // RANGE_ITEMS))
    range_bits = min(bits - 1, max(1, (ranges - 1).bit_length()))
    own_bits = bits - range_bits

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, counts, pending, waiting = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

        def settle():
            nonlocal seen, counts, pending, waiting
            every = np.concatenate([seen, *pending])
            weight = np.concatenate([counts, np.ones(waiting, np.int64)])
            seen, at = np.unique(every, return_inverse=True)
            counts = np.bincount(at, weight, len(seen)).astype(np.int64)
            pending, waiting = [], 0

        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            pending.append(values.view(np.uint64) & np.uint64((1 << bits) - 1))
            waiting += len(values)
            if waiting > RANGE_ITEMS:
                settle()
        settle()
        home = (seen >> np.uint64(own_bits)).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, home[1:] != home[:-1]]) if len(seen) else np.zeros(0, int)
        mask = np.uint64((1 << own_bits) - 1)
        for start, end in zip(starts, np.r_[starts[1:], len(seen)]):
            made = CountingQuotientFilter.build(seen[start:end] & mask, counts[start:end], own_bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array([home[start]], pa.int64()), pa.array([made.to_bytes()], pa.binary())], names=["home", "filter"]
            )

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        whole = CountingQuotientFilter.merge([CountingQuotientFilter.from_bytes(x) for x in group["filter"]])
        own, counts = whole.items()
        many = counts > 1
        value = (own[many] | (np.uint64(key[0]) << np.uint64(own_bits))).astype(np.uint64)
        return pd.DataFrame({"print": value.view(np.int64), "n": counts[many]})

    filters = prints.select("print").mapInArrow(build, "home long, filter binary")
    return filters.groupBy("home").applyInPandas(merge, "print long, n long")


def with_copies(rows: DataFrame, table: DataFrame, key: str, size: str, items: int, limit: int) -> DataFrame:
    """Left join with a table of one row per repeated key, ``size`` rows of all ``items`` each.

    Up to ``limit`` keys are broadcast. Beyond, only keys that own over 1/1000 of the rows are, at most
    1000 of them, and the join of the rest is shuffled.
    """
    if table.limit(limit + 1).count() <= limit:
        return rows.join(F.broadcast(table), key, "left")
    hot = F.broadcast(table.filter(F.col(size) * 1000 > items))
    rest = rows.join(hot.select(key), key, "left_anti").join(table, key, "left")
    return rows.join(hot, key).unionByName(rest)


def exact_duplicates(docs: DataFrame, bits: int = 64) -> DataFrame:
    """One row per document: (row, doc_id, keep_id, group_size, kept, text_sha256).

    Only rows whose fingerprint the merged filters count more than once are grouped and compared.
    """
    normal = ascii_lower(text_of())
    rows = materialize(
        docs.select(
            F.monotonically_increasing_id().alias("row"), "doc_id",
            fingerprint(normal, bits).alias("print"), F.sha2(normal, 256).alias("text_sha256"),
        )
    )
    items = rows.count()
    repeated = materialize(repeated_fingerprints(rows, bits, items))
    texts = docs.select(normal.alias("normal"), fingerprint(normal, bits).alias("print"))
    routed_texts = with_copies(texts, repeated, "print", "n", items, BROADCAST_ITEMS).filter("n is not null")
    # Equal bytes within a fingerprint, counted in every task before anything is shuffled.
    equal = routed_texts.groupBy("print", "normal").agg(F.count("*").alias("group_size")).filter("group_size > 1")
    verified = equal.select(F.sha2("normal", 256).alias("text_sha256"), "group_size")
    flagged = with_copies(rows, repeated, "print", "n", items, BROADCAST_ITEMS)
    routed, single = flagged.filter("n is not null"), flagged.filter("n is null")
    best = F.max(F.struct("doc_id", "row")).alias("best")
    # The largest row of a text, found in every task first: a group may hold a third of all rows.
    groups = materialize(verified.join(routed.groupBy("text_sha256").agg(best), "text_sha256"))
    named = with_copies(routed, groups, "text_sha256", "group_size", items, BROADCAST_GROUPS)
    out = named.unionByName(single, allowMissingColumns=True)
    alone = F.col("best").isNull()
    return out.select(
        "row", "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce(F.col("group_size"), F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("best.row"))).alias("kept"), "text_sha256",
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever the names of those."""
    names, docs = docs.columns, set_aside(docs, ("doc_id", "text"))
    rows = materialize(exact_duplicates(docs).select("doc_id", "text_sha256", "kept"))
    keyed = docs.withColumn("_sha", F.sha2(ascii_lower(text_of()), 256))
    # A copy goes if no row with its doc_id and text stays; of rows equal in both one stays.
    same = rows.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    named = same.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_text"), "kept", "n")
    equal = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_text"))
    gone = materialize(named.filter("not kept"))
    out = keyed.join(checked_broadcast(gone), equal, "left_anti")
    twice = materialize(named.filter("kept and n > 1"))
    if twice.limit(1).count():
        twice = checked_broadcast(twice)
        once = out.join(twice, equal, "left_semi").dropDuplicates(["doc_id", "_sha"])
        out = out.join(twice, equal, "left_anti").union(once)
    return out.drop("_sha").toDF(*names)
