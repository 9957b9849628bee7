"""Removal of repeated byte strings by suffix arrays.

Every byte covered by a string of ``LENGTH`` bytes that starts anywhere else as well is removed.
Texts are UTF-8 bytes, null is empty, and strings never cross documents.

1. A string's anchor is the least hash among its ``GRAM``-byte pieces, the first of equal ones. Equal
   strings have equal anchors in the same place, so strings need only be compared within an anchor's
   bucket. Neighbouring strings of a document mostly share one anchor; such a stretch is a segment.
2. Segments whose anchor occurs once are done. Equal segments are one from here on, and a segment
   with a copy is repeated from end to end.
3. The distinct segments of buckets are laid end to end, without what can't be repeated and with what
   all share as one symbol, and their suffixes sorted by ``suffix_array``. A string is repeated if it equals that of the suffix before
   or after it in order.
4. A bucket with more than ``BUCKET`` distinct segments is split: its strings go to buckets of their
   own, by hash, and are counted there.
5. The repeated stretches of a document are joined and cut out of its text.

Rows equal in doc_id and text count as often as they occur and all give the same result. Strings
compared by hash are compared by 64 bits in every step but the third. Extra columns are ignored by
``removals`` and kept by ``cleaned``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from spendcast.llm.common import BROADCAST_IDS, checked_broadcast, drop_table, handing_back, set_aside
from spendcast.llm.suffix_array import suffix_array
from spendcast.session import materialize

LENGTH, GRAM = 200, 32
#: Distinct segments up to which a bucket is sorted whole, and bytes that are sorted at a time.
BUCKET, CHUNK = 5000, 80_000

_BYTE = np.random.default_rng(17).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = 0x9E3779B97F4A7C15


def _rolled(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of every piece of ``length`` bytes, by joining hashes of halves."""
    whole, have, power = None, 0, _BYTE[data]
    width, bits = 1, length
    while bits:
        if bits & 1:
            if whole is None:
                whole, have = power, width
            else:
                m = len(data) - have - width + 1
                whole = whole[:m] * np.uint64(pow(_FACTOR, width, 1 << 64)) + power[have : have + m]
                have += width
        bits >>= 1
        if bits:
            m = len(power) - width
            power = power[:m] * np.uint64(pow(_FACTOR, width, 1 << 64)) + power[width : width + m]
            width *= 2
    whole = whole ^ (whole >> np.uint64(31))
    whole = whole * np.uint64(0xBF58476D1CE4E5B9)
    return whole ^ (whole >> np.uint64(29))


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` over every stretch of ``width`` values, by doubling."""
    have = 1
    while have * 2 <= width:
        values = best(values[:-have], values[have:])
        have *= 2
    more = width - have
    return best(values[: len(values) - more], values[more:]) if more else values


def segments(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last start, anchor place and anchor hash of the stretches of strings with one anchor."""
    starts = len(data) - length + 1
    if starts < 1:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    grams = _rolled(np.frombuffer(data, np.uint8), gram)
    width = length - gram + 1
    least = _sliding(grams, width, np.minimum)
    first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    final = np.r_[first[1:] - 1, starts - 1]
    value = least[first]
    # Pieces that are the least of some string: the largest minimum around them is themselves.
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    anchors = np.flatnonzero(_sliding(padded, width, np.maximum) == grams)
    out = []
    while len(first):
        at = np.searchsorted(anchors, first)
        open_ = grams[anchors[at]] != value
        while open_.any():
            at[open_] += 1
            open_ = grams[anchors[at]] != value
        place = anchors[at]
        out.append((first, np.minimum(final, place), place, value))
        # The same piece again further on: later strings begin behind this one.
        rest = place < final
        first, final, value = place[rest] + 1, final[rest], value[rest]
    first, final, place, value = (np.concatenate(x) for x in zip(*out))
    order = np.argsort(first, kind="stable")
    return first[order], final[order], place[order], value[order]


def _shared_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:  # a and b agree up to low, not up to high
        middle = (low + high) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle)
    return low


def _longest_shared(texts: list[bytes]) -> list[int]:
    """For every text the longest prefix it has in common with any other: that of a neighbour in order."""
    order = sorted(range(len(texts)), key=texts.__getitem__)
    out = [0] * len(texts)
    for i, j in zip(order, order[1:]):
        n = _shared_prefix(texts[i], texts[j])
        out[i], out[j] = max(out[i], n), max(out[j], n)
    return out


def repeated_starts(buckets: list[list[tuple[bytes, int]]], anchors: list[np.uint64], length: int = LENGTH, gram: int = GRAM) -> list[list[list[int]]]:
    """For each member (bytes, number of strings) of each bucket, the starts whose string another member has, too.

    Members agree around their anchor. Counted back from it, a string can only begin where the member
    shares both what lies before and what lies behind with some other; the bytes that all strings left
    in a bucket contain stand as one symbol, equal for equal bytes, so that suffixes are sorted by what
    can differ. Ends of members are symbols of their own.
    """
    found = [[[] for _ in own] for own in buckets]
    rows: list[tuple] = []  # bucket, member, first start, starts, left, middle, right, symbols of a string
    middles: dict[tuple, int] = {}
    for number, (own, anchor) in enumerate(zip(buckets, anchors)):
        data, strings = own[0]
        hashes = _rolled(np.frombuffer(data, np.uint8), gram)
        at = strings - 1 + int(np.flatnonzero(hashes[strings - 1 :] == anchor)[0])
        word = data[at : at + gram]
        places = [d.find(word, n - 1) for d, n in own]
        ahead = _longest_shared([d[p:] for (d, _), p in zip(own, places)])
        behind = _longest_shared([d[:p][::-1] for (d, _), p in zip(own, places)])
        # Distances from the anchor back to a string's start.
        near = [max(p - n + 1, length - r) for (_, n), p, r in zip(own, places, ahead)]
        far = [min(p, r) for p, r in zip(places, behind)]
        left_over = [i for i in range(len(own)) if near[i] <= far[i]]
        if len(left_over) < 2:
            continue
        low, high = min(near[i] for i in left_over), max(far[i] for i in left_over)
        for i in left_over:
            data, place = own[i][0], places[i]
            middle = middles.setdefault((number, data[place - low : place - high + length]), len(middles))
            left, right = data[place - far[i] : place - low], data[place - high + length : place - near[i] + length]
            rows.append((number, i, place - far[i], far[i] - near[i] + 1, left, middle, right, high - low + 1))
    ends = len(rows)
    text: list[int] = []
    owner: list[int] = []
    offset: list[int] = []
    for k, (_, _, _, _, left, middle, right, _) in enumerate(rows):
        offset.append(len(text))
        text += [b + ends for b in left]
        text.append(ends + 256 + middle)
        text += [b + ends for b in right]
        text.append(ends - 1 - k)  # the least one at the very end
        owner += [k] * (len(text) - offset[k])
    before, before_at = None, (0, 0)
    hit: list[set[int]] = [set() for _ in rows]
    for suffix in suffix_array(text) if rows else ():
        k = owner[suffix]
        start = suffix - offset[k]
        _, _, _, starts, left, middle, right, symbols = rows[k]
        if start < starts:
            string = (left[start:], middle, right[: symbols - 1 - len(left) + start])
            if string == before:
                hit[k].add(start)
                hit[before_at[0]].add(before_at[1])
            before, before_at = string, (k, start)
    for (number, i, first, *_), own in zip(rows, hit):
        found[number][i] = sorted(first + x for x in own)
    return found


def _runs(starts: list[int]) -> list[tuple[int, int]]:
    """Ascending numbers as ranges with both ends included."""
    out: list[tuple[int, int]] = []
    for s in starts:
        if out and s == out[-1][1] + 1:
            out[-1] = (out[-1][0], s)
        else:
            out.append((s, s))
    return out


def _row() -> Column:
    """Names a document by its content, so a lost task gives its rows the same names again."""
    return F.xxhash64("doc_id", "text")


def _only(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``texts`` whose ``row`` is in ``ids``; few ids are sent to the scan."""
    return texts.join(checked_broadcast(ids), "row", "left_semi")


def _segment_table(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, grams, prints, firsts, lasts = [], [], [], [], []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = (text or "").encode("utf-8", "replace")
                first, last, place, value = segments(data, length, gram)
                rows.append(np.full(len(first), row))
                grams.append(value.view(np.int64))
                firsts.append(first)
                lasts.append(last)
                prints += [
                    xxhash.xxh3_64_intdigest(data[a : b + length], p - a)
                    for a, b, p in zip(first.tolist(), last.tolist(), place.tolist())
                ]
            columns = [
                pa.array(np.concatenate(rows)), pa.array(np.concatenate(grams)),
                pa.array(np.array(prints, np.uint64).view(np.int64)),
                pa.array(np.concatenate(firsts).astype(np.int32)), pa.array(np.concatenate(lasts).astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "gram", "print", "first", "last"])

    schema = "row long, gram long, print long, first int, last int"
    return docs.select("row", "text").mapInArrow(handing_back(run), schema)


def _with_bytes(docs: DataFrame, members: DataFrame, length: int) -> DataFrame:
    """Members (gram, print, row, first, last) with their ``data``."""
    by_row = members.groupBy("row").agg(F.collect_list(F.struct("gram", "print", "first", "last")).alias("own"))
    texts = _only(docs.select("row", "text"), members.select("row").distinct()).dropDuplicates(["row"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("gram", "print", "row", "first", "last", "data")}
            for row, text, own in zip(*(batch.column(i).to_pylist() for i in range(3))):
                data = text.encode("utf-8", "replace")
                for m in own:
                    for n in ("gram", "print", "first", "last"):
                        out[n].append(m[n])
                    out["row"].append(row)
                    out["data"].append(data[m["first"] : m["last"] + length])
            types = {"first": pa.int32(), "last": pa.int32(), "data": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(v, types.get(n, pa.int64())) for n, v in out.items()], names=list(out))

    return texts.join(by_row, "row").select("row", "text", "own").mapInArrow(
        handing_back(run), "gram long, print long, row long, first int, last int, data binary"
    )


def _sorted_spans(members: DataFrame, length: int, gram: int) -> DataFrame:
    """Repeated stretches (row, start, stop) among members of equal anchors, by suffix arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[list[tuple]] = []  # buckets of (anchor, row, first, last, data)
        size = 0

        def settle() -> pa.RecordBatch:
            rows, starts, stops = [], [], []
            found = repeated_starts(
                [[(m[4], m[3] - m[2] + 1) for m in own] for own in waiting],
                [np.int64(own[0][0]).view(np.uint64) for own in waiting], length, gram,
            )
            for bucket, each in zip(waiting, found):
                for (_, row, first, _, _), own in zip(bucket, each):
                    for a, b in _runs(own):
                        rows.append(row)
                        starts.append(first + a)
                        stops.append(first + b + length)
            columns = [pa.array(rows, pa.int64()), pa.array(starts, pa.int32()), pa.array(stops, pa.int32())]
            return pa.RecordBatch.from_arrays(columns, names=["row", "start", "stop"])

        for batch in batches:
            for member in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if not waiting or waiting[-1][0][0] != member[0]:  # buckets come one after the other
                    if size > CHUNK:
                        yield settle()
                        waiting, size = [], 0
                    waiting.append([])
                waiting[-1].append(member)
                size += len(member[4])
        if waiting:
            yield settle()

    dealt = members.select("gram", "row", "first", "last", "data").repartition("gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(handing_back(run), "row long, start int, stop int")


def _counted_spans(members: DataFrame, length: int) -> DataFrame:
    """Repeated strings (row, start, stop) among members of very full buckets, by the hash of each string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, strings = [], [], []
            for row, first, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                own = _rolled(np.frombuffer(data, np.uint8), length)
                rows.append(np.full(len(own), row))
                starts.append(first + np.arange(len(own), dtype=np.int32))
                strings.append(own.view(np.int64))
            if rows:
                columns = [pa.array(np.concatenate(x)) for x in (rows, starts, strings)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "start", "string"])

    strings = materialize(members.select("row", "first", "data").mapInArrow(run, "row long, start int, string long"))
    often = strings.groupBy("string").agg(F.count("*").alias("n")).filter("n > 1").select("string")
    return strings.join(often, "string", "left_semi").select("row", "start", (F.col("start") + length).alias("stop"))


def spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Stretches of repeated strings (row, start, stop), overlapping ones included, for documents (row, text)."""
    table = materialize(_segment_table(docs, length, gram))
    anchors = table.groupBy("gram").agg(F.count("*").alias("n"), F.min("print").alias("low"), F.max("print").alias("high"))
    shared = anchors.filter("n > 1").select("gram", (F.col("low") != F.col("high")).alias("mixed"))
    held = materialize(table.join(shared, "gram"))
    drop_table(table)
    one = F.min(F.struct("row", "first", "last")).alias("one")
    distinct = materialize(held.groupBy("gram", "print", "mixed").agg(F.count("*").alias("n"), one))
    copies = held.join(distinct.filter("n > 1").select("gram", "print"), ["gram", "print"], "left_semi")
    whole = copies.select("row", F.col("first").alias("start"), (F.col("last") + length).alias("stop"))

    members = distinct.filter("mixed").select("gram", "print", "one.row", "one.first", "one.last")
    full = members.groupBy("gram").agg(F.count("*").alias("many")).filter(F.col("many") > BUCKET).select("gram")
    data = materialize(_with_bytes(docs, members, length))
    usual = _sorted_spans(data.join(full, "gram", "left_anti"), length, gram)
    hot = _counted_spans(data.join(full, "gram", "left_semi"), length)
    return whole.union(usual).union(hot)


def cut(data: bytes, own: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left of the bytes without the stretches, and the number of maximal removed runs."""
    kept, runs, at, end = [], 0, 0, -1
    for start, stop in sorted(own):
        if start > end:  # touching stretches make one run
            kept.append(data[at:start])
            runs += 1
        end = max(end, stop)
        at = end
    kept.append(data[at:])
    return b"".join(kept), runs


def _met(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """The columns of ``docs`` with ``_own``, the stretches to cut out of each text (null: none)."""
    keyed = docs.withColumn("_row", _row())
    found = materialize(spans(docs.select(_row().alias("row"), "text"), length, gram))
    by_row = materialize(found.groupBy(F.col("row").alias("_row")).agg(F.collect_list(F.struct("start", "stop")).alias("_own")))
    drop_table(found)
    columns = docs.columns
    ids = by_row.select("_row")
    if ids.count() > BROADCAST_IDS:
        return keyed.join(by_row, "_row", "left").select(*columns, "_own")
    # Only texts that lose something meet their stretches in a shuffle.
    hit = keyed.join(F.broadcast(ids), "_row", "left_semi").join(by_row, "_row")
    rest = keyed.join(F.broadcast(ids), "_row", "left_anti").withColumn("_own", F.lit(None).cast(by_row.schema["_own"].dataType))
    return hit.select(*columns, "_own").union(rest.select(*columns, "_own"))


def _cuts(texts: pa.Array, own: pa.Array) -> Iterator[tuple[str | None, bytes, bytes, int]]:
    """For every text: itself, its bytes, what is left of them, and the number of removed runs."""
    for text, stretches in zip(texts.to_pylist(), own.to_pylist()):
        data = (text or "").encode("utf-8", "replace")
        yield text, data, *cut(data, [(s["start"], s["stop"]) for s in stretches or []])


def remove(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The columns of ``docs`` with ``n_bytes``, ``n_spans`` and ``kept`` (the remaining bytes)."""
    docs = docs.drop("n_bytes", "n_spans", "kept")
    columns = docs.columns
    position = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, runs, kept = [], [], []
            for _, data, left, n in _cuts(batch.column(position), batch.column(len(columns))):
                sizes.append(len(data))
                runs.append(n)
                kept.append(left)
            added = [pa.array(sizes, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())]
            names = [*columns, "n_bytes", "n_spans", "kept"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], names=names)

    schema = docs.limit(0).schema.add("n_bytes", "long").add("n_spans", "long").add("kept", "binary")
    return _met(docs, length, gram).mapInArrow(handing_back(run), schema)


def removals(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    done = remove(docs.select("doc_id", "text"), length)
    return done.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def cleaned(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with repeated strings cut out of ``text``; characters that lost a byte go, too.

    All columns stay, whatever their names. Texts are cut and decoded in one step: two would send each
    text to Python twice and hold two workers a task.
    """
    names, kinds = docs.columns, docs.limit(0).schema
    docs = set_aside(docs, ("doc_id", "text"))
    columns = docs.columns
    position = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = _cuts(batch.column(position), batch.column(len(columns)))
            own = list(batch.columns[: len(columns)])
            own[position] = pa.array([left.decode("utf-8", "ignore") if n else text for text, _, left, n in cuts], pa.string())
            yield pa.RecordBatch.from_arrays(own, names=names)

    return _met(docs, length, GRAM).mapInArrow(handing_back(run), kinds)
