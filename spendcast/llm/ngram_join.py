"""Jaccard self-join on word n-grams by T-occurrence search with DivideSkip.

A document's set holds its distinct ``WORDS``-word shingles, as 64-bit hashes; a shorter text is one
shingle, a text without words has none and is linked with nothing. Two documents link when
``100 * intersection >= PERCENT * union``.

1. Equal sets are one document from here on, the one with the smallest doc_id.
2. Shingles have one global order, frequent ones last. Two linked sets share a shingle among the
   first ``n - ceil(PERCENT * n / 100) + 1`` of either, so only these are listed by shingle.
3. A list's documents are first checked against its smallest one, which settles most of a group of
   near copies in as many checks as it has documents. Lists whose documents are in one component by
   then are done. While the others have more pairs than there are entries and a round halves them, the
   documents outside a list's largest component are checked against a few pivots of it: those of its
   documents with most links, more of them each round. In the lists left after that every document
   outside the largest component is checked against those of other components. No link between
   different components is lost, and links inside one cannot change it.
4. A check begins with the heads: what they share and what is left behind them must suffice. What
   remains is a T-occurrence search: up to ``BLOCK`` candidates of a query are put in inverted lists
   by the query's shingles, short lists are heap-merged, long ones binary-probed for what the short
   ones found often enough.

Null texts are empty. Rows repeated with one doc_id are copies of it. A null doc_id takes part; it
counts as larger than any other, so a component of such rows alone has none. Extra columns are
ignored. Which shingles count as frequent only affects the work, never the result.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from spendcast.llm.common import checked_broadcast, components, drop_table, handing_back, set_aside
from spendcast.session import materialize

WORDS, PERCENT, BLOCK = 5, 80, 256
#: Most frequent shingles that are sent to every task, and shingles counted at a time in a task.
FREQUENT, CHUNK = 1 << 20, 2_500_000
#: Pivots of a component in the first round and how many times as many in each further one; rounds end when the lists
#: that are left have at most so many pairs for each listed shingle, or more than half of those they had before.
PIVOTS, MORE, ENOUGH = 32, 4, 1

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """64-bit hashes of words, emptied when large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_KNOWN = _Words()


def _forget_words() -> None:
    _KNOWN.clear()


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Ascending distinct hashes of the shingles. Words end at a space or a control character from 9 to 13."""
    cut = (text or "").encode("utf-8", "replace").lower().split()  # of bytes: A-Z and these characters only
    if not cut:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_KNOWN.__getitem__, cut), np.uint64, len(cut))
    length = min(words, len(h))
    s = np.full(len(h) - length + 1, length, np.uint64)
    for i in range(length):
        s = s * _FACTOR + h[i : len(h) - length + 1 + i]
        s ^= s >> np.uint64(29)
    s *= np.uint64(0xBF58476D1CE4E5B9)
    s.sort()  # several times as fast as np.unique
    return s[np.r_[True, s[1:] != s[:-1]]]


def needed(percent: int, a, b):
    """The least intersection of linked sets of these sizes: percent * (a + b) / (100 + percent), rounded up."""
    return -(-(percent * (a + b)) // (100 + percent))


def frequent_shingles(docs: DataFrame, words: int) -> pd.DataFrame:
    """The most frequent shingles, rarest of them first. Tasks count shingles in chunks and pass on repeated ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, size = [], 0

        def settle() -> pa.RecordBatch:
            every = np.sort(np.concatenate(pending))
            first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]][: len(every)])
            counts = np.diff(np.r_[first, len(every)])
            many = counts > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(every[first[many]].view(np.int64)), pa.array(counts[many])], names=["shingle", "n"]
            )

        for batch in batches:
            for text in batch.column(0).to_pylist():
                own = shingles(text, words)
                pending.append(own)
                size += len(own)
                if size > CHUNK:
                    yield settle()
                    pending, size = [], 0
        if pending:
            yield settle()

    counted = docs.select("text").mapInArrow(handing_back(run, _forget_words), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counted.filter("n > 2").orderBy(F.desc("n"), "shingle").limit(FREQUENT).toPandas()
    return top.sort_values(["n", "shingle"])


def describe(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Rows (doc_id, n, print, head): set size, a hash of the whole set, the first shingles in global order."""
    top = frequent_shingles(docs, words)
    values = top["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(values)
    sent = docs.sparkSession.sparkContext.broadcast((values[order], order + 1))  # at most FREQUENT numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, place = sent.value
        for batch in batches:
            sizes, prints, heads = [], [], []
            for text in batch.column(1).to_pylist():
                own = shingles(text, words)
                n = len(own)
                sizes.append(n)
                prints.append(xxhash.xxh3_128_digest(own.tobytes()))
                if len(known) and n:
                    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    rank = np.where(known[at] == own, place[at], 0)
                    own = own[np.argsort(rank, kind="stable")]
                heads.append(own[: n + percent * -n // 100 + 1 if n else 0].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
                    pa.array(heads, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "print", "head"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n long, print binary, head array<long>"
    return docs.select("doc_id", "text").mapInArrow(handing_back(run, _forget_words), schema)


def divide_skip(lists: list[list[int]], least: list[int]) -> list[int]:
    """Numbers of the documents that occur in at least ``least[document]`` of the ascending lists.

    With T the smallest need, the longest lists are set aside, fewer than T of them; a document has to
    occur in T less their number of the short lists, which are merged by a heap. It is then looked up
    in the long lists by bisection, until it has enough or can't get there any more.
    """
    t = min(least, default=1)
    lists = sorted(lists, key=len)
    size = len(lists[-1]) if lists else 0
    # The usual balance between merging and probing, with the factor 0.01.
    aside = min(max(0, t - 1), int(t / (0.01 * np.log2(max(size, 2)) + 1)), len(lists))
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :][::-1]
    heap = [(own[0], i, 0) for i, own in enumerate(short) if own]
    heapq.heapify(heap)
    found = []
    while heap:
        doc, count = heap[0][0], 0
        while heap and heap[0][0] == doc:
            _, i, at = heap[0]
            count += 1
            own = short[i]
            if at + 1 < len(own):
                heapq.heapreplace(heap, (own[at + 1], i, at + 1))
            else:
                heapq.heappop(heap)
        need = least[doc]
        if count + len(long) < need:
            continue
        for i, own in enumerate(long):
            if count >= need or count + len(long) - i < need:
                break
            at = bisect_left(own, doc)
            count += at < len(own) and own[at] == doc
        if count >= need:
            found.append(doc)
    return found


def search(query: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> list[int]:
    """Which of the ascending ``sets`` link with the query."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    at = np.minimum(np.searchsorted(query, every), max(len(query) - 1, 0))
    hit = query[at] == every
    at, owner = at[hit], owner[hit]
    order = np.lexsort((owner, at))
    cuts = np.flatnonzero(np.diff(at[order])) + 1
    lists = [x.tolist() for x in np.split(owner[order], cuts)] if len(order) else []
    return divide_skip(lists, [int(needed(percent, len(query), len(s))) for s in sets])


def may_link(percent: int, n: str, at: str, m: str, to: str) -> Column:
    """Whether sets of sizes n and m that first meet at places ``at`` and ``to`` can share enough."""
    left = F.least(F.col(n) - F.col(at), F.col(m) - F.col(to))
    return (100 + percent) * left >= percent * (F.col(n) + F.col(m))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of ``pairs`` (a, b) those that link. Queries with many candidates are split into blocks."""
    salts = F.pmod(F.xxhash64("a"), F.ceil(F.col("many") / BLOCK))
    load = pairs.groupBy(F.col("b").alias("q")).agg(F.count("*").alias("many"))
    dealt = pairs.join(load, F.col("b") == F.col("q")).select("a", "b", salts.alias("block"))
    asked = load.select(F.col("q").alias("b"), F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("many") / BLOCK) - 1)).alias("block"))
    candidates = dealt.join(sets.select(F.col("doc").alias("a"), "set"), "a")
    queries = asked.join(sets.select(F.col("doc").alias("b"), F.col("set").alias("query")), "b")

    def run(key: tuple, own: pd.DataFrame, query: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(query):
            return pd.DataFrame({"a": [], "b": []})
        held = [np.frombuffer(x, np.uint64) for x in own["set"]]
        at = search(np.frombuffer(query["query"].iloc[0], np.uint64), held, percent)
        return pd.DataFrame({"a": own["a"].to_numpy()[at], "b": key[0]})

    return (
        candidates.groupBy("b", "block").cogroup(queries.groupBy("b", "block")).applyInPandas(run, "a long, b long")
    )


def sets_of(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """Rows (doc, set) of the documents in ``ids`` (doc, print), read from their texts again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingles(t, words).tobytes() for t in batch.column(1).to_pylist()]
            # A doc_id with several texts: the one that is meant.
            own = [i for i, (x, p) in enumerate(zip(made, batch.column(2).to_pylist())) if xxhash.xxh3_128_digest(x) == p]
            columns = [batch.column(0).take(pa.array(own, pa.int64())), pa.array([made[i] for i in own], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "set"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    return texts.join(checked_broadcast(ids), "doc").select("doc", "text", "print").mapInArrow(handing_back(run, _forget_words), "doc long, set binary")


def link_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id)."""
    described = materialize(describe(docs, words, percent))
    rows = described.select(F.col("doc_id").cast("long").alias("doc"), "n", "print", "head").filter("n > 0")
    groups = materialize(rows.groupBy("print").agg(F.min("doc").alias("doc"), F.max("doc").alias("high")))
    copied = groups.filter("high > doc").select("print", F.col("doc").alias("low"))
    gone = rows.select("doc", "print").join(copied, "print").filter("doc > low").select("doc", "print").distinct()
    one = rows.join(checked_broadcast(materialize(gone)), ["doc", "print"], "left_anti").filter("doc is not null")
    listed = one.select("doc", "n", F.posexplode("head").alias("at", "shingle"))
    shared = listed.groupBy("shingle").agg(F.count("*").alias("many")).filter("many > 1")
    entries = materialize(listed.join(shared, "shingle"))
    first = entries.groupBy("shingle").agg(F.min(F.struct("doc", "n", "at")).alias("first"))
    first = first.select("shingle", *(F.col(f"first.{c}").alias(f"first_{c}") for c in ("doc", "n", "at")))
    lists = entries.join(first, "shingle")
    to_first = materialize(
        lists.filter((F.col("doc") != F.col("first_doc")) & may_link(percent, "n", "at", "first_n", "first_at"))
        .select(F.col("doc").alias("a"), F.col("first_doc").alias("b")).distinct()
    )
    links = materialize(_checked(docs, to_first, one, words, percent))
    left, pairs = unsettled(entries.filter("many > 2"), links)  # a list of two was settled by its pivot
    listed, many = entries.count(), PIVOTS
    tried = to_first
    while pairs > ENOUGH * listed:
        checked = materialize(against_pivots(left, many, percent).join(tried, ["a", "b"], "left_anti"))
        found = materialize(_checked(docs, checked, one, words, percent))
        if not found.limit(1).count():
            break
        links, tried, before, many = links.union(found), tried.union(checked), pairs, many * MORE
        left, pairs = unsettled(left.select("shingle", "doc", "n", "at"), links)
        if 2 * pairs > before:
            break
    drop_table(entries)
    outside = left.filter("own != main")
    other = left.select("shingle", *(F.col(c).alias(f"other_{c}") for c in ("doc", "n", "at", "own")))
    across = (
        outside.join(other, "shingle")
        .filter((F.col("own") != F.col("other_own")) & ((F.col("other_own") == F.col("main")) | (F.col("doc") > F.col("other_doc"))))
        .filter(may_link(percent, "n", "at", "other_n", "other_at"))
    )
    pair = across.select(F.greatest("doc", "other_doc").alias("a"), F.least("doc", "other_doc").alias("b")).distinct()
    rest = materialize(pair.join(tried, ["a", "b"], "left_anti"))
    linked = components(links.union(materialize(_checked(docs, rest, one, words, percent))))

    final = groups.join(linked.withColumnRenamed("node", "doc"), "doc", "left").select(
        "print", F.coalesce("component", "doc").alias("component_id")
    )
    return described.join(final, "print", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id").cast("long")).alias("component_id"),
    )


def unsettled(entries: DataFrame, links: DataFrame) -> tuple[DataFrame, int]:
    """What the links leave to compare: the entries of lists in several components, and how many pairs these lists have.

    Entries come with ``own``, the document's component, and ``main``, the one that has most of the list's documents.
    Pairs inside a component don't count; a pair counts in every list that has it.
    """
    settled = components(links)
    marked = entries.join(settled.withColumnRenamed("node", "doc"), "doc", "left").select(
        "shingle", "doc", "n", "at", F.coalesce("component", "doc").alias("own")
    )
    weight = marked.groupBy("shingle", "own").agg(F.count("*").alias("many"))
    of_list = weight.groupBy("shingle").agg(
        F.max_by("own", F.struct("many", "own")).alias("main"),
        ((F.pow(F.sum("many"), 2) - F.sum(F.pow("many", 2))) / 2).alias("pairs"),
    )
    lists = materialize(of_list.filter("pairs > 0").select("shingle", "main", "pairs"))
    left = materialize(marked.join(lists.select("shingle", "main"), "shingle"))
    return left, int(lists.agg(F.sum("pairs")).first()[0] or 0)  # one number


def against_pivots(left: DataFrame, many: int, percent: int) -> DataFrame:
    """Pairs (a, b) of each document outside a list's main component and up to ``many`` documents of that one.

    A component has the same pivots in all lists: its documents with most entries there. A document that
    differs much from the rest of its group has shingles of its own in its head, and thus few.
    """
    members = left.filter("own = main").groupBy("doc", "n", "own").agg(F.count("*").alias("listed"))
    place = F.row_number().over(Window.partitionBy("own").orderBy(F.desc("listed"), F.xxhash64("doc"), "doc", "n"))
    pivots = members.withColumn("place", place).filter(F.col("place") <= many)
    pivots = pivots.select(F.col("own").alias("main"), F.col("doc").alias("pivot"), F.col("n").alias("size"))
    outside = left.filter("own != main").select("doc", "n", "main").distinct()
    near = outside.join(pivots, "main").filter(percent * F.greatest("n", "size") <= 100 * F.least("n", "size"))
    return near.select(F.greatest("doc", "pivot").alias("a"), F.least("doc", "pivot").alias("b")).distinct()


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("doc")).union(pairs.select(F.col("b").alias("doc"))).distinct()


def plausible(pairs: DataFrame, one: DataFrame, percent: int) -> DataFrame:
    """Of ``pairs`` (a, b) those whose heads share enough.

    All shingles that two sets share come, but for those behind the head that ends first, from both
    heads; so linked sets share at least their need less what the longer rest may hold.
    """
    heads = one.join(checked_broadcast(materialize(_ids(pairs))), "doc", "left_semi").select("doc", "n", "head")
    heads = materialize(heads)
    of = lambda c: heads.select(*(F.col(x).alias(y) for x, y in (("doc", c), ("n", f"n_{c}"), ("head", f"head_{c}"))))
    rest = F.greatest(F.col("n_a") - F.size("head_a"), F.col("n_b") - F.size("head_b"))
    both = (100 + percent) * (F.size(F.array_intersect("head_a", "head_b")) + rest)
    near = pairs.join(of("a"), "a").join(of("b"), "b").filter(both >= percent * (F.col("n_a") + F.col("n_b")))
    return near.select("a", "b").distinct()


def _checked(docs: DataFrame, pairs: DataFrame, one: DataFrame, words: int, percent: int) -> DataFrame:
    """Of ``pairs`` (a, b) those that link. ``one`` describes the text that each doc stands for."""
    near = materialize(plausible(pairs, one, percent))
    meant = one.select("doc", "print")
    sets = materialize(sets_of(docs, materialize(meant.join(checked_broadcast(materialize(_ids(near))), "doc", "left_semi").distinct()), words))
    return verified(near, sets, percent)


def representatives(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component; rows without doc_id stay.

    All columns stay, whatever their names.
    """
    names, docs = docs.columns, set_aside(docs, ("doc_id", "text"))
    classes = link_components(docs, words, percent)
    gone = materialize(classes.filter("component_id != doc_id").select("doc_id").distinct())
    return docs.join(checked_broadcast(gone), "doc_id", "left_anti").select(*docs.columns).toDF(*names)
