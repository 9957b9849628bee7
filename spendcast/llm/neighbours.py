"""Approximate nearest neighbours by learned partitions.

On at most about ``SAMPLE`` vectors the exact neighbour graph is drawn and cut into ``PARTS`` parts of
even size with few edges between them; a small classifier learns the part from the vector. Every row
is filed under its most probable part. A query visits as many of its most probable parts as it takes
to find ``RECALL`` of the sample's own neighbours, and all their rows are ranked by exact cosine in
double precision. A query that found fewer than ``k`` rows there visits all parts.

Parts are split into blocks of ``BLOCK`` rows and their queries into blocks of ``QUERIES``, so no
task holds a whole part; every block gives at most ``k`` rows per query. Vectors that are null, zero,
of another length than most of the sample, or that hold null or non-finite components take no part,
as rows with a null id. Ties go to the smaller vec_id. Rows with one vec_id are one candidate and one
query, as near as the nearest of their vectors. Vectors are scaled by a power of two before anything
is multiplied, so components of any size give the cosines of the original vectors. Empty tables give
no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from spendcast.llm.common import checked_broadcast
from spendcast.session import materialize

SAMPLE, PARTS, DEGREE, RECALL = 8192, 64, 10, 0.985
BLOCK, QUERIES = 32_768, 2048


def usable(vector: Column) -> Column:
    """Holds finite numbers only, not all of them zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Every row by the power of two that brings its largest component to [0.5, 1)."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """For every row of unit vectors its k nearest other rows, nearest first."""
    out = np.empty((len(x), k), np.int64)
    for start in range(0, len(x), 512):
        cosine = x[start : start + 512] @ x.T
        cosine[np.arange(len(cosine)), start + np.arange(len(cosine))] = -2
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        order = np.argsort(-np.take_along_axis(cosine, near, 1), axis=1, kind="stable")
        out[start : start + 512] = np.take_along_axis(near, order, 1)
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, sweeps: int = 12, slack: float = 0.05) -> np.ndarray:
    """Cut the graph: halve along main directions to begin, then move vertices to the parts of their neighbours.

    A vertex moves to the part that most of its neighbours are in as long as that part has room, so
    sizes stay within ``slack`` of even.
    """
    label = np.zeros(len(x), np.int64)
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        groups.sort(key=len)
        rows = groups.pop()
        centred = x[rows] - x[rows].mean(axis=0)
        _, axes = np.linalg.eigh(centred.T @ centred)
        order = rows[np.argsort(centred @ axes[:, -1], kind="stable")]
        groups += [order[: len(order) // 2], order[len(order) // 2 :]]
    for i, rows in enumerate(groups):
        label[rows] = i
    most = int(np.ceil(len(x) / parts * (1 + slack)))
    back = [[] for _ in range(len(x))]
    for i, near in enumerate(graph.tolist()):
        for j in near:
            back[j].append(i)
    either = [np.array(sorted(set(a) | set(b)), np.int64) for a, b in zip(graph.tolist(), back)]
    size = np.bincount(label, minlength=parts)
    for _ in range(sweeps):
        moved = 0
        for i in range(len(x)):
            votes = np.bincount(label[either[i]], minlength=parts)
            own = label[i]
            votes[(size >= most) & (np.arange(parts) != own)] = -1
            best = int(votes.argmax())
            if votes[best] > votes[own]:
                size[own] -= 1
                size[best] += 1
                label[i] = best
                moved += 1
        if moved < len(x) // 200:
            break
    return label


@dataclass
class Router:
    """One hidden layer between unit vectors and the probabilities of parts."""

    dimensions: int
    first: np.ndarray
    second: np.ndarray
    probes: int = 1

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(np.c_[x, np.ones(len(x))] @ self.first, 0)
        return np.c_[hidden, np.ones(len(x))] @ self.second


def train_router(x: np.ndarray, label: np.ndarray, parts: int, hidden: int = 128, epochs: int = 40) -> Router:
    """Adam on the log loss, in batches of 256."""
    rng = np.random.default_rng(3)
    w = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1] + 1, hidden)), rng.normal(0, hidden**-0.5, (hidden + 1, parts))]
    mean, square, step = [0 * a for a in w], [0 * a for a in w], 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs)
        order = rng.permutation(len(x))
        for start in range(0, len(x), 256):
            rows = order[start : start + 256]
            inner = np.c_[x[rows], np.ones(len(rows))]
            hid = np.maximum(inner @ w[0], 0)
            outer = np.c_[hid, np.ones(len(rows))]
            logits = outer @ w[1]
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), label[rows]] -= 1
            p /= len(rows)
            gradients = [inner.T @ ((p @ w[1][:-1].T) * (hid > 0)), outer.T @ p]
            step += 1
            for i, g in enumerate(gradients):
                mean[i] = 0.9 * mean[i] + 0.1 * g
                square[i] = 0.999 * square[i] + 0.001 * g * g
                w[i] -= rate * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8)
    return Router(x.shape[1], *w)


def fit(vectors: DataFrame, vector: str, key: str, size: int = SAMPLE, parts: int = PARTS, recall: float = RECALL) -> Router | None:
    """The router, and how many parts a query has to visit; None without usable vectors."""
    own = vectors.filter(usable(F.col(vector)) & F.col(key).isNotNull())
    n = own.count()
    if not n:
        return None
    place = F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = own.filter(place < min(1.0, size / n)).select(key, vector).collect()
    rows = rows or own.select(key, vector).limit(1).collect()
    lengths = np.array([len(r[1]) for r in rows])
    dimensions = int(np.bincount(lengths).argmax())
    rows = sorted((r for r in rows if len(r[1]) == dimensions), key=lambda r: (r[0], r[1]))
    x = _unit(_scaled(np.array([r[1] for r in rows], float)))
    x = np.unique(x, axis=0)  # copies would only fill each other's neighbour lists
    parts = max(1, min(parts, len(x) // 32))
    degree = min(DEGREE, len(x) - 1)
    if parts == 1 or not degree:
        return Router(dimensions, np.zeros((dimensions + 1, 1)), np.zeros((2, 1)), 1)
    graph = neighbour_graph(x, degree)
    router = train_router(x, balanced_parts(x, graph, parts), parts)
    order = np.argsort(-router.logits(x), axis=1, kind="stable")
    filed = order[:, 0]
    # In which place of a row's own order its neighbours' parts come.
    rank = np.argsort(order, axis=1)
    wanted = np.take_along_axis(rank, filed[graph[:, : min(5, degree)]], 1).ravel()
    found = np.cumsum(np.bincount(wanted, minlength=parts)) / len(wanted)
    router.probes = int(np.searchsorted(found, recall) + 1)
    return router


def nearest(
    vectors: DataFrame, queries: DataFrame, router: Router | None, k: int = 5, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): each query's k best of the parts it visits, its own id left out."""
    spark = vectors.sparkSession
    if router is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = materialize(_search(vectors, queries, router, k, key, vector))
    full = found.filter(F.col("rank") == k).select(F.col("query_id").alias(key))
    asked = _usable_rows(queries, router, key, vector)
    short = materialize(asked.join(checked_broadcast(full), key, "left_anti"))
    every = len(router.second[0])
    if router.probes >= every or not short.limit(1).count():
        return found
    again = _search(vectors, short, replace(router, probes=every), k, key, vector)
    return found.join(checked_broadcast(full.withColumnRenamed(key, "query_id")), "query_id", "left_semi").union(again)


def _usable_rows(df: DataFrame, router: Router, key: str, vector: str) -> DataFrame:
    ok = df.filter(usable(F.col(vector)) & F.col(key).isNotNull() & (F.size(vector) == router.dimensions))
    return ok.select(F.col(key).cast("long").alias(key), F.col(vector).cast("array<double>").alias(vector))


def _search(vectors: DataFrame, queries: DataFrame, router: Router, k: int, key: str, vector: str) -> DataFrame:
    spark = vectors.sparkSession
    sent = spark.sparkContext.broadcast(router)  # layer sizes only, whatever the number of rows

    def file(probing: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = sent.value
            visits = own.probes if probing else 1
            for batch in batches:
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                x = np.asarray(batch.column(1).flatten().to_numpy(zero_copy_only=False), float).reshape(-1, own.dimensions)
                if not len(x):
                    continue
                x = _scaled(x)
                _, first = np.unique(np.c_[ids.astype(np.int64), x.view(np.int64)], axis=0, return_index=True)
                ids, x = ids[first], x[first]  # a row repeated without end is one in every batch
                parts = np.argsort(-own.logits(_unit(x)), axis=1, kind="stable")[:, :visits]
                packed = [row.tobytes() for row in x]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(ids, parts.shape[1])), pa.array(parts.ravel().astype(np.int32)),
                        pa.array([v for v in packed for _ in range(parts.shape[1])], pa.binary()),
                    ],
                    names=["id", "part", "vector"],
                )

        return run

    def filed(df: DataFrame, probing: bool) -> DataFrame:
        return _usable_rows(df, router, key, vector).mapInArrow(file(probing), "id long, part int, vector binary")

    base, asked = filed(vectors, False), filed(queries, True)
    # How many blocks each part's rows and queries are dealt to: one row per part.
    sizes = base.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    loads = asked.groupBy("part").agg(F.ceil(F.count("*") / QUERIES).alias("turns"))
    plan = F.broadcast(sizes.join(loads, "part"))
    dealt = lambda n: F.pmod(F.xxhash64("id", "vector"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    rows = base.join(plan, "part").withColumn("block", dealt("blocks")).withColumn("turn", every("turns"))
    asks = asked.join(plan, "part").withColumn("turn", dealt("turns")).withColumn("block", every("blocks"))

    def rank(_, own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(own) and len(asked):
            own, asked = own.drop_duplicates(["id", "vector"]), asked.drop_duplicates(["id", "vector"])
            ids = own["id"].to_numpy()
            alone = own["id"].is_unique
            x = np.frombuffer(b"".join(own["vector"]), float).reshape(len(own), -1)
            length = np.sqrt((x * x).sum(axis=1))
            names = asked["id"].to_numpy()
            q = np.frombuffer(b"".join(asked["vector"]), float).reshape(len(asked), -1)
            for start in range(0, len(q), 64):
                cosine = (_unit(q[start : start + 64]) @ x.T) / length
                for i, line in enumerate(cosine):
                    line[ids == names[start + i]] = -3
                    least = np.partition(line, -k)[-k] if alone and len(line) > k else -2
                    at = np.flatnonzero((line >= least - 1e-9) & (line > -2))
                    # One formula for each pair by itself, so equal vectors score equal.
                    own_q = q[start + i]
                    score = (x[at] * own_q).sum(axis=1) / (length[at] * np.sqrt((own_q * own_q).sum()))
                    best = np.lexsort((ids[at], -score))
                    if not alone:  # the nearest vector of every id
                        best = best[np.sort(np.unique(ids[at][best], return_index=True)[1])]
                    best = best[:k]
                    found += [(names[start + i], ids[at][b], score[b]) for b in best]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    keys = ["part", "block", "turn"]
    near = (
        rows.select(*keys, "id", "vector").groupBy(*keys)
        .cogroup(asks.select(*keys, "id", "vector").groupBy(*keys))
        .applyInPandas(rank, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # Ids with several vectors may have been found in several blocks.
    once = near.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
