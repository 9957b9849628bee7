"""Whitening of embeddings: components of the covariance, each row's projection scaled to variance one.

Entries become whole numbers, ``floor(scale * c) + shift``, whose sums are exact. One pass adds up rows
and sums, a second one outer products of centred rows, a task's rows at once. The covariance (its size
is the square of the dimension, whatever the number of rows) is reduced to tridiagonal form, the
leading eigenvalues are found by bisection and their vectors by inverse iteration (``tridiagonal``);
mean and components are sent to all tasks, which project every row.

Rows whose vector is null or holds null or non-finite entries take no part. The dimension is the most
frequent length (the larger one of equally frequent ones); vectors of other lengths, empty ones
included, take no part. Rows may repeat, also with one id, and a null id stays null. Whole numbers
beyond 2^62 are cut there; ``deviation`` is null where it exceeds 64 bits. Components without variance
have no whitened value and are left out, so equal rows or a single one give no rows, as does an empty
table. Equal eigenvalues leave their components free up to a rotation; one choice holds for all rows.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spendcast.llm.tridiagonal import EPS, leading_eigenpairs

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8

LIMIT = 1 << 62


@dataclass
class Whitener:
    """What the fit leaves: exact sums, and components by falling eigenvalue (as columns)."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0


def usable(rows: DataFrame, vector: str, key: str) -> tuple[DataFrame, int]:
    """Rows (key, vector as doubles) that take part, and their dimension."""
    doubles = rows.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = doubles.filter(F.col("vector").isNotNull() & (F.size("vector") > 0) & F.coalesce(fine, F.lit(False)))
    sizes = whole.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    dimension = most[0]["size"] if most else 0
    return whole.filter(F.size("vector") == dimension), dimension


def whole_numbers(batch: pa.Array, dimension: int) -> np.ndarray:
    """The vectors of a batch as whole numbers, one row each."""
    values = batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
    with np.errstate(over="ignore"):
        floors = np.floor(values * SCALE)
    return (np.clip(floors, -LIMIT, LIMIT)).astype(np.int64) + SHIFT


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, as 64-bit numbers where they fit and as Python's otherwise."""
    largest = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    if n * largest + max(map(abs, sums)) < LIMIT:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _sums(rows: DataFrame, dimension: int) -> tuple[int, list[int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * dimension
        for batch in batches:
            x = whole_numbers(batch.column(1), dimension)
            n += len(x)
            small = len(x) * max(int(x.max(initial=0)), -int(x.min(initial=0))) < LIMIT
            own = x.sum(axis=0) if small else x.astype(object).sum(axis=0)
            sums = [a + int(b) for a, b in zip(sums, own)]
        yield pa.RecordBatch.from_arrays([pa.array([n] * dimension), pa.array(range(dimension), pa.int64()), pa.array(map(str, sums))], names=["n", "place", "s"])

    per_task = rows.mapInArrow(run, "n long, place long, s string")
    total = per_task.groupBy("place").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    found = {r["place"]: r for r in total.collect()}  # one row per dimension
    if not found:
        return 0, []
    return found[0]["n"], [int(found[i]["s"]) for i in range(dimension)]


def _products(rows: DataFrame, dimension: int, centred, width: int) -> np.ndarray:
    """Sum of outer products of ``centred(batch)``, rows of ``width`` numbers, added up by matrix row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            y = centred(batch)
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["place", "line"])

    lines = rows.mapInArrow(run, "place int, line array<double>")
    cells = lines.select("place", F.posexplode("line").alias("other", "value"))
    summed = cells.groupBy("place", "other").agg(F.sum("value").alias("value"))
    out = np.zeros((width, width))
    for r in summed.toArrow().to_pylist():  # the square of the dimension
        out[r["place"], r["other"]] = r["value"]
    return (out + out.T) / 2


def _centred(batch: pa.RecordBatch, dimension: int, n: int, sums: list[int]) -> np.ndarray:
    return deviations(whole_numbers(batch.column(1), dimension), n, sums).astype(float) / n


def fit(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> Whitener | None:
    """Fit on all rows that take part; ``None`` if there are none."""
    table, dimension = usable(rows, vector, key)
    if not dimension:
        return None
    n, sums = _sums(table, dimension)
    covariance = _products(table, dimension, lambda b: _centred(b, dimension, n, sums), dimension) / n
    values, vectors = leading_eigenpairs(covariance, min(components, dimension))
    trace = float(np.trace(covariance))
    real = values > dimension * EPS * trace
    model = Whitener(n, sums, values[real], vectors[:, real], trace)
    width = int(real.sum())
    if width:
        # The whitened rows' covariance as it comes out of the rows; their mean is zero but for rounding.
        spread = _products(table, dimension, lambda b: np.c_[_whitened(b, dimension, model), np.ones(b.num_rows)], width + 1) / n
        mean = spread[width, :width]
        model.identity_error = float(np.abs(spread[:width, :width] - np.outer(mean, mean) - np.eye(width)).max())
    return model


def _whitened(batch: pa.RecordBatch, dimension: int, model: Whitener) -> np.ndarray:
    return _centred(batch, dimension, model.n, model.sums) @ (model.vectors / np.sqrt(model.values))


def project(rows: DataFrame, model: Whitener | None, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """Rows (key, component, n, deviation, whitened, explained, identity_error), one for each row and component."""
    table, dimension = usable(rows, vector, key)
    kind = dict(table.dtypes)["key"]
    schema = f"{key} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not dimension or not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)
    width = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            away = deviations(whole_numbers(batch.column(1), dimension), model.n, model.sums)
            rough = (away.astype(float) ** 2).sum(axis=1)
            exact = away.dtype != object and float(rough.max(initial=0.0)) < LIMIT
            square = (away**2).sum(axis=1).tolist() if exact else [sum(int(v) ** 2 for v in r) for r in away]
            square = [s if s < 1 << 63 else None for s in square]
            whitened = (away.astype(float) / model.n) @ (model.vectors / np.sqrt(model.values))
            each = pa.array(np.repeat(np.arange(m), width))
            columns = [
                batch.column(0).take(each), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), m)),
                pa.array(np.full(m * width, model.n)), pa.array(square, pa.int64()).take(each), pa.array(whitened.ravel()),
                pa.array(np.tile(model.values / model.trace, m)), pa.array(np.full(m * width, model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return table.mapInArrow(run, schema)
