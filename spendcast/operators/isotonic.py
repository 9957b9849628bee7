"""Isotonic regression of an outcome on a probability, for any number of rows.

Equal probabilities become one point. Every task pools adjacent violators over one range of them, which
leaves blocks of rising means. Ranges are then joined in order, neighbours first: two rising runs can
only pool into one block around the place where they meet, so just the ends that face each other
travel, at most ``ENDS`` blocks a side. A block that swallowed a whole end is met again by the next
blocks until nothing pools. No task sees more than its own range or two ends.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from spendcast.session import materialize

#: Blocks of either side that are looked at in one step where two ranges meet (two at least).
ENDS = 10_000

Block = tuple[float, float, float, float]  # low, high, total, weight


def pool(rising: list[Block], more: Iterable[Block]) -> list[Block]:
    """Append ``more`` to the ``rising`` blocks, merging until every mean is above the one before."""
    for low, high, total, weight in more:
        while rising and rising[-1][2] / rising[-1][3] >= total / weight:
            low, _, earlier_total, earlier_weight = rising.pop()
            total, weight = total + earlier_total, weight + earlier_weight
        rising.append((low, high, total, weight))
    return rising


def blocks(rows: DataFrame, prob: str = "p", outcome: str = "y", weight: Column | None = None, ranges: int | None = None, ends: int = ENDS) -> DataFrame:
    """Rows (``low``, ``high``, ``weight``, ``mean``): the steps of the rising function nearest to the outcomes.

    Rows with a null probability or outcome, or without a positive weight, take no part; no rows give
    no blocks. Without ``ranges`` Spark chooses how many there are by the size of the points.
    """
    w = F.lit(1.0) if weight is None else weight.cast("double")
    used = rows.select(F.col(prob).cast("double").alias("low"), F.col(outcome).cast("double").alias("y"), w.alias("w"))
    points = used.dropna().filter("w > 0").groupBy("low").agg(F.sum(F.col("y") * F.col("w")).alias("total"), F.sum("w").alias("weight"))

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rising: list[Block] = []
        for batch in batches:
            low, total, mass = (c.to_pylist() for c in batch.columns)
            pool(rising, zip(low, low, total, mass))
        if rising:
            columns = [pa.array(c, pa.float64()) for c in zip(*rising)]
            run = pa.array([TaskContext.get().partitionId()] * len(rising), pa.int32())
            yield pa.RecordBatch.from_arrays([run, *columns], names=["run", "low", "high", "total", "weight"])

    by = [ranges, "low"] if ranges else ["low"]
    dealt = points.repartitionByRange(*by).sortWithinPartitions("low")
    found = materialize(dealt.mapInArrow(pooled, "run int, low double, high double, total double, weight double"))
    last = found.agg(F.max("run")).first()[0] or 0
    while last:
        found = _joined(found, ends)
        last //= 2
    return found.select("low", "high", "weight", (F.col("total") / F.col("weight")).alias("mean"))


def _joined(found: DataFrame, ends: int) -> DataFrame:
    """Runs 2k and 2k + 1 as run k, rising again."""
    pair, left = F.shiftright("run", 1), F.col("run") % 2 == 0
    facing = Window.partitionBy("run").orderBy(F.when(left, -F.col("low")).otherwise(F.col("low")))

    def meet(key: tuple, taken: pd.DataFrame) -> pd.DataFrame:
        own = taken.sort_values("low")[["low", "high", "total", "weight"]].itertuples(index=False, name=None)
        before = list(own)
        known = set(before)
        made = [(key[0], *b, b[0] == before[0][0] or b[1] == before[-1][1]) for b in pool([], before) if b not in known]
        return pd.DataFrame(made, columns=["pair", "from", "to", "total", "weight", "open"])

    schema = "pair int, from double, to double, total double, weight double, open boolean"
    while True:
        taken = found.withColumn("at", F.row_number().over(facing)).filter(F.col("at") <= max(2, ends))
        # One block at most for each pair of ranges.
        merged = materialize(taken.withColumn("pair", pair).groupBy("pair").applyInPandas(meet, schema))
        if merged.isEmpty():
            break
        gone = merged.select("pair", "from", "to")
        inside = (F.col("low") >= F.col("from")) & (F.col("high") <= F.col("to")) & (pair == F.col("pair"))
        kept = found.join(F.broadcast(gone), inside, "left_anti")
        new = merged.select((F.col("pair") * 2).alias("run"), F.col("from").alias("low"), F.col("to").alias("high"), "total", "weight")
        found = materialize(kept.unionByName(new))
        if not merged.filter("open").limit(1).count():
            break
    return found.withColumn("run", pair)


def model(found: DataFrame, **columns: str) -> IsotonicRegressionModel:
    """A Spark ML model of the steps of ``blocks``, which is what its own fit gives on all rows.

    The model is one list of steps, so it must fit in one place. Outcomes of 0 and 1 leave few: the
    corners of a convex line on a grid grow with rows to the power of two thirds at most.
    """
    corners = F.when(F.col("low") == F.col("high"), F.array("low")).otherwise(F.array("low", "high"))
    steps = found.withColumn("_at", F.explode(corners))
    return IsotonicRegression(featuresCol="_at", labelCol="mean", weightCol="weight", **columns).fit(steps)
