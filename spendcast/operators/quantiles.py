"""Exact quantiles from mergeable sketches: no value is sorted that no quantile is near to.

One aggregate gives a KLL sketch of every column. It brackets each quantile between two values, with
a margin well over the sketch's error. A second pass counts what lies below each bracket and orders
the values inside, counted first, so that a value owned by a third of the rows is one of them. The
counts prove whether the wanted ranks lie inside; a bracket that missed is opened on that side. A
bracket that would still hold many values is sketched again first, so the ordered part stays small
whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Size of the sketches, and the margin in rank on either side of a quantile (their error is 0.0014).
SKETCH, MARGIN = 2000, 0.005
#: Rows that a bracket may be expected to hold when its values are ordered.
ORDERED = 100_000


@dataclass(frozen=True)
class Target:
    """A quantile of a column, the ranks it lies between, and a bracket (``None`` is no limit).

    ``outer`` is the last bracket known to hold the ranks; ``below`` and ``inside`` are its counts.
    """

    column: str
    prob: float
    first: int = 0
    second: int = 0
    part: float = 0.0
    low: float | None = None
    high: float | None = None
    outer: tuple[float | None, float | None] = (None, None)
    below: int = 0
    inside: int = 0
    settled: bool = False  # a further sketch would not narrow the bracket: few values own it

    def under(self) -> Column:
        return F.lit(False) if self.low is None else F.col(self.column) < self.low

    def within(self) -> Column:
        held = F.col(self.column).isNotNull()
        if self.low is not None:
            held = held & (F.col(self.column) >= self.low)
        return held if self.high is None else held & (F.col(self.column) <= self.high)

    def narrowed(self, quantiles: Sequence[float]) -> "Target":
        """The bracket between two quantiles of what is inside the present one."""
        start, end = self.shares()
        low = quantiles[0] if start > 0 else self.low
        high = quantiles[1] if end < 1 else self.high
        same = (low, high) == (self.low, self.high) or low is not None and low == high
        return replace(self, low=low, high=high, outer=(self.low, self.high), settled=same)

    def shares(self) -> tuple[float, float]:
        """Where the bracket should begin and end, as shares of the rows inside."""
        size = max(self.inside, 1)
        return max((self.first - self.below) / size - MARGIN, 0.0), min((self.second - self.below + 1) / size + MARGIN, 1.0)

    def expected(self) -> float:
        start, end = self.shares()
        return (end - start) * self.inside


def _survey(doubles: DataFrame, targets: Sequence[Target]) -> list[Target]:
    """Count below and inside every bracket, then narrow it by a sketch of what is inside; one aggregate."""
    kinds = list(dict.fromkeys((t.column, t.low, t.high) for t in targets))
    place = [kinds.index((t.column, t.low, t.high)) for t in targets]
    measures = []
    for i in range(len(kinds)):
        t = targets[place.index(i)]
        inside = F.when(t.within(), F.col(t.column))
        measures += [F.count_if(t.under()).alias(f"b{i}"), F.count(inside).alias(f"n{i}"), F.kll_sketch_agg_double(inside, F.lit(SKETCH)).alias(f"s{i}")]
    row = doubles.agg(*measures).first()  # a count and a sketch of bounded size per bracket
    known = [_checked(t, row[f"b{i}"], row[f"n{i}"]) for t, i in zip(targets, place)]
    full = [(k, t, i) for k, (t, i) in enumerate(zip(known, place)) if t.inside]
    if not full:
        return known
    sketches = doubles.sparkSession.createDataFrame([tuple(row[f"s{i}"] for _, _, i in full)], ", ".join(f"s{k} binary" for k, _, _ in full))
    asked = [F.kll_sketch_get_quantile_double(f"s{k}", F.array(*map(F.lit, t.shares()))).alias(f"q{k}") for k, t, _ in full]
    found = sketches.select(*asked).first()
    return [t.narrowed(found[f"q{k}"]) if t.inside else t for k, t in enumerate(known)]


def _checked(target: Target, below: int, inside: int) -> Target:
    """Take over the counts of a bracket; one that missed its ranks is opened on that side."""
    if target.inside == 0:  # the first survey: ranks follow from the number of values
        h = target.prob * (inside - 1)
        return replace(target, first=max(math.floor(h), 0), second=max(math.ceil(h), 0), part=h - math.floor(h), inside=inside)
    if target.first < below or target.second >= below + inside:
        return _opened(target, below, inside)
    return replace(target, below=below, inside=inside)


def _opened(target: Target, below: int, inside: int) -> Target:
    low = target.outer[0] if target.first < below else target.low
    high = target.outer[1] if target.second >= below + inside else target.high
    return replace(target, low=low, high=high)


def _ordered(doubles: DataFrame, targets: Sequence[Target]) -> list[tuple]:
    """For each bracket: (rows below, rows up to its end, value at the first rank, value at the second)."""
    counted = doubles.agg(*[F.count_if(t.under()).alias(str(i)) for i, t in enumerate(targets)])
    below = counted.select(
        F.explode(F.array(*[F.struct(F.lit(i).alias("id"), F.lit(None).cast("double").alias("value"), F.col(str(i)).alias("n")) for i in range(len(targets))])).alias("r")
    ).select("r.*")
    marked = F.array(*[F.when(t.within(), F.struct(F.lit(i).alias("id"), F.col(t.column).alias("value"))) for i, t in enumerate(targets)])
    inside = (
        doubles.select(F.explode(F.array_compact(marked)).alias("r"))
        .groupBy("r.id", "r.value")
        .agg(F.count("*").alias("n"))
    )
    # The count below comes first, as a null value; at most ORDERED or so rows follow it per bracket.
    upto = Window.partitionBy("id").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = doubles.sparkSession.createDataFrame([(i, t.first, t.second) for i, t in enumerate(targets)], "id int, first long, second long")
    at = lambda rank: F.min(F.when(F.col("value").isNotNull() & (F.col("upto") > F.col(rank)), F.col("value")))
    picked = (
        below.unionByName(inside)
        .withColumn("upto", F.sum("n").over(upto))
        .join(F.broadcast(ranks), "id")
        .groupBy("id")
        .agg(F.min("upto").alias("below"), F.max("upto").alias("end"), at("first").alias("first"), at("second").alias("second"))
    )
    rows = {r["id"]: tuple(r)[1:] for r in picked.collect()}  # one row per quantile
    return [rows[i] for i in range(len(targets))]


def quantile_values(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], ordered: int = ORDERED
) -> dict[str, list[float]]:
    """Exact quantiles with linear interpolation: for each column that has values a list as long as ``probs``.

    Nulls do not count. ``df`` is read twice, and once more for every hundredfold of ``ordered`` rows.
    """
    columns = list(dict.fromkeys(columns))
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    # The first survey is the same for all quantiles of a column but for the ranks it asks for.
    first = [Target(c, float(p)) for c in columns for p in probs]
    targets = [t for t in _survey(doubles, first) if t.inside]
    done: dict[tuple[str, float], float] = {}
    while targets:
        wide = [t for t in targets if t.expected() > ordered and not t.settled]
        if wide:
            others = [t for t in targets if t not in wide]
            targets = others + _survey(doubles, wide)
            continue
        missed = []
        for t, (below, end, first, second) in zip(targets, _ordered(doubles, targets)):
            if t.first < below or t.second >= end:
                missed.append(_opened(t, below, end - below))
            else:
                done[t.column, t.prob] = first + (second - first) * t.part
        targets = missed
    return {c: [done[c, float(p)] for p in probs] for c in columns if (c, float(probs[0])) in done}


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``quantile_values`` as a table: one row per column, ``q`` in the order of ``probs``."""
    rows = list(quantile_values(df, columns, probs).items())
    return df.sparkSession.createDataFrame(rows, "feature string, q array<double>")
