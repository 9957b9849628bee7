"""Buy-till-you-die estimates: BG/NBD for purchases and Gamma-Gamma for order value.

The fits work on a table of distinct inputs with their counts. One Spark aggregate gives the
likelihood, its gradient and its second derivatives at a few parameter points, one row per point,
which is all that the driver sees of the customers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from spendcast.config import SETTINGS
from spendcast.functions.special import digamma, hyp2f1_column, lgamma, trigamma
from spendcast.session import materialize

# First penalty and the ones tried after it.
PENALTY = 0.01
FURTHER_PENALTIES = [0.05, 0.1, 0.5, 1.0, 5.0]


class FitError(RuntimeError):
    """No penalty led to a converged fit."""


@dataclass(frozen=True)
class PurchaseParams:
    r: float
    alpha: float
    a: float
    b: float
    penalty: float = PENALTY
    objective: float | None = None


@dataclass(frozen=True)
class ValueParams:
    p: float
    q: float
    v: float
    global_mean: float
    penalty: float = PENALTY
    objective: float | None = None


def _positive(x: Column) -> Column:
    return F.greatest(x, F.lit(1.0))


def purchase_loglik(x: Column, tx: Column, age: Column, r: Column, alpha: Column, a: Column, b: Column) -> Column:
    """BG/NBD log-likelihood of one customer."""
    alive = -(r + x) * F.ln(alpha + age)
    gone = F.ln(a) - F.ln(b + _positive(x) - 1) - (r + x) * F.ln(alpha + tx)
    top = F.greatest(alive, gone)
    both = top + F.ln(F.exp(alive - top) + F.exp(gone - top))
    return (
        lgamma(r + x)
        - lgamma(r)
        + r * F.ln(alpha)
        + lgamma(a + b)
        + lgamma(b + x)
        - lgamma(b)
        - lgamma(a + b + x)
        + F.when(x > 0, both).otherwise(alive)
    )


def value_loglik(x: Column, mean: Column, p: Column, q: Column, v: Column) -> Column:
    """Gamma-Gamma log-likelihood of one repeat buyer."""
    px = p * x
    return (
        lgamma(px + q)
        - lgamma(px)
        - lgamma(q)
        + q * F.ln(v)
        + (px - 1) * F.ln(mean)
        + px * F.ln(x)
        - (px + q) * F.ln(v + mean * x)
    )


def repeat_buyers(base: DataFrame) -> DataFrame:
    return base.filter((F.col("Frequency") > 0) & (F.col("Monetary") > 0))


@dataclass(frozen=True)
class Terms:
    """A part of the log-likelihood of one customer and its derivatives by the parameters, as columns.

    ``rows`` gives the table that it is summed over, with weights ``n``, from the distinct inputs: some
    parts depend on the number of purchases alone. ``helpers`` are columns that the terms share, added
    in steps. What is not named is zero.
    """

    rows: Callable[[DataFrame], DataFrame]
    helpers: list[dict[str, Column]]
    value: Column
    first: dict[str, Column]
    second: dict[tuple[str, str], Column]


def _steps(x: str) -> Callable[[DataFrame], DataFrame]:
    """How many customers have more than ``k`` purchases, for each ``k`` that some have."""

    def rows(data: DataFrame) -> DataFrame:
        counts = data.groupBy(x).agg(F.sum("n").alias("n")).filter(F.col(x) > 0)
        each = counts.select(F.explode(F.sequence(F.lit(0), F.col(x).cast("int") - 1)).alias("k"), "n")
        return each.groupBy("k").agg(F.sum("n").alias("n")).coalesce(1)

    return rows


def purchase_terms(x: str, tx: Column, age: Column) -> tuple[tuple[str, ...], list[Terms]]:
    """BG/NBD with parameters in the columns r, alpha, a, b; ``x`` holds whole numbers.

    A repeat buyer is still alive, or gone after the last purchase; ``gone`` is the share of the
    second in the likelihood, zero without a repeat. Quotients of gamma functions at a distance of
    ``x`` are products of ``x`` steps, so all customers together need one step per number.
    """
    names, count = ("r", "alpha", "a", "b"), F.col(x)
    r, alpha, a, b = (F.col(n) for n in names)
    repeats, power = _positive(count) - 1, r + count
    odds = F.ln(a) - F.ln(b + repeats) - power * (F.col("_gone_log") - F.col("_alive_log"))  # log of gone over alive
    helpers = {
        "_alive_log": F.ln(alpha + age),
        "_gone_log": F.ln(alpha + tx),
        "_alive_rate": 1 / (alpha + age),
        "_gone_rate": 1 / (alpha + tx),
        "_b_rate": 1 / (b + repeats),
    }
    al, gl, ar, gr, br = map(F.col, helpers)
    gone = F.col("_gone")
    alive = 1 - gone
    # The differences between the two branches give the curvature of their mixture.
    apart = {"r": al - gl, "alpha": power * (ar - gr), "a": 1 / a, "b": -br}
    own = {
        ("r", "r"): F.lit(0.0),
        ("r", "alpha"): 1 / alpha - alive * ar - gone * gr,
        ("alpha", "alpha"): power * (alive * ar * ar + gone * gr * gr) - r / (alpha * alpha),
        ("a", "a"): -gone / (a * a),
        ("b", "b"): gone * br * br,
    }
    pairs = [(p, q) for i, p in enumerate(names) for q in names[i:]]
    branches = Terms(
        lambda data: data,
        [helpers, {"_gone": F.when(count > 0, 1 / (1 + F.exp(-odds))).otherwise(0.0)}],
        # The log of the sum is that of the larger branch plus what the other adds to it.
        r * F.ln(alpha) - power * al + F.when(count > 0, F.greatest(odds, F.lit(0.0)) + F.log1p(F.exp(-F.abs(odds)))).otherwise(0.0),
        {"r": F.ln(alpha) - alive * al - gone * gl, "alpha": r / alpha - power * (alive * ar + gone * gr), "a": gone / a, "b": -gone * br},
        {k: own.get(k, F.lit(0.0)) + gone * alive * apart[k[0]] * apart[k[1]] for k in pairs},
    )
    kr, kb, kab = F.col("_r"), F.col("_b"), F.col("_ab")
    gammas = Terms(
        _steps(x),
        [{"_r": r + F.col("k"), "_b": b + F.col("k"), "_ab": a + b + F.col("k")}],
        F.ln(kr) + F.ln(kb) - F.ln(kab),
        {"r": 1 / kr, "a": -1 / kab, "b": 1 / kb - 1 / kab},
        {("r", "r"): -1 / (kr * kr), ("a", "a"): 1 / (kab * kab), ("a", "b"): 1 / (kab * kab), ("b", "b"): 1 / (kab * kab) - 1 / (kb * kb)},
    )
    return names, [branches, gammas]


def value_terms(x: str, mean: Column) -> tuple[tuple[str, ...], list[Terms]]:
    """Gamma-Gamma with parameters in the columns p, q, v."""
    names, count = ("p", "q", "v"), F.col(x)
    p, q, v = (F.col(n) for n in names)
    px = p * count
    log, rate = F.col("_log"), F.col("_rate")
    amounts = Terms(
        lambda data: data,
        [{"_log": F.ln(v + mean * count), "_rate": 1 / (v + mean * count)}],
        (px - 1) * F.ln(mean) - (px + q) * log,
        {"p": count * (F.ln(mean) - log), "q": -log, "v": -(px + q) * rate},
        {("p", "v"): -count * rate, ("q", "v"): -rate, ("v", "v"): (px + q) * rate * rate},
    )
    at, sum_at = F.col("_at"), F.col("_sum_at")
    gammas = Terms(
        lambda data: data.groupBy(x).agg(F.sum("n").alias("n")).coalesce(1),
        [{"_at": px, "_sum_at": px + q}, {"_psi": digamma(sum_at), "_tri": trigamma(sum_at)}],
        lgamma(sum_at) - lgamma(at) - lgamma(q) + q * F.ln(v) + px * F.ln(count),
        {"p": count * (F.col("_psi") - digamma(at) + F.ln(count)), "q": F.col("_psi") - digamma(q) + F.ln(v), "v": q / v},
        {
            ("p", "p"): count * count * (F.col("_tri") - trigamma(at)),
            ("p", "q"): count * F.col("_tri"),
            ("q", "q"): F.col("_tri") - trigamma(q),
            ("q", "v"): 1 / v,
            ("v", "v"): -q / (v * v),
        },
    )
    return names, [amounts, gammas]


Point = tuple[float, np.ndarray, np.ndarray]


def derivatives(data: DataFrame, names: Sequence[str], parts: Sequence[Terms]) -> Callable[[np.ndarray], DataFrame]:
    """Mean log-likelihood and derivatives over ``n`` copies of each row: one row (id, value, ...) per point.

    The points are one folded array literal, so each pass reuses the same compiled stages.
    """
    pairs = [(p, q) for i, p in enumerate(names) for q in names[i:]]
    weight = F.lit(float(data.agg(F.sum("n")).first()[0] or 1))
    prepared = []
    for terms in parts:
        rows = terms.rows(data)
        rows = rows if rows is data else rows.cache()
        named = {"value": terms.value, **{f"d_{k}": c for k, c in terms.first.items()}, **{f"d_{j}_{k}": c for (j, k), c in terms.second.items()}}
        every = ["value", *[f"d_{k}" for k in names], *[f"d_{j}_{k}" for j, k in pairs]]
        means = [((F.sum(named[k] * F.col("n")) / weight) if k in named else F.lit(0.0)).alias(k) for k in every]
        prepared.append((rows, terms.helpers, means))

    def at(points: np.ndarray) -> DataFrame:
        entries = [
            f"named_struct('id', {i}, " + ", ".join(f"'{n}', {float(v)!r}D" for n, v in zip(names, row)) + ")"
            for i, row in enumerate(points)
        ]
        given = F.expr(f"explode(array({', '.join(entries)}))")
        summed = []
        for rows, helpers, means in prepared:
            placed = rows.withColumn("_p", given).select("*", "_p.*")
            for step in helpers:
                placed = placed.withColumns(step)
            summed.append(placed.groupBy("id").agg(*means))
        both = summed[0]
        for other in summed[1:]:
            both = both.unionByName(other)
        return both.groupBy("id").agg(*[F.sum(c).alias(c) for c in both.columns if c != "id"])

    return at


def _objective(
    data: DataFrame, model: tuple[Sequence[str], Sequence[Terms]], penalty: float
) -> Callable[[np.ndarray], list[Point | None]]:
    """Penalised mean negative log-likelihood with gradient and curvature at log-parameter points.

    ``None`` stands for a point where any of it is not finite.
    """
    names, parts = model
    rows_at = derivatives(data, names, parts)

    def evaluate(points: np.ndarray) -> list[Point | None]:
        values = np.exp(points)
        out: list[Point | None] = [None] * len(points)
        for row in rows_at(values).collect():
            at = values[row["id"]]
            gradient = np.array([row[f"d_{k}"] for k in names], float)
            curvature = np.array([[row[f"d_{names[min(i, j)]}_{names[max(i, j)]}"] for j in range(len(names))] for i in range(len(names))], float)
            # From parameters to their logarithms.
            slope = -at * gradient + 2 * penalty * at**2
            bend = -np.outer(at, at) * curvature + np.diag(-at * gradient + 4 * penalty * at**2)
            value = np.nan if row["value"] is None else -row["value"] + penalty * float(np.sum(at**2))
            if np.isfinite(value) and np.all(np.isfinite(slope)) and np.all(np.isfinite(bend)):
                out[row["id"]] = (value, slope, bend)
        return out

    return evaluate


def _minimise(
    evaluate: Callable[[np.ndarray], list[Point | None]], start: np.ndarray, tol: float, max_rounds: int = 60
) -> tuple[np.ndarray, float] | None:
    """Damped Newton steps. Each round tries a few (plain, stretched, damped) in a single aggregate."""
    x, here = start, evaluate(start[None, :])[0]
    shrink = 1.0
    for _ in range(max_rounds):
        if here is None:
            return None
        value, gradient, hessian = here
        if np.max(np.abs(gradient)) < tol:
            return x, float(value)
        roots, basis = np.linalg.eigh(hessian)
        projected = basis.T @ gradient
        tried = []
        for damping, stretch in ((0.0, 1.0), (0.0, 2.0), (0.0, 4.0), (0.1, 1.0), (10.0, 1.0)):
            step = -basis @ (projected / np.maximum(np.abs(roots) + damping, 1e-10))
            step = step * min(1.0, 2.0 / max(np.max(np.abs(step)), 1e-12))
            tried.append(x + shrink * stretch * step)
        found = evaluate(np.vstack(tried))
        usable = [np.inf if f is None else f[0] for f in found]
        best = int(np.argmin(usable))
        if usable[best] < value:
            x, here, shrink = tried[best], found[best], 1.0
        elif np.max(np.abs(gradient)) < 100 * tol:
            return x, float(value)  # steps no longer show in the value
        elif shrink < 1e-3:
            return None
        else:
            shrink *= 0.2
    return None


def counted_inputs(rows: DataFrame, *keys: Column | str) -> DataFrame:
    """Distinct inputs and their number ``n``, written and cached for the passes of a fit.

    Cached by itself the aggregate would keep all partitions of its shuffle, and every pass a task for each.
    """
    return materialize(rows.groupBy(*keys).agg(F.count("*").alias("n"))).cache()


def fit_purchases(
    train: DataFrame,
    penalty: float = PENALTY,
    further: Sequence[float] = tuple(FURTHER_PENALTIES),
    tol: float = 1e-7,
) -> PurchaseParams:
    """Fit BG/NBD; on failure try larger penalties, and raise when none converges.

    Times are divided by the largest T first and alpha is scaled back afterwards, so the ridge
    penalty sees alpha on the unit scale.
    """
    counted = counted_inputs(train, "Frequency", "Recency", "T")
    try:
        longest = counted.agg(F.max("T")).first()[0] or 1.0
        scale = F.lit(1.0 / max(float(longest), 1.0))
        model = purchase_terms("Frequency", F.col("Recency") * scale, F.col("T") * scale)
        for coefficient in [penalty, *further]:
            found = _minimise(_objective(counted, model, coefficient), np.full(4, 0.1), tol)
            if found is not None:
                r, alpha, a, b = np.exp(found[0])
                return PurchaseParams(
                    float(r), float(alpha) * max(float(longest), 1.0), float(a), float(b), coefficient, found[1]
                )
    finally:
        counted.unpersist()
    raise FitError("BG/NBD did not converge at any penalty")


def fit_values(train: DataFrame, penalty: float = PENALTY, tol: float = 1e-7) -> ValueParams:
    """Fit Gamma-Gamma on repeat buyers. Money is not rescaled, so the penalty sees dollars."""
    repeat = repeat_buyers(train)
    counted = counted_inputs(repeat, F.bround("Frequency", 0).alias("x"), "Monetary")
    try:
        mean = counted.agg((F.sum(F.col("Monetary") * F.col("n")) / F.sum("n")).alias("m")).first()["m"]
        if mean is None:
            raise FitError("no repeat buyer with positive spend")
        found = _minimise(_objective(counted, value_terms("x", F.col("Monetary")), penalty), np.full(3, 0.1), tol)
    finally:
        counted.unpersist()
    if found is None:
        raise FitError("Gamma-Gamma did not converge")
    p, q, v = np.exp(found[0])
    return ValueParams(float(p), float(q), float(v), float(mean), penalty, found[1])


def prob_alive(x: Column, tx: Column, age: Column, k: PurchaseParams) -> Column:
    ratio = (F.lit(k.alpha) + age) / (F.lit(k.alpha) + tx)
    gone = F.lit(k.a) / (k.b + _positive(x) - 1) * F.pow(ratio, k.r + x)
    return F.when(x > 0, 1 / (1 + gone)).otherwise(1.0)


def expected_purchases(x: Column, tx: Column, age: Column, k: PurchaseParams, horizon: float) -> Column:
    """Expected purchases in the next ``horizon`` days."""
    a = k.a if abs(k.a - 1) > 1e-9 else 1 + 1e-9
    # A customer without repeats has no value at a + b = 1, only a limit; a step aside is near it.
    b = k.b if abs(a + k.b - 1) > 1e-7 else 1 - a + 1e-7
    c = x + (a + b - 1)
    end = age + (k.alpha + horizon)
    series = hyp2f1_column(x + k.r, x + b, c, F.lit(float(horizon)) / end)
    growth = 1 - series * F.pow((age + k.alpha) / end, x + k.r)
    return c / (a - 1) * growth * prob_alive(x, tx, age, k)


def expected_value(x: Column, mean: Column, k: ValueParams) -> Column:
    """Expected order value; customers without a repeat day get the train mean."""
    count = F.bround(x, 0)
    posterior = F.lit(k.p) * (k.v + mean * count) / (k.p * count + k.q - 1)
    return F.when(x > 0, posterior).otherwise(F.lit(k.global_mean))


def add_estimates(
    base: DataFrame, purchases: PurchaseParams, values: ValueParams, horizon: float = SETTINGS.horizon_days
) -> DataFrame:
    """Probabilistic features from fitted parameters: a narrow projection."""
    x, tx, age = F.col("Frequency"), F.col("Recency"), F.col("T")
    return base.withColumns(
        {
            "Prob_Pred_Txn": expected_purchases(x, tx, age, purchases, horizon),
            "Prob_Alive": prob_alive(x, tx, age, purchases),
            "Prob_Pred_Val": expected_value(x, F.col("Monetary"), values),
        }
    )


def baseline_log_prediction() -> Column:
    return F.log1p(F.greatest(F.col("Prob_Pred_Txn") * F.col("Prob_Pred_Val"), F.lit(0.0)))
