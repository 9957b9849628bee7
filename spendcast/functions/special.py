"""Special functions: log-gamma and its derivatives as column expressions and 2F1 as an Arrow function."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType

_SHIFT = 8
_MAX_TERMS = 20000


def lgamma(x: Column) -> Column:
    """log-gamma for x > 0: Stirling's series after shifting the argument up by eight."""
    z = x + _SHIFT
    product = x
    for k in range(1, _SHIFT):
        product = product * (x + k)
    inverse = F.lit(1.0) / z
    square = inverse * inverse
    tail = inverse * (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square * (1 / 1680))))
    return (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + tail - F.ln(product)


def _shifted(term: Callable[[Column], Column]) -> Column:
    """Sum over the steps of the shift, as a loop: written out, the plan would be large for a few rows."""
    return F.aggregate(F.sequence(F.lit(0), F.lit(_SHIFT - 1)), F.lit(0.0), lambda total, k: total + term(k))


def digamma(x: Column) -> Column:
    """First derivative of log-gamma for x > 0, by the same shift and series."""
    z = x + _SHIFT
    inverse = F.lit(1.0) / z
    square = inverse * inverse
    tail = square * (1 / 12 - square * (1 / 120 - square * (1 / 252 - square * (1 / 240 - square * (1 / 132)))))
    return F.ln(z) - inverse / 2 - tail - _shifted(lambda k: 1 / (x + k))


def trigamma(x: Column) -> Column:
    """Second derivative of log-gamma for x > 0."""
    z = x + _SHIFT
    inverse = F.lit(1.0) / z
    square = inverse * inverse
    tail = 1 / 6 - square * (1 / 30 - square * (1 / 42 - square * (1 / 30 - square * (5 / 66))))
    return inverse + square / 2 + inverse * square * tail + _shifted(lambda k: 1 / ((x + k) * (x + k)))


def hyp2f1(a: np.ndarray, b: np.ndarray, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Gauss 2F1 for 0 <= z < 1: power series after Euler's transformation; NaN if it does not settle.

    Where the transformed terms would change sign and cancel, the series is summed as it is.
    """
    a, b, c, z = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, b, c, z))
    turned = (c - a > -1) & (c - b > -1)
    p, q = np.where(turned, c - a, a), np.where(turned, c - b, b)
    with np.errstate(all="ignore"):
        total, term = np.ones_like(z), np.ones_like(z)
        settled = False
        for n in range(_MAX_TERMS):
            term = term * ((p + n) * (q + n) / ((c + n) * (n + 1))) * z
            total = total + term
            if n % 8 == 7:
                small = np.abs(term) <= 1e-15 * np.abs(total)
                if np.all(small | ~np.isfinite(term)):
                    settled = True
                    break
        if not settled:
            total = np.where(np.abs(term) <= 1e-12 * np.abs(total), total, np.nan)
        return np.where(turned, (1 - z) ** (c - a - b), 1.0) * total


@F.pandas_udf(DoubleType())
def hyp2f1_column(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b, c, z in parts:
        yield pd.Series(hyp2f1(a.to_numpy(), b.to_numpy(), c.to_numpy(), z.to_numpy()))
