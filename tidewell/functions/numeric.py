"""Scalar and small-matrix numerics used inside tasks."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

# Published response surface for the Dickey-Fuller statistic with a constant (MacKinnon 1994).
ADF_STAR, ADF_MIN, ADF_MAX = -1.61, -18.83, 2.74
ADF_SMALL_P = (2.1659, 1.4412, 0.038269)
ADF_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def adf_p_value(statistic: float) -> float:
    if statistic > ADF_MAX:
        return 1.0
    if statistic < ADF_MIN:
        return 0.0
    coefficients = ADF_SMALL_P if statistic <= ADF_STAR else ADF_LARGE_P
    return normal_cdf(sum(c * statistic**i for i, c in enumerate(coefficients)))


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction (modified Lentz)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - incomplete_beta(b, a, 1.0 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    value, c, d = 1.0, 1.0, 0.0
    for step in range(400):
        m = step // 2
        if step == 0:
            term = 1.0
        elif step % 2 == 0:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 + term * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + term / c
        c = c if abs(c) > tiny else tiny
        value *= c * d
        if step and abs(1.0 - c * d) < 1e-15:
            break
    return front * (value - 1.0)


def f_tail(statistic: float, df1: float, df2: float) -> float:
    """P(F > statistic)."""
    if not math.isfinite(statistic) or statistic < 0:
        return float("nan")
    return incomplete_beta(df2 / 2.0, df1 / 2.0, df2 / (df2 + df1 * statistic))


def least_squares(gram: np.ndarray, cross: np.ndarray) -> tuple[np.ndarray, bool]:
    """Coefficients from the normal equations, and whether they were ill-conditioned.

    The system is scaled to a unit diagonal first; a singular one gets its minimum-norm solution.
    """
    size = np.sqrt(np.clip(np.diag(gram), 1e-300, None))
    scaled = gram / np.outer(size, size)
    right = cross / (size[:, None] if cross.ndim == 2 else size)
    ill = bool(np.linalg.cond(scaled) > 1e12)
    solution = np.linalg.lstsq(scaled, right, rcond=1e-12)[0] if ill else np.linalg.solve(scaled, right)
    return solution / (size[:, None] if cross.ndim == 2 else size), ill


def triangle(parts: Sequence[np.ndarray]) -> np.ndarray:
    """The square triangular factor of stacked rows: the same products of columns, without forming them."""
    stacked = np.vstack(parts)
    n = stacked.shape[1]
    factor = np.linalg.qr(stacked, mode="r") if len(stacked) else stacked
    return np.vstack([factor, np.zeros((n - len(factor), n))]) if len(factor) < n else factor


@dataclass
class Solution:
    """Coefficients (terms, targets), what is left of the targets (its products are those of the residuals), for each term the square
    root of its place in the inverse of the products, and whether the terms are nearly dependent."""

    beta: np.ndarray
    residual: np.ndarray
    spread: np.ndarray
    ill: bool


def solve_factor(factor: np.ndarray, m: int) -> Solution:
    """Least squares of the last columns on the first ``m``, from the triangular factor of all; dependent terms get the least norm."""
    inner, cross = factor[:m, :m], factor[:m, m:]
    size = np.linalg.norm(inner, axis=0)
    scaled = inner / np.where(size > 0, size, 1.0)
    left, values, right = np.linalg.svd(scaled)
    ill = bool(values[-1] <= 1e-13 * values[0])
    kept = values > 1e-13 * values[0]
    inverse = (right.T[:, kept] / values[kept]) @ left.T[kept] / np.where(size > 0, size, 1.0)[:, None]
    beta = inverse @ cross
    return Solution(beta, np.vstack([cross - inner @ beta, factor[m:, m:]]) if ill else factor[m:, m:], np.linalg.norm(inverse, axis=1), ill)
