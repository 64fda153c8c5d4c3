"""A logistic curve over one number a row, fitted from a histogram."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 400


def _newton(x: np.ndarray, y1: np.ndarray, y0: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of P(1 | x) from counts at each x: Newton steps, halved until they help.

    A weak ridge on standardised x keeps the slope finite where the labels can be told apart.
    """
    n = y1 + y0
    centre = (n @ x) / n.sum()
    scale = max(float(np.sqrt(n @ (x - centre) ** 2 / n.sum())), 1e-9)
    design = np.column_stack([np.ones_like(x), (x - centre) / scale])
    ridge = np.array([1e-6, 0.05])

    def loss(beta: np.ndarray) -> float:
        z = design @ beta
        return float(n @ np.logaddexp(0, z) - y1 @ z + 0.5 * ridge @ beta**2)

    beta = np.zeros(2)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -500, 500)))
        gradient = design.T @ (n * p - y1) + ridge * beta
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        size, before = 1.0, loss(beta)
        while size > 1e-8 and loss(beta - size * step) > before:
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(beta[0] - beta[1] * centre / scale), float(beta[1] / scale)


def fit_logistic(rows: DataFrame, x: str, label: str, width: float = 0.1) -> tuple[float, float] | None:
    """From all rows, in at most ``BINS`` bins of ``x`` with their mean; None without both labels."""
    edge = F.greatest(F.least(F.floor(F.col(x) / width), F.lit(BINS // 2)), F.lit(-BINS // 2))
    bins = rows.groupBy(edge.alias("bin")).agg(
        F.sum(label).alias("y1"), F.count("*").alias("n"), F.avg(x).alias("x")
    )
    found = bins.collect()  # one row a bin
    at, y1, n = (np.array([float(r[k]) for r in found]) for k in ("x", "y1", "n"))
    if not y1.sum() or y1.sum() == n.sum():
        return None
    return _newton(at, y1, n - y1)


def logistic(curve: tuple[float, float], x: str) -> Column:
    return 1 / (1 + F.exp(-(F.lit(curve[0]) + F.lit(curve[1]) * F.col(x))))
