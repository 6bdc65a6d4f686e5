"""Logistic regression by Newton's method on aggregated Gram matrices.

Each step is one pass over all rows: every task adds up the loss, the gradient
and the upper triangle of the weighted Gram matrix (a fixed number of sums) in
Arrow batches, and one aggregate adds up the tasks. The driver solves a system
of one unknown per feature and the intercept.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def margin_of(columns: Sequence[Column], weights: Sequence[float], intercept: float) -> Column:
    """``intercept + sum(weight * column)``."""
    margin = F.lit(float(intercept))
    for w, c in zip(weights, columns, strict=True):
        margin = margin + F.lit(float(w)) * c
    return margin


def newton_logit(rows: DataFrame, columns: Sequence[str], label: str, penalty: float = 1.0, tol: float = 1e-11,
                 max_iter: int = 50) -> tuple[list[float], float]:
    """(weights, intercept) that minimise ``penalty * (|w|^2 + b^2) / 2 + sum of log-losses`` over all rows.

    The intercept is penalised like a weight. Steps end when the largest
    change is below ``tol``; a step that does not lower the objective is
    halved. The result depends on the rows and not on their layout, but for
    the last bits of the sums. Without rows all parameters are 0. Eager: about
    ten aggregates over ``rows``, which should be a table.
    """
    size, names = len(columns) + 1, list(columns)
    upper = [(i, j) for i in range(size) for j in range(i, size)]
    sums = [f"s{i}" for i in range(1 + size + len(upper))]
    # the parameters travel with the function, so every step runs the same compiled aggregate
    given = rows.select(*[F.col(c).cast("double").alias(c) for c in names], F.col(label).cast("double").alias("_y"))

    def at(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(sums))
            for b in batches:
                x = np.column_stack([*[b.column(c).to_numpy(zero_copy_only=False) for c in names], np.ones(b.num_rows)])
                y, m = b.column("_y").to_numpy(zero_copy_only=False), x @ beta
                small = np.exp(-np.abs(m))  # no overflow on either side
                p = np.where(m >= 0, 1 / (1 + small), small / (1 + small))
                gram = x.T @ (x * (p * (1 - p))[:, None])
                total += np.r_[(np.log1p(small) + np.maximum(m, 0) - y * m).sum(), x.T @ (p - y), [gram[i, j] for i, j in upper]]
            yield pa.RecordBatch.from_arrays([pa.array([t]) for t in total], names=sums)

        parts = given.mapInArrow(run, ", ".join(f"{s} double" for s in sums))
        found = [float(s or 0.0) for s in parts.agg(*[F.sum(s) for s in sums]).first()]
        gram = np.zeros((size, size))
        for (i, j), s in zip(upper, found[1 + size:]):
            gram[i, j] = gram[j, i] = s
        return (found[0] + penalty * float(beta @ beta) / 2, np.array(found[1:1 + size]) + penalty * beta,
                gram + penalty * np.eye(size))

    beta = np.zeros(size)
    value, slope, curve = at(beta)
    for _ in range(max_iter):
        step = np.linalg.solve(curve, slope)
        part = 1.0
        while True:
            after = at(beta - part * step)
            if after[0] <= value * (1 + 1e-12) or part < 1e-6:
                break
            part /= 2
        beta = beta - part * step
        value, slope, curve = after
        if np.abs(part * step).max() < tol:
            break
    return [float(w) for w in beta[:-1]], float(beta[-1])
