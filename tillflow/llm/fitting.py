"""What the trained classifiers share: bounded training samples and a minimiser."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A quarter of the documents is never learnt from.
FOLDS, HELD_OUT = 4, 2


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    """crc32 of the id as text, modulo the number of folds; null for a null id."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % folds


def held_out(doc_id: Column, folds: int = FOLDS, number: int = HELD_OUT) -> Column:
    return F.coalesce(fold(doc_id, folds) == number, F.lit(False))


def sample(ratings: DataFrame, classes: int, per_class: int) -> tuple[DataFrame | None, list[int]]:
    """At most `per_class` rated documents of each class outside the held-out fold.

    ratings: doc_id and a whole-number `grade` from 0. A document rated more than once has the
    highest of its grades. Which ones are taken depends on a hash of their ids alone. Also gives the
    number of documents there are of each class, or None and zeros if nothing is rated.
    """
    usable = (
        ratings.where(F.col("doc_id").isNotNull() & F.col("grade").between(0, classes - 1))
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("grade").cast("int").alias("grade"))
    )
    sizes = [0] * classes
    for grade, count in usable.groupBy("grade").count().collect():
        sizes[grade] = count
    taken = None
    for grade in range(classes):
        if sizes[grade]:
            part = (
                usable.where(F.col("grade") == grade)
                .orderBy(F.xxhash64("doc_id"), "doc_id")
                .limit(per_class)
            )
            taken = part if taken is None else taken.union(part)
    return taken, sizes


def class_weights(grades: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Per sampled row, a weight that restores the shares of the classes."""
    seen = np.bincount(grades, minlength=len(sizes))
    shares = np.array(sizes) / max(1, sum(sizes))
    per_class = np.divide(shares, seen, out=np.zeros(len(sizes)), where=seen > 0)
    return per_class[grades]


def minimise(
    loss: Callable[[np.ndarray], tuple[float, np.ndarray]],
    start: np.ndarray,
    rounds: int = 120,
    memory: int = 10,
    tolerance: float = 1e-6,
) -> np.ndarray:
    """Limited-memory quasi-Newton descent with backtracking; loss gives value and gradient."""
    x = start.copy()
    value, slope = loss(x)
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        if np.abs(slope).max(initial=0.0) < tolerance:
            break
        direction, kept = slope.copy(), []
        for s, y, rho in reversed(steps):
            a = rho * (s @ direction)
            direction -= a * y
            kept.append(a)
        if steps:
            s, y, _ = steps[-1]
            direction *= (s @ y) / (y @ y)
        for (s, y, rho), a in zip(steps, reversed(kept), strict=True):
            direction += (a - rho * (y @ direction)) * s
        down = slope @ direction
        if down <= 0:
            steps, direction, down = [], slope.copy(), slope @ slope
        size = 1.0 if steps else 1.0 / max(1.0, np.sqrt(down))
        for _ in range(30):
            candidate = x - size * direction
            new_value, new_slope = loss(candidate)
            if new_value <= value - 1e-4 * size * down:
                break
            size /= 2
        else:
            break
        s, y = candidate - x, new_slope - slope
        if s @ y > 1e-12:
            steps = [*steps[1 - memory :], (s, y, 1 / (s @ y))]
        x, value, slope = candidate, new_value, new_slope
    return x


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
