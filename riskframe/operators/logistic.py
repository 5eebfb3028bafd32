"""Many logistic regressions at once (K2, K9): all grid points of all folds share their passes.

A cross-validated search fits (folds x points) models that differ in the rows they see, the penalty
and the class weights only. Here the models are one stack of coefficient vectors, and each Newton step is
one pass over the rows as they are before any fold prepares them: a task prepares each batch for every fold,
adds up the loss, the gradient and the curvature of every model with a few matrix products, and the sums
of all tasks are added per number. No prepared row is kept, neither in memory nor on disk. Some eight passes
fit everything; one more counts the validation rows.

The objective is Spark ML's with ``standardization=False``: the mean weighted log loss plus
regParam / 2 times the squared coefficients, without the intercept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import is_missing
from riskframe.operators.features import ArrayPreparation
from riskframe.operators.gram import added_up

#: coefficients up to which the curvature is held (its size is their square, for each model)
MOST_FEATURES = 128
MOST_PASSES, GRADIENT = 60, 1e-10


@dataclass(frozen=True)
class Stack:
    """The models: penalties by fold and point, which points balance the classes, rows by fold and class."""

    penalties: np.ndarray
    balanced: np.ndarray
    class_rows: np.ndarray

    @property
    def class_weights(self) -> np.ndarray:
        """By fold, point and class: 1, or rows / (classes * rows of the class)."""
        n, present = self.class_rows.sum(axis=1, keepdims=True), (self.class_rows > 0).sum(axis=1, keepdims=True)
        w = n / (np.maximum(present, 1) * np.maximum(self.class_rows, 1))
        return np.where(self.balanced[None, :, None], w[:, None, :], 1.0)


def fold_rows(prepared: dict[int, DataFrame], fold_col: str, features: str = "reduced", label: str = "label") -> DataFrame:
    """(k, trains, y, x) of all rows, once for each fold's own preparation."""
    parts = [df.select(F.lit(k).alias("k"), (F.col(fold_col) != k).alias("trains"), F.col(label).cast("int").alias("y"),
                       vector_to_array(F.col(features)).alias("x")) for k, df in prepared.items()]
    return reduce(DataFrame.union, parts)


BLOCK_SCHEMA = "k int, trains boolean, y int, n long, x binary"


def in_blocks(rows: DataFrame) -> DataFrame:
    """(k, trains, y, n, x): the features of n rows of one fold, use and label as one run of doubles. Every
    pass then reads a few long values in place of an array per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = pc.list_flatten(batch.column("x")).to_numpy().reshape(batch.num_rows, -1)
            keys = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("k", "trains", "y")])
            found, which = np.unique(keys, axis=0, return_inverse=True)
            which = which.ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[:, 0], pa.int32()), pa.array(found[:, 1] == 1), pa.array(found[:, 2], pa.int32()),
                 pa.array(np.bincount(which, minlength=len(found)), pa.int64()),
                 pa.array([np.ascontiguousarray(x[which == i], float).tobytes() for i in range(len(found))], pa.binary())],
                ["k", "trains", "y", "n", "x"])

    return rows.mapInArrow(run, BLOCK_SCHEMA)


#: a batch's training (True) or validation rows as (fold, features and a one for the intercept by rows, label)
Parts = Callable[[pa.RecordBatch, bool], Iterator[tuple[int, np.ndarray, int]]]


def _by_fold(batch: pa.RecordBatch, trains: bool) -> Iterator[tuple[int, np.ndarray, int]]:
    """The parts of a batch of blocks."""
    batch = batch.filter(batch.column("trains") if trains else pc.invert(batch.column("trains")))
    if not batch.num_rows:
        return
    for k, y, n, x in zip(*(batch.column(c) for c in ("k", "y", "n", "x"))):
        n = n.as_py()
        x = np.frombuffer(x.as_buffer(), float).reshape(n, -1)
        yield k.as_py(), np.vstack([x.T, np.ones(n)]), y.as_py()


def raw_rows(train: DataFrame, fold_col: str, prepared: dict[int, ArrayPreparation], label: str = "label") -> DataFrame:
    """(k, y, n0, n1, .., c0, c1, ..): fold, label and the columns that the preparations read, as they are."""
    one = next(iter(prepared.values()))
    types = {f.name: f.dataType for f in train.schema.fields}
    numbers = [F.col(c).cast("double").alias(f"n{i}") for i, (c, *_) in enumerate(one.numbers)]
    levels = [F.when(~is_missing(c, types[c]), F.col(c)).cast("string").alias(f"c{i}") for i, (c, *_) in enumerate(one.levels)]
    rows = train.where(F.col(fold_col).isNotNull())
    return rows.select(F.col(fold_col).cast("int").alias("k"), F.col(label).cast("int").alias("y"), *numbers, *levels)


def prepared_parts(prepared: dict[int, ArrayPreparation], features: int) -> Parts:
    """The parts of a batch of raw rows, each fold's prepared as that fold was fitted. A fold that knows fewer
    than ``features`` (a level that it never meets) has zeros in place of the others."""
    one = next(iter(prepared.values()))

    def parts(batch: pa.RecordBatch, trains: bool) -> Iterator[tuple[int, np.ndarray, int]]:
        if not batch.num_rows:
            return
        fold, label = (batch.column(c).to_numpy() for c in ("k", "y"))
        others = max(prepared) + 1  # rows of no fold that is left out train for all
        key = (label * (others + 1) + np.where((fold < 0) | (fold > others), others, fold)).astype(np.int16)
        at = np.argsort(key, kind="stable")  # by label and fold
        key = key[at]
        numbers = [batch.column(f"n{i}").to_numpy(zero_copy_only=False)[at] for i in range(len(one.numbers))]
        levels = []
        for i in range(len(one.levels)):
            found = batch.column(f"c{i}").dictionary_encode(null_encoding="encode")
            levels.append((found.indices.to_numpy(zero_copy_only=False)[at], found.dictionary.to_pylist()))
        for y in (0, 1):
            first, end = np.searchsorted(key, [y * (others + 1), (y + 1) * (others + 1)])
            for k, prepare in prepared.items():
                lo, hi = first + np.searchsorted(key[first:end], y * (others + 1) + np.array([k, k + 1]))
                cut = (lambda v: np.concatenate([v[first:lo], v[hi:end]])) if trains else (lambda v: v[lo:hi])
                n = end - first - (hi - lo) if trains else hi - lo
                if n:
                    x = prepare([cut(v) for v in numbers], [(cut(codes), names) for codes, names in levels], features + 1)
                    x[features] = 1.0
                    yield k, x, y

    return parts


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Batches of a few rows, however many the session gives a worker at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


#: coefficients up to which all products of two features are formed at once
FEW = 24


def _weighted_squares(x: np.ndarray, bend: np.ndarray, upper: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The upper halves of the sums of ``bend`` x x' over the rows, by point."""
    if len(x) <= FEW:
        pairs, at = np.empty((len(upper[0]), x.shape[1])), 0
        for i in range(len(x)):
            np.multiply(x[i], x[i:], out=pairs[at:at + len(x) - i])
            at += len(x) - i
        return bend @ pairs.T
    return np.stack([((x * b) @ x.T)[upper] for b in bend])


def _curvature(rows: DataFrame, weights: np.ndarray, stack: Stack, parts: Parts = _by_fold) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums over the training rows: loss (folds, points), gradient (.., d) and curvature (.., d, d)."""
    folds, points, d = weights.shape
    upper = np.triu_indices(d)
    width = 1 + d + len(upper[0])
    shared = rows.sparkSession.sparkContext.broadcast((weights, stack.class_weights))

    def run(batches: Iterator[pa.RecordBatch], total: np.ndarray) -> None:
        w, class_weights = shared.value
        sums = total.reshape(folds, points, width)
        for batch in _slices(batches):
            for k, x, y in parts(batch, True):
                z = (-w[k] if y else w[k]) @ x  # the log odds of the other class
                e = np.abs(z)
                np.exp(np.negative(e, out=e), out=e)
                one = e + 1.0
                # the logarithm of a product of at most 512 numbers of 2 at most, in place of as many logarithms
                logs = np.log(np.multiply.reduceat(one, np.arange(0, x.shape[1], 512), axis=1)).sum(axis=1)
                wrong = np.where(z >= 0, 1.0, e)
                wrong /= one
                e /= np.multiply(one, one, out=one)
                rw = class_weights[k][:, y]
                sums[k, :, 0] += rw * (np.maximum(z, 0, out=z).sum(axis=1) + logs)
                sums[k, :, 1:1 + d] += (-rw if y else rw)[:, None] * (wrong @ x.T)
                sums[k, :, 1 + d:] += rw[:, None] * _weighted_squares(x, e, upper)

    sums = added_up(rows, run, folds * points * width).reshape(folds, points, width)
    bend = np.empty((folds, points, d, d))
    bend[..., upper[0], upper[1]] = bend[..., upper[1], upper[0]] = sums[..., 1 + d:]
    return sums[..., 0], sums[..., 1:1 + d], bend


def fit_stack(rows: DataFrame, stack: Stack, features: int, parts: Parts | None = None) -> np.ndarray:
    """Coefficients (folds, points, features + intercept) at the optimum, from raw rows and their ``parts`` or else from prepared
    rows or their blocks, by Newton steps that are halved where they would not lower the objective."""
    rows = rows if parts or "n" in rows.columns else in_blocks(rows)
    parts = parts or _by_fold
    folds, points = stack.penalties.shape
    w = np.zeros((folds, points, features + 1))
    n = np.maximum(stack.class_rows.sum(axis=1), 1)[:, None]  # balanced weights add up to it, too
    free = np.append(np.ones(features), 0.0)  # the intercept is not penalized
    best, at, step, size = np.full((folds, points), np.inf), w, np.zeros_like(w), np.ones((folds, points))
    for _ in range(MOST_PASSES):
        loss, grad, bend = _curvature(rows, w, stack, parts)
        penalty = stack.penalties[..., None]
        value = loss / n + (penalty * free * w * w).sum(axis=2) / 2
        worse = value > best + 1e-12 * np.abs(best)
        grad = grad / n[..., None] + penalty * free * w
        bend = bend / n[..., None, None] + (penalty * free)[..., None] * np.eye(features + 1)
        bend[..., np.arange(features + 1), np.arange(features + 1)] += 1e-14
        new = -np.linalg.solve(bend, grad[..., None])[..., 0]
        at, best = np.where(worse[..., None], at, w), np.where(worse, best, value)
        step = np.where(worse[..., None], step, new)
        size = np.where(worse, size / 2, 1.0)
        done = ~worse & (np.abs(grad).max(axis=2) < GRADIENT) | (size < 1e-6)
        if done.all():
            return at
        w = np.where(done[..., None], at, at + size[..., None] * step)
    return at


def validation_counts(rows: DataFrame, weights: np.ndarray, parts: Parts = _by_fold) -> np.ndarray:
    """tp, fp, fn of the positive class on each fold's validation rows: (folds, points, 3)."""
    folds, points, _ = weights.shape
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch], total: np.ndarray) -> None:
        w = shared.value
        sums = total.reshape(folds, points, 3)
        for batch in _slices(batches):
            for k, x, y in parts(batch, False):
                says = (w[k] @ x > 0).sum(axis=1)  # a probability above one half
                if y == 1:
                    sums[k, :, 0] += says
                    sums[k, :, 2] += x.shape[1] - says
                else:
                    sums[k, :, 1] += says

    return added_up(rows, run, folds * points * 3).reshape(folds, points, 3)


def cross_validated_f1(train: DataFrame, fold_col: str, prepared: dict[int, ArrayPreparation], class_rows: np.ndarray,
                       penalties: np.ndarray, balanced: np.ndarray) -> np.ndarray:
    """F1 of the positive class by fold and point; ``prepared[k]`` prepares any row as fold k does, ``class_rows`` are
    the training rows by fold and class."""
    features = max(p.width for p in prepared.values())
    rows, parts = raw_rows(train, fold_col, prepared), prepared_parts(prepared, features)
    weights = fit_stack(rows, Stack(penalties, balanced, class_rows), features, parts)
    tp, fp, fn = np.moveaxis(validation_counts(rows, weights, parts), 2, 0)
    return np.where(2 * tp + fp + fn > 0, 2 * tp / np.maximum(2 * tp + fp + fn, 1), 0.0)
