"""Second moments of many columns in one pass.

Every task multiplies blocks of its rows with themselves and adds the products up; the sums of all tasks
are added per number, so what moves is (columns squared) numbers a task and never a row. Missing
values have weight zero, which gives the moments of every pair over the rows that have both.

Values are shifted by the mean of a few rows before they are multiplied: sums of squares of large,
hardly varying values keep their digits. The shift changes no result otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHIFT_ROWS = 1000


def added_up(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch], np.ndarray], None], size: int) -> np.ndarray:
    """The sum over all tasks of the array of ``size`` numbers that ``run`` adds to in each."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        run(batches, total)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["i", "v"])

    out = np.zeros(size)
    sums = rows.mapInArrow(task, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
    out[sums["i"].to_numpy(np.int64)] = sums["v"].to_numpy()
    return out


@dataclass
class Moments:
    """Over the rows that have both columns i and j: rows n[i, j], mean[i, j] of column i, and the sum
    of products of deviations cross[i, j]."""

    n: np.ndarray
    mean: np.ndarray
    cross: np.ndarray
    spread: np.ndarray  # sum of squared deviations of column i

    def covariance(self, ddof: int = 1) -> np.ndarray:
        return self.cross / np.maximum(self.n - ddof, 1)

    def correlation(self) -> np.ndarray:
        """Null (NaN) where a column does not vary over the pair's rows."""
        with np.errstate(invalid="ignore", divide="ignore"):
            scale = np.sqrt(self.spread * self.spread.T)
            return np.where(scale > 0, np.clip(self.cross / scale, -1.0, 1.0), np.nan)


def moments(df: DataFrame, values: Column, width: int, group: Column | None = None, groups: list | None = None) -> list[Moments]:
    """Moments of the array column ``values`` (``width`` numbers; null and NaN are missing), for each
    of ``groups`` (values of ``group``; other rows do not count) or for all rows."""
    groups = [0] if group is None else groups
    rows = df.select(values.cast("array<double>").alias("x"), (F.lit(0) if group is None else group).cast("double").alias("g"))
    few = [r["x"] for r in rows.where("x is not null").select("x").limit(SHIFT_ROWS).collect()]
    shift = np.zeros(width)
    if few:
        first = np.array(few, float)
        here = np.isfinite(first)
        shift = np.where(here, first, 0.0).sum(axis=0) / np.maximum(here.sum(axis=0), 1)
    shared = df.sparkSession.sparkContext.broadcast((shift, np.array(groups, float)))

    def run(batches: Iterator[pa.RecordBatch], total: np.ndarray) -> None:
        sums = total.reshape(len(groups), 4, width, width)
        centre, names = shared.value
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("x")))
            if not batch.num_rows:
                continue
            every = pc.list_flatten(batch.column("x")).to_numpy(zero_copy_only=False).reshape(-1, width) - centre
            g = batch.column("g").to_numpy(zero_copy_only=False)
            for k, name in enumerate(names):
                x = every[g == name]
                if not len(x):
                    continue
                here = ~np.isnan(x)
                if here.all():  # every pair has all rows
                    n, s, q = float(len(x)), x.sum(axis=0), (x * x).sum(axis=0)
                    sums[k] += np.stack([np.full((width, width), n), np.repeat(s[:, None], width, 1), x.T @ x, np.repeat(q[:, None], width, 1)])
                else:
                    m, x = here.astype(float), np.where(here, x, 0.0)
                    sums[k] += np.stack([m.T @ m, x.T @ m, x.T @ x, (x * x).T @ m])

    total = added_up(rows, run, len(groups) * 4 * width * width).reshape(len(groups), 4, width, width)
    out = []
    for n, s, xy, xx in total:
        at_least = np.maximum(n, 1)
        out.append(Moments(n, s / at_least + shift[:, None], xy - s * s.T / at_least, np.maximum(xx - s * s / at_least, 0.0)))
    return out
