"""Exact quantiles of many features by splitters: three scans, no sort of the data.

1. Each feature gets up to ``SPLITTERS`` splitting values from a mergeable quantile sketch. They only decide
   how even the next step is, never the answer.
2. One counting pass puts every row between its feature's splitters (a binary search in
   generated code over the feature's own array) and counts rows per (feature, cell), with the least
   and the largest value. A cell with one value settles the ranks in it.
3. The wanted ranks are joined to the running counts of the cells. Only rows of cells that hold a wanted
   rank and several values are looked at again: their distinct values are counted and summed up in
   order with :func:`running_sums`, and the ranks are joined to those sums.

Nothing is collected. The splitters reach the executors as one row per feature (SPLITTERS doubles each),
the cells with wanted ranks as at most two rows per feature and fraction.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.gram import added_up
from riskframe.operators.ordered import running_sums
from riskframe.session import write_once

SPLITTERS = 512


def with_cell(rows: DataFrame, cuts: str, value: str, out: str, most: int) -> DataFrame:
    """Add the number of sorted ``cuts`` (at most ``most``) that are <= ``value``, by halving steps."""
    step = 1 << max(0, math.ceil(math.log2(most + 1)) - 1)
    x = rows.withColumn(out, F.lit(0))
    while step:
        # each step is a projection of its own, so that the position is computed once
        x = x.withColumn(out, F.expr(f"{out} + if(try_element_at({cuts}, {out} + {step}) <= {value}, {step}, 0)"))
        step //= 2
    return x


def wanted_ranks(sizes: DataFrame, fractions: list[float]) -> DataFrame:
    """(feature, i, q, t, rank, side): the ranks below and above each fraction of ``(feature, n)`` rows."""
    points = F.expr("array(" + ", ".join(f"named_struct('i', {i}, 'q', {float(q)!r}D)" for i, q in enumerate(fractions)) + ")")
    h = (F.col("n") - 1) * F.col("q")
    x = sizes.select("feature", "n", F.inline(points)).select("feature", "i", "q", h.alias("h"))
    sides = F.array(F.struct(F.lit("lo").alias("side"), F.floor("h").cast("long").alias("rank")),
                    F.struct(F.lit("hi").alias("side"), F.ceil("h").cast("long").alias("rank")))
    return x.select("feature", "i", "q", (F.col("h") - F.floor("h")).alias("t"), F.inline(sides))


def interpolated(found: DataFrame) -> DataFrame:
    """(feature, i, q, quantile) from (feature, i, q, t, side, value)."""
    both = found.groupBy("feature", "i", "q", "t").agg(F.max(F.when(F.col("side") == "lo", F.col("value"))).alias("lo"),
                                                       F.max(F.when(F.col("side") == "hi", F.col("value"))).alias("hi"))
    # equal neighbours (also infinities) are the answer as they are
    return both.select("feature", "i", "q", F.when(F.col("lo") == F.col("hi"), F.col("lo"))
                       .otherwise(F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("t")).alias("quantile"))


def select_quantiles(long: DataFrame, fractions: list[float], weight: str | None = None,
                     splitters: int | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles of ``(feature, value[, weight])``
    rows (weight = row multiplicity, e.g. a collapsed count). Returns
    ``(feature, i, q, quantile)`` like NumPy's default method."""
    most = splitters or SPLITTERS
    rows = long.select("feature", F.col("value").cast("double").alias("value"), (F.col(weight) if weight else F.lit(1)).cast("long").alias("w"))
    rows = rows.where(F.col("value").isNotNull() & ~F.isnan("value") & (F.col("w") > 0))
    points = ", ".join(f"{k / (most + 1)!r}D" for k in range(1, most + 1))
    cuts = rows.groupBy("feature").agg(F.expr(f"array_distinct(percentile_approx(value, array({points}), {4 * most}))").alias("cuts"))
    cuts = write_once(cuts, "cuts")  # the sketch is a pass of its own: made once for all plans below
    celled = with_cell(rows.join(F.broadcast(cuts), "feature"), "cuts", "value", "cell", most).drop("cuts")
    counted = write_once(celled.groupBy("feature", "cell").agg(F.sum("w").alias("c"), F.min("value").alias("mn"), F.max("value").alias("mx")), "cells")
    upto = F.sum("c").over(Window.partitionBy("feature").orderBy("cell"))  # at most ``most`` + 1 rows a feature
    cells = counted.withColumn("before", upto - F.col("c"))
    ranks = wanted_ranks(counted.groupBy("feature").agg(F.sum("c").alias("n")), fractions)
    at = ranks.join(cells, "feature").where((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("c")))
    at = write_once(at, "ranks")
    found = at.where("mn = mx").select("feature", "i", "q", "t", "side", F.col("mn").alias("value"))
    still = at.where("mn <> mx")
    if not still.isEmpty():
        # a value is of an open cell if it lies between that cell's least and largest: no second search
        open_cells = F.broadcast(still.select(F.col("feature").alias("__f"), "cell", "mn", "mx").distinct())
        within = (F.col("feature") == F.col("__f")) & F.col("value").between(F.col("mn"), F.col("mx"))
        inside = rows.join(open_cells, within).groupBy("feature", "cell", "value").agg(F.sum("w").alias("w"))
        sums = running_sums(inside, ["feature", "cell"], "value", ["w"])
        hit = sums.join(still.select("feature", "cell", "i", "q", "t", "side", (F.col("rank") - F.col("before")).alias("r")), ["feature", "cell"])
        hit = hit.where((F.col("cum_w") - F.col("w") <= F.col("r")) & (F.col("r") < F.col("cum_w")))
        found = found.union(hit.select("feature", "i", "q", "t", "side", "value"))
    return interpolated(found)


#: bits of a value that one pass settles
DIGIT = 16


def _ordered_bits(x: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the doubles ``x`` (both zeros alike)."""
    u = (x + 0.0).view(np.uint64)
    return np.where(u >> np.uint64(63), ~u, u | np.uint64(1 << 63))


def _value_of(bits: int) -> float:
    bits = bits ^ (1 << 63) if bits >> 63 else bits ^ ((1 << 64) - 1)
    return float(np.array([bits], np.uint64).view(float)[0])


def column_quantiles(df: DataFrame, columns: list[str], fractions: list[float]) -> dict[str, list[float]]:
    """Exact linearly interpolated quantiles of whole columns, null and NaN left out; a column without
    values is left out of the result. The values' ordered bits are settled ``DIGIT`` at a time: each pass
    counts, in numpy, the next digit of the values that begin like a wanted rank, so that four
    passes over the columns as they stand find any rank. What moves is the counts of the digits."""
    return column_quantiles_without(df, columns, fractions)[None]


def column_quantiles_without(df: DataFrame, columns: list[str], fractions: list[float], fold_col: str | None = None,
                             folds: tuple[int, ...] = ()) -> dict[int | None, dict[str, list[float]]]:
    """:func:`column_quantiles` of all rows (under None) and, for each of ``folds``, of the rows with another fold. All share
    the four passes, which count digits by fold."""
    values = [F.col(c).cast("double").alias(str(i)) for i, c in enumerate(columns)]
    groups = len(folds) + 2 if fold_col else 1  # each fold, any other fold, no fold
    if fold_col:
        fold = F.coalesce(*[F.when(F.col(fold_col) == k, F.lit(j)) for j, k in enumerate(folds)],
                          F.when(F.col(fold_col).isNotNull(), F.lit(groups - 2)), F.lit(groups - 1))
        values.append(fold.cast("long").alias("g"))
    rows = df.select(*values)
    members = {None: list(range(groups))} | {k: [g for g in range(groups - 1) if g != j] for j, k in enumerate(folds)}
    every, wanted = 1 << DIGIT, {}
    cells = [(i, 0) for i in range(len(columns))]  # column, first bits
    for left in range(64 - DIGIT, -1, -DIGIT):  # bits that are left after the pass
        def run(batches: Iterator[pa.RecordBatch], total: np.ndarray) -> None:
            sums = total.reshape(len(cells), groups * every)
            for batch in batches:
                seen = {}
                group = batch.column("g").to_numpy() * every if groups > 1 else np.zeros(batch.num_rows, np.int64)
                for k, (i, begins) in enumerate(cells):
                    if i not in seen:
                        x = batch.column(i).to_numpy(zero_copy_only=False)
                        here = ~np.isnan(x)
                        seen[i] = _ordered_bits(x[here]) >> np.uint64(left), group[here]
                    u, g = seen[i]
                    if left + DIGIT < 64:
                        alike = (u >> np.uint64(DIGIT)) == np.uint64(begins)
                        u, g = u[alike], g[alike]
                    if len(u):
                        np.add.at(sums[k], (u & np.uint64(every - 1)).astype(np.int64) + g, 1.0)

        counts = added_up(rows, run, len(cells) * groups * every).reshape(len(cells), groups, every)
        upto = {(of, cell): np.cumsum(counts[k][some].sum(axis=0)) for k, cell in enumerate(cells) for of, some in members.items()}
        if not wanted:  # (rows, column, fraction, side) -> first bits, rank among the values that begin so
            for of in members:
                for i in range(len(columns)):
                    n = int(upto[of, (i, 0)][-1])
                    for q in fractions if n else ():
                        h = (n - 1) * float(q)
                        wanted |= {(of, i, q, "lo"): (0, math.floor(h)), (of, i, q, "hi"): (0, math.ceil(h)), (of, i, q, "t"): (0, h - math.floor(h))}
        for (of, i, q, side), (begins, rank) in wanted.items():
            if side != "t":
                to = upto[of, (i, begins)]
                digit = int(np.searchsorted(to, rank, side="right"))
                wanted[of, i, q, side] = begins << DIGIT | digit, rank - (int(to[digit - 1]) if digit else 0)
        cells = sorted({(i, begins) for (_, i, _, side), (begins, _) in wanted.items() if side != "t"})
        if not cells:
            break
    out = {of: {} for of in members}
    for of in members:
        for i, c in enumerate(columns):
            for q in fractions if (of, i, fractions[0], "lo") in wanted else ():
                lo, hi = (_value_of(wanted[of, i, q, side][0]) for side in ("lo", "hi"))
                out[of].setdefault(c, []).append(lo if lo == hi else lo + (hi - lo) * wanted[of, i, q, "t"][1])
    return out
