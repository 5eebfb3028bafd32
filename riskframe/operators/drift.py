"""Drift: exact quantile edges, PSI, two-sample KS, drift report.

All features are handled at once in long form ``(feature, value)``: one
plan, a fixed number of jobs however many features there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe import schema as S
from riskframe.functions.bands import psi_verdict
from riskframe.functions.columns import hash_normal, hash_uniform
from riskframe.operators.ordered import running_sums
from riskframe.session import write_once

KS_SERIES_TERMS = 100
KS_SMALL_LAMBDA = 0.2


def numeric_features(df: DataFrame, features: list[str]) -> list[str]:
    """Column-type gate (P13): only numeric columns enter drift."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in features if c in types and isinstance(types[c], T.NumericType)]


def to_long(df: DataFrame, features: list[str], drop_missing: bool = True) -> DataFrame:
    """Unpivot to ``(feature, value double)``; drop null/NaN per feature."""
    cols = numeric_features(df, features)
    if not cols:
        raise ValueError("no numeric feature to compare")
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "feature", "value")
    if drop_missing:
        long = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return long


def linspace(n_bins: int) -> list[float]:
    """Fractions 0..1 computed as NumPy's linspace does (3/10 -> 0.30000000000000004)."""
    step = 1.0 / n_bins
    return [0.0 if i == 0 else (1.0 if i == n_bins else i * step) for i in range(n_bins + 1)]


def tagged_pair(ref_long: DataFrame, cur_long: DataFrame) -> DataFrame:
    """(feature, value, nr, nc) of every value, with the sample it is of."""
    return (ref_long.select("feature", "value", F.lit(1).alias("nr"), F.lit(0).alias("nc"))
            .unionByName(cur_long.select("feature", "value", F.lit(0).alias("nr"), F.lit(1).alias("nc"))))


def collapse_pair(ref_long: DataFrame, cur_long: DataFrame) -> DataFrame:
    """One row per (feature, distinct value) with the count in each sample. A hot value collapses
    map-side to one row."""
    return tagged_pair(ref_long, cur_long).groupBy("feature", "value").agg(F.sum("nr").alias("nr"), F.sum("nc").alias("nc"))


def quantiles_from_counts(counts: DataFrame, fractions: list[float],
                          count_col: str = "cnt") -> DataFrame:
    """Exact quantiles per feature from ``(feature, value, count)`` rows, without a sort of the
    rows; see :mod:`riskframe.operators.selection`."""
    from riskframe.operators.selection import select_quantiles
    return select_quantiles(counts.select("feature", "value", count_col), fractions,
                            weight=count_col)


def quantiles_by_ranks(counts: DataFrame, fractions: list[float],
                       count_col: str = "cnt") -> DataFrame:
    """Exact, linearly interpolated quantiles per feature from
    ``(feature, value, count)`` rows: cumulative counts with
    :func:`running_sums`, then the values at ranks floor/ceil of ``(n-1)q``, by a join.
    Returns ``(feature, i, q, quantile)``."""
    from riskframe.operators.selection import interpolated, wanted_ranks
    c = (counts.where(F.col(count_col) > 0)
         .select("feature", "value", F.col(count_col).alias("cnt")))
    cum = running_sums(c, ["feature"], "value", ["cnt"])
    # features x fractions x 2 rows: bounded by the spec, safe to broadcast
    ranks = F.broadcast(wanted_ranks(cum.groupBy("feature").agg(F.sum("cnt").alias("n")), fractions))
    return interpolated(cum.join(ranks, "feature").where(
        (F.col("cum_cnt") - F.col("cnt") <= F.col("rank")) & (F.col("rank") < F.col("cum_cnt"))))


def exact_quantiles(long: DataFrame, fractions: list[float]) -> DataFrame:
    """Exact quantiles per feature (A21) of a long ``(feature, value)`` frame,
    by distributed selection (no sort of the values)."""
    from riskframe.operators.selection import select_quantiles
    return select_quantiles(long.select("feature", "value"), fractions)


def _edges(quantiles: DataFrame) -> DataFrame:
    return quantiles.groupBy("feature").agg(
        F.array_sort(F.array_distinct(F.collect_list("quantile"))).alias("edges"))


def psi_edges(ref_long: DataFrame, n_bins: int = S.PSI_BINS) -> DataFrame:
    """Distinct reference quantile edges per feature: ``(feature, edges array)``."""
    return _edges(exact_quantiles(ref_long, linspace(n_bins)))


def bin_index(edges: Column, value: Column, n_bins: int = S.PSI_BINS) -> Column:
    """Bin of ``value`` for [a, b) bins with open outer edges (A22): the
    number of interior edges <= value. Unrolled over the at most
    ``n_bins - 1`` interior edges so it stays in generated code."""
    count = F.lit(0)
    for k in range(2, n_bins + 1):               # interior edges: 1-based 2 .. size-1
        hit = (F.lit(k) < F.size(edges)) & (F.try_element_at(edges, F.lit(k)) <= value)
        count = count + F.when(F.coalesce(hit, F.lit(False)), F.lit(1)).otherwise(F.lit(0))
    return count


def psi_from_collapsed(collapsed: DataFrame, features: list[str], n_bins: int = S.PSI_BINS,
                       eps: float = S.PSI_EPSILON, edges: DataFrame | None = None) -> DataFrame:
    """Population stability index per feature (A23) from
    :func:`collapse_pair` rows. Fewer than 3 distinct edges -> 0.0; an empty
    sample -> NaN; a bin empty in one sample still counts (with epsilon)."""
    spark = collapsed.sparkSession
    names = spark.createDataFrame([(f,) for f in features], "feature string")
    if edges is None:
        edges = _edges(quantiles_from_counts(collapsed, linspace(n_bins), "nr"))
    usable = edges.where(F.size("edges") >= 3)
    nb = F.size("edges") - 1
    totals = collapsed.groupBy("feature").agg(F.sum("nr").alias("total_ref"),
                                              F.sum("nc").alias("total_cur"))
    # edges: one row per feature -> broadcast
    binned = (collapsed.join(F.broadcast(usable), "feature")
              .groupBy("feature", bin_index(F.col("edges"), F.col("value"), n_bins).alias("bin"))
              .agg(F.sum("nr").alias("n_ref"), F.sum("nc").alias("n_cur")))
    grid = usable.select("feature", F.explode(F.sequence(F.lit(0), nb - 1)).alias("bin"))
    per_bin = (grid.join(binned, ["feature", "bin"], "left").fillna(0, ["n_ref", "n_cur"])
               .join(F.broadcast(totals), "feature"))
    pr = F.col("n_ref") / F.greatest(F.col("total_ref"), F.lit(1)) + F.lit(eps)
    pc = F.col("n_cur") / F.greatest(F.col("total_cur"), F.lit(1)) + F.lit(eps)
    sums = per_bin.groupBy("feature").agg(F.sum((pc - pr) * F.log(pc / pr)).alias("psi_sum"))
    tr = F.coalesce(F.col("total_ref"), F.lit(0))
    tc = F.coalesce(F.col("total_cur"), F.lit(0))
    return (names.join(totals, "feature", "left").join(sums, "feature", "left")
            .join(edges, "feature", "left")
            .select("feature",
                    F.when((tr == 0) | (tc == 0), F.lit(float("nan")))
                    .when(F.size("edges") < 3, F.lit(0.0))
                    .otherwise(F.col("psi_sum")).alias("psi"),
                    tr.cast("long").alias("n_ref"), tc.cast("long").alias("n_cur")))


def psi(ref_long: DataFrame, cur_long: DataFrame, features: list[str],
        n_bins: int = S.PSI_BINS, eps: float = S.PSI_EPSILON) -> DataFrame:
    """PSI per feature from the two long-form samples."""
    return psi_from_collapsed(collapse_pair(ref_long, cur_long), features, n_bins, eps)


def kolmogorov_pvalue(lam: Column) -> Column:
    """Asymptotic two-sided Kolmogorov survival function Q(lambda)."""
    terms = F.sequence(F.lit(1), F.lit(KS_SERIES_TERMS))
    series = F.aggregate(
        terms, F.lit(0.0),
        lambda acc, k: acc + F.lit(2.0) * F.when(k % 2 == 1, 1.0).otherwise(-1.0)
        * F.exp(F.lit(-2.0) * k * k * lam * lam))
    return (F.when(lam.isNull(), F.lit(None).cast("double"))
            .when(lam < KS_SMALL_LAMBDA, F.lit(1.0))
            .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series))))


#: cells of the recurrence up to which a call by itself works out an exact p-value
KS_EXACT_CELLS = 2_000_000_000
#: natural logarithm below which a double is zero; steps for which the recurrence sets up its arrays
LOG_ZERO, KS_STEPS = -746.0, 4096


def ks_exact_pvalue(m: int, n: int, d: float, cells: int | None = KS_EXACT_CELLS) -> float:
    """Exact two-sided P(D >= d) for samples of sizes m and n without ties: the probability that a
    uniformly random monotone lattice path from (0, 0) to (m, n) leaves the band |i/m - j/n| < d.

    The paths are followed diagonal by diagonal, with the probability of every point inside the
    band that the path has not left; what steps out is added up, so a small p-value keeps its
    digits. A p-value that no double can hold is zero without following the paths. A band of more
    than ``cells`` cells is refused (None: never), as the asymptotic form is the one to name where an
    answer is awaited; :func:`drift_report` works all of them out in its tasks."""
    if m <= 0 or n <= 0:
        return float("nan")
    # compare in integers: |i*n - j*m| >= h is outside
    h = round(d * m * n)
    if h <= 0:
        return 1.0
    both = m + n
    if cells is not None and both * min(m, n, 2 * h // both + 1) > cells:
        raise ValueError(f"samples of {m} and {n} rows are too large for the exact p-value; use 'asymptotic'")
    # Serfling's and Hoeffding's bounds (draws without replacement) on being h / both or more off the diagonal at any t
    if math.log(2 * both) - 2 * (h / both) ** 2 * max(4 * both / (both + 1) ** 2, 1 / min(m, n)) < LOG_ZERO:
        return 0.0
    out, first, size = 0.0, 0, 1  # prob[at:at + size]: the points first, first + 1, ...
    prob, at = np.ones(1), 0
    for t in range(1, both + 1):  # i + j = t; the points inside have |i*both - t*m| < h
        if t % KS_STEPS == 1:  # room for these steps
            prob = np.concatenate([prob[at:at + size], np.zeros(2 * KS_STEPS)])
            at, begin, ups = 0, first, np.empty(len(prob))
            rest = np.arange(m - first, m - first - len(prob), -1.0)  # steps of i that are left
        lo = max(0, t - n, (t * m - h) // both + 1)
        hi = min(m, t, -((-t * m - h) // both) - 1)
        x, up = prob[at:at + size], ups[:size]
        np.divide(rest[first - begin:first - begin + size], both - t + 1, out=up)  # exactly 1 where only steps of i are left
        up *= x
        x -= up
        prob[at + 1:at + size + 1] += up
        size += 1
        a, b = max(lo - first, 0), max(hi - first + 1, 0)
        if b < size:
            out += prob[at + b:at + size].sum()
            prob[at + b:at + size] = 0.0
            size = b
        if a:
            out += prob[at:at + min(a, size)].sum()
            at, first, size = at + a, first + a, size - a
        if size <= 0:
            break
    return float(min(1.0, max(0.0, out)))


def _exact_pvalues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("tot_r", "tot_c", "ks_statistic")))
        p = [None if d is None else ks_exact_pvalue(int(m or 0), int(n or 0), d, None) for m, n, d in rows]
        yield pa.RecordBatch.from_arrays([batch.column("feature"), batch.column("ks_statistic"), pa.array(p, pa.float64())],
                                         ["feature", "ks_statistic", "ks_pvalue"])


def ks_from_collapsed(collapsed: DataFrame, pvalue: str = "asymptotic") -> DataFrame:
    """Two-sample KS statistic (A24, W3) and p-value per feature:
    the largest gap between the two empirical CDFs over the distinct values.
    ``pvalue="exact"`` works out one feature a task."""
    if pvalue not in ("asymptotic", "exact"):
        raise ValueError(f"unknown p-value method {pvalue!r}")
    cum = running_sums(collapsed, ["feature"], "value", ["nr", "nc"])
    totals = cum.groupBy("feature").agg(F.sum("nr").alias("tot_r"), F.sum("nc").alias("tot_c"))
    d = (cum.join(F.broadcast(totals), "feature")  # one row per feature
         .groupBy("feature", "tot_r", "tot_c")
         .agg(F.max(F.abs(F.try_divide(F.col("cum_nr"), F.col("tot_r"))
                          - F.try_divide(F.col("cum_nc"), F.col("tot_c"))))
              .alias("ks_statistic")))
    en = F.sqrt(F.try_divide(F.col("tot_r") * F.col("tot_c"), F.col("tot_r") + F.col("tot_c")))
    out = d.select("feature", "tot_r", "tot_c",
                   F.when((F.col("tot_r") > 0) & (F.col("tot_c") > 0),
                          F.col("ks_statistic")).alias("ks_statistic"))
    if pvalue == "exact":
        # few rows, each of them long work: dealt out by feature before the work begins
        return (write_once(out, "ks").repartition("feature")
                .mapInArrow(_exact_pvalues, "feature string, ks_statistic double, ks_pvalue double"))
    return out.select("feature", "ks_statistic", kolmogorov_pvalue(en * F.col("ks_statistic")).alias("ks_pvalue"))


def ks_test(ref_long: DataFrame, cur_long: DataFrame) -> DataFrame:
    return ks_from_collapsed(collapse_pair(ref_long, cur_long))


def long_pair(reference: DataFrame, current: DataFrame, features: list[str],
              prediction: str | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both samples in long form, each from a single unpivot (one scan);
    the prediction column, when given, is one more feature named
    ``prediction`` (A27)."""
    feats = [c for c in numeric_features(reference, features) if c in numeric_features(current, features)]
    names = list(feats) + (["prediction"] if prediction is not None else [])

    def long(df: DataFrame) -> DataFrame:
        cols = [F.col(c).cast("double").alias(c) for c in feats]
        if prediction is not None:
            cols.append(F.col(prediction).cast("double").alias("prediction"))
        return (df.select(*cols).unpivot([], names, "feature", "value")
                .where(F.col("value").isNotNull() & ~F.isnan("value")))
    return long(reference), long(current), names


def drift_report(reference: DataFrame, current: DataFrame, features: list[str],
                 prediction: str | None = None, n_bins: int = S.PSI_BINS,
                 method: str = "exact", pvalue: str = "asymptotic") -> DataFrame:
    """PSI + KS + verdict for every numeric feature (A26) and the prediction.

    ``method="exact"`` takes the reference deciles from exact ranks;
    ``method="kll"`` from KLL sketches (approximate edges, one pass).
    ``pvalue="asymptotic"`` uses the Kolmogorov series; ``"exact"`` the exact
    lattice-path probability at every size (its cost grows with the sizes). A
    feature that the current sample lacks is skipped."""
    if method not in ("exact", "kll"):
        raise ValueError(f"unknown method {method!r}")
    ref_long, cur_long, names = long_pair(reference, current, features, prediction)
    # PSI from edges and bin counts (no value is moved for it); the values are moved once, for KS
    edges = _edges(kll_quantiles(ref_long, linspace(n_bins))) if method == "kll" else psi_edges(ref_long, n_bins)
    p = psi_from_collapsed(tagged_pair(ref_long, cur_long), names, n_bins, edges=edges)
    k = ks_from_collapsed(collapse_pair(ref_long, cur_long), pvalue)
    return (p.join(k, "feature", "left")
            .withColumn("verdict", psi_verdict("psi"))
            .select("feature", "psi", "ks_statistic", "ks_pvalue", "verdict", "n_ref", "n_cur"))


def psi_report(reference: DataFrame, current: DataFrame, features: list[str],
               prediction: str | None = None, n_bins: int = S.PSI_BINS) -> DataFrame:
    """PSI and verdict alone, for decisions that need no KS (A28, L2): edges by selection, then one
    map-side count per feature and bin. No value is shuffled or written."""
    ref_long, cur_long, names = long_pair(reference, current, features, prediction)
    counted = tagged_pair(ref_long, cur_long)
    p = psi_from_collapsed(counted, names, n_bins, edges=psi_edges(ref_long, n_bins))
    return p.withColumn("verdict", psi_verdict("psi"))


def any_drift(report: DataFrame) -> DataFrame:
    """One row: does any feature (or the prediction) show drift."""
    return report.agg(F.coalesce(F.bool_or(F.col("verdict") == S.VERDICT_DRIFT),
                                 F.lit(False)).alias("has_drift"))


def inject_drift(df: DataFrame, key: Column, seed: int, shift_col: str, shift: float,
                 noisy_col: str, noise_shift: float, noise_std: float,
                 level_col: str, level_from, level_to, level_share: float) -> DataFrame:
    """Deterministic perturbation (P12): shift one column, add shifted normal
    noise to another, move a share of one category level to another.
    Draws come from the row key, so they do not depend on partitioning."""
    noise = hash_normal(key, seed, noise_shift, noise_std)
    move = (F.col(level_col) == F.lit(level_from)) & (hash_uniform(key, seed, "lvl") < level_share)
    return (df.withColumn(shift_col, F.col(shift_col) + F.lit(shift))
            .withColumn(noisy_col, F.col(noisy_col) + noise)
            .withColumn(level_col, F.when(move, F.lit(level_to)).otherwise(F.col(level_col))))


def kll_quantiles(long: DataFrame, fractions: list[float]) -> DataFrame:
    """Approximate quantiles per feature from KLL sketches: one map-side
    pass, mergeable, bounded memory per feature, no sort. For inputs where
    the exact rank pass is too costly. Returns ``(feature, i, q, quantile)``."""
    arr = "array(" + ", ".join(repr(float(q)) for q in fractions) + ")"
    sk = long.groupBy("feature").agg(
        F.expr(f"kll_sketch_get_quantile_double(kll_sketch_agg_double(value), {arr})")
        .alias("qs"))
    fr = F.array(*[F.lit(float(q)) for q in fractions])
    return sk.select("feature", F.posexplode(F.arrays_zip(fr.alias("q"), F.col("qs").alias("v")))
                     .alias("i", "z")).select("feature", "i", F.col("z.q").alias("q"),
                                              F.col("z.v").alias("quantile"))
