"""Roll-ups by day that any longer window is merged from (A27, by week and month).

Two small tables are written once a day and never touched again: counts of each feature by value bin, and
the confusion counts of the decisions. A week, a month or any other window is a sum of days, so no
row of the past is read again.

Bins are geometric: a value x > 0 lies in bin k if base**(k - 1) < x <= base**k with base =
(1 + accuracy) / (1 - accuracy), negative values mirror that, and zero is a bin of its own. A quantile read
from the bins is therefore within ``accuracy`` of a true one, relatively, whatever the distribution and the
window, and the table has some hundred rows a feature and day. Counts are plain sums: merging loses nothing,
in any order. Costs come from the confusion counts and are exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe import schema as S
from riskframe.functions.bands import psi_verdict
from riskframe.operators.drift import linspace
from riskframe.operators.metrics import confusion_counts, rates_from_confusion

ACCURACY = 0.005
PERIODS = ("day", "week", "month", "quarter", "year")
#: values nearer to zero than this share its bin
SMALLEST = 1e-300


def _base(accuracy: float) -> float:
    return math.log((1 + accuracy) / (1 - accuracy))


def value_bin(value: Column, accuracy: float = ACCURACY) -> Column:
    """The bin of a finite value: 0 for zero, else the sign times a positive number."""
    size = F.abs(value)
    steps = F.ceil(F.ln(F.greatest(size, F.lit(SMALLEST))) / _base(accuracy)) + math.ceil(-math.log(SMALLEST) / _base(accuracy)) + 1
    return F.when(size <= SMALLEST, F.lit(0)).otherwise(F.signum(value) * steps).cast("int")


def bin_value(k: Column, accuracy: float = ACCURACY) -> Column:
    """The value in the middle of a bin: within ``accuracy`` of every value in it."""
    steps = F.abs(k) - 1 - math.ceil(-math.log(SMALLEST) / _base(accuracy))
    return F.when(k == 0, F.lit(0.0)).otherwise(F.signum(k.cast("double")) * F.exp(steps * _base(accuracy)) * (1 - accuracy))


def daily_values(df: DataFrame, ts: str, features: list[str], accuracy: float = ACCURACY) -> DataFrame:
    """(feature, day, bin, n): one map-side aggregate. Null and non-finite values do not count."""
    long = df.select(F.to_date(ts).alias("day"), *[F.col(c).cast("double").alias(c) for c in features]).unpivot(["day"], features, "feature", "value")
    finite = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < float("inf"))
    return long.where(finite & F.col("day").isNotNull()).groupBy("feature", "day", value_bin(F.col("value"), accuracy).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def daily_confusion(df: DataFrame, ts: str, label: str, prediction: str) -> DataFrame:
    """(day, tp, fp, fn, tn, n)."""
    return confusion_counts(df.withColumn("day", F.to_date(ts)).where("day is not null"), label, prediction, ("day",))


def _start(period: str) -> Column:
    if period not in PERIODS:
        raise ValueError(f"unknown period {period!r}; there are {', '.join(PERIODS)}")
    return F.to_date(F.date_trunc(period, "day"))


def costs_by(confusion: DataFrame, period: str, cost_fn: float = S.COST_FALSE_NEGATIVE, cost_fp: float = S.COST_FALSE_POSITIVE) -> DataFrame:
    """Metrics and cost per case of each period, from the daily counts: (period_start, days, ...)."""
    counts = ("tp", "fp", "fn", "tn", "n")
    merged = confusion.groupBy(_start(period).alias("period_start")).agg(F.count(F.lit(1)).alias("days"), *[F.sum(c).alias(c) for c in counts])
    return rates_from_confusion(merged, cost_fn, cost_fp)


def merged_bins(values: DataFrame, period: str) -> DataFrame:
    """(feature, period_start, bin, n): the days' counts, added up."""
    return values.groupBy("feature", _start(period).alias("period_start"), "bin").agg(F.sum("n").alias("n"))


def merged_quantiles(bins: DataFrame, fractions: list[float], keys: tuple[str, ...] = ("feature", "period_start"), accuracy: float = ACCURACY) -> DataFrame:
    """(keys, i, q, bin, quantile): the bin that holds each fraction's lower rank, and its value."""
    order = Window.partitionBy(*keys).orderBy("bin")  # some hundred bins a feature
    whole = Window.partitionBy(*keys)
    points = F.expr("array(" + ", ".join(f"named_struct('i', {i}, 'q', {float(q)!r}D)" for i, q in enumerate(fractions)) + ")")
    cum = bins.withColumn("upto", F.sum("n").over(order)).withColumn("total", F.sum("n").over(whole)).select("*", F.inline(points))
    rank = F.floor((F.col("total") - 1) * F.col("q"))
    hit = cum.where((F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank))
    return hit.select(*keys, "i", "q", "bin", bin_value(F.col("bin"), accuracy).alias("quantile"))


def psi_by(values: DataFrame, period: str, n_bins: int = S.PSI_BINS, eps: float = S.PSI_EPSILON) -> DataFrame:
    """PSI of every period against the one before it that has data: (feature, period_start, psi, verdict,
    n, n_reference). The classes are the reference's deciles, moved to the next bin end, so both sides
    are counted exactly by them."""
    bins = merged_bins(values, period)
    before = Window.partitionBy("feature").orderBy("period_start")  # one row a period
    pairs = bins.groupBy("feature", "period_start").agg(F.sum("n").alias("total")).select(
        "feature", "period_start", "total", F.lag("period_start").over(before).alias("reference"), F.lag("total").over(before).alias("ref_total"))
    pairs = pairs.where("reference is not null")
    ends = merged_quantiles(bins, linspace(n_bins)[1:-1]).groupBy("feature", "period_start").agg(F.array_sort(F.collect_set("bin")).alias("ends"))
    ends = ends.withColumnRenamed("period_start", "reference")
    cur = bins.join(pairs.select("feature", "period_start", "reference"), ["feature", "period_start"]).select("feature", "period_start", "reference", "bin", "n", F.lit(0).cast("long").alias("r"))
    ref = (bins.withColumnRenamed("period_start", "reference").join(pairs.select("feature", "period_start", "reference"), ["feature", "reference"])
           .select("feature", "period_start", "reference", "bin", F.lit(0).cast("long").alias("n"), F.col("n").alias("r")))
    klass = F.size(F.filter("ends", lambda e: e < F.col("bin")))  # at most n_bins - 1 ends
    counted = (cur.union(ref).join(ends, ["feature", "reference"]).groupBy("feature", "period_start", klass.alias("class"))
               .agg(F.sum("n").alias("n"), F.sum("r").alias("r")).join(pairs, ["feature", "period_start"]))
    pc, pr = F.col("n") / F.col("total") + eps, F.col("r") / F.col("ref_total") + eps
    return (counted.groupBy("feature", "period_start", "total", "ref_total").agg(F.sum((pc - pr) * F.log(pc / pr)).alias("psi"))
            .select("feature", "period_start", "psi", psi_verdict("psi").alias("verdict"), F.col("total").alias("n"), F.col("ref_total").alias("n_reference")))
