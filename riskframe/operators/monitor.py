"""Lifecycle monitoring: alerts, rolling metrics, retrain triggers,
promotion gate (L1-L5, W7, W8, J6, J7)."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe import schema as S
from riskframe.functions.columns import zero_div
from riskframe.operators.drift import bin_index


def metric_alerts(baseline: DataFrame, current: DataFrame,
                  thresholds: tuple[tuple[str, float], ...] = S.METRIC_ALERT_DROPS,
                  keys: tuple[str, ...] = ()) -> DataFrame:
    """L1: long-form metrics ``(keys..., metric, value)`` against a baseline
    ``(metric, value)``; alert when the drop is strictly above the limit."""
    spark = current.sparkSession
    th = spark.createDataFrame(list(thresholds), "metric string, max_drop double")
    base = baseline.select("metric", F.col("value").alias("baseline"))
    return (current.join(F.broadcast(th), "metric")        # fixed-size rule table
            .join(F.broadcast(base), "metric")             # one row per metric
            .select(*keys, "metric", "baseline", F.col("value").alias("current"), "max_drop",
                    (F.col("baseline") - F.col("value")).alias("drop"))
            .withColumn("alert", F.col("drop") > F.col("max_drop")))


def psi_retrain(report: DataFrame, features: tuple[str, ...] = S.RETRAIN_FEATURES,
                threshold: float = S.RETRAIN_PSI,
                min_features: int = S.RETRAIN_MIN_FEATURES) -> DataFrame:
    """L2: retrain when PSI > threshold (strict) on at least ``min_features``
    of the watched features."""
    hit = F.count_if((F.col("psi") > threshold) & F.col("feature").isin(*features))
    return report.agg(hit.alias("n_features_over"),
                      (hit >= min_features).alias("retrain_psi"))


def daily_confusion(df: DataFrame, ts: str, label: str, prediction: str,
                    keys: tuple[str, ...] = ()) -> DataFrame:
    """Per-day tp, fp, fn, tn (the pre-aggregation that keeps every later
    window small: one row per key and day)."""
    y, p = F.col(label).cast("int") == 1, F.col(prediction).cast("int") == 1
    return (df.groupBy(*keys, F.to_date(F.col(ts)).alias("day"))
            .agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                 F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn")))


def rolling_metrics(daily: DataFrame, days: int = S.ROLLING_DAYS,
                    keys: tuple[str, ...] = (), cost_fn: float = S.COST_FALSE_NEGATIVE,
                    cost_fp: float = S.COST_FALSE_POSITIVE) -> DataFrame:
    """Trailing ``days``-day sums per key (calendar range frame), then
    recall and expected cost over the window."""
    d = daily.withColumn("__day", F.unix_date("day"))
    part = list(keys) if keys else [F.lit(0)]
    # one row per key and day: a series stays small even at scale
    w = Window.partitionBy(*part).orderBy("__day").rangeBetween(-(days - 1), 0)
    for c in ("tp", "fp", "fn", "tn"):
        d = d.withColumn(f"r_{c}", F.sum(c).over(w))
    n = F.col("r_tp") + F.col("r_fp") + F.col("r_fn") + F.col("r_tn")
    return (d.withColumn("rolling_recall", zero_div(F.col("r_tp"), F.col("r_tp") + F.col("r_fn")))
            .withColumn("rolling_cost", zero_div(F.lit(cost_fn) * F.col("r_fn")
                                                 + F.lit(cost_fp) * F.col("r_fp"), n))
            .withColumn("rolling_n", n)
            .drop("__day"))


def retrain_triggers(rolling: DataFrame, baseline_recall: Column | float,
                     cost_ceiling: float, last_train_day: str,
                     recall_drop: float = S.RETRAIN_RECALL_DROP,
                     max_age_days: int = S.RETRAIN_MAX_AGE_DAYS,
                     manual_flag: bool = False) -> DataFrame:
    """L3 + L4 per day: recall drop, cost ceiling, model age, manual flag,
    and the combined decision."""
    base = baseline_recall if isinstance(baseline_recall, Column) else F.lit(baseline_recall)
    age = F.datediff(F.col("day"), F.to_date(F.lit(last_train_day)))
    return (rolling
            .withColumn("trigger_recall", (base - F.col("rolling_recall")) > recall_drop)
            .withColumn("trigger_cost", F.col("rolling_cost") > cost_ceiling)
            .withColumn("trigger_age", age > max_age_days)
            .withColumn("trigger_manual", F.lit(manual_flag))
            .withColumn("retrain", F.col("trigger_recall") | F.col("trigger_cost")
                        | F.col("trigger_age") | F.col("trigger_manual")))


def _stirling_rest(x: Column) -> Column:
    """log(x!) less Stirling's formula, for x >= 1: a table up to 15, the series beyond."""
    table = F.array(*(F.lit(math.lgamma(i + 1) - (0.5 * math.log(2 * math.pi * i) + i * math.log(i) - i))
                      for i in range(1, 16)))
    r = F.lit(1.0) / (x * x)
    series = (F.lit(1 / 12) - (F.lit(1 / 360) - (F.lit(1 / 1260) - F.lit(1 / 1680) * r) * r) * r) / x
    return F.when(x <= 15, F.get(table, F.least(x, F.lit(15.0)).cast("int") - 1)).otherwise(series)


def binomial_half_tail(m: Column, n: Column) -> Column:
    """P[X <= m], X ~ Bin(n, 1/2), for 0 <= m <= n/2 and n >= 1, by one formula for all sizes:
    (n - m) * P[X = m] * integral over v in (0, 1) of (1 - v)^(n-m-1) * (1 + v)^m.

    P[X = m] comes from the deviance (no difference of large factorials); the integral is taken
    by Gauss-Legendre nodes over the part where the integrand exceeds exp(-45) of its start.
    """
    n, m = n.cast("double"), m.cast("double")
    k = n - m
    u = (k - m) / n
    deviance = n / 2 * ((1 - u) * F.log1p(-u) + (1 + u) * F.log1p(u))
    rest = _stirling_rest(n) - _stirling_rest(m) - _stirling_rest(k)
    point = F.when(m <= 0, F.exp(-n * F.lit(math.log(2.0)))).otherwise(
        F.exp(rest - deviance) * F.sqrt(n / (F.lit(2 * math.pi) * m * k)))
    slope = k - m - 1
    reach = F.least(F.lit(1.0), (F.sqrt(slope * slope + 90 * n) - slope) / n)
    nodes, weights = np.polynomial.legendre.leggauss(64)
    total = F.lit(0.0)
    for x, w in zip((nodes + 1) / 2, weights / 2):
        v = reach * F.lit(float(x))
        total = total + F.lit(float(w)) * F.exp((k - 1) * F.log1p(-v) + m * F.log1p(v))
    return F.least(F.lit(1.0), k * point * reach * total)


def sign_test_pvalue(b: Column, c: Column) -> Column:
    """Two-sided exact sign test on discordant counts b, c:
    min(1, 2*P[X <= min(b,c)]), X ~ Bin(b+c, 1/2)."""
    n = b + c
    return F.when(n == 0, F.lit(1.0)).when(b == c, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), F.lit(2.0) * binomial_half_tail(F.least(b, c), n)))


def promotion_gate(paired: DataFrame, label: str, candidate: str, production: str,
                   alpha: float = 0.05) -> DataFrame:
    """Paired predictions of two models on the same hold-out rows.
    Promote when the candidate is right more often and the sign test on the
    discordant pairs is significant."""
    y = F.col(label).cast("int")
    cand_ok, prod_ok = F.col(candidate).cast("int") == y, F.col(production).cast("int") == y
    counts = paired.agg(F.count_if(cand_ok & ~prod_ok).alias("b"),
                        F.count_if(~cand_ok & prod_ok).alias("c"),
                        F.count(F.lit(1)).alias("n"))
    return (counts.withColumn("p_value", sign_test_pvalue(F.col("b"), F.col("c")))
            .withColumn("promote", (F.col("b") > F.col("c")) & (F.col("p_value") < alpha)))


def daily_psi_vs_trailing(long: DataFrame, edges: DataFrame, ts: str = "ts",
                          window_days: int = S.REFERENCE_WINDOW_DAYS,
                          eps: float = S.PSI_EPSILON, n_bins: int = S.PSI_BINS) -> DataFrame:
    """Each day's distribution vs the previous ``window_days`` days, on
    frozen bin edges ``(feature, edges)``.

    Rows are first counted per (feature, bin, day). Each daily count is then
    credited to the ``window_days`` following days (a fixed fan-out of the
    small daily table, not of the rows), so the reference side of day d is
    the sum of days d-window..d-1. A bin seen on only one side still counts.
    """
    binned = (long.join(F.broadcast(edges), "feature")  # one row per feature
              .groupBy("feature", bin_index(F.col("edges"), F.col("value"), n_bins).alias("bin"),
                       F.to_date(ts).alias("day"))
              .agg(F.count(F.lit(1)).alias("n")))
    ref = (binned.select("feature", "bin", "n", "day",
                         F.explode(F.sequence(F.lit(1), F.lit(window_days))).alias("k"))
           .groupBy("feature", "bin", F.date_add("day", F.col("k")).alias("day"))
           .agg(F.sum("n").alias("ref_n")))
    days = binned.select("day").distinct()
    full = (binned.join(ref, ["feature", "bin", "day"], "full")
            .join(days, "day", "left_semi")          # only days that have data
            .fillna(0, ["n", "ref_n"]))
    tot = Window.partitionBy("feature", "day")      # bins of one feature-day
    full = (full.withColumn("cur_total", F.sum("n").over(tot))
            .withColumn("ref_total", F.sum("ref_n").over(tot)))
    pc = F.col("n") / F.greatest(F.col("cur_total"), F.lit(1)) + F.lit(eps)
    pr = F.col("ref_n") / F.greatest(F.col("ref_total"), F.lit(1)) + F.lit(eps)
    return (full.where((F.col("ref_total") > 0) & (F.col("cur_total") > 0))
            .groupBy("feature", "day")
            .agg(F.sum((pc - pr) * F.log(pc / pr)).alias("psi"),
                 F.max("cur_total").alias("n_day"), F.max("ref_total").alias("n_reference")))
