import math

import pytest

import numpy as np
from pyspark.sql import functions as F

from riskframe.operators import metrics, monitor
from riskframe.operators.ordered import running_sums


def _frame(spark, y, p, s=None):
    rows = [(int(a), int(b), None if s is None else float(c))
            for a, b, c in zip(y, p, s if s is not None else [0] * len(y))]
    return spark.createDataFrame(rows, "label int, prediction int, score double")


def test_scores_that_part_the_classes(spark):
    """Three positives above four negatives: every ranking and class metric is at its best; with one
    class turned over, the ranking stays and the class metrics follow by hand."""
    s = [0.9, 0.2, 0.8, 0.1, 0.3, 0.7, 0.25]
    y = [1, 0, 1, 0, 0, 1, 0]
    best = metrics.evaluate(_frame(spark, y, y, s), "label", "prediction", "score").first()
    assert all(best[k] == 1.0 for k in ("accuracy", "precision", "recall", "f1", "roc_auc", "average_precision"))
    one_off = metrics.evaluate(_frame(spark, y, [1, 0, 1, 0, 1, 1, 0], s), "label", "prediction", "score").first()
    assert (one_off["roc_auc"], one_off["recall"], one_off["precision"]) == (1.0, 1.0, 3 / 4)
    assert one_off["accuracy"] == 6 / 7 and one_off["f1"] == 6 / 7


def test_costs_by_hand(spark):
    """Eleven cases: two missed, three false alarms, four caught, two rightly passed over."""
    y = [1] * 6 + [0] * 5
    p = [0, 0, 1, 1, 1, 1, 1, 1, 1, 0, 0]
    m = metrics.evaluate(_frame(spark, y, p), "label", "prediction").first()
    assert (m["fn"], m["fp"], m["tp"], m["tn"]) == (2, 3, 4, 2)
    assert m["expected_cost_per_case"] == (2 * 5 + 3 * 1) / 11
    assert m["capture_rate"] == 4 / 6 and m["false_alarm_rate"] == 3 / 5
    assert abs(m["positives_caught_over_random"] - (4 - 6 * 6 / 11)) < 1e-12
    dear = metrics.evaluate(_frame(spark, y, p), "label", "prediction", cost_fn=2.0, cost_fp=7.0).first()
    assert dear["expected_cost_per_case"] == (2 * 2 + 3 * 7) / 11


def _brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (
        len(pos) * len(neg))


def _brute_ap(y, s):
    ap, prev, P = 0.0, 0.0, y.sum()
    for t in np.unique(s)[::-1]:
        m = s >= t
        tp = y[m].sum()
        ap += (tp / P - prev) * tp / m.sum()
        prev = tp / P
    return ap


def test_auc_ap_with_ties_match_brute_force(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400) * 0.5 + y * 0.2, 2)      # many ties
    df = _frame(spark, y, (s > 0.4).astype(int), s)
    auc = metrics.roc_auc(df, "label", "score").first()["roc_auc"]
    ap = metrics.average_precision(df, "label", "score").first()["average_precision"]
    assert abs(auc - _brute_auc(y, s)) < 1e-12
    assert abs(ap - _brute_ap(y, s)) < 1e-12


def test_single_class_gives_null_auc(spark):
    df = _frame(spark, [1, 1, 1], [1, 0, 1], [0.2, 0.3, 0.9])
    m = metrics.evaluate(df, "label", "prediction", "score").first()
    assert m["roc_auc"] is None and m["tp"] == 2 and m["fn"] == 1


def test_running_sums_of_many_partitions_equal_those_of_one(spark):
    # one hot group holding most rows, one small group
    rows = [("hot", float(i % 997), 1) for i in range(20000)] + [("cold", float(i), 2) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, v double, w int").groupBy("g", "v").agg(F.sum("w").alias("w"))
    a = running_sums(df, ["g"], "v", ["w"], partitions=16).orderBy("g", "v").collect()
    b = running_sums(df, ["g"], "v", ["w"], partitions=1).orderBy("g", "v").collect()
    assert [(r.g, r.v, r.cum_w) for r in a] == [(r.g, r.v, r.cum_w) for r in b]


def test_subgroup_audit(spark):
    rows = [(1, 1, "a"), (0, 0, "a"), (1, 0, "b"), (0, 1, "b")]
    df = spark.createDataFrame(rows, "label int, prediction int, g string")
    out = {(r["dimension"], r["level"]): r for r in
           metrics.subgroup_audit(df, "label", "prediction", ["g"]).collect()}
    assert out[("g", "a")]["f1"] == 1.0 and out[("g", "b")]["f1"] == 0.0
    assert out[("overall", "all")]["f1"] == 0.5 and out[("g", "a")]["flag"]


def test_sign_test_exact(spark):
    df = spark.createDataFrame([(3, 12), (0, 0), (10, 10)], "b long, c long")
    got = [r[0] for r in df.select(monitor.sign_test_pvalue(F.col("b"), F.col("c"))).collect()]

    def exact(b, c):
        n, m = b + c, min(b, c)
        return 1.0 if n == 0 else min(1.0, 2 * sum(math.comb(n, k) for k in range(m + 1)) / 2 ** n)
    for g, (b, c) in zip(got, [(3, 12), (0, 0), (10, 10)]):
        assert abs(g - exact(b, c)) < 1e-12


@pytest.mark.parametrize("b,c", [(9, 11), (20, 0), (1, 0), (7, 8), (15, 18), (0, 1000), (400, 600), (49_500, 50_400), (49_600, 50_500),
                                 (4_990_000, 5_010_000), (4_998_000, 5_002_000)])
def test_sign_test_is_exact_at_every_size(spark, b, c):
    """Against a sum from the largest term down, in plain floats."""
    n, m = b + c, min(b, c)
    term = math.exp(math.lgamma(n + 1) - math.lgamma(m + 1) - math.lgamma(n - m + 1) - n * math.log(2))
    terms, k = [term], m
    while k and terms[-1] > term * 1e-20:
        terms.append(terms[-1] * k / (n - k + 1))
        k -= 1
    want = min(1.0, 2 * math.fsum(terms))
    got = spark.range(1).select(monitor.sign_test_pvalue(F.lit(b).cast("long"), F.lit(c).cast("long"))).first()[0]
    assert got == pytest.approx(want, rel=1e-6 if n > 10**6 else 1e-9)


def test_metrics_without_scores_or_rows(spark):
    rows = [(1, 1, None), (0, 0, None)]
    df = spark.createDataFrame(rows, "label int, prediction int, score double")
    m = metrics.evaluate(df, "label", "prediction", "score").collect()
    assert len(m) == 1 and m[0]["accuracy"] == 1.0 and m[0]["roc_auc"] is None
    empty = metrics.evaluate(df.limit(0), "label", "prediction", "score").collect()
    assert len(empty) == 1 and empty[0]["n"] == 0 and empty[0]["f1"] == 0.0
