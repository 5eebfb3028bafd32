"""Daily roll-ups merged into weeks and months, against the rows themselves."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import metrics, rollup

START = np.datetime64("2024-01-10")


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    n = 6000
    day = rng.integers(0, 80, n)
    skewed = np.exp(rng.normal(0, 2, n) + day / 40) * rng.choice([-1, 1], n, p=[0.2, 0.8])
    flat = np.where(rng.random(n) < 0.1, 0.0, rng.normal(50, 5, n))
    frame = [(str(START + int(d)), float(a), None if i % 31 == 0 else float(b), float("nan") if i % 47 == 0 else 1.0, int(i % 3 == 0), int(a > 1))
             for i, (d, a, b) in enumerate(zip(day, skewed, flat))]
    return spark.createDataFrame(frame, "day string, skewed double, flat double, odd double, label int, prediction int").withColumn("ts", F.to_timestamp("day")).drop("day").cache()


def test_bins_hold_their_values_within_the_accuracy(spark):
    values = [0.0, 1e-305, 1.0, -1.0, 1.0000001, 3.7e-200, -2.5e250, 1e308, 123.456, math.pi]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", rollup.value_bin(F.col("v")).alias("k")).withColumn("m", rollup.bin_value(F.col("k"))).collect():
        assert abs(r["m"] - r["v"]) <= rollup.ACCURACY * 1.001 * abs(r["v"]) or abs(r["v"]) <= rollup.SMALLEST
    order = df.orderBy("v").select(rollup.value_bin(F.col("v")).alias("k")).collect()
    assert [r[0] for r in order] == sorted(r[0] for r in order)


@pytest.mark.parametrize("period", ["day", "week", "month"])
def test_costs_are_exact(rows, period):
    got = {r["period_start"]: r for r in rollup.costs_by(rollup.daily_confusion(rows, "ts", "label", "prediction"), period).collect()}
    direct = metrics.rates_from_confusion(metrics.confusion_counts(rows.withColumn("p", F.to_date(F.date_trunc(period, "ts"))), "label", "prediction", ("p",)))
    want = {r["p"]: r for r in direct.collect()}
    assert got.keys() == want.keys()
    for p, r in want.items():
        assert all(got[p][c] == r[c] for c in ("tp", "fp", "fn", "tn", "n", "expected_cost_per_case", "f1"))
    assert sum(r["days"] for r in got.values()) == 80


def test_merged_quantiles_are_within_the_accuracy(rows):
    q = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    bins = rollup.merged_bins(rollup.daily_values(rows, "ts", ["skewed", "flat", "odd"]), "month")
    got = {(r["feature"], r["period_start"].month, r["i"]): r["quantile"] for r in rollup.merged_quantiles(bins, q).collect()}
    pdf = rows.toPandas()
    for name in ("skewed", "flat", "odd"):
        for month, part in pdf.groupby(pdf.ts.dt.month):
            x = np.sort(part[name].dropna().to_numpy())
            for i, f in enumerate(q):
                want = x[math.floor((len(x) - 1) * f)]
                assert abs(got[name, month, i] - want) <= 1.001 * rollup.ACCURACY * abs(want) + 1e-299


@pytest.mark.parametrize("period", ["week", "month"])
def test_psi_of_merged_windows(rows, period):
    """Equal to the PSI by deciles at bin ends; near the one by exact deciles: a decile moves by at most
    the rows of one bin, so the shares of a class differ by no more than the rows of two."""
    got = {(r["feature"], r["period_start"]): r for r in rollup.psi_by(rollup.daily_values(rows, "ts", ["skewed"]), period).collect()}
    pdf = rows.toPandas()
    freq = {"week": "W-SUN", "month": "M"}[period]
    parts = [(p.start_time.date(), g["skewed"].to_numpy()) for p, g in pdf.groupby(pdf.ts.dt.to_period(freq))]
    assert len(got) == len(parts) - 1
    for (_, ref), (start, cur) in zip(parts, parts[1:]):
        edges = np.quantile(ref, np.linspace(0, 1, 11))[1:-1]
        share = lambda x: np.bincount(np.searchsorted(edges, x, side="left"), minlength=10) / len(x) + 1e-6
        exact = ((share(cur) - share(ref)) * np.log(share(cur) / share(ref))).sum()
        r = got["skewed", start]
        assert (r["n"], r["n_reference"]) == (len(cur), len(ref))
        assert abs(r["psi"] - exact) < 0.05 + 0.1 * exact


def test_periods_and_empty_input(spark, rows):
    with pytest.raises(ValueError, match="fortnight"):
        rollup.costs_by(rollup.daily_confusion(rows, "ts", "label", "prediction"), "fortnight")
    assert rollup.psi_by(rollup.daily_values(rows.limit(0), "ts", ["flat"]), "week").count() == 0
