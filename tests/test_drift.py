import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from riskframe.operators import drift


def _sample(spark, arrays: dict):
    n = len(next(iter(arrays.values())))
    cols = list(arrays)
    rows = [tuple(float(arrays[c][i]) for c in cols) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))


def _counted_psi(r, c, parts=10):
    """By counting each interval between neighbouring deciles of the reference, one by one."""
    cuts = sorted({float(np.quantile(r, k / parts)) for k in range(1, parts)})
    total = 0.0
    for low, high in zip([-math.inf, *cuts], [*cuts, math.inf]):
        was, now = (sum(low <= x < high for x in v) / len(v) + 1e-6 for v in (r, c))
        total += (now - was) * math.log(now / was)
    return total


def _np_ks(x, y):
    x, y = np.sort(x), np.sort(y)
    allv = np.concatenate([x, y])
    return float(np.max(np.abs(np.searchsorted(x, allv, "right") / len(x)
                               - np.searchsorted(y, allv, "right") / len(y))))


def _levels(spark, **columns):
    """Rows with given numbers of each value; None is missing."""
    long = {c: [v for v, n in counts.items() for _ in range(n)] for c, counts in columns.items()}
    rows = zip(*long.values(), strict=True)
    return spark.createDataFrame(list(rows), ", ".join(f"{c} double" for c in long))


def test_order_and_missing_values_do_not_matter(spark):
    """Eight skewed levels; the current sample has them backwards, twice over, and gaps."""
    counts = {float(2 ** k): 64 // 2 ** k + 3 for k in range(8)}
    ref = _levels(spark, wait=counts)
    twice = {v: 2 * n for v, n in reversed(counts.items())}
    cur = _levels(spark, wait={None: 31, float("nan"): 9, **twice})
    rep = drift.drift_report(ref, cur, ["wait"]).first()
    assert abs(rep["psi"]) < 1e-12 and rep["ks_statistic"] == 0.0 and rep["verdict"] == "estavel"
    assert rep["n_cur"] == 2 * rep["n_ref"] == sum(twice.values())


def test_psi_and_ks_of_counted_levels(spark):
    """Shares 4:3:2:1 against 1:2:3:4: PSI = 2 (.3 ln 4 + .1 ln 1.5), and the distributions are furthest
    apart after the second level: .7 against .3."""
    ref = _levels(spark, kind={1.0: 40, 2.0: 30, 3.0: 20, 4.0: 10})
    cur = _levels(spark, kind={1.0: 30, 2.0: 60, 3.0: 90, 4.0: 120})
    rep = drift.drift_report(ref, cur, ["kind"]).first()
    assert abs(rep["psi"] - 2 * (0.3 * math.log(4) + 0.1 * math.log(1.5))) < 1e-4
    assert abs(rep["ks_statistic"] - 0.4) < 1e-12 and rep["verdict"] == "drift" and rep["ks_pvalue"] < 1e-6


def test_statistics_of_a_heavy_tail(spark):
    rng = np.random.default_rng(17)
    r, c = rng.pareto(1.5, 3000), rng.pareto(1.2, 2100) * 1.3
    rep = drift.drift_report(_sample(spark, {"x": r}), _sample(spark, {"x": c}), ["x"]).first()
    assert abs(rep["psi"] - _counted_psi(r, c)) < 1e-9 and abs(rep["ks_statistic"] - _np_ks(r, c)) < 1e-12


def test_verdicts_follow_the_shares_that_moved(spark):
    """Of 100 rows, 2, 17 and 40 move from the first of two levels to the second: PSI .0016, .1204 and
    .8789 for shares of one half; three verdicts in one report."""
    half = {0.0: 50, 1.0: 50}
    moved = lambda k: {0.0: 50 - k, 1.0: 50 + k}
    ref = _levels(spark, little=half, some=half, much=half, same=half)
    cur = _levels(spark, little=moved(2), some=moved(17), much=moved(40), same=half)
    rep = {r["feature"]: r for r in drift.drift_report(ref, cur, ["little", "some", "much", "same"]).collect()}
    for name, k in (("little", 2), ("some", 17), ("much", 40), ("same", 0)):
        a, b = 0.5 - k / 100, 0.5 + k / 100
        assert abs(rep[name]["psi"] - ((a - 0.5) * math.log(a / 0.5) + (b - 0.5) * math.log(b / 0.5))) < 1e-4
    assert [rep[c]["verdict"] for c in ("same", "little", "much")] == ["estavel", "estavel", "drift"]
    assert rep["some"]["verdict"] not in ("estavel", "drift")
    assert drift.any_drift(drift.drift_report(ref, cur, ["little", "much"])).first()[0]
    assert not drift.any_drift(drift.drift_report(ref, cur, ["little", "same"])).first()[0]


def test_exact_ks_pvalue_by_enumeration():
    """All orders of small samples, and the digits of a small p-value."""
    from itertools import combinations
    for m, n in ((3, 4), (5, 5), (2, 7)):
        gaps = []
        for where in combinations(range(m + n), m):
            i = j = gap = 0
            for k in range(m + n):
                i, j = (i + 1, j) if k in where else (i, j + 1)
                gap = max(gap, abs(i * n - j * m))
            gaps.append(gap)
        for d in sorted(set(gaps)):
            want = sum(g >= d for g in gaps) / len(gaps)
            assert abs(drift.ks_exact_pvalue(m, n, d / (m * n)) - want) < 1e-12
    assert abs(drift.ks_exact_pvalue(60, 60, 1.0) / (2 / math.comb(120, 60)) - 1) < 1e-9
    try:
        drift.ks_exact_pvalue(10**9, 10**9, 0.5)
    except ValueError as e:
        assert "asymptotic" in str(e)
    else:
        raise AssertionError("sizes beyond the exact method must be refused")


def test_low_cardinality_and_empty_sample(spark):
    ref = spark.createDataFrame([(1.0, 1.0)] * 55 + [(2.0, None)] * 45, "two double, opt double")
    cur = spark.createDataFrame([(2.0, None)] * 100, "two double, opt double")
    rep = {r["feature"]: r for r in drift.drift_report(ref, cur, ["two", "opt"]).collect()}
    assert rep["two"]["psi"] == 0.0                    # fewer than 3 distinct edges
    assert math.isnan(rep["opt"]["psi"]) and rep["opt"]["verdict"] == "drift"


def test_quantiles_match_numpy(spark):
    x = np.random.default_rng(3).integers(0, 30, 777).astype(float)
    long = _sample(spark, {"x": x}).select(F.lit("x").alias("feature"), F.col("x").alias("value"))
    fr = drift.linspace(10)
    got = [r["quantile"] for r in drift.exact_quantiles(long, fr).orderBy("i").collect()]
    assert np.allclose(got, np.quantile(x, fr), rtol=0, atol=1e-12)


def test_ks_pvalue_series(spark):
    df = spark.createDataFrame([(0.1,), (1.0,), (2.0,)], "lam double")
    got = [r[0] for r in df.select(drift.kolmogorov_pvalue(F.col("lam"))).collect()]
    exact = [1.0] + [2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * l * l) for k in range(1, 101))
                     for l in (1.0, 2.0)]
    assert np.allclose(got, exact, atol=1e-12)


def test_injection_is_deterministic(spark):
    df = spark.range(100).select(F.col("id"), F.lit(50.0).alias("age"), F.lit(120.0).alias("bp"),
                                 F.lit(1).alias("chol"))
    a = drift.inject_drift(df, F.col("id").cast("string"), 42, "age", 3.0, "bp", 7.0, 2.0,
                           "chol", 1, 2, 0.2)
    b = drift.inject_drift(df.repartition(7), F.col("id").cast("string"), 42, "age", 3.0, "bp",
                           7.0, 2.0, "chol", 1, 2, 0.2)
    assert sorted(a.collect()) == sorted(b.collect())
    r = a.agg(F.avg("age"), F.avg("bp"), F.avg("chol")).first()
    assert r[0] == 53.0 and 125 < r[1] < 129 and 1.05 < r[2] < 1.4


def test_kll_edges_close_to_exact(spark):
    rng = np.random.default_rng(8)
    r, c = rng.normal(0, 1, 20000), rng.normal(0.5, 1, 20000)
    ref, cur = _sample(spark, {"x": r}), _sample(spark, {"x": c})
    exact = drift.drift_report(ref, cur, ["x"]).first()
    kll = drift.drift_report(ref, cur, ["x"], method="kll").first()
    assert abs(exact["psi"] - kll["psi"]) < 0.02 and exact["verdict"] == kll["verdict"]
    assert exact["ks_statistic"] == kll["ks_statistic"]


def test_exact_ks_pvalue_matches_enumeration():
    from itertools import combinations
    for m, n in [(5, 4), (6, 6), (3, 7)]:
        total = math.comb(m + n, m)
        stats = []
        for pos in combinations(range(m + n), m):       # positions of the first sample
            a = set(pos)
            i = j = 0
            dmax = 0.0
            for k in range(m + n):
                if k in a:
                    i += 1
                else:
                    j += 1
                dmax = max(dmax, abs(i / m - j / n))
            stats.append(dmax)
        for d in sorted(set(stats))[1:]:
            want = sum(1 for x in stats if x >= d - 1e-12) / total
            assert abs(drift.ks_exact_pvalue(m, n, d) - want) < 1e-12


def test_exact_pvalues_of_large_samples_are_worked_out():
    """The report's tasks refuse no size: here more cells than a call by itself follows."""
    d = 5 / math.sqrt(400_000 * 200_000 / 600_000)
    batch = pa.RecordBatch.from_pylist([{"feature": f, "tot_r": 400_000, "tot_c": 200_000, "ks_statistic": x} for f, x in (("a", d), ("b", 0.06), ("c", None))])
    out, = drift._exact_pvalues(iter([batch]))
    got = out.column("ks_pvalue").to_pylist()
    assert abs(got[0] / (2 * math.exp(-50)) - 1) < 0.03 and got[1:] == [0.0, None]  # b: exp(-950) is no double


def test_small_exact_pvalues_keep_their_digits():
    """D = 1 - 1/60 of 60 and 60 rows: few paths, each of probability 1 / C(120, 60)."""
    total = math.comb(120, 60)
    # by reflection: paths that reach a lead of 59 at either side
    want = 2 * math.comb(120, 1) / total
    assert abs(drift.ks_exact_pvalue(60, 60, 59 / 60) / want - 1) < 1e-12


def test_pvalue_methods_in_report(spark):
    rng = np.random.default_rng(2)
    r, c = rng.normal(0, 1, 300), rng.normal(0.3, 1, 200)
    rep = drift.drift_report(_sample(spark, {"x": r}), _sample(spark, {"x": c}), ["x"],
                             pvalue="exact").first()
    assert abs(rep["ks_pvalue"] - drift.ks_exact_pvalue(300, 200, rep["ks_statistic"])) < 1e-15
    asym = drift.drift_report(_sample(spark, {"x": r}), _sample(spark, {"x": c}), ["x"]).first()
    assert abs(asym["ks_pvalue"] - rep["ks_pvalue"]) < 0.05


def test_psi_report_equals_the_full_report_without_a_value_shuffle(spark):
    rng = np.random.default_rng(3)
    ref = _sample(spark, {"a": rng.normal(0, 1, 3000), "b": np.repeat(2.0, 3000)})
    cur = _sample(spark, {"a": rng.normal(0.4, 1, 2000), "b": np.repeat(2.0, 2000)})
    full = {r["feature"]: (r["psi"], r["verdict"]) for r in drift.drift_report(ref, cur, ["a", "b"]).collect()}
    out = drift.psi_report(ref, cur, ["a", "b"])
    got = {r["feature"]: (r["psi"], r["verdict"]) for r in out.collect()}
    assert got.keys() == full.keys()
    for f in got:
        assert abs(got[f][0] - full[f][0]) < 1e-12 and got[f][1] == full[f][1]
    assert "hashpartitioning(feature, value" not in out._jdf.queryExecution().toString()


def test_a_column_that_the_current_sample_lacks_is_skipped(spark):
    ref = _sample(spark, {"a": np.arange(50.0), "b": np.arange(50.0)})
    assert [r["feature"] for r in drift.drift_report(ref, ref.drop("b"), ["a", "b"]).collect()] == ["a"]
