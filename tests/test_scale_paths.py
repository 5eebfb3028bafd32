"""Two-level running sums give the same answers however the rows are parted: all in one
partition, or many partitions with groups that go on from one to the next."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import drift, metrics, ordered, split


def _collect(df, cols, order):
    return [tuple(r[c] for c in cols) for r in df.orderBy(*order).collect()]


@pytest.fixture(params=["one partition", "many partitions"])
def parted(spark, request):
    """Small shuffles are coalesced into one partition, or left as 8 range partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(request.param == "one partition").lower())
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _scored(spark):
    rng = np.random.default_rng(11)
    y = rng.integers(0, 2, 3000)
    s = np.round(rng.random(3000) * 0.6 + y * 0.2, 3)
    g = np.where(rng.random(3000) < 0.8, "hot", "cold")       # one dominant group
    rows = [(int(a), float(b), str(c), int(b > 0.5)) for a, b, c in zip(y, s, g)]
    return spark.createDataFrame(rows, "label int, score double, g string, prediction int")


def _metrics(spark):
    df = _scored(spark)
    m = metrics.evaluate(df, "label", "prediction", "score", ("g",))
    return _collect(m, ["g", "roc_auc", "average_precision", "f1"], ["g"])


def test_metrics_of_any_parting(spark, parted):
    rows = _scored(spark).collect()
    got = {g: (auc, ap) for g, auc, ap, _ in _metrics(spark)}
    for g in ("hot", "cold"):
        y = np.array([r["label"] for r in rows if r["g"] == g])
        s = np.array([r["score"] for r in rows if r["g"] == g])
        below = (s[y == 1][:, None] > s[y == 0]).mean() + (s[y == 1][:, None] == s[y == 0]).mean() / 2
        at = [((y[s >= t] == 1).mean(), (y[s == t] == 1).sum() / (y == 1).sum()) for t in np.unique(s)]
        assert abs(got[g][0] - below) < 1e-12 and abs(got[g][1] - sum(p * w for p, w in at)) < 1e-12


def _drift(spark):
    rng = np.random.default_rng(5)
    ref = spark.createDataFrame([(float(x), float(round(x, 1))) for x in rng.normal(0, 1, 3000)],
                                "x double, xr double")
    cur = spark.createDataFrame([(float(x), float(round(x, 1))) for x in rng.normal(0.3, 1, 2000)],
                                "x double, xr double")
    rep = drift.drift_report(ref, cur, ["x", "xr"])
    q = drift.exact_quantiles(drift.to_long(ref, ["x", "xr"]), drift.linspace(10))
    return (_collect(rep, ["feature", "psi", "ks_statistic"], ["feature"]),
            _collect(q, ["feature", "i", "quantile"], ["feature", "i"]))


def test_drift_of_any_parting(spark, parted):
    report, quantiles = _drift(spark)
    rng = np.random.default_rng(5)
    ref = [float(x) for x in rng.normal(0, 1, 3000)]
    cur = [float(x) for x in rng.normal(0.3, 1, 2000)]
    for name, a, b in (("x", ref, cur), ("xr", [round(v, 1) for v in ref], [round(v, 1) for v in cur])):
        a, b = np.sort(a), np.sort(b)
        both = np.concatenate([a, b])
        gap = np.abs(np.searchsorted(a, both, "right") / len(a) - np.searchsorted(b, both, "right") / len(b)).max()
        assert abs(next(r[2] for r in report if r[0] == name) - gap) < 1e-12
        assert [r[2] for r in quantiles if r[0] == name] == list(np.quantile(a, drift.linspace(10)))


def test_exact_split_of_any_parting(spark, clinical, parted):
    key = F.col("id").cast("string")
    from riskframe.functions.columns import hash_uniform
    rows = clinical.select("id", "label", hash_uniform(key, 42).alias("u")).collect()
    rank = {}
    for c in (0, 1):
        for i, r in enumerate(sorted((r for r in rows if r["label"] == c), key=lambda r: (r["u"], str(r["id"])))):
            rank[r["id"]] = i
    folds = _collect(split.stratified_folds(clinical, key, "label", 5, 42), ["id", "fold"], ["id"])
    assert folds == [(i, rank[i] % 5) for i in sorted(rank)]
    quota = split.class_quotas([(c, sum(r["label"] == c for r in rows)) for c in (0, 1)], 0.2)
    labels = {r["id"]: r["label"] for r in rows}
    assert _collect(split.exact_stratified_split(clinical, key, "label", 42), ["id", "split"], ["id"]) == [
        (i, "test" if rank[i] < quota[labels[i]] else "train") for i in sorted(rank)]


def test_running_sums_of_20_000_groups_and_one_of_10_million_rows(spark):
    """Small groups beside one that fills most partitions; the sums of row numbers are known."""
    big, small = 10_000_000, 20_000
    rows = (spark.range(big).select(F.lit(7_000).alias("g"), F.col("id").alias("v"), F.lit(1).alias("w"))
            .union(spark.range(small * 3).select((F.col("id") % small).cast("int").alias("g"), (-1 - F.floor(F.col("id") / small)).alias("v"), F.lit(2).alias("w"))))
    got = ordered.running_sums(rows, ["g"], "v", ["w"], partitions=16)
    small_sum = F.when(F.col("v") < 0, 2 * (4 + F.col("v")))  # the rows -3, -2, -1 of each group
    want = F.when(F.col("g") == 7_000, F.coalesce(small_sum, 6 + 1 + F.col("v"))).otherwise(small_sum)
    out = got.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("cum_w") != want).alias("wrong"), F.countDistinct("g").alias("groups")).first()
    assert (out["n"], out["wrong"], out["groups"]) == (big + 3 * small, 0, small)


def test_null_groups_and_null_values(spark):
    rows = [(None, 1.0, 3), (None, 2.0, None), (None, 3.0, 4), ("a", 1.0, 1)]
    df = spark.createDataFrame(rows, "g string, v double, w int").withColumn("__o", F.lit("mine")).withColumn("__p", F.lit("too"))
    for parts in (1, 4):
        got = ordered.running_sums(df, ["g"], "v", ["w"], partitions=parts)
        assert got.columns == [*df.columns, "cum_w"]
        assert sorted((r["g"] or "", r["v"], r["cum_w"], r["__o"]) for r in got.collect()) == [
            ("", 1.0, 3, "mine"), ("", 2.0, 3, "mine"), ("", 3.0, 7, "mine"), ("a", 1.0, 1, "mine")]


def test_running_sums_of_fractions(spark):
    rng = np.random.default_rng(8)
    rows = [(int(g), float(v), float(w)) for g, v, w in zip(rng.integers(0, 3, 4000), rng.permutation(4000), rng.random(4000) * 10.0 ** rng.integers(-9, 9, 4000))]
    got = ordered.running_sums(spark.createDataFrame(rows, "g int, v double, w double"), ["g"], "v", ["w"], partitions=7).collect()
    for g in range(3):
        mine = sorted((r["v"], r["w"], r["cum_w"]) for r in got if r["g"] == g)
        assert np.allclose(np.cumsum([x[1] for x in mine]), [x[2] for x in mine], rtol=1e-12)


def test_descending_running_sums_with_buckets(spark):
    rows = [("a", float(v), 1) for v in range(500)]
    df = spark.createDataFrame(rows, "g string, v double, w int")
    a = ordered.running_sums(df, ["g"], "v", ["w"], descending=True, partitions=6)
    got = {r["v"]: r["cum_w"] for r in a.collect()}
    assert all(got[float(v)] == 500 - v for v in range(500))


def test_selection_matches_rank_quantiles(spark):
    from riskframe.operators import selection
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(0, 1, 5000), np.full(3000, 1.25), rng.integers(0, 4, 2000)])
    long = spark.createDataFrame([("x", float(v)) for v in x] + [("y", float(v) * 3) for v in x[:700]],
                                 "feature string, value double")
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cnt"))
    fr = drift.linspace(10) + [0.5, 0.01]
    by_rank = _collect(drift.quantiles_by_ranks(counts, fr), ["feature", "i", "quantile"],
                       ["feature", "i"])
    for splitters in (512, 5, 1):        # nearly every cell is settled at once, or none
        sel = _collect(selection.select_quantiles(long, fr, splitters=splitters),
                       ["feature", "i", "quantile"], ["feature", "i"])
        assert sel == by_rank
    assert [v for f, i, v in by_rank if f == "x"] == list(np.quantile(x, fr))


def test_selection_extreme_values(spark):
    from riskframe.operators import selection
    vals = [-1.7e308, -1.0, 0.0, 2.0, 1.7e308, 5.0, 5.0]
    long = spark.createDataFrame([("x", v) for v in vals], "feature string, value double")
    fr = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = [r["quantile"] for r in selection.select_quantiles(long, fr, splitters=2).orderBy("i").collect()]
    assert got == list(np.quantile(np.array(vals), fr))
    inf = spark.createDataFrame([("x", v) for v in [float("-inf"), 1.0, 2.0, float("inf")]],
                                "feature string, value double")
    got = [r["quantile"] for r in selection.select_quantiles(inf, [0.0, 0.5, 1.0]).orderBy("i").collect()]
    assert got == [float("-inf"), 1.5, float("inf")]


def test_quantiles_of_many_features_collect_nothing(spark, monkeypatch):
    """1,000 features x 11 fractions; the driver sees no rows while the plan is made."""
    from pyspark.sql.classic.dataframe import DataFrame

    from riskframe.operators import selection
    n, k = 400, 1000
    i = np.arange(n * k)
    f, x = i % k, (i * 7919 % 100_003) / 7.0 * (1 + i % k % 13)
    ids = spark.range(n * k)
    long = ids.select(F.concat(F.lit("f"), F.col("id") % k).alias("feature"), (F.col("id") * 7919 % 100_003 / 7.0 * (1 + F.col("id") % k % 13)).alias("value"))
    with monkeypatch.context() as m:
        for name in ("collect", "toPandas", "take", "head"):
            real = getattr(DataFrame, name)
            m.setattr(DataFrame, name, lambda self, *a, _real=real, _name=name, **kw: (_ for _ in ()).throw(AssertionError(_name))
                      if _name in ("collect", "toPandas") else _real(self, *a, **kw))
        found = selection.select_quantiles(long, drift.linspace(10), splitters=16)
    got = {(r["feature"], r["i"]): r["quantile"] for r in found.collect()}
    assert len(got) == 11 * k
    for c in (0, 9, 500, 999):
        assert [got[f"f{c}", j] for j in range(11)] == list(np.quantile(x[f == c], drift.linspace(10)))
