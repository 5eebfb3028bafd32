import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe.operators.features import (DimReducer, ExactMedianImputer, FisherLDA, ModeImputer,
                                          PopulationStandardScaler, VariancePCA,
                                          build_preprocessor)
from tests.conftest import CATEGORICAL, NUMERIC


def test_exact_median_and_mode(spark):
    df = spark.createDataFrame([(1.0, 2), (2.0, 2), (3.0, 1), (4.0, 1), (None, None),
                                (float("nan"), 3)], "x double, c int")
    med = ExactMedianImputer(["x"]).fit(df)
    assert med.values()["x"] == 2.5                       # Spark's Imputer would say 2.0
    mode = ModeImputer(["c"]).fit(df)
    assert mode.values()["c"] == "1"                       # tie 1/2 -> smallest
    out = mode.transform(med.transform(df)).collect()
    assert out[4]["x"] == 2.5 and out[4]["c"] == 1 and out[5]["x"] == 2.5


def test_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    m = PopulationStandardScaler(["x"], ["z"]).fit(df)
    mean, std = m.stats()["x"]
    assert mean == 2.5 and abs(std - np.std([1, 2, 3, 4])) < 1e-12
    const = PopulationStandardScaler(["x"], ["z"]).fit(df.select(F.lit(5.0).alias("x")))
    assert const.stats()["x"][1] == 1.0


def test_preprocessor_shape_and_leakage(clinical):
    train, test = clinical.where("id % 3 <> 1"), clinical.where("id % 3 = 1")
    model = build_preprocessor(NUMERIC, CATEGORICAL).fit(train)
    width = len(model.transform(test).select("features").first()[0])
    levels = sum(train.select(c).distinct().count() for c in CATEGORICAL)
    assert width == len(NUMERIC) + levels
    # a pipeline sees all rows and fits on the training rows: other test rows change no fitted value,
    # other training rows do
    def fitted(rows):
        m = build_preprocessor(NUMERIC, CATEGORICAL).fit(rows.where("id % 3 <> 1"))
        return m.stages[0].values(), m.stages[1].stats(), m.stages[2].values()

    shifted = lambda which: clinical.withColumn("weight", F.when(F.expr(which), F.col("weight") * 3 + 50).otherwise(F.col("weight")))
    assert fitted(shifted("id % 3 = 1")) == fitted(clinical)
    assert fitted(shifted("id % 3 = 2")) != fitted(clinical)


def test_unknown_category_is_all_zeros(clinical):
    model = build_preprocessor([], ["gluc"]).fit(clinical.where("gluc IN (1, 2)"))
    unseen = clinical.where("gluc = 3")
    assert unseen.count() > 0
    for r in model.transform(unseen).select("features").collect():
        assert len(r[0]) == 2 and sum(r[0].toArray()) == 0.0
    assert model.transform(clinical.where("gluc = 2")).select("features").first()[0].toArray().tolist() == [0.0, 1.0]


def test_pca_variance_and_k(clinical):
    pre = build_preprocessor(NUMERIC, CATEGORICAL).fit(clinical).transform(clinical)
    two = VariancePCA("features", "reduced", k=2).fit(pre)
    assert len(two.transform(pre).select("reduced").first()[0]) == 2
    auto = VariancePCA("features", "reduced", k=0, varianceRatio=0.95).fit(pre)
    d = len(pre.select("features").first()[0])
    assert 1 <= auto.output_dim <= d and sum(auto.explained_variance) >= 0.95 - 1e-9


def test_lda_one_component_and_separation(clinical):
    pre = build_preprocessor(NUMERIC, CATEGORICAL).fit(clinical).transform(clinical)
    m = FisherLDA("features", "reduced", "label").fit(pre)
    out = m.transform(pre).select("label", vector_to_array("reduced")[0].alias("z"))
    assert m.output_dim == 1
    means = {r["label"]: r["m"] for r in out.groupBy("label").agg(F.avg("z").alias("m")).collect()}
    assert means[1] != means[0]


def test_lda_requires_label(clinical):
    pre = build_preprocessor(NUMERIC, CATEGORICAL).fit(clinical).transform(clinical)
    with pytest.raises(ValueError):
        FisherLDA("features", "reduced", "label").fit(pre.drop("label"))
    with pytest.raises(ValueError):
        DimReducer("tsne")


def test_mode_ties_use_numeric_order(spark):
    df = spark.createDataFrame([(10, "b"), (10, "b"), (2, "a"), (2, "a")], "n int, s string")
    vals = ModeImputer(["n", "s"]).fit(df).values()
    assert vals == {"n": "2", "s": "a"}


def test_median_of_integers_is_not_truncated(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "k int")
    out = ExactMedianImputer(["k"], ["k_imp"]).fit(df).transform(df).collect()
    assert out[4]["k_imp"] == 2.5 and out[0]["k_imp"] == 1.0


def test_moments_of_300_columns_with_gaps(spark):
    """Pairwise complete correlations against pandas; large, hardly varying values keep their digits."""
    import pandas as pd
    from riskframe.operators.explore import correlation_pairs
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 12)) @ rng.normal(size=(12, 300)) + rng.normal(size=(400, 300))
    x[:, 7] = 1e9 + x[:, 7]
    x[:, 8] = 4.0
    x[rng.random(x.shape) < 0.1] = np.nan
    cols = [f"c{i}" for i in range(300)]
    want = pd.DataFrame(x, columns=cols)
    df = spark.createDataFrame([tuple(None if np.isnan(v) and i % 2 else float(v) for i, v in enumerate(r)) for r in x], ", ".join(f"{c} double" for c in cols)).repartition(5)
    rows = correlation_pairs(df, cols).collect()
    corr, held = want.corr().to_numpy(), want.notna().to_numpy().astype(int)
    both = held.T @ held
    assert len(rows) == 300 * 299 // 2
    for r in rows:
        i, j = int(r["col_a"][1:]), int(r["col_b"][1:])
        assert r["n"] == both[i, j]
        if 8 in (i, j):
            assert r["corr"] is None
        else:
            assert abs(r["corr"] - corr[i, j]) < (1e-5 if 7 in (i, j) else 1e-10)


def test_projections_by_their_invariants(clinical):
    pre = build_preprocessor(NUMERIC, CATEGORICAL).fit(clinical).transform(clinical).cache()
    rows = pre.select(vector_to_array("features").alias("x"), "label").collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows])
    full = VariancePCA("features", "reduced", k=x.shape[1]).fit(pre)
    z = np.array([r[0] for r in full.transform(pre).select(vector_to_array("reduced")).collect()])
    cov = np.cov(z.T)
    assert np.allclose(z.mean(axis=0), 0, atol=1e-10) and np.allclose(cov, np.diag(np.diag(cov)), atol=1e-9)
    assert np.allclose(np.diag(cov).sum(), np.trace(np.cov(x.T))) and np.allclose(full.explained_variance, np.diag(cov) / np.diag(cov).sum())
    lda = FisherLDA("features", "reduced", "label").fit(pre)
    z = np.array([r[0][0] for r in lda.transform(pre).select(vector_to_array("reduced")).collect()])
    within = sum(((z[y == c] - z[y == c].mean()) ** 2).sum() for c in (0, 1)) / (len(z) - 2)
    assert abs(within - 1) < 1e-8
    # no other direction parts the classes better
    ratio = lambda v: (v[y == 1].mean() - v[y == 0].mean()) ** 2 / sum(((v[y == c] - v[y == c].mean()) ** 2).sum() for c in (0, 1))
    rng = np.random.default_rng(1)
    assert all(ratio(x @ rng.normal(size=x.shape[1])) <= ratio(z) + 1e-12 for _ in range(200))


def test_components_as_a_share_of_the_variance(clinical):
    pre = build_preprocessor(NUMERIC, CATEGORICAL).fit(clinical).transform(clinical)
    few, more = (DimReducer("pca", share).fit(pre) for share in (0.3, 0.8))
    assert 1 <= few.output_dim < more.output_dim
    assert sum(few.explained_variance) >= 0.3 > sum(few.explained_variance[:-1])
    assert DimReducer("pca", 2).fit(pre).output_dim == 2 and DimReducer("none").fit(pre).output_dim is None
    for technique, n in (("pca", 1.5), ("lda", 0.5), ("pca", -1)):
        with pytest.raises(ValueError, match="share"):
            DimReducer(technique, n)
