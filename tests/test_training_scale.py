"""Steps of the training queries that once grew faster than their input."""

import math

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.columns import round_half_up
from riskframe.operators import logistic, models, selection, split
from riskframe.sources import readers


def test_column_quantiles_match_numpy(spark):
    rng = np.random.default_rng(8)
    x, k = np.round(rng.normal(0, 50, 3001), 2), rng.integers(-3, 4, 3001)
    x[:7] = [math.inf, -math.inf, 1e-300, -1e-300, 0.0, -0.0, 1e300]
    rows = [(float(a), int(b), None if i % 3 else float(a), float("nan")) for i, (a, b) in enumerate(zip(x, k))]
    df = spark.createDataFrame(rows, "x double, k long, some double, none double").repartition(5)
    fr = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = selection.column_quantiles(df, ["x", "k", "some", "none"], fr)
    assert sorted(got) == ["k", "some", "x"]
    for name, v in (("x", x), ("k", k.astype(float)), ("some", x[::3])):
        assert np.allclose(got[name][1:-1], np.quantile(v, fr[1:-1]), rtol=1e-15, atol=0)
        assert [got[name][0], got[name][-1]] == [v.min(), v.max()]
    assert selection.column_quantiles(df.limit(0), ["x"], [0.5]) == {}


def test_half_up_is_sparks_round(spark):
    v = [0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, 4503599627370497.5, 1e17, -0.2, 123456.5, 3.0, None]
    df = spark.createDataFrame([(a,) for a in v], "a double")
    same = round_half_up("a").cast("long").eqNullSafe(F.round("a").cast("long"))
    assert df.where(~same).isEmpty()


def test_class_ranks_stay_in_the_jvm(spark):
    """Ranks by place in the sorted partition: no row goes through Python, null labels and equal keys count."""
    rows = [(i % 41, None if i % 7 == 0 else i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, label int").repartition(6)
    ranked = split._class_ranks(df, F.col("id"), "label", 42)
    assert ranked.columns == ["id", "label", "__rank"]
    by = {}
    for r in ranked.collect():
        by.setdefault(r["label"], []).append(r["__rank"])
    assert {k: sorted(v) for k, v in by.items()} == {k: list(range(1, len(v) + 1)) for k, v in by.items()}
    assert sum(map(len, by.values())) == 400


def test_blocks_hold_every_row_once(spark):
    rows = [Row(k=i % 2, trains=i % 3 > 0, y=i % 5 % 2, x=[float(i), 1.0]) for i in range(300)]
    blocks = logistic.in_blocks(spark.createDataFrame(rows, "k int, trains boolean, y int, x array<double>").coalesce(2)).collect()
    assert len(blocks) <= 2 * 8
    got = sorted((b["k"], b["trains"], b["y"], *x) for b in blocks for x in np.frombuffer(b["x"]).reshape(b["n"], -1).tolist())
    assert got == sorted((r.k, r.trains, r.y, *r.x) for r in rows)


def test_one_point_searches_keep_no_fold_in_memory(spark):
    rows = [(f"r{i}", float(i % 17), "ab"[i % 2], i % 3 % 2, i % 5) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id string, v double, c string, label int, fold int")
    seen = []
    old = models.evaluator_of

    def watched(scoring):
        ev = old(scoring)
        evaluate = ev.evaluate
        ev.evaluate = lambda d: (seen.append(d.storageLevel.useMemory), evaluate(d))[1]
        seen.append(spark._jsc.sc().getPersistentRDDs().size())
        return ev
    models.evaluator_of = watched
    try:
        found = models.tune_with_cv(models.learner("dummy"), df, ["v"], ["c"])
    finally:
        models.evaluator_of = old
    assert len(found.all_metrics) == 1 and not any(seen[1:])


def test_headers_are_found_without_sorting_the_lines(spark, tmp_path):
    for name, head in (("a", "k;v"), ("b", "extra; v ;k")):
        (tmp_path / f"{name}.csv").write_text("\n".join([head] + [";".join("7" for _ in head.split(";"))] * 50) + "\n")
    found = readers.headers_by_file(spark, str(tmp_path), ";", ("k", "v"))
    assert sorted(found) == [("extra", "v", "k"), ("k", "v")] and all(len(v) == 1 for v in found.values())
    df = readers.read_delimited(spark, str(tmp_path), {"k": T.LongType(), "v": T.LongType()}, sep=";", with_source=False)
    assert [tuple(r) for r in df.distinct().collect()] == [(7, 7)] and df.count() == 100
    (tmp_path / "c.csv").write_text("k;w\n1;2\n")
    with pytest.raises(ValueError, match="missing columns"):
        readers.headers_by_file(spark, str(tmp_path), ";", ("k", "v"))


def _gappy(spark, n=400):
    """Rows with missing numbers and levels, and a level that only fold 1 has."""
    rng = np.random.default_rng(11)
    rows = [(None if i % 13 == 0 else float("nan") if i % 17 == 0 else float(v), int(w), None if i % 19 == 0 else "z" if i % 31 == 1 and i % 5 == 1 else "ab"[i % 2],
             int(v + w / 9 + rng.normal() > 0), i % 5) for i, (v, w) in enumerate(zip(rng.normal(0, 2, n), rng.integers(-9, 10, n)))]
    return spark.createDataFrame(rows, "v double, w int, c string, label int, fold int").repartition(3)


@pytest.mark.parametrize("technique", ["none", "pca", "lda"])
def test_array_preparation_is_the_transform(spark, technique):
    from pyspark.ml.functions import vector_to_array
    from riskframe.operators.features import in_arrays
    df = _gappy(spark)
    pipe, _ = models.build_pipeline(models.learner("logistic_regression"), ["v", "w"], ["c"], technique)
    fitted = models.Pipeline(stages=pipe.getStages()[:-1]).fit(df.where("fold <> 1"))  # level z is unknown then
    arrays = in_arrays(fitted)
    got = fitted.transform(df).select("v", "w", "c", vector_to_array("reduced").alias("x")).collect()
    names = [None, "a", "b", "z"]
    x = arrays([np.array([float("nan") if r[c] is None else r[c] for r in got]) for c in ("v", "w")], [(np.array([names.index(r["c"]) for r in got]), names)], 9)
    assert x.shape == (9, len(got)) and arrays.width == len(got[0]["x"]) and not x[arrays.width:].any()
    assert np.allclose(x[:arrays.width].T, [r["x"] for r in got], rtol=1e-12, atol=1e-12)


def test_search_keeps_no_training_row_in_memory(spark, monkeypatch):
    """The executors' heap holds no copy of the training rows while the search runs, and no fold's prepared rows are stored."""
    held, tables = [], []
    fit, write = logistic.fit_stack, models.write_once
    monkeypatch.setattr(logistic, "fit_stack", lambda *a: held.append(spark._jsc.sc().getPersistentRDDs().size()) or fit(*a))
    monkeypatch.setattr(models, "write_once", lambda *a, **k: tables.append(write(*a, **k)) or tables[-1])
    before = spark._jsc.sc().getPersistentRDDs().size()
    found = models.tune_with_cv(models.learner("logistic_regression"), _gappy(spark), ["v", "w"], ["c"])
    assert held == [before] and len(found.all_metrics) == 8 and found.cv_mean > 0.5
    from riskframe.session import path_exists
    assert len(tables) == 1 and not any(path_exists(spark, f) for f in tables[0].inputFiles())


def test_medians_without_each_fold_share_their_passes(spark):
    df = _gappy(spark).withColumn("fold", F.expr("if(w = 3, null, fold)"))
    got = selection.column_quantiles_without(df, ["v", "w"], [0.5, 0.9], "fold", (0, 3))
    assert sorted(got, key=str) == [0, 3, None]
    for k, found in got.items():
        assert found == selection.column_quantiles(df if k is None else df.where(F.col("fold") != k), ["v", "w"], [0.5, 0.9])
