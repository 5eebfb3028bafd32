import json
import os

import pytest
import tempfile

from pyspark.sql import types as T

from riskframe.operators import drift, quality, runs
from riskframe.sources import readers


def _dir():
    return tempfile.mkdtemp(prefix="riskframe-io-")


def test_run_table_append_and_flatten(spark):
    path = os.path.join(_dir(), "runs")
    runs.append_run(spark, path, "r1", "xgboost__raw", "FINISHED",
                    {"mlflow.runName": "xgboost__raw", "model_family": "xgboost",
                     "dim_technique": "none"}, {"max_depth": 5, "grid": [1, 2]},
                    {"tech.f1": 0.7, "tech.roc_auc": 0.8, "biz.expected_cost_per_case": 0.9,
                     "train.fit_seconds": 12.0})
    runs.append_run(spark, path, "r2", "dummy__raw", "FAILED", {"model_family": "dummy"}, {},
                    {"tech.f1": 0.5})
    t = spark.read.parquet(path)
    flat = runs.flatten_runs(t)
    got = {r["run_id"]: r for r in runs.finished(flat).collect()}
    assert list(got) == ["r1"] and got["r1"]["f1"] == 0.7 and got["r1"]["run_name"] == "xgboost__raw"
    params = t.where("run_id = 'r1'").first()["params"]
    assert params == {"max_depth": "5", "grid": "[1, 2]"}


def test_drift_json_sink(spark):
    ref = spark.createDataFrame([(float(i), float(i % 7)) for i in range(200)], "a double, p double")
    cur = spark.createDataFrame([(float(i) + 50, float(i % 7)) for i in range(200)], "a double, p double")
    rep = drift.drift_report(ref, cur, ["a"], prediction="p")
    path = os.path.join(_dir(), "drift")
    readers.write_drift_report(rep, path)
    files = [f for f in os.listdir(path) if f.endswith(".json")]
    doc = json.loads(open(os.path.join(path, files[0])).read())
    assert [f["feature"] for f in doc["per_feature"]] == ["a"]
    assert doc["prediction_drift"]["feature"] == "prediction"


def test_quality_text(spark):
    df = spark.createDataFrame([(1, 300.0, "a"), (2, None, "a"), (3, 90.0, "b"), (4, 90.0, "a")], "id long, ap_hi double, g string")
    text = quality.quality_text(quality.quality_summary(df, "g"), quality.quality_report(df, inversion=None))
    lines = [r["line"] for r in text.orderBy("line_no").collect()]
    assert lines[:7] == ["== table ==", "rows: 4", "repeated rows: 0", "missing cells: 1", "== class balance ==", "a: 75.00 %", "b: 25.00 %"]
    assert lines[7] == "== findings ==" and any("ap_hi | 1 rows" in x for x in lines[8:])


def test_model_save_and_load(spark, clinical):
    from riskframe.operators import models
    from tests.conftest import CATEGORICAL, NUMERIC
    pipe, _ = models.build_pipeline(models.learner("logistic_regression"),
                                    NUMERIC, CATEGORICAL)
    model = pipe.fit(clinical)
    path = os.path.join(_dir(), "model")
    readers.save_model(model, path, clinical.select(*NUMERIC, *CATEGORICAL))
    again = readers.load_model(path)
    a = model.transform(clinical).select("prediction").collect()
    b = again.transform(clinical).select("prediction").collect()
    assert a == b
    assert os.path.isdir(os.path.join(path, "input_example"))


def test_json_records_and_size_bound(spark):
    reqs = spark.createDataFrame(
        [('{"patients": [{"age_years": 50.0, "gender": 1}, {"age_years": 60.0, "gender": 2}]}',),
         ('{"patients": []}',)], "body string")
    out = readers.parse_records(reqs, "body", "age_years double, gender int")
    rows = out.collect()
    assert sum(1 for r in rows if r["age_years"] is not None) == 2
    assert {r["request_ok"] for r in rows} == {True, False}


def test_scoring_csv_quarantines_bad_rows(spark):
    path = os.path.join(_dir(), "batch.csv")
    with open(path, "w") as f:
        f.write("a,b\n1,2\n3,4,5\n6,7\n")
    good, bad = readers.read_scoring_csv(spark, path, {"a": T.IntegerType(), "b": T.IntegerType()})
    assert sorted(r["a"] for r in good.collect()) == [1, 6]
    assert [r["raw_line"] for r in bad.collect()] == ["3,4,5"]


def test_files_with_other_headers_are_read_by_name(spark):
    from pyspark.sql import types as T
    d = _dir()
    for i, text in enumerate(("x;y\n1;2\n", "y ; x;z\n40;30;q\n")):
        with open(os.path.join(d, f"{i}.csv"), "w") as f:
            f.write(text)
    types = {"x": T.IntegerType(), "y": T.IntegerType()}
    got = {(r["x"], r["y"]) for r in readers.read_delimited(spark, d, types).collect()}
    assert got == {(1, 2), (30, 40)}
    with open(os.path.join(d, "2.csv"), "w") as f:
        f.write("x;other\n1;2\n")
    with pytest.raises(ValueError, match="y"):
        readers.read_delimited(spark, d, types)


def test_scoring_csv_quarantines_with_a_reason(spark):
    from pyspark.sql import types as T
    d = _dir()
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("x | y|z\n1|2.5|a\nabc|1|b\n4||c\n5|6\n")
    good, bad = readers.read_scoring_csv(spark, d, {"x": T.IntegerType(), "y": T.DoubleType()}, "|")
    assert {tuple(r) for r in good.collect()} == {(1, 2.5), (4, None)}
    assert {(r["raw_line"], r["n_fields"], r["reason"]) for r in bad.collect()} == {
        ("abc|1|b", 3, "bad value: x"), ("5|6", 2, "field count")}
