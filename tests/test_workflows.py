import os
import tempfile

from pyspark.sql import functions as F

from riskframe.plans import workflows
from tests.conftest import CATEGORICAL, NUMERIC


def test_experiment_select_load_score(spark, clinical):
    d = tempfile.mkdtemp(prefix="riskframe-flow-")
    key = F.col("id").cast("string")
    ids = workflows.run_experiment(spark, clinical, key, NUMERIC, CATEGORICAL,
                                   f"{d}/runs", f"{d}/models", ["dummy", "logistic_regression"],
                                   ("none",), folds=2)
    assert len(ids) == 2
    ranking = workflows.select_and_register(spark, f"{d}/runs", f"{d}/registry", "risk_model")
    assert ranking.count() == 1                       # the baseline is not a candidate
    model, version = workflows.load_production(spark, f"{d}/registry", f"{d}/models", "risk_model")
    assert version == "1"
    req = clinical.select(*[c for c in NUMERIC + CATEGORICAL]).withColumn(
        "bmi", F.when(F.col("gender") == 1, F.lit(None)).otherwise(F.col("bmi")))
    scored, bad = workflows.score_records(req, model, version)
    assert scored.count() + bad.count() == clinical.count()
    assert scored.where("risk_level IS NULL").count() == 0
    # a second selection archives version 1
    workflows.select_and_register(spark, f"{d}/runs", f"{d}/registry", "risk_model")
    _, v2 = workflows.load_production(spark, f"{d}/registry", f"{d}/models", "risk_model")
    assert v2 == "2"


def test_simulated_drift_flags_shift(spark, clinical):
    out = os.path.join(tempfile.mkdtemp(prefix="riskframe-drift-"), "report")
    rep = workflows.simulate_drift(clinical, F.col("id").cast("string"), "label",
                                   ["age_years", "ap_hi", "cholesterol", "weight"], 42,
                                   "age_years", "ap_hi", "cholesterol", out)
    r = {x["feature"]: x for x in rep.collect()}
    assert r["ap_hi"]["psi"] > r["weight"]["psi"]
    assert os.path.isdir(out)
