"""End-to-end flows (train matrix, select + register, load, drift, score),
each a short composition of the operators. Storage is plain Parquet under
paths the caller chooses (a shared folder on a cluster)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe import schema as S
from riskframe.operators import derive, drift, models, quality, runs, split
from riskframe.sources import readers


def run_experiment(spark: SparkSession, df: DataFrame, key: Column, numeric: list[str],
                   categorical: list[str], runs_path: str, models_dir: str,
                   model_names: list[str] | None = None,
                   techniques: tuple[str, ...] = S.DIM_TECHNIQUES, folds: int = 5) -> list[str]:
    """Every model x reducer is tuned, evaluated on the test split,
    appended to the runs table (S7) and saved (S8). Returns the run ids."""
    ids = []
    example = df.select(*numeric, *categorical)
    for run in models.run_matrix(df, key, numeric, categorical, model_names, techniques, folds):
        run_id = uuid.uuid4().hex
        tags = {"mlflow.runName": run["run_name"], **run["tags"]}
        metrics = {k: v for k, v in run["metrics"].items() if v is not None}
        readers.save_model(run["model"], f"{models_dir}/{run_id}", example)
        runs.append_run(spark, runs_path, run_id, run["run_name"], S.RUN_FINISHED, tags,
                        run["params"], metrics)
        ids.append(run_id)
    return ids


def select_and_register(spark: SparkSession, runs_path: str, registry_path: str,
                        model_name: str, missing_cost: str = "max_f1") -> DataFrame:
    """Finished runs -> composite score -> winner -> new registry version,
    promoted to Production with earlier Production versions archived (K7).
    Returns the ranking."""
    table = runs.flatten_runs(spark.read.parquet(runs_path))
    scored = runs.composite_score(table, missing_cost)
    ranked = runs.rank_runs(scored)
    best = runs.winner(scored).first()
    if best is None:
        raise ValueError("no finished run with an F1 to select from")
    runs.Registry(spark, registry_path).register(model_name, best["run_id"])
    return ranked


def load_production(spark: SparkSession, registry_path: str, models_dir: str,
                    model_name: str, stage: str = "Production"):
    """S9 + K6: the model of ``stage``, else the highest version."""
    v = runs.Registry(spark, registry_path).resolve(model_name, stage).first()
    if v is None:
        raise RuntimeError(f"model {model_name!r} is not registered")
    return readers.load_model(f"{models_dir}/{v['run_id']}"), str(v["version"])


def simulate_drift(df: DataFrame, key: Column, label: str, features: list[str], seed: int,
                   shift_col: str, noisy_col: str, level_col: str,
                   out_path: str | None = None) -> DataFrame:
    """reference = training split, current = perturbed test split (P12);
    PSI + KS per feature; optionally written as JSON (S10)."""
    d = split.exact_stratified_split(df, key, label, seed)
    ref = d.where(F.col("split") == "train")
    cur = drift.inject_drift(d.where(F.col("split") == "test"), key, seed, shift_col, 3.0,
                             noisy_col, 7.0, 2.0, level_col, 1, 2, 0.20)
    rep = drift.drift_report(ref, cur, features)
    if out_path:
        readers.write_drift_report(rep, out_path)
    return rep


def score_records(df: DataFrame, model, version: str,
                  rules: S.ValidationRules = S.REQUEST_RULES) -> tuple[DataFrame, DataFrame]:
    """Validate (F4), fill BMI where missing (P4), score with risk band
    (K15). Returns (scored valid rows, quarantined rows with reasons)."""
    v = quality.validate(df, rules)
    if "bmi" in v.columns and {"weight", "height"} <= set(v.columns):
        v = derive.fill_bmi(v)
    valid = v.where("is_valid").drop("violations", "is_valid")
    bad = v.where(~F.col("is_valid"))
    return models.score_table(model, valid, version), bad
