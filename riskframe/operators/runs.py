"""Tracked runs: scoring, ranking, pivots and the model registry
(S6, S7, K6, K7, K13, K14, A18-A20, A29, J5, P6, P7, P10, P11, T1-T3).

The runs table is a plain DataFrame, one row per run:
``run_id, status, run_name, model_family, dim_technique, f1, roc_auc,
expected_cost, fit_seconds`` (+ any other metrics). :func:`flatten_runs`
turns the map form ``tags/params/metrics`` into it.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe import schema as S
from riskframe.functions.columns import is_missing
from riskframe.session import create_exclusive, file_names, path_exists

ONE = "__one"


def _with_one(df: DataFrame) -> DataFrame:
    return df.withColumn(ONE, F.lit(1))


def flatten_runs(runs: DataFrame, metric_keys: dict[str, str] | None = None,
                 tag_keys: dict[str, str] | None = None) -> DataFrame:
    """Map columns to flat, renamed columns (``metrics['tech.f1']`` -> ``f1``)."""
    metric_keys = metric_keys or {"tech.f1": "f1", "tech.roc_auc": "roc_auc",
                                  "tech.precision": "precision", "tech.recall": "recall",
                                  "biz.expected_cost_per_case": "expected_cost",
                                  "train.fit_seconds": "fit_seconds", "cv.mean": "cv_mean"}
    tag_keys = tag_keys or {"mlflow.runName": "run_name", "model_family": "model_family",
                            "dim_technique": "dim_technique"}
    return runs.select("run_id", "status",
                       *[F.col("tags")[k].alias(v) for k, v in tag_keys.items()],
                       *[F.col("metrics")[k].alias(v) for k, v in metric_keys.items()])


def finished(runs: DataFrame) -> DataFrame:
    """Runs whose status is FINISHED (a pushed-down parquet filter)."""
    return runs.where(F.col("status") == S.RUN_FINISHED)


def minmax(col: str, lo: Column, hi: Column) -> Column:
    """(x - min)/(max - min); a constant column maps to 0.5."""
    return F.when(hi == lo, F.lit(0.5)).otherwise((F.col(col) - lo) / (hi - lo))


def composite_score(runs: DataFrame, missing_cost: str = "max_f1") -> DataFrame:
    """0.60*F1n + 0.25*(1-costn) + 0.15*(1-timen) over finished,
    non-baseline runs with an F1. Missing cost is filled with the largest F1
    (the reference's behaviour) or, with ``missing_cost='worst'``, with the
    largest cost; missing fit time with 0."""
    r = (finished(runs)
         .where(F.coalesce(F.col("model_family"), F.lit("")) != S.BASELINE_FAMILY)  # F7
         .where(~is_missing("f1")))                                                  # F6
    r = _with_one(r)
    fill = r.groupBy(ONE).agg(F.max("f1").alias("__max_f1"),
                              F.max(F.when(~is_missing("expected_cost"), F.col("expected_cost")))
                              .alias("__max_cost"))
    fill_value = F.col("__max_f1") if missing_cost == "max_f1" else F.col("__max_cost")
    r = (r.join(F.broadcast(fill), ONE)  # one row
         .withColumn("cost_filled", F.when(is_missing("expected_cost"), fill_value)
                     .otherwise(F.col("expected_cost")))
         .withColumn("fit_filled", F.when(is_missing("fit_seconds"), F.lit(0.0))
                     .otherwise(F.col("fit_seconds")))
         .drop("__max_f1", "__max_cost"))
    stats = r.groupBy(ONE).agg(*[f(c).alias(f"__{f.__name__}_{c}")
                                 for c in ("f1", "cost_filled", "fit_filled")
                                 for f in (F.min, F.max)])
    r = r.join(F.broadcast(stats), ONE)  # one row
    f1n = minmax("f1", F.col("__min_f1"), F.col("__max_f1"))
    costn = F.lit(1.0) - minmax("cost_filled", F.col("__min_cost_filled"), F.col("__max_cost_filled"))
    fitn = F.lit(1.0) - minmax("fit_filled", F.col("__min_fit_filled"), F.col("__max_fit_filled"))
    score = (F.lit(S.WEIGHT_PERFORMANCE) * f1n + F.lit(S.WEIGHT_ROBUSTNESS) * costn
             + F.lit(S.WEIGHT_EFFICIENCY) * fitn)
    return (r.withColumn("f1_norm", f1n).withColumn("cost_norm", costn)
            .withColumn("fit_norm", fitn).withColumn("score", score)
            .drop(ONE, *[c for c in r.columns if c.startswith("__")]))


def rank_runs(scored: DataFrame) -> DataFrame:
    """Ranking, best first, ties by AUC (missing last) then run id;
    ``rank`` is 1-based. Uses the bounded running-sum operator rather than a
    window over the whole table."""
    from riskframe.operators.ordered import running_sums
    x = (scored.withColumn("__g", F.lit(0)).withColumn("__one", F.lit(1))
         .withColumn("__auc", F.coalesce(-F.col("roc_auc"), F.lit(float("inf")))))
    r = running_sums(x, ["__g"], "score", ["__one"], descending=True,
                     tie_cols=("__auc", "run_id"), prefix="__rank")
    return (r.withColumn("rank", F.col("__rank__one").cast("int"))
            .drop("__g", "__one", "__auc", "__rank__one"))


def winner(scored: DataFrame) -> DataFrame:
    """Best by (score, AUC), run id breaks remaining ties."""
    return scored.orderBy(F.col("score").desc(), F.col("roc_auc").desc_nulls_last(),
                          F.col("run_id")).limit(1)


def f1_pivot(runs: DataFrame, value: str = "f1") -> DataFrame:
    """Model family x reducer, best value."""
    return (runs.groupBy("model_family").pivot("dim_technique", list(S.DIM_TECHNIQUES))
            .agg(F.max(value)))


def mean_by(runs: DataFrame, value: str = "f1",
            keys: tuple[str, ...] = ("model_family", "dim_technique")) -> DataFrame:
    """Mean per (model, reducer)."""
    return runs.groupBy(*keys).agg(F.avg(value).alias(f"mean_{value}"),
                                   F.count(F.lit(1)).alias("n_runs"))


def delta_vs_raw(runs: DataFrame, value: str = "f1") -> DataFrame:
    """Each run's value minus the best ``none`` run of the same family."""
    raw = (runs.where(F.col("dim_technique") == "none").groupBy("model_family")
           .agg(F.max(value).alias(f"{value}_raw")))
    return (runs.join(raw, "model_family", "left")
            .withColumn(f"delta_{value}", F.col(value) - F.col(f"{value}_raw")))


def cv_summary(fold_scores: DataFrame, keys: tuple[str, ...] = ("run_id",),
               value: str = "score") -> DataFrame:
    """Mean and population std of fold scores."""
    return fold_scores.groupBy(*keys).agg(F.avg(value).alias("cv_mean"),
                                          F.stddev_pop(value).alias("cv_std"),
                                          F.count(F.lit(1)).alias("n_folds"))


def stringify_params(params: dict) -> dict[str, str]:
    """Every parameter value as a string (non-primitives via repr)."""
    out = {}
    for k, v in params.items():
        out[k] = v if isinstance(v, str) else (str(v) if isinstance(v, (int, float, bool))
                                                 or v is None else repr(v))
    return out


def append_run(spark, path: str, run_id: str, run_name: str, status: str,
               tags: dict[str, str], params: dict, metrics: dict[str, float]) -> None:
    """Append one run row to the runs table."""
    row = [(run_id, run_name, status, dict(tags), stringify_params(params),
            {k: float(v) for k, v in metrics.items()})]
    schema = ("run_id string, run_name string, status string, tags map<string,string>, "
              "params map<string,string>, metrics map<string,double>")
    spark.createDataFrame(row, schema).write.mode("append").parquet(path)


# --- registry: append-only events, current state = latest event per version

REGISTRY_SCHEMA = ("model_name string, version int, event string, stage string, "
                   "run_id string, seq long")


def registry_events(registrations: DataFrame) -> DataFrame:
    """K7 for a whole history at once: ``(model_name, position, run_id)`` in order of position
    become versions 1, 2, ...; each is registered and promoted to Production, and the version
    before it is archived. Events keep the run of their version. One window per model, over its
    registrations only."""
    order = Window.partitionBy("model_name").orderBy("position")
    rows = registrations.select("model_name", "run_id", F.row_number().over(order).alias("version"),
                                F.lead("position").over(order).isNotNull().alias("followed"))
    v = F.col("version").cast("long") * 3

    def event(name: str, stage: str, seq: Column) -> Column:
        return F.struct(F.lit(name).alias("event"), F.lit(stage).alias("stage"), seq.alias("seq"))

    made = [event("registered", "None", v - 2), event("stage_changed", "Production", v - 1)]
    gone = F.when(F.col("followed"), event("stage_changed", "Archived", v + 3))
    return (rows.select("model_name", "version", "run_id", F.explode(F.array_compact(F.array(*made, gone))).alias("e"))
            .select("model_name", "version", "e.event", "e.stage", "run_id", "e.seq"))


def registry_state(events: DataFrame) -> DataFrame:
    """Current stage per (model, version): the stage of its latest event (W6). The run is that of
    the registration, whatever later events carry."""
    registered = F.when(F.col("event") == "registered", F.col("run_id"))
    return events.groupBy("model_name", "version").agg(
        F.max_by("stage", "seq").alias("stage"), F.max(registered).alias("run_id"))


def resolve_version(events: DataFrame, model_name: str, stage: str = "Production") -> DataFrame:
    """K6: highest version in ``stage``, else highest version at all."""
    st = registry_state(events).where(F.col("model_name") == model_name)
    pref = F.when(F.col("stage") == stage, F.lit(1)).otherwise(F.lit(0))
    return st.orderBy(pref.desc(), F.col("version").desc()).limit(1)


def register_winner(spark, events: DataFrame | None, model_name: str, run_id: str,
                    promote_to: str = "Production") -> DataFrame:
    """K7: events for a new version (registered, then stage change) and the
    archiving of the versions currently in ``promote_to``. Returns only the
    new events; append them to the registry table."""
    if events is None:
        events = spark.createDataFrame([], REGISTRY_SCHEMA)
    mine = events.where(F.col("model_name") == model_name)
    top = mine.agg(F.coalesce(F.max("version"), F.lit(0)).alias("v"),
                   F.coalesce(F.max("seq"), F.lit(0)).alias("s")).first()
    v, s = int(top["v"]) + 1, int(top["s"])
    current = [(r["version"], r["run_id"]) for r in registry_state(mine)
               .where(F.col("stage") == promote_to).select("version", "run_id").collect()]
    rows = [(model_name, v, "registered", "None", run_id, s + 1),
            (model_name, v, "stage_changed", promote_to, run_id, s + 2)]
    rows += [(model_name, int(old), "stage_changed", "Archived", run, s + 3 + i)
             for i, (old, run) in enumerate(sorted(current))]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


class Registry:
    """K6 / K7 for any number of writers: versions of models in a folder of the shared file system.

    A writer claims the next version number by creating a file that only one writer can create, and
    takes the number after it when another was faster. Events are added in a folder of their own per
    write, so writers do not meet there. After its own events are written, a writer archives every lower
    version that is still in the stage; whichever of two writers looks last sees both, so one version
    stays. A writer that is lost after its claim leaves a number that no event uses.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def events(self) -> DataFrame:
        if not path_exists(self.spark, f"{self.path}/events"):
            return self.spark.createDataFrame([], REGISTRY_SCHEMA)
        return self.spark.read.schema(REGISTRY_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{self.path}/events")

    def _add(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, REGISTRY_SCHEMA).coalesce(1).write.parquet(f"{self.path}/events/{uuid.uuid4().hex}")

    def claim(self, model_name: str) -> int:
        """A version number that no other writer has."""
        folder = f"{self.path}/claims/{quote(model_name, safe='')}"
        version = max(map(int, file_names(self.spark, folder)), default=0) + 1
        while not create_exclusive(self.spark, f"{folder}/{version}"):
            version += 1
        return version

    def register(self, model_name: str, run_id: str, promote_to: str = "Production") -> int:
        """A new version of the model, in ``promote_to``; lower versions there are archived."""
        version = self.claim(model_name)
        # the events of a version are counted by themselves, so writers need no common counter
        self._add([(model_name, version, "registered", "None", run_id, 1), (model_name, version, "stage_changed", promote_to, run_id, 2)])
        self.settle(model_name, promote_to)
        return version

    def settle(self, model_name: str, stage: str = "Production") -> None:
        """Leave the highest version in the stage and archive the others."""
        mine = self.events().where(F.col("model_name") == model_name)
        last = mine.groupBy("version").agg(F.max("seq").alias("seq"))
        held = registry_state(mine).where(F.col("stage") == stage).join(last, "version").orderBy(F.col("version").desc()).collect()  # versions in one stage
        if held[1:]:
            self._add([(model_name, r["version"], "stage_changed", "Archived", r["run_id"], r["seq"] + 1) for r in held[1:]])

    def resolve(self, model_name: str, stage: str = "Production") -> DataFrame:
        return resolve_version(self.events(), model_name, stage)
