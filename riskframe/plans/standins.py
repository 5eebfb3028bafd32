"""Stand-in frames derived from the driver tables.

The operators are schema-agnostic; these functions map the driver's
tables onto the roles the operators expect (features, label, score,
subgroup, reference vs current sample). Each one is a projection or a
join of the given tables, so its work grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe import schema as S
from riskframe.functions.bands import run_name
from riskframe.functions.columns import hash_uniform, round_half_up, row_key, safe_div

SEED = 42
# windows over events, in days from the first event
EDGE_DAYS, REFERENCE_DAYS = 7, 20

# lineitem rules for the quality report (stand-ins for the clinical bounds)
LINEITEM_RANGES = (
    S.RangeRule("l_quantity", 1.0, 50.0),
    S.RangeRule("l_extendedprice", 1000.0, 100000.0),
    S.RangeRule("l_discount", 0.01, 0.09),
    S.RangeRule("l_tax", 0.0, 0.07),
    S.RangeRule("disc_per_tax", 0.0, 5.0),
)
LINEITEM_INVERSION = S.InversionRule(high_col="l_discount", low_col="l_tax")
LINEITEM_INVERSION_DESC = "l_tax maior que l_discount (inversao)"
LINEITEM_RULES = S.ValidationRules(
    ranges=(S.RangeRule("l_quantity", 1.0, 45.0), S.RangeRule("l_discount", 0.0, 0.08),
            S.RangeRule("l_extendedprice", 1000.0, 100000.0)),
    enums=(("l_returnflag", ("A", "N")), ("l_linestatus", ("O", "F"))),
)
LINEITEM_RULES_NUMERIC = S.ValidationRules(
    ranges=(S.RangeRule("l_quantity", 1.0, 45.0), S.RangeRule("l_discount", 0.0, 0.08)),
    enums=(("l_linestatus", ("O", "F")),),
)
LINEITEM_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINEITEM_CATEGORICAL = ("l_returnflag", "l_linestatus")
EVENT_FEATURES = ("value", "user_id", "level")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lineitem_key() -> Column:
    """Unique row key of lineitem (the four key columns repeat; the price
    in cents makes the tuple unique)."""
    cents = round_half_up(F.col("l_extendedprice") * 100).cast("long")
    return row_key("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", cents)


def quality_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem projected to a feature table; ``disc_per_tax`` is null where
    the tax is zero (a natural missing value)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(lineitem_key().alias("row_id"), *LINEITEM_NUMERIC, *LINEITEM_CATEGORICAL,
                     safe_div("l_discount", "l_tax").alias("disc_per_tax"))


def labelled_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with a key and a 0/1 label (return flag R)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(lineitem_key().alias("row_id"), *LINEITEM_NUMERIC, *LINEITEM_CATEGORICAL,
                     (F.col("l_returnflag") == "R").cast("int").alias("label"))


def clinical_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem mapped onto clinical-style measures for derived columns:
    height = quantity+150, weight = price/1000, systolic = 90+2*quantity,
    diastolic = 50+1000*tax, age in days since 1992-01-01 at ship date."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        lineitem_key().alias("row_id"),
        F.datediff(F.to_date("l_shipdate"), F.lit("1992-01-01").cast("date")).alias("age"),
        (F.col("l_quantity") + 150.0).alias("height"),
        (F.col("l_extendedprice") / 1000.0).alias("weight"),
        (F.col("l_quantity") * 2.0 + 90.0).alias("ap_hi"),
        (F.col("l_tax") * 1000.0 + 50.0).alias("ap_lo"),
        safe_div(F.col("l_extendedprice"), F.col("l_tax") * 1e6).alias("bmi_reported"),
        (F.col("l_quantity") + 20.0).alias("age_band_years"))


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels joined to documents: truth = quality, score = n_chars/20000
    capped at 1, prediction at 0.5; a second rule (cut 0.3) for pairing."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    lab = table(spark, sf_dir, "labels")
    score = F.least(F.col("n_chars") / 20000.0, F.lit(1.0))
    return (lab.join(docs, "doc_id")
            .withColumn("score", score)
            .withColumn("prediction", (F.col("score") >= S.CLASS_THRESHOLD).cast("int"))
            .withColumn("candidate", (F.col("score") >= 0.3).cast("int")))


def events_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with an integer-coded 3-level column and the number of days since the first event."""
    ev = table(spark, sf_dir, "events")
    first_day = ev.agg(F.min(F.to_date("ts"))).first()[0]
    k = F.get_json_object("props", "$.k").cast("long")
    return ev.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id",
                     "event_type", "value", (F.pmod(k, F.lit(3)) + 1).cast("int").alias("level"),
                     F.datediff(F.to_date("ts"), F.lit(first_day).cast("date")).alias("day_no"))


def drift_samples(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Reference = events of the first 20 days; current = all later ones with injected
    drift (value +3, user_id +7+N(0,2), 20 % of level 1 -> 2) and a score."""
    from riskframe.operators.drift import inject_drift
    ev = events_frame(spark, sf_dir).withColumn(
        "prediction", F.least(F.col("value") / 500.0, F.lit(1.0)))
    ref = ev.where(F.col("day_no") < REFERENCE_DAYS)
    cur = ev.where(F.col("day_no") >= REFERENCE_DAYS)
    cur = inject_drift(cur, F.col("event_id").cast("string"), SEED, "value", 3.0,
                       "user_id", 7.0, 2.0, "level", 1, 2, 0.20)
    return ref, cur


def event_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a prediction log: truth = purchase/signup, prediction = value > 50."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.col("ts").cast("timestamp").alias("ts"),
                     F.col("event_type").isin("purchase", "signup").cast("int").alias("label"),
                     (F.col("value") > 50).cast("int").alias("prediction"))


def runs_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A runs table derived from data: one run per (source, lang) of the
    labelled documents. model_family = source ('src0' plays the baseline
    'dummy'), dim_technique from lang, metrics computed from the rows, fit
    seconds = characters processed / 1e5, status FAILED under 5 rows."""
    from riskframe.operators.metrics import evaluate
    from riskframe.session import cut_lineage
    d = scored_documents(spark, sf_dir)
    fam = F.when(F.col("source") == "src0", F.lit(S.BASELINE_FAMILY)).otherwise(F.col("source"))
    tech = (F.when(F.col("lang") == "fr", "pca").when(F.col("lang") == "de", "lda")
            .otherwise("none"))
    keys = ("source", "lang")
    m = evaluate(d, "quality", "prediction", "score", keys)
    work = d.groupBy(*keys).agg((F.sum("n_chars") / 1e5).alias("fit_seconds"))
    runs = (m.join(work, list(keys))
            .select(F.md5(F.concat_ws(":", "source", "lang")).alias("run_id"),
                    F.when(F.col("n") >= 5, F.lit(S.RUN_FINISHED)).otherwise(F.lit("FAILED"))
                    .alias("status"),
                    fam.alias("model_family"), tech.alias("dim_technique"),
                    F.concat_ws("__", run_name(fam, tech), F.col("lang")).alias("run_name"),
                    "n", "f1", "roc_auc", "precision", "recall",
                    F.col("expected_cost_per_case").alias("expected_cost"), "fit_seconds"))
    # the runs table is a stored artifact: every ranking query reads it several times
    return cut_lineage(runs)


def fold_scores(spark: SparkSession, sf_dir: str, k: int = 5) -> DataFrame:
    """F1 per (run, fold) with hash folds over the documents of each run."""
    from riskframe.operators.metrics import confusion_counts, rates_from_confusion
    d = scored_documents(spark, sf_dir).withColumn(
        "fold", F.floor(hash_uniform(F.col("doc_id").cast("string"), SEED, "fold") * k)
        .cast("int"))
    m = rates_from_confusion(confusion_counts(d, "quality", "prediction",
                                              ("source", "lang", "fold")))
    return m.select(F.md5(F.concat_ws(":", "source", "lang")).alias("run_id"), "fold",
                    F.col("f1").alias("score"))
