"""Classification and cost metrics as aggregates.

Every metric is computed in one pass of ``count_if`` aggregates; AUC and
average precision collapse to one row per distinct score and run ordered
sums through :func:`running_sums`, so they stay exact and distributed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe import schema as S
from riskframe.functions.columns import zero_div
from riskframe.operators.ordered import running_sums

CONFUSION = ("tp", "fp", "fn", "tn")


def _truth(label: str) -> Column:
    return F.col(label).cast("int") == 1


def confusion_counts(df: DataFrame, label: str, prediction: str,
                     group_cols: tuple[str, ...] = ()) -> DataFrame:
    """tp, fp, fn, tn and n per group (A11). Rows with a null label or
    prediction are not counted."""
    y, p = _truth(label), F.col(prediction).cast("int") == 1
    valid = F.col(label).isNotNull() & F.col(prediction).isNotNull()
    return df.groupBy(*group_cols).agg(
        F.count_if(valid & y & p).alias("tp"),
        F.count_if(valid & ~y & p).alias("fp"),
        F.count_if(valid & y & ~p).alias("fn"),
        F.count_if(valid & ~y & ~p).alias("tn"),
    ).withColumn("n", F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))


def rates_from_confusion(df: DataFrame, cost_fn: float = S.COST_FALSE_NEGATIVE,
                         cost_fp: float = S.COST_FALSE_POSITIVE) -> DataFrame:
    """Technical (A12) and business (A13-A15) metrics from confusion columns.
    A zero denominator gives 0, like the reference's ``zero_division=0``."""
    tp, fp, fn, tn, n = (F.col(c) for c in (*CONFUSION, "n"))
    positives = tp + fn
    prevalence = zero_div(positives, n)
    return (df
            .withColumn("accuracy", zero_div(tp + tn, n))
            .withColumn("precision", zero_div(tp, tp + fp))
            .withColumn("recall", zero_div(tp, positives))
            .withColumn("f1", zero_div(2 * tp, 2 * tp + fp + fn))
            .withColumn("expected_cost_per_case",
                        zero_div(F.lit(cost_fn) * fn + F.lit(cost_fp) * fp, n))
            .withColumn("capture_rate", zero_div(tp, positives))
            .withColumn("false_alarm_rate", zero_div(fp, fp + tn))
            .withColumn("positives_caught_over_random",
                        tp.cast("double") - prevalence * positives)
            .withColumn("cost_weight_fn", F.lit(float(cost_fn)))
            .withColumn("cost_weight_fp", F.lit(float(cost_fp))))


def _score_counts(df: DataFrame, label: str, score: str,
                  group_cols: tuple[str, ...]) -> DataFrame:
    """One row per (group, distinct score) with positive / negative counts;
    map-side partial aggregation keeps a hot score value to one row."""
    y = _truth(label)
    return (df.where(F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(score))
            .groupBy(*group_cols, F.col(score).alias("score"))
            .agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")))


def _keyed(counts: DataFrame, group_cols: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    if group_cols:
        return counts, list(group_cols)
    return counts.withColumn("__g", F.lit(0)), ["__g"]


def ranking_from_counts(counts: DataFrame, group_cols: tuple[str, ...] = ()) -> DataFrame:
    """W1 and W2 on ``(group, score, pos, neg)`` from one ordered pass.

    ``roc_auc``: sum over scores of pos * (negatives below + ties/2), divided by P*N; null without
    both classes. ``average_precision``: over descending distinct scores, sum of (pos/P) * precision
    at that score; null without positives."""
    counts, key = _keyed(counts, group_cols)
    cum = running_sums(counts, key, "score", ["pos", "neg"])
    totals = counts.groupBy(*key).agg(F.sum("pos").alias("__p"), F.sum("neg").alias("__n"))
    same = None
    for i, c in enumerate(key):
        totals = totals.withColumnRenamed(c, f"__k_{i}")
        same = F.col(c).eqNullSafe(F.col(f"__k_{i}")) if same is None else same & F.col(c).eqNullSafe(F.col(f"__k_{i}"))
    above_pos = F.col("__p") - F.col("cum_pos") + F.col("pos")  # positives at this score or above
    above_all = above_pos + F.col("__n") - F.col("cum_neg") + F.col("neg")
    out = cum.join(totals, same).groupBy(*key, "__p", "__n").agg(
        F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2.0)).alias("__a"),
        F.sum(F.col("pos") * above_pos / above_all).alias("__s"))
    out = out.select(*key, F.when((F.col("__p") > 0) & (F.col("__n") > 0), F.col("__a") / (F.col("__p") * F.col("__n"))).alias("roc_auc"),
                     F.when(F.col("__p") > 0, F.col("__s") / F.col("__p")).alias("average_precision"))
    return out.drop("__g") if key == ["__g"] else out


def roc_auc(df: DataFrame, label: str, score: str,
            group_cols: tuple[str, ...] = ()) -> DataFrame:
    """Tie-aware ROC AUC per group."""
    return ranking_from_counts(_score_counts(df, label, score, group_cols), group_cols).drop("average_precision")


def average_precision(df: DataFrame, label: str, score: str,
                      group_cols: tuple[str, ...] = ()) -> DataFrame:
    """Step-wise average precision per group."""
    return ranking_from_counts(_score_counts(df, label, score, group_cols), group_cols).drop("roc_auc")


def evaluate(df: DataFrame, label: str, prediction: str, score: str | None = None,
             group_cols: tuple[str, ...] = (), cost_fn: float = S.COST_FALSE_NEGATIVE,
             cost_fp: float = S.COST_FALSE_POSITIVE) -> DataFrame:
    """All technical and business metrics per group, one row each.

    The rows are read once: they collapse to ``(group, score, prediction)``
    with positive / negative counts, and the confusion matrix, AUC and AP
    are all computed from that collapsed frame.
    """
    keys = list(group_cols)
    if score is None:
        out = rates_from_confusion(confusion_counts(df, label, prediction, group_cols),
                                   cost_fn, cost_fp)
        return (out.withColumn("roc_auc", F.lit(None).cast("double"))
                .withColumn("average_precision", F.lit(None).cast("double")))
    y, p = _truth(label), F.col(prediction).cast("int") == 1
    valid = F.col(label).isNotNull() & F.col(prediction).isNotNull()
    base = df.groupBy(*keys, F.col(score).alias("score"), p.alias("__p"), valid.alias("__v")).agg(
        F.count_if(y).alias("pos"), F.count_if(~y & F.col(label).isNotNull()).alias("neg"))
    # the collapsed rows feed confusion, AUC and AP: materialise them once
    from riskframe.session import cut_lineage
    base = cut_lineage(base)
    conf = base.where("__v").groupBy(*keys).agg(
        F.sum(F.when(F.col("__p"), F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("__p"), F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~F.col("__p"), F.col("pos")).otherwise(0)).alias("fn"),
        F.sum(F.when(~F.col("__p"), F.col("neg")).otherwise(0)).alias("tn"))
    conf = (conf.fillna(0, ["tp", "fp", "fn", "tn"])   # an empty input still gives one row
            .withColumn("n", F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")))
    out = rates_from_confusion(conf, cost_fn, cost_fp)
    counts = (base.where(F.col("score").isNotNull() & ~F.isnan("score"))
              .groupBy(*keys, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    ranking = ranking_from_counts(counts, group_cols)
    if group_cols:
        return out.join(ranking, keys, "left")
    one = F.lit(1).alias("__one")
    # one-row frames; the ranking's row is absent when no row has a score
    return out.select("*", one).join(F.broadcast(ranking.select("*", one)), "__one", "left").drop("__one")


def flatten_metrics(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Long form ``(keys..., metric, value)`` with ``tech.``/``biz.`` prefixes (P5)."""
    tech = ("accuracy", "precision", "recall", "f1", "roc_auc", "average_precision")
    biz = ("expected_cost_per_case", "capture_rate", "false_alarm_rate",
           "positives_caught_over_random", "cost_weight_fn", "cost_weight_fp")
    cols = [(f"tech.{c}", c) for c in tech] + [(f"biz.{c}", c) for c in biz]
    pairs = F.array(*[F.struct(F.lit(name).alias("metric"),
                               F.col(c).cast("double").alias("value")) for name, c in cols])
    return df.select(*keys, F.inline(pairs))


def subgroup_audit(df: DataFrame, label: str, prediction: str, subgroups: list[str],
                   gap: float = 0.05) -> DataFrame:
    """Metrics per subgroup level and overall in one GROUPING SETS pass
    (A30); flags levels whose F1 is more than ``gap`` from the overall F1."""
    y, p = _truth(label), F.col(prediction).cast("int") == 1
    src = (df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
           .select(*[F.col(c).cast("string").alias(c) for c in subgroups],
                   y.alias("__y"), p.alias("__p")))
    sets = [[F.col(c)] for c in subgroups] + [[]]
    body = src.groupingSets(sets, *[F.col(c) for c in subgroups]).agg(
        *[F.grouping(c).alias(f"__g_{c}") for c in subgroups],
        F.count_if(F.col("__y") & F.col("__p")).alias("tp"), F.count_if(~F.col("__y") & F.col("__p")).alias("fp"),
        F.count_if(F.col("__y") & ~F.col("__p")).alias("fn"), F.count_if(~F.col("__y") & ~F.col("__p")).alias("tn"))
    dim = F.coalesce(*[F.when(F.col(f"__g_{c}") == 0, F.lit(c)) for c in subgroups],
                     F.lit("overall"))
    level = F.coalesce(*[F.when(F.col(f"__g_{c}") == 0, F.coalesce(F.col(c), F.lit("<null>")))
                         for c in subgroups], F.lit("all"))
    m = rates_from_confusion(body.withColumn(
        "n", F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")))
    m = m.select(dim.alias("dimension"), level.alias("level"), "n", "tp", "fp", "fn", "tn",
                 "accuracy", "precision", "recall", "f1", F.lit(1).alias("__one"))
    overall = (m.where(F.col("dimension") == "overall")
               .select("__one", F.col("f1").alias("overall_f1")))
    return (m.join(F.broadcast(overall), "__one")  # one row
            .withColumn("f1_gap", F.col("f1") - F.col("overall_f1"))
            .withColumn("flag", F.abs(F.col("f1_gap")) > F.lit(gap))
            .drop("__one"))
