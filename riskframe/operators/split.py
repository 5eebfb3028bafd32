"""Reproducible splits, folds and samples.

Draws are ``md5(key:seed)`` uniforms: independent of partitioning and of
recomputation after an executor loss, and equal in any engine that has
md5. The default split is a per-row threshold (no shuffle); ``exact=True``
ranks rows inside each class for exact class quotas.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.columns import hash_uniform
from riskframe.session import write_once


def hash_split(df: DataFrame, key: Column, seed: int, test_size: float = 0.2,
               out_col: str = "split") -> DataFrame:
    """X1 default: ``test`` iff u(key, seed) < test_size. Streams, no shuffle;
    the class ratio is kept in expectation."""
    u = hash_uniform(key, seed)
    return df.withColumn(out_col, F.when(u < test_size, F.lit("test")).otherwise(F.lit("train")))


def class_quotas(class_counts: list[tuple], test_size: float) -> dict:
    """Test rows per class: ceil(test_size*n) in total, split by largest
    remainder; remainder ties go to the smaller class value."""
    n = sum(c for _, c in class_counts)
    n_test = math.ceil(test_size * n)
    ideal = {k: c * n_test / n for k, c in class_counts}
    quota = {k: math.floor(v) for k, v in ideal.items()}
    left = n_test - sum(quota.values())
    order = sorted(ideal, key=lambda k: (-(ideal[k] - quota[k]), k))
    for k in order[:left]:
        quota[k] += 1
    return quota


def _class_ranks(df: DataFrame, key: Column, label: str, seed: int, drop: tuple[str, ...] = ()) -> DataFrame:
    """1-based rank (``__rank``) of each row inside its class in (u, key) order, so that a dominant class
    is not one task: the rows are range partitioned and sorted, a row's place in its partition is taken
    from Spark's row ids, and the rows of a class in earlier partitions are added from a table of one
    row per class and partition. The ordered rows are written once, without the keys they are sorted by.
    Columns to ``drop`` serve the key alone and are not moved."""
    by = [label, "__u", "__key"]
    x = df.withColumn("__u", hash_uniform(key, seed)).withColumn("__key", key.cast("string")).drop(*drop)
    x = x.repartitionByRange(*by).sortWithinPartitions(*by).drop("__u", "__key")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the row's number in its partition
    written = write_once(x.withColumn("__p", F.spark_partition_id()).withColumn("__i", place), "ranked", few=True)
    held = written.groupBy(label, "__p").agg(F.min("__i").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(label).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    shift = held.select(F.col(label).alias("__c"), F.col("__p").alias("__q"),
                        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1).alias("__shift"))
    same = F.col(label).eqNullSafe(F.col("__c")) & (F.col("__p") == F.col("__q"))
    return (written.join(F.broadcast(shift), same)
            .withColumn("__rank", F.col("__i") + F.col("__shift")).drop("__c", "__q", "__p", "__i", "__shift"))


def exact_stratified_split(df: DataFrame, key: Column, label: str, seed: int,
                           test_size: float = 0.2, out_col: str = "split") -> DataFrame:
    """Exact per-class test quotas. Class counts (one row per class) are
    the only thing that reaches the driver."""
    counts = [(r[label], r["count"]) for r in df.groupBy(label).count().collect()]
    quotas = class_quotas(counts, test_size)
    q = df.sparkSession.createDataFrame(
        [(k, int(v)) for k, v in quotas.items()],
        df.select(label).schema.add("__quota", "long"))
    ranked = _class_ranks(df, key, label, seed)
    return (ranked.join(F.broadcast(q), label, "left")   # one row per class
            .withColumn(out_col, F.when(F.col("__rank") <= F.col("__quota"), F.lit("test"))
                        .otherwise(F.lit("train")))
            .drop("__rank", "__quota"))


def split_with_folds(df: DataFrame, key: Column, label: str, seed: int,
                     test_size: float = 0.2, k: int = 5, split_col: str = "split",
                     fold_col: str = "fold", drop: tuple[str, ...] = ()) -> tuple[DataFrame, dict]:
    """W4 + W5 from one ranking pass. The test rows of a class are its first
    ``quota`` rows in (u, key) order, so a training row's rank among the
    training rows is ``rank - quota``: folds come out exactly as
    :func:`stratified_folds` on the training rows would give them, without
    ranking twice. Returns the frame, without the columns to ``drop``, and the training rows per class."""
    counts = [(r[label], r["count"]) for r in df.groupBy(label).count().collect()]
    quotas = class_quotas(counts, test_size)
    q = df.sparkSession.createDataFrame(
        [(c, int(v)) for c, v in quotas.items()],
        df.select(label).schema.add("__quota", "long"))
    ranked = _class_ranks(df, key, label, seed, drop)
    test = F.col("__rank") <= F.col("__quota")
    out = (ranked.join(F.broadcast(q), label, "left")   # one row per class
           .withColumn(split_col, F.when(test, F.lit("test")).otherwise(F.lit("train")))
           .withColumn(fold_col, F.when(~test, F.pmod(F.col("__rank") - F.col("__quota") - 1,
                                                      F.lit(k)).cast("int")))
           .drop("__rank", "__quota"))
    train_counts = {c: n - quotas[c] for c, n in counts}
    return out, train_counts


def stratified_folds(df: DataFrame, key: Column, label: str, k: int, seed: int,
                     out_col: str = "fold") -> DataFrame:
    """fold = (rank-1) mod k inside each class, so fold sizes differ
    by at most one per class."""
    ranked = _class_ranks(df, key, label, seed)
    return (ranked.withColumn(out_col, F.pmod(F.col("__rank") - 1, F.lit(k)).cast("int"))
            .drop("__rank"))


def hash_sample(df: DataFrame, key: Column, fraction: float, seed: int) -> DataFrame:
    """Rows whose draw falls below ``fraction``."""
    return df.where(hash_uniform(key, seed, "sample") < fraction)


def canary_route(df: DataFrame, key: Column, seed: int, share: float,
                 candidate: str, current: str, out_col: str = "model_version") -> DataFrame:
    """Send ``share`` of the rows to the candidate version."""
    return df.withColumn(out_col, F.when(hash_uniform(key, seed, "canary") < share,
                                         F.lit(candidate)).otherwise(F.lit(current)))
