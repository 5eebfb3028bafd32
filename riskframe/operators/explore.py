"""Exploratory aggregates: correlation, histograms, value counts."""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import is_missing
from riskframe.operators.gram import moments


def correlation_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation for every pair, pairwise-complete like pandas,
    in one pass of block products: ``(col_a, col_b, n, corr)``. NaN counts as missing;
    a column that does not vary has a null correlation."""
    clean = F.array(*[F.when(~is_missing(c), F.col(c).cast("double")) for c in cols])
    m = moments(df, clean, len(cols))[0]
    corr = m.correlation()
    rows = [(a, b, int(m.n[i, j]), None if np.isnan(corr[i, j]) else float(corr[i, j]))
            for (i, a), (j, b) in combinations(enumerate(cols), 2)]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, n long, corr double")


def histogram(df: DataFrame, cols: list[str], bins: int = 40) -> DataFrame:
    """Equal-width histogram per column, last bin closed:
    ``(column, bin, bin_low, bin_high, count)``; constant columns use
    [v-0.5, v+0.5] like NumPy."""
    long = (df.select(*[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot([], cols, "column", "value")
            .where(F.col("value").isNotNull() & ~F.isnan("value")))
    rng = long.groupBy("column").agg(F.min("value").alias("vmin"), F.max("value").alias("vmax"))
    rng = (rng.withColumn("lo", F.when(F.col("vmin") == F.col("vmax"), F.col("vmin") - 0.5)
                          .otherwise(F.col("vmin")))
           .withColumn("hi", F.when(F.col("vmin") == F.col("vmax"), F.col("vmax") + 0.5)
                       .otherwise(F.col("vmax"))))
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.least(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins),
                F.lit(bins - 1)).cast("int")
    counts = (long.join(F.broadcast(rng), "column")  # one row per column
              .groupBy("column", b.alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    grid = rng.select("column", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))
                      .alias("bin"))
    return (grid.join(counts, ["column", "bin"], "left")
            .select("column", "bin", (F.col("lo") + F.col("bin") * width).alias("bin_low"),
                    (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_high"),
                    F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A10: ``(value, count)``, most frequent first."""
    return df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
