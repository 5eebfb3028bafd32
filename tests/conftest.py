import math
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from riskframe.functions.columns import hash_uniform  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").appName("riskframe-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riskframe-test-ckpt-"))
    yield s


def _spread(salt, low, high):
    """Evenly spread values of one column, from a hash of the row key."""
    return F.lit(float(low)) + hash_uniform(F.col("id").cast("string"), 7, salt) * float(high - low)


@pytest.fixture(scope="session")
def clinical(spark):
    """240 rows that satisfy the request contract. Measures are spread evenly over their ranges
    and categories go round by key; a row is positive when its pulse pressure and weight are
    large together, with one row in sixteen turned around."""
    measures = {"age_years": (31, 69), "height": (151, 194), "weight": (47, 118),
                "ap_lo": (61, 94), "bmi": (17, 41)}
    df = spark.range(240).select("id", *(F.round(_spread(c, *r), 1).alias(c) for c, r in measures.items()))
    df = df.withColumn("ap_hi", F.round(F.col("ap_lo") + _spread("gap", 24, 88), 0))
    rounds = {"gender": 2, "cholesterol": 3, "gluc": 3}
    flags = {"smoke": 5, "alco": 7, "active": 3}
    df = df.select("*", *((F.pmod(F.col("id") * (i + 3), F.lit(n)) + 1).cast("int").alias(c) for i, (c, n) in enumerate(rounds.items())),
                   *((F.col("id") % n == 0).cast("int").alias(c) for c, n in flags.items()))
    heavy = (F.col("ap_hi") - F.col("ap_lo")) / 56 + F.col("weight") / 82 > 2
    turned = F.pmod(F.xxhash64("id"), F.lit(16)) == 0
    return df.withColumn("label", (heavy != turned).cast("int")).cache()


NUMERIC = ["age_years", "height", "weight", "ap_hi", "ap_lo", "bmi"]
CATEGORICAL = ["gender", "cholesterol", "gluc", "smoke", "alco", "active"]
