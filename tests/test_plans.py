"""Physical-plan properties that matter at scale."""
import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from riskframe.operators import ordered

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filters_reach_the_parquet_scan(spark):
    plan = _plan(entry.queries()["cleaning_filter"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_quantity)" in plan or "GreaterThan(l_quantity,1.0)" in plan
    assert "GreaterThan(l_quantity,1.0)" in plan


def test_quality_report_reads_only_needed_columns(spark):
    plan = _plan(entry.queries()["quality_report"](spark, SF))
    schemas = [l for l in plan.splitlines() if l.startswith("ReadSchema")]
    assert schemas and all("l_shipdate" not in l for l in schemas)


def test_documents_text_is_never_read_for_metrics(spark):
    plan = _plan(entry.queries()["quality_date_inversion"](spark, SF))
    schemas = [l for l in plan.splitlines() if l.startswith("ReadSchema")]
    assert all("l_quantity" not in l for l in schemas)      # only keys and dates


@pytest.mark.parametrize("name", ["drift_report", "classification_report", "metric_alerts",
                                  "run_ranking", "quality_report", "subgroup_audit"])
def test_no_cartesian_products(spark, name):
    assert "CartesianProduct" not in _plan(entry.queries()[name](spark, SF))


def test_ordered_rows_are_not_windowed_by_group(spark):
    """Windows see totals by group and partition only: one range exchange moves the rows, once."""
    df = spark.range(500).select(F.lit("g").alias("grp"), (F.col("id") % 97).cast("double").alias("v"),
                                 F.lit(1).alias("w"))
    plan = _plan(ordered.running_sums(df, ["grp"], "v", ["w"], partitions=4))
    scans = [l for l in plan.splitlines() if l.startswith("ReadSchema")]
    assert len(scans) == 2 and any("v:" not in l for l in scans)  # the totals read no order column
    assert "rangepartitioning" not in plan and "BroadcastHashJoin" in plan


def test_cluster_sizing():
    from riskframe.session import cluster_conf
    conf = cluster_conf(100 * 1024 ** 4)                  # 100 TB
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600   # 256 MB partitions
    small = cluster_conf(10 * 1024 ** 3, executors=10)
    assert int(small["spark.sql.shuffle.partitions"]) == 80       # two waves of 40 cores


def test_no_machine_local_checkpoint_on_a_cluster():
    from riskframe.session import checkpoint_dir

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Ctx:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class _Session:
        sparkContext = _Ctx()
        conf = _Conf()

    with pytest.raises(RuntimeError, match="shared folder"):
        checkpoint_dir(_Session())
