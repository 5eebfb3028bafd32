"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Session defaults. Only applied to sessions we create ourselves; a cluster
# session keeps whatever its operator configured.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # let AQE coalesce / split the partitions of cached plans too
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    # a broadcast is only ever requested explicitly for sides with a size bound
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


PARTITION_BYTES = 256 * 1024 * 1024


def cluster_conf(input_bytes: int, executors: int = 1000, cores_per_executor: int = 4,
                 partition_bytes: int = PARTITION_BYTES) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of Parquet.

    Scan splits and shuffle partitions target ``partition_bytes`` each (so a
    task's sort/aggregate buffer fits in executor memory and spills rarely),
    and never fewer than 2 waves of the cluster's cores. AQE then coalesces
    small partitions and splits skewed ones at run time.
    """
    cores = executors * cores_per_executor
    parts = max(2 * cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def build_session(master: str = "local[8]", app: str = "riskframe",
                  shuffle_partitions: int = 8, driver_memory: str = "16g",
                  extra: dict[str, str] | None = None,
                  input_bytes: int | None = None) -> SparkSession:
    """A session with our defaults; on a cluster pass ``input_bytes`` to size
    partitions with :func:`cluster_conf`."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    if input_bytes:
        conf.update(cluster_conf(input_bytes))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; we only pick a local
    folder when the session has none (tests and local runs).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder "
                               "(HDFS / object store) for checkpoints and intermediate tables")
        # local runs and tests only: a machine-local folder is fine on one machine
        current = tempfile.mkdtemp(prefix="riskframe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on whichever file system Spark reads it from."""
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(hadoop).exists(where)


def create_exclusive(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it exists. Of any number of writers exactly one succeeds: the file
    system's own exclusive create decides (on a local disk the operating system's, as Hadoop's local file
    system looks first and creates afterwards)."""
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(hadoop)
    fs.mkdirs(where.getParent())
    if fs.getScheme() == "file":
        try:
            os.close(os.open(where.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
            return True
        except FileExistsError:
            return False
    if fs.exists(where):
        return False
    try:
        fs.create(where, False).close()
        return True
    except Py4JJavaError:
        if fs.exists(where):
            return False
        raise


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder of any file system; none if it does not exist."""
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(folder)
    fs = where.getFileSystem(hadoop)
    return [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []


#: row groups of a table in few files: a task holds one while it writes, and one while it reads
ROW_GROUP_BYTES = 16 * 1024 * 1024


def write_once(df: DataFrame, name: str, few: bool = False) -> DataFrame:
    """``df`` as a table below the shared folder, for plans that read it more than once. ``few``: one task a core
    writes, a file each, as on a local disk every file begins processes (``chmod``) that share the executor's pages
    until they have loaded."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write
    if few:
        writer = df.coalesce(df.sparkSession.sparkContext.defaultParallelism).write.option("parquet.block.size", ROW_GROUP_BYTES)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Drop the table of a :func:`write_once` result that is no longer read; a table elsewhere is left alone."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    base = path(checkpoint_dir(spark)).toUri().getPath().rstrip("/")
    for file in df.inputFiles()[:1]:
        folder = path(file).getParent()
        if folder.toUri().getPath().startswith(base + "/"):
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss, unlike a local checkpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
