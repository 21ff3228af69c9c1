"""Session builder and the two helpers that touch session-wide state."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession


def session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine is written for; ``conf`` overrides them.

    AQE stays on: it coalesces small shuffle partitions, splits skewed join partitions and
    chooses broadcast joins from measured sizes, so no operator hard-codes a broadcast of data
    that grows. On a cluster (a master is given here or by spark-submit) the number of shuffle
    partitions is the cluster's; AQE merges them to ``advisoryPartitionSizeInBytes``. Only a local
    session is given few, one for each core.
    """
    master = master or SparkConf().get("spark.master") or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if master.startswith("local["):
        cores = master[len("local[") : -1].partition(",")[0]
        settings |= {"spark.driver.memory": os.environ.get("DRIVER_MEMORY", "8g")} | ({} if cores == "*" else {"spark.sql.shuffle.partitions": cores})
    builder = SparkSession.builder.appName("millrace").master(master)
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only where the setting is absent (tests, one machine) a local temporary folder is set.
    """
    found = spark.sparkContext.getCheckpointDir()
    if found is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="millrace-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def new_dir(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet; Spark makes the folder when it writes."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder; its readers survive the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` in at least as many partitions as there are cores, for Python stages that cost far more than their bytes.

    A table in many files is read in many partitions anyway and is left as it is; only one that
    lies in a few files is shuffled, by ``key``. No row is lost either way. ``df`` must be a plain
    scan: to count the partitions of a plan with exchanges would run them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
