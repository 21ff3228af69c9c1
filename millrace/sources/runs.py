"""The store of run records: one folder per run with a ``run.json``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.expressions import is_stale

RECORD = "run_id string, status string, started_at timestamp, deadline_at timestamp, ended_at timestamp, family string, route string, error struct<code: string, message: string, stage: string>, rows map<string,int>"


def scan_runs(spark: SparkSession, path: str) -> DataFrame:
    """Every run record; the id is the folder's name, whatever the record says."""
    raw = spark.read.schema(RECORD).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "run.json").json(path)
    return raw.withColumn("run_id", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))


def with_state(runs: DataFrame, now: Column) -> DataFrame:
    """``runs`` with ``state``: a run past its deadline is stale."""
    return runs.withColumn("state", F.when(is_stale(F.col("status"), F.col("deadline_at"), now), "stale").otherwise(F.col("status")))


def run_list(runs: DataFrame, uploads: DataFrame, now: Column, waiting_s: int = 120) -> DataFrame:
    """Runs and uploads without a run in one list; an upload waits, then counts as lost."""
    a = with_state(runs, now).select("run_id", "state", F.col("started_at").alias("at"))
    age = F.unix_timestamp(now) - F.unix_timestamp("uploaded_at")
    b = uploads.join(runs.select("run_id"), "run_id", "left_anti").select("run_id", F.when(age <= waiting_s, "waiting").otherwise("no_record").alias("state"), F.col("uploaded_at").alias("at"))
    return a.unionByName(b)
